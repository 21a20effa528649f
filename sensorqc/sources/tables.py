"""The stored tables (Parquet, ``dt=<day>/batch_id=<batch>``)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import lower_bound
from sensorqc.schemas import PARTITIONS, ROLLUP_SCHEMAS, TABLE_DEFAULTS, TABLE_SCHEMAS
from sensorqc.sinks.commits import CommitLog


def read_table(spark: SparkSession, path: str, as_of: datetime | None = None, hours: float | None = None,
               ts_col: str = "timestamp", partition_col: str = "dt") -> DataFrame:
    """S3: scan a table with a time lower bound.

    The bound reaches the Parquet reader as a pushed filter (row-group
    skipping); on day-partitioned tables it also prunes ``dt`` directories. Of
    a table with commit markers only committed batches are read.
    """
    log = CommitLog(spark, path)
    if log.exists():
        df = _committed(spark, log, None if as_of is None or hours is None else (as_of - timedelta(hours=hours)).date())
    else:
        df = spark.read.parquet(path)
    if hours is None:
        return df
    lower = lower_bound(as_of, hours)
    df = df.where(F.col(ts_col) >= lower)
    if partition_col in df.columns:
        df = df.where(F.col(partition_col) >= F.to_date(lower))
    return df


def _committed(spark: SparkSession, log: CommitLog, since: date | None) -> DataFrame:
    folders = [log.location(*x) for x in log.live(since)]
    name = log.path.rsplit("/", 1)[-1]
    if folders:
        return spark.read.option("basePath", log.path).parquet(*folders)
    schema = TABLE_SCHEMAS.get(name) or ROLLUP_SCHEMAS.get(name)
    if schema:
        return spark.createDataFrame([], schema)
    raise FileNotFoundError(f"{log.path} has no committed batch")


def define_tables(spark: SparkSession, base: str, database: str | None = None) -> list[str]:
    """Create the tables (if absent) as Parquet tables under ``base``.

    Columns have the defaults of :data:`sensorqc.schemas.TABLE_DEFAULTS`, so an
    ``INSERT`` may leave them out. Folders written before or since become
    visible by ``recover_partitions``.
    """
    names = []
    for name, schema in TABLE_SCHEMAS.items():
        full = f"{database}.{name}" if database else name
        default = TABLE_DEFAULTS.get(name, {})
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {default[f.name]}" if f.name in default else "")
                         for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{base.rstrip('/')}/{name}'")
        names.append(full)
    return names


def recover_partitions(spark: SparkSession, names: list[str]) -> None:
    """Makes the catalog list the days and batches that count, and no others."""
    for name in names:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        log = CommitLog(spark, _location(spark, name))
        if log.exists():
            for day, batch in sorted(set(log.folders()) - set(log.live())):
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt = DATE'{day}', batch_id = '{batch}')")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]
