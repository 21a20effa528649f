"""Stored tables, the metric topic and retention.

Tables are Parquet in one layout, ``dt=<day>/batch_id=<batch>``: time-bounded
reports prune days, and retention drops whole days. Every write is a batch of
its own: micro-batch n of a stream is batch ``s-<run>-<n>``, the run being the id
that its checkpoint keeps, so a replay replaces its own rows and a stream
started anew on another checkpoint touches nobody else's; a batch load gets an
id of its own. Rows count once their batch is committed
(:mod:`sensorqc.sinks.commits`), and writers do not disturb each other: each stages its files
apart. Inside a file, rows are sorted by the table's key so Parquet min/max
statistics skip row groups.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.functions.expressions import severity_rank
from sensorqc.functions.timeutil import from_micros, iso_format, ntz_literal, to_micros
from sensorqc.operators.rollups import merge_metric_rollups, merge_reading_rollups, metric_rollup, reading_rollup
from sensorqc.schemas import PARTITIONS, TABLE_CLUSTERING, TABLE_RETENTION_DAYS
from sensorqc.sinks.commits import CommitLog, new_attempt

#: Sensors that a row group's bloom filter is sized for. Row groups with few sensors have
#: a dictionary instead, which the reader checks alike; both skip a sensor that min/max cannot.
BLOOM_SENSORS = 100_000
#: Target size of a compacted file.
COMPACTED_FILE_BYTES = 256 << 20


def _ms(ts: str) -> Column:
    """Truncate to milliseconds (the stored precision)."""
    us = to_micros(F.col(ts))
    return from_micros(us - F.pmod(us, F.lit(1000)))


def _now(received_at: Column | None) -> Column:
    return received_at if received_at is not None else F.localtimestamp()


def sensor_data_rows(readings: DataFrame, received_at: Column | None = None) -> DataFrame:
    """S4 projection: 5 stored columns (``area`` dropped), ms time, defaults."""
    return readings.select(
        _ms("timestamp").alias("timestamp"), "sensor_id",
        F.col("temperature").cast("float").alias("temperature"),
        F.col("humidity").cast("float").alias("humidity"),
        F.col("wind_speed").cast("float").alias("wind_speed"),
        _now(received_at).alias("received_at"),
    ).withColumn("dt", F.to_date("timestamp"))


def metric_rows(metrics: DataFrame, created_at: Column | None = None) -> DataFrame:
    """S5 projection: metric rows as stored (float32 value and threshold)."""
    return metrics.select(
        _ms("timestamp").alias("timestamp"), "sensor_id", "metric_name",
        F.col("metric_value").cast("float").alias("metric_value"),
        F.col("threshold").cast("float").alias("threshold"),
        "status", _ms("window_start").alias("window_start"), _ms("window_end").alias("window_end"),
        _now(created_at).alias("created_at"),
    ).withColumn("dt", F.to_date("timestamp"))


def alert_rows(alerts: DataFrame, created_at: Column | None = None) -> DataFrame:
    """S6 projection: alert rows as stored, ``resolved`` false.

    ``seq`` names the evaluation, which notifications group by; the severity
    rank and the metric's place follow from the stored names.
    """
    return alerts.select(
        F.col("seq").cast("long").alias("seq"), _ms("timestamp").alias("timestamp"), "sensor_id", "alert_type", "severity", "message",
        "metric_name", F.col("metric_value").cast("float").alias("metric_value"),
        F.col("threshold").cast("float").alias("threshold"),
        F.coalesce(F.col("resolved"), F.lit(False)).alias("resolved"),
        _now(created_at).alias("created_at"),
    ).withColumn("dt", F.to_date("timestamp"))


def reject_rows(rejects: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Rejected messages as stored: arrival number, reason, raw text, time of rejection."""
    seq = F.col("seq") if "seq" in rejects.columns else F.lit(None)
    return rejects.select(seq.cast("long").alias("seq"), "reject_reason", "raw",
                          _now(rejected_at).alias("rejected_at")).withColumn("dt", F.to_date("rejected_at"))


def cluster_for_write(df: DataFrame, table: str, files: int | None = None) -> DataFrame:
    """Range-partition by (day, table key) and sort by it.

    The day comes first in both, because the writer keeps an order that begins
    with the partition columns (any other order it sorts away), and so that a
    task writes few days: with n ranges over d days there are at most n + d
    files. Ranges give files with disjoint keys, which makes min/max skipping
    effective. ``files`` bounds the number of ranges (default: the session's
    shuffle partitions).
    """
    if "severity_rank" in TABLE_CLUSTERING[table]:
        df = df.withColumn("severity_rank", severity_rank())
    keys = [F.col(k) for k in (*[p for p in PARTITIONS if p in df.columns], *TABLE_CLUSTERING[table])]
    out = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys).drop("severity_rank")


def run_of(spark: SparkSession) -> str | None:
    """Inside ``foreachBatch``, the running query's id, which its checkpoint keeps over restarts; else None."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_name(batch_id: int | str | None, run: str | None = None) -> str:
    """``s-<run>-<n>`` for a stream's micro-batch, the caller's text, or a new name for a load."""
    if batch_id is None:
        return f"load-{uuid.uuid4().hex}"
    return f"s-{run or 'none'}-{batch_id:010d}" if isinstance(batch_id, int) else batch_id


def write_batch(df: DataFrame, path: str, table: str, batch_id: int | str | None = None, cluster: bool = True,
                files: int | None = None, run: str | None = None) -> None:
    """Writes rows (with ``dt``) as one batch of the table; a batch written again replaces itself.

    ``run`` names the stream that an integer ``batch_id`` belongs to (default:
    the streaming query this is called from).
    """
    spark = df.sparkSession
    log = CommitLog(spark, path)
    batch = batch_name(batch_id, run or run_of(spark))
    attempt = new_attempt(batch)
    again = batch_id is not None and log.begin(batch)
    days = _stage(df, log, attempt, table, cluster, files)
    old = {x for x in log.attempts(batch) if x[1] != attempt} if again else set()
    if days or old or not log.exists():  # a table whose first batch is empty can be read, too
        log.commit(attempt, old)
    if old:
        log.clean_up()
    if batch_id is not None:
        log.finished(batch)


def _stage(df: DataFrame, log: CommitLog, attempt: str, table: str, cluster: bool, files: int | None) -> list[str]:
    """Writes the rows apart and moves their day folders into the table, where they do not count yet."""
    if cluster:
        df = cluster_for_write(df, table, files)
    writer = df.write.partitionBy("dt")
    if "sensor_id" in df.columns:
        writer = (writer.option("parquet.bloom.filter.enabled#sensor_id", "true")
                  .option("parquet.bloom.filter.expected.ndv#sensor_id", str(BLOOM_SENSORS)))
    writer.parquet(log.staged(attempt))
    return log.move_in(attempt)


def append_readings(readings: DataFrame, path: str, batch_id: int | str | None = None, cluster: bool = True,
                    received_at: Column | None = None, files: int | None = None, run: str | None = None) -> None:
    """Append readings to ``sensor_data``."""
    write_batch(sensor_data_rows(readings, received_at), path, "sensor_data", batch_id, cluster, files, run)


def append_metrics(metrics: DataFrame, path: str, batch_id: int | str | None = None, cluster: bool = True,
                   created_at: Column | None = None, files: int | None = None, run: str | None = None) -> None:
    """Append metric rows to ``quality_metrics``."""
    write_batch(metric_rows(metrics, created_at), path, "quality_metrics", batch_id, cluster, files, run)


def append_alerts(alerts: DataFrame, path: str, batch_id: int | str | None = None, cluster: bool = True,
                  created_at: Column | None = None, files: int | None = None, run: str | None = None) -> None:
    """Append alerts to ``alerts``."""
    write_batch(alert_rows(alerts, created_at), path, "alerts", batch_id, cluster, files, run)


def append_rejects(rejects: DataFrame, path: str, batch_id: int | str | None = None,
                   rejected_at: Column | None = None, run: str | None = None) -> None:
    """Append rejected messages to ``rejects`` (not clustered)."""
    write_batch(reject_rows(rejects, rejected_at), path, "rejects", batch_id, cluster=False, run=run)


def append_rollups(readings: DataFrame, metrics: DataFrame, base: str, batch_id: int | str | None = None,
                   files: int | None = None, run: str | None = None) -> None:
    """The hourly partial aggregates of readings and metrics, of the values as stored."""
    reading_rows = reading_rollup(sensor_data_rows(readings))
    write_batch(reading_rows, f"{base}/reading_rollups", "reading_rollups", batch_id, cluster=False, run=run)
    write_batch(metric_rollup(metric_rows(metrics)), f"{base}/metric_rollups", "metric_rollups", batch_id, files=files, run=run)


#: How compaction merges the rows of a table; those of others stay as they are.
MERGES = {"metric_rollups": merge_metric_rollups, "reading_rollups": merge_reading_rollups}


def compact_day(spark: SparkSession, path: str, table: str, day: str, files: int | None = None,
                file_bytes: int = COMPACTED_FILE_BYTES) -> None:
    """Rewrites the batches of a finished day as one batch of sorted files; partial aggregates are merged.

    There are as many files as the day's measured bytes need (``files``
    overrides). One commit puts the new batch in the place of the old ones: a
    reader sees either, and a writer that dies leaves the day as it was or as it is to be.
    """
    log = CommitLog(spark, path)
    old = [x for x in log.live() if x[0] == day]
    if not old:
        return
    files = files or max(1, -(-log.size(old) // file_bytes))
    rows = spark.read.option("basePath", path).parquet(*[log.location(*x) for x in old])
    attempt = new_attempt(f"compact-{uuid.uuid4().hex}")
    _stage(MERGES.get(table, lambda df: df)(rows.drop("batch_id")), log, attempt, table, True, files)
    log.commit(attempt, old)
    log.clean_up()


def metric_records(metrics: DataFrame) -> DataFrame:
    """S7 projection: the published record (ISO times) and its JSON text."""
    rec = metrics.select(
        iso_format("timestamp").alias("timestamp"), "sensor_id", "metric_name",
        F.col("metric_value").alias("value"), "threshold", "status",
        iso_format("window_start").alias("window_start"), iso_format("window_end").alias("window_end"),
    )
    return rec.withColumn("value_json", F.to_json(F.struct(*[F.col(c) for c in rec.columns])))


def publish_metrics(metrics: DataFrame, fmt: str = "kafka", options: dict | None = None,
                    path: str | None = None, batch: str | None = None) -> None:
    """Write metric records as JSON messages (batch; streams use foreachBatch).

    Kafka needs ``kafka.bootstrap.servers`` and ``topic`` in ``options``;
    other formats write keys and values to ``path``, a named ``batch`` to a
    folder of its own there, which it replaces when it is published again.
    """
    out = metric_records(metrics).select(F.col("sensor_id").alias("key"), F.col("value_json").alias("value"))
    writer = out.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("overwrite" if batch else "append").save(f"{path}/batch_id={batch}" if batch else path)


def apply_retention(df: DataFrame, ts_col: str = "timestamp", days: int | None = None,
                    as_of: datetime | None = None, table: str | None = None) -> DataFrame:
    """Keep rows younger than the retention (``ts + days > as_of``)."""
    days = days if days is not None else TABLE_RETENTION_DAYS[table]
    if as_of is None:
        bound = F.timestamp_add("DAY", F.lit(-days), F.localtimestamp())
    else:
        bound = ntz_literal(as_of - timedelta(days=days))
    return df.where(F.col(ts_col) > bound)


def expired_partitions(spark: SparkSession, path: str, days: int, as_of: datetime) -> list[str]:
    """S11 on disk: ``dt`` partition directories entirely past retention.

    Lists folder names only; a day is expired when its last instant is past
    the bound.
    """
    cutoff = (as_of - timedelta(days=days)).date().isoformat()
    return [f"{path.rstrip('/')}/dt={day}" for day in CommitLog(spark, path).days() if day < cutoff]


def drop_expired(spark: SparkSession, path: str, days: int, as_of: datetime, name: str | None = None) -> list[str]:
    """S11 on disk: deletes the expired days of a table, from its folders and, if ``name`` is given, its catalog.

    The days go by one commit; what a crash leaves on disk no reader sees, and
    the next call (or any ``clean_up``) deletes it. Returns the dropped days.
    """
    log = CommitLog(spark, path)
    gone = [p.rsplit("=", 1)[1] for p in expired_partitions(spark, path, days, as_of)]
    if gone:
        log.commit(new_attempt(f"expire-{uuid.uuid4().hex}"), [x for x in log.folders() if x[0] in gone])
        log.clean_up()
        log.drop_days(gone)
        if name:
            for listed in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator():
                day, batch = (x.split("=", 1)[1] for x in listed[0].split("/"))
                if day in gone:
                    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt = DATE'{day}', batch_id = '{batch}')")
    return gone
