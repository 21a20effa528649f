"""Small helpers shared by the operators: tables, scratch tables, column names."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.session import ensure_checkpoint_dir

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (a Parquet file or folder)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new path below the folder that driver and executors share.

    The folder is the one the session names in ``spark.checkpoint.dir``; one is
    set only where it is unset (local sessions).
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    The table survives lost executors and cuts the lineage; it stays until the
    shared folder is cleared.
    """
    path = shared_folder(df.sparkSession, what)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder (small tables)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named input columns, under the operator's own names."""
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of equal keys; the batches must be sorted by them."""
    at, held = None, []
    for batch in batches:
        start = 0
        for key, same in itertools.groupby(zip(*(batch.column(k).to_pylist() for k in keys))):
            n = sum(1 for _ in same)
            if key != at and held:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(start, n))
            start += n
    if held:
        yield at, pa.Table.from_batches(held)
