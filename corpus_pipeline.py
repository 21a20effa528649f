"""From raw documents to training sequences: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet in the shared folder and read again as the next stage's input. All
but the last keep the columns of ``documents``; the last returns the packed
pieces, of which a document taken twice has two sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorqc.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules
from sensorqc.llm.common import table, written


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps (operator 4)."""
    return quality_rules.keep(docs, version=2)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that 10 or more of them share (operator 5)."""
    return line_dedup.dedup_lines(docs, min_docs=10)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of common five-word shingles (operator 9)."""
    return minhash_dedup.dedup(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their weights (operator 2)."""
    return mixing.emit(docs, mixing.plan(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequences and places (operator 8)."""
    return packing.pack(docs, seq_len=1024)


STAGES = [
    ("quality rules", reject_by_rules),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokens and packing have no SQL form; tests replay the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
