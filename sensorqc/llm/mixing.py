"""Mixing sources to target weights by systematic sampling.

Targets: each source's share of the mix by weight, at most ``cap`` times its
own size, the excess going to the others by weight (water filling). Within a
source every document expects target / size copies; documents are laid end to
end by these expectations in the order of their sizes, one random offset per
source is added, and a document is emitted once per integer boundary it
crosses. The order by size keeps the words taken within about one document of
the target.

Expected copies are fixed-point numbers (24 fractional bits), so prefix sums
are exact and a document's end is its successor's start.

Cases: a null source is a source of its own, after all others; a null or empty
text has size 0 and is copied like any other document; equal sizes are ordered
by doc_id (null first); identical rows (same id, source and text) are planned one by
one and emitted equally often, their mean rounded up; empty tables give empty results;
columns other than the named ones, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorqc.llm.common import WORD, checkpointed, fresh

ONE = 1 << 24  # an expectation of one copy


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: str, source: str, text: str) -> Column:
    """Identity of a row; rows that agree in all three are interchangeable."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), F.col(f"`{text}`"), F.col(f"`{doc_id}`").isNull(),
                      F.col(f"`{source}`").isNull(), F.col(f"`{text}`").isNull())


def sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"), row_key(doc_id, source, text).alias("key"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per source: source_size and target (words).

    Works on one aggregated row per source. A source is at its cap if its fair
    share of what is left, after all sources that fill up before it, is above
    the cap; sources fill up in the order of cap / weight.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (per_source.select("source", "source_size", (F.lit(cap) * F.col("source_size")).alias("cap"),
                                weight.alias("weight"))
              .withColumn("level", (F.lit(share) * F.sum("source_size").over(all_rows)
                                    - (F.sum("cap").over(filling) - F.col("cap")))
                          / (F.sum("weight").over(all_rows) - (F.sum("weight").over(filling) - F.col("weight"))))
              .withColumn("first", F.row_number().over(filling)))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    return (ranked.withColumn("level", F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("first"))).over(all_rows))
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).cast("double")
                    .alias("target")))


def plan(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
         cap: float = 2.0, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target, copies, taken.

    Documents are range-partitioned by (source, size, doc_id), which splits a
    source of any size; ranks come from each range's own numbering plus the
    counts of the ranges before it (one row per range and source).
    """
    sized = sizes(docs, doc_id, source, text)
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id").asc_nulls_first(), F.col("key")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ranged = checkpointed(checkpointed(sized).repartitionByRange(n, *order).sortWithinPartitions(*order)
                          .select("*", F.shiftright(at, 33).alias("range"),
                                  at.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    before = (Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    goal = targets(ranged, weights, share, cap).withColumn(
        "step", F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * ONE)).otherwise(0)
        .cast("long"))
    ranges = (ranged.groupBy("source", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
              .select("source", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift"))
              .alias("r").join(goal.alias("g"), F.expr("r.source <=> g.source"))
              .select("r.source", "range", "shift", "source_size", "target", "step"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("s.source"), F.lit("")))), 1, 6),
                    16, 10).cast("long")
    end = (F.col("at") + F.col("shift") + 1) * F.col("step") + offset
    copies = F.shiftright(end, 24) - F.shiftright(end - F.col("step"), 24)
    return (ranged.alias("s").join(ranges.alias("r"), F.expr("s.range = r.range and s.source <=> r.source"))
            .select("doc_id", "s.source", "key", "size", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit(docs: DataFrame, planned: DataFrame, doc_id: str = "doc_id", source: str = "source",
         text: str = "text") -> DataFrame:
    """The mix itself: every document repeated by its copies, own columns only."""
    k, c = fresh(docs, "mix_key"), fresh(docs, "mix_copies")
    per_key = planned.groupBy(F.col("key").alias(k)).agg(F.ceil(F.avg("copies")).cast("int").alias(c)).filter(f"{c} > 0")
    cols = [F.col(f"`{x}`") for x in docs.columns]
    return (docs.withColumn(k, row_key(doc_id, source, text)).join(per_key, k)
            .select(*cols, F.explode(F.array_repeat(F.lit(0), F.col(c))).alias(k)).select(*cols))
