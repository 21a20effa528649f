"""Connected components by contraction, for the links of near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorqc.llm.common import checkpointed


def _roots(parents: DataFrame) -> DataFrame:
    """(id, parent) with every parent replaced by the root above it (pointer doubling)."""
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("next"))
        jumped = checkpointed(parents.join(above, "parent").select("id", "next", F.col("parent").alias("was")))
        parents = jumped.select("id", F.col("next").alias("parent"))
        if jumped.filter("next <> was").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges`` (a, b).

    Each round hangs every node below its least neighbour, if that is smaller,
    follows the parents up to the roots, and contracts the edges to roots. At
    least half of a component's nodes go each round (roots are never
    neighbours), so edges shrink geometrically and rounds are logarithmic.
    Minima are combined before they are shuffled; a hub's edges are rows of
    the larger join side, which Spark splits. Every step is checkpointed, so
    neither plans nor recomputation grow.
    """
    edges = checkpointed(edges.filter("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct())
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        both = edges.selectExpr("a as id", "b as other").union(edges.selectExpr("b as id", "a as other"))
        least = checkpointed(both.groupBy("id").agg(F.min("other").alias("other"))
                             .selectExpr("id", "least(id, other) as parent"))
        roots = _roots(least)
        rounds.append(roots)
        a, b = (roots.select(F.col("id").alias(x), F.col("parent").alias(f"root_{x}")) for x in "ab")
        edges = checkpointed(edges.join(a, "a").join(b, "b").filter("root_a <> root_b")
                             .selectExpr("least(root_a, root_b) as a", "greatest(root_a, root_b) as b").distinct())
    found = rounds.pop()
    while rounds:
        higher = found.select(F.col("id").alias("parent"), F.col("parent").alias("higher"))
        found = checkpointed(rounds.pop().join(higher, "parent", "left")
                             .select("id", F.coalesce("higher", "parent").alias("parent")))
    return found.select("id", F.col("parent").alias("component"))
