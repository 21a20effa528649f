"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Equal vectors of a label are first folded into one class with a count. Classes
are assigned to the cell of the nearest centroid (centroids are fitted on a
bounded sample, see ``SAMPLE``; every vector is assigned). A vector whose
distance to the border of another cell is at most ``margin`` also visits that
cell, so that links across a border are found. Within (label, cell) the
vectors are dealt into blocks, and pairs of blocks are compared by one matrix
product each, in double precision. A product yields counts per vector and a
spanning forest of its links, never the pairs themselves.

Two vectors of cosine c are a chord of sqrt(2 - 2c) apart. The border distances
of two vectors in different cells add up to the chord's projection on the line
between the centroids, so one of them is within half a chord of the border.
The default ``margin`` is that half, with which no link can be missed.

Cases: vectors that are null, empty or zero, or hold null or non-finite
components, and those without a label or a vec_id, link with nothing and are kept
(with a null component where the vec_id is null); vectors of different lengths do not link; rows that repeat a vector link with each other; an empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from sensorqc.llm.common import checkpointed, runs, written
from sensorqc.llm.graph import components

SAMPLE = 20_000  # vectors, at most, on which centroids are fitted
MAX_CELLS = 4096
BLOCK = 1024  # vectors in a block, on average
ROWS = 512  # vectors compared with all centroids at a time
THRESHOLD = 0.98
_FOUND = "id bigint, n_links bigint, least bigint"


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest component, against overflow)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k unit centroids of the unit rows x; empty cells keep their centroid."""
    c = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        cell = np.concatenate([(x[i: i + ROWS] @ c.T).argmax(axis=1) for i in range(0, len(x), ROWS)])
        total = np.zeros_like(c)
        np.add.at(total, cell, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def classes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
            label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows have vec_id, label, v (null if it can link with nothing); classes id, label, v, n."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = (~bad) & F.exists(v, lambda x: x != 0) & F.col(f"`{label}`").isNotNull() & F.col(f"`{vec_id}`").isNotNull()
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                          F.when(fine, v).alias("v"))
    found = (rows.filter("v is not null").groupBy("label", "v")
             .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")))
    return rows, found


def fit_cells(found: DataFrame, n: int, dim: int) -> np.ndarray:
    """Centroids for n classes: about sqrt(n) / 16, at most MAX_CELLS, from at most SAMPLE classes."""
    sample = (found.filter(F.size("v") == dim).select("v").orderBy(F.xxhash64("id", "label"), "id").limit(SAMPLE).collect())
    x = unit(np.array([r["v"] for r in sample], float))
    return spherical_kmeans(x, max(1, min(MAX_CELLS, int(np.sqrt(n) / 16), len(x))))


def assigned(found: DataFrame, centroids: np.ndarray, margin: float) -> DataFrame:
    """classes with ``cells``: the own cell first, then those whose border is within the margin.

    Vectors of another length than the centroids' are all in one cell, -1.
    """
    def visited(x: np.ndarray) -> list[list[int]]:
        near = x @ centroids.T
        own = near.argmax(axis=1)
        gap = np.sqrt(np.maximum(2 - 2 * centroids[own] @ centroids.T, 1e-24))  # between the two centroids
        border = (near[np.arange(len(x)), own][:, None] - near) / gap
        return [[int(o), *(int(j) for j in np.flatnonzero(row) if j != o)] for o, row in zip(own, border <= margin)]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                b = whole.slice(start, ROWS)
                vs = b.column("v").to_pylist()
                out = [[-1]] * len(vs)
                at = [i for i, v in enumerate(vs) if len(v) == centroids.shape[1]]
                if at:
                    for i, c in zip(at, visited(unit(np.array([vs[i] for i in at], float)))):
                        out[i] = c
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))],
                                                 [*b.schema.names, "cells"])

    return found.mapInArrow(cells, StructType([*found.schema, StructField("cells", ArrayType(IntegerType()))]))


def _forest(hit: np.ndarray) -> np.ndarray:
    """Least row reachable from each row by the symmetric matrix ``hit``."""
    label = np.arange(len(hit))
    while True:
        new = np.minimum(label, np.where(hit, label[None, :], len(hit)).min(axis=1, initial=len(hit)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(tile: pa.Table, kind: int, same: bool, threshold: float) -> list[tuple[int, int, int]]:
    """(id, links, least id reachable) for the vectors of one tile that have links.

    kind 0: two blocks at home (``same``: one with itself); kind 1: visitors against a home block.
    """
    side = tile["side"].to_numpy()
    ids, n = tile["id"].to_numpy(), tile["n"].to_numpy()
    v = unit(tile["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1))
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    hit = (v[left] @ v[right].T) >= threshold
    if same:
        np.fill_diagonal(hit, False)
    if kind == 1 and hit.any():  # pairs that both sides find count where the visitor has the smaller id
        cells = tile["cells"].to_pylist()
        home = np.array([cells[i][0] for i in left])
        for h in np.unique(home):
            back = np.array([h in cells[j] for j in right])
            hit &= ~((home == h)[:, None] & back & (ids[left][:, None] > ids[right]))
    links = np.zeros(len(ids), np.int64)
    links[left] += hit @ n[right]
    square = np.zeros((len(ids),) * 2, bool)
    square[np.ix_(left, right)] = hit
    if not same:
        links[right] += hit.T @ n[left]
        square |= square.T
    least = ids[_forest(square)]
    return [(int(ids[i]), int(links[i]), int(least[i])) for i in np.flatnonzero(links)]


def links(cells: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(id, n_links, least): partial counts of links, and edges that connect what is linked."""
    visit = cells.select("id", "label", "v", "n", "cells", F.posexplode("cells").alias("visit", "cell"))
    visit = visit.withColumn("home", F.col("visit") == 0).withColumn("dim", F.size("v"))
    keys = ["label", "dim", "cell"]
    sizes = visit.groupBy(*keys).agg(
        F.ceil(F.count_if("home") / block).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / block).cast("int").alias("guests"))
    sized = visit.join(sizes.filter("homes > 0"), keys)
    own = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int")
    tile = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    b = F.col("block")
    at_home = F.concat(
        F.transform(upto(F.col("homes")), lambda k: tile(0, F.least(k, b), F.greatest(k, b),
                                                         F.when(k < b, F.lit(1)).otherwise(F.lit(0)))),
        F.transform(upto(F.col("guests")), lambda k: tile(1, k, b, F.lit(1))))
    visiting = F.transform(upto(F.col("homes")), lambda k: tile(1, b, k, F.lit(0)))
    dealt = (sized.withColumn("block", own)
             .withColumn("tile", F.explode(F.when(F.col("home"), at_home).otherwise(visiting)))
             .select(*keys, "tile.*", "id", "v", "n", "cells"))
    order = [*keys, "kind", "i", "j"]

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, tile in runs(batches, order):
            found = _compare(tile, key[3], key[3] == 0 and key[4] == key[5], threshold)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                 ["id", "n_links", "least"])

    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(tiles, _FOUND)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, margin: float | None = None,
                    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, found = classes(vectors, vec_id, embedding, label)
    found = checkpointed(found)
    dims = found.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    centroids = fit_cells(found, dims["count"], dims["dim"])
    chord = float(np.sqrt(2 - 2 * threshold))
    width = chord / 2 * (1 + 1e-9) + 1e-9 if margin is None else margin  # a little more, against rounding
    found_links = written(links(assigned(found, centroids, width), threshold), "vector-links")
    counts = found_links.groupBy("id").agg(F.sum("n_links").alias("links"))
    parts = components(found_links.select(F.col("id").alias("a"), F.col("least").alias("b")))
    judged = (found.join(counts, "id", "left").join(parts, "id", "left")
              .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                      F.coalesce("component", "id").alias("component")))
    out = rows.join(judged, ["label", "v"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
