"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard.

Shingles are mapped to places 0..D-1, a first permutation shuffles the places,
and coordinate k of the signature is the least value that a second permutation,
shifted circularly by k, takes on the set. One shifted permutation makes all
coordinates: place p contributes the K neighbours p, p+1, ... of one array, so
a signature is the column-wise minimum of contiguous slices.

1. Documents with equal sets form a class, represented by its least id; only
   classes are compared, so copies by the thousand cost one row.
2. Classes that agree in one of ``bands`` bands of ``rows`` coordinates share a
   bucket. Buckets join classes into groups by spanning forests: in buckets of
   up to ``BLOCK`` classes of pairs whose signatures agree in at least
   ``least_agreement`` coordinates, in larger ones by a star.
3. Groups are dealt into blocks, and pairs of blocks (tiles) are compared on
   the full shingle sets, most similar pairs first, leaving out pairs that the
   tile has already connected. A tile gives a spanning forest of exact links.
4. Components of the links.

With 32 bands of 4 rows a pair of similarity 0.8 is missed by all buckets with
probability (1 - 0.8 ** 4) ** 32 = 5e-8, and by the agreement test (72 of 128)
with 1e-10. No bucket or group is capped, and no group's pairs are listed.

Cases: without words (null, empty or blank text) a document links with nothing;
texts with fewer words than a shingle are one shingle; repeated rows are copies;
ties take the least doc_id; texts of any length are read whole; an empty table
gives an empty result; other columns do not matter. doc_id identifies a
document; a row with a null doc_id links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorqc.llm.common import runs, written
from sensorqc.llm.graph import components
from sensorqc.llm.shingles import mix, shingle_sets

PLACES = 1 << 20
BANDS, ROWS = 32, 4
LEAST_AGREEMENT = 72  # of BANDS * ROWS
BLOCK = 128  # classes in a block, on average
BLOCK_CHARS = 4 << 20  # characters in a block, on average
_SIGNED = ("doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint, bands array<bigint>, sketch binary")


@cache
def permutations(coordinates: int, places: int = PLACES) -> tuple[np.ndarray, np.ndarray]:
    """(first, shifted): the first permutation, and row p of the second's values at p, p+1, ..."""
    rng = np.random.default_rng(20240501)
    first = rng.permutation(places).astype(np.int32)
    second = rng.permutation(places).astype(np.uint32)
    wrapped = np.concatenate([second, second[:coordinates]])
    return first, np.lib.stride_tricks.sliding_window_view(wrapped, coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set."""
    first, shifted = permutations(coordinates)
    at = first[(shingles >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)]
    least = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(at), 2048):
        np.minimum(least, shifted[at[i: i + 2048]].min(axis=0), out=least)
    return least


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) hashes of each band's coordinates and its number."""
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return h.view(np.int64)


def signed(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Per document: size and digest of its shingle set, band hashes, and the signature's low bytes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                sets = shingle_sets(batch.column(1), k)
                full = [i for i, s in enumerate(sets) if len(s)]
                sigs = np.array([signature(sets[i], bands * rows) for i in full], np.uint32).reshape(-1, bands * rows)
                hashes = band_hashes(sigs, bands, rows)
                c1, c2, b, sk = ([None] * len(sets) for _ in range(4))
                for n, i in enumerate(full):
                    c1[i], c2[i] = np.frombuffer(xxhash.xxh3_128_digest(sets[i].tobytes()), np.int64).tolist()
                    b[i], sk[i] = hashes[n], sigs[n].astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(b, pa.list_(pa.int64())),
                     pa.array(sk, pa.binary())], ["doc_id", "n_shingles", "c1", "c2", "bands", "sketch"])

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(sign, _SIGNED))


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal coordinates of all pairs of two sets of sketches."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(0, len(a), 32):
        out[i: i + 32] = (a[i: i + 32, None, :] == b[None, :, :]).sum(axis=2, dtype=np.uint16)
    return out


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


class Union:
    """Sets of row numbers that only grow."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        """False if they were in one set."""
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _sizes_fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a[:, None], b) >= percent * np.maximum(a[:, None], b)


def groups(classes: DataFrame, percent: int, least_agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """(id, component): classes (id, n_shingles, bands, sketch) that may be linked, directly or by others."""
    rows = classes.select("id", F.explode("bands").alias("bucket"))
    shared = (rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("leader")).filter("n > 1"))
    members = written(rows.join(shared, "bucket"), "buckets")
    stars = members.filter((F.col("n") > BLOCK) & (F.col("id") != F.col("leader"))).select("id", "leader")

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bucket in runs(batches, ["bucket"]):
            sketch, size, ids = _sketches(bucket["sketch"]), bucket["n_shingles"].to_numpy(), bucket["id"].to_numpy()
            near = (_agreement(sketch, sketch) >= least_agreement) & _sizes_fit(size, size, percent)
            sets = Union(len(ids))
            found = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(near, 1))) if sets.join(int(i), int(j))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["id", "leader"])

    forest = (members.filter(F.col("n") <= BLOCK).select("bucket", "id")
              .join(classes.select("id", "n_shingles", "sketch"), "id")
              .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(forests, "id bigint, leader bigint"))
    edges = stars.unionByName(forest).select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    return components(edges)


def _exact(sets: list[np.ndarray], i: int, j: int, percent: int) -> bool:
    a, b = sets[i], sets[j]
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(members: DataFrame, k: int, percent: int, least_agreement: int = LEAST_AGREEMENT) -> DataFrame:
    """Spanning forests (a, b) of the exact links within groups: members (group, id, sketch, text)."""
    blocks = members.groupBy("group").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK, F.sum(F.length("text")) / BLOCK_CHARS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    tile = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda t: F.struct(
        F.least(t, F.col("block")).alias("i"), F.greatest(t, F.col("block")).alias("j"),
        (F.col("block") > t).alias("second")))
    dealt = (members.join(blocks, "group").withColumn("block", own).withColumn("tile", F.explode(tile))
             .select("group", "tile.*", "id", "sketch", "text"))
    order = ["group", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in runs(batches, order):
            sets = shingle_sets(rows["text"].combine_chunks(), k)
            size, ids, sketch = np.array([len(s) for s in sets]), rows["id"].to_numpy(), _sketches(rows["sketch"])
            second = np.array(rows["second"].to_pylist(), bool)
            left = np.flatnonzero(~second)
            right = left if i == j else np.flatnonzero(second)
            agree = _agreement(sketch[left], sketch[right])
            near = (agree >= least_agreement) & _sizes_fit(size[left], size[right], percent)
            if i == j:
                near = np.triu(near, 1)
            at = np.argwhere(near)
            joined, found = Union(len(ids)), []
            for a, b in at[np.argsort(-agree[near].astype(int), kind="stable")]:
                a, b = int(left[a]), int(right[b])
                if joined.find(a) != joined.find(b) and _exact(sets, a, b, percent):
                    joined.join(a, b)
                    found.append((ids[a], ids[b]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Links pairs whose sets of k-word shingles have at least ``percent`` per cent of their union in common.
    """
    every = written(signed(docs, k, doc_id=doc_id, text=text), "signatures")
    by_class = every.filter("c1 is not null and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("id"))
    by_class = written(by_class, "classes")
    classes = written(every.join(by_class.withColumnRenamed("id", "doc_id"), ["c1", "c2", "doc_id"])
                      .dropDuplicates(["doc_id", "c1", "c2"])
                      .select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sketch"), "classes")
    found = groups(classes, percent).withColumnRenamed("component", "group")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    members = written(found.join(classes.select("id", "sketch"), "id").join(texts, "id")
                      .dropDuplicates(["id"]).select("group", "id", "sketch", "text"), "members")
    parts = components(links(members, k, percent))
    judged = (by_class.join(parts, "id", "left").select("c1", "c2", F.coalesce("component", "id").alias("component")))
    component = F.coalesce("component", "doc_id")
    return (every.select("doc_id", "n_shingles", "c1", "c2").join(judged, ["c1", "c2"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def dedup(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component; rows without an id stay, of repeated rows one."""
    kept = near_duplicates(docs, k, percent, doc_id, text).filter("kept and doc_id is not null")
    key = F.col(f"`{doc_id}`")
    ids = kept.select(F.col("doc_id").alias(doc_id)).distinct()
    return (docs.filter(key.isNotNull()).join(ids, doc_id, "left_semi").dropDuplicates([doc_id])
            .unionByName(docs.filter(key.isNull())))
