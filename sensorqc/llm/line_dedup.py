"""Reversible line deduplication: exact reference counts and sharded cuckoo filters.

The state is a table of exact reference counts, one row per line key with the
number of documents that hold it. Adding documents adds their counts, deleting
documents subtracts them, so a line that was dropped comes back once enough of
its documents are gone. Beside it stand cuckoo filters, one per shard of the
key space, holding a 32-bit fingerprint of every key found in at least
``min_docs`` documents; cuckoo filters allow deletions, so they follow the
counts without being rebuilt.

Rewriting probes every line against the filters. A filter never misses a key
but may answer for a foreign one; the reference counts hold every key of the
corpus, so the keys for which it answers wrongly are known exactly and are
taken out. Filters and exceptions go to all tasks only while their measured
size is below ``FILTER_BYTES``; beyond it, the lines are joined with the
counts instead, with the same result.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased; 128-bit digests stand for keys. Blank lines have no key and
always stay.

Cases: a null or empty text is one blank line and stays as it is; a document
counts once for a key however often it repeats the line; repeated rows count
as documents of their own; texts of any length are read whole; an empty table
gives empty counts and results; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorqc.llm.common import checkpointed, fresh, written

BLANK = b" \t\n\x0b\x0c\r"
SLOTS = 4  # fingerprints in a bucket
LOAD = 0.85  # of a filter's slots
FILTER_BYTES = 32 << 20  # filters and exceptions that may go to every task
KEYS_PER_SHARD = 50_000
SHARDS = 16  # at least
REFS = "h1 bigint, h2 bigint, n_docs bigint"
FILTERS = "shard int, n_buckets bigint, slots binary"


def line_keys(text: str | None) -> list[bytes]:
    return [x.strip(BLANK).lower() for x in (text or "").encode().split(b"\n")]


def digests(keys) -> np.ndarray:
    """(n, 2) signed 64-bit halves of the keys' digests."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<i8").reshape(-1, 2)


# -- reference counts ---------------------------------------------------------------------------------------------


def line_refs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Line keys of ``docs`` with the number of documents holding each."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digests({k for k in line_keys(t) if k}) for t in batch.column(0).to_pylist()]
            rows = np.concatenate([np.empty((0, 2), np.int64), *found])
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in (0, 1)], ["h1", "h2"])

    return (docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(keys, "h1 bigint, h2 bigint")
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs")))


def add_refs(refs: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts after documents with the counts ``delta`` were added."""
    return refs.unionByName(delta).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))


def remove_refs(refs: DataFrame, delta: DataFrame) -> DataFrame:
    """Counts after documents with the counts ``delta`` were deleted."""
    return add_refs(refs, delta.withColumn("n_docs", -F.col("n_docs"))).filter("n_docs > 0")


# -- cuckoo filters -----------------------------------------------------------------------------------------------


def fingerprint(h2: np.ndarray) -> np.ndarray:
    f = (h2.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return np.where(f == 0, np.uint32(1), f)


def first_bucket(h1: np.ndarray, n_buckets) -> np.ndarray:
    return (h1.view(np.uint64) & (np.asarray(n_buckets).astype(np.uint64) - np.uint64(1))).astype(np.int64)


def other_bucket(bucket: np.ndarray, f: np.ndarray, n_buckets) -> np.ndarray:
    """The second place of a fingerprint; applied twice it gives the first again."""
    with np.errstate(over="ignore"):  # modulo 2**64
        spread = (f.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return bucket ^ (spread & (np.asarray(n_buckets).astype(np.uint64) - np.uint64(1))).astype(np.int64)


class Cuckoo:
    """One shard's filter; the number of buckets is a power of two."""

    def __init__(self, n_buckets: int, slots: np.ndarray | None = None):
        self.n_buckets = n_buckets
        self.slots = np.zeros((n_buckets, SLOTS), np.uint32) if slots is None else slots

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> Cuckoo:
        n = 1 << max(2, int(np.ceil(np.log2(max(1, len(h1)) / (SLOTS * LOAD)))))
        while not (made := cls(n)).insert(h1, h2):
            n *= 2
        return made

    @classmethod
    def read(cls, n_buckets: int, raw: bytes) -> Cuckoo:
        return cls(n_buckets, np.frombuffer(raw, np.uint32).reshape(n_buckets, SLOTS).copy())

    def places(self, h1: np.ndarray, h2: np.ndarray):
        f = fingerprint(h2)
        b = first_bucket(h1, self.n_buckets)
        return f, b, other_bucket(b, f, self.n_buckets)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """False if a key found no place; the filter is then to be built anew."""
        rng = np.random.default_rng(0)
        for f, a, b in zip(*self.places(h1, h2)):
            at, f = a, np.uint32(f)
            for hop in range(500):
                for at_ in (at, int(other_bucket(np.int64(at), f, self.n_buckets))):
                    free = np.flatnonzero(self.slots[at_] == 0)
                    if len(free):
                        self.slots[at_, free[0]] = f
                        break
                else:
                    at = int(other_bucket(np.int64(at), f, self.n_buckets)) if hop else int((a, b)[rng.integers(2)])
                    s = rng.integers(SLOTS)
                    f, self.slots[at, s] = self.slots[at, s], f
                    continue
                break
            else:
                return False
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Takes out one fingerprint for each key; the keys must be in the filter."""
        for f, a, b in zip(*self.places(h1, h2)):
            for at in (a, b):
                s = np.flatnonzero(self.slots[at] == f)
                if len(s):
                    self.slots[at, s[0]] = 0
                    break

    def row(self, shard: int) -> tuple:
        return shard, self.n_buckets, self.slots.tobytes()


def shard_of(h1, n_shards: int):
    """By the digest's top bits; buckets take the low ones."""
    if isinstance(h1, np.ndarray):
        return ((h1.view(np.uint64) >> np.uint64(40)) % np.uint64(n_shards)).astype(np.int64)
    return (F.shiftrightunsigned(h1, 40) % n_shards).cast("int")


def shard_count(refs: DataFrame, min_docs: int) -> int:
    """So many shards that each has about ``KEYS_PER_SHARD`` frequent keys."""
    return max(SHARDS, -(-refs.filter(F.col("n_docs") >= min_docs).count() // KEYS_PER_SHARD))


def build_filters(refs: DataFrame, min_docs: int, n_shards: int) -> DataFrame:
    """One filter per shard over the keys found in at least ``min_docs`` documents."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        made = Cuckoo.of(group.h1.to_numpy(np.int64), group.h2.to_numpy(np.int64))
        return pd.DataFrame([made.row(int(group.shard.iloc[0]))], columns=["shard", "n_buckets", "slots"])

    return (refs.filter(F.col("n_docs") >= min_docs).withColumn("shard", shard_of(F.col("h1"), n_shards))
            .groupBy("shard").applyInPandas(build, FILTERS))


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int, n_shards: int) -> DataFrame:
    """Filters after the counts changed: keys that crossed ``min_docs`` are put in or taken out.

    A shard whose filter overflows is built anew from the exact counts.
    """
    b = before.select("h1", "h2", (F.col("n_docs") >= min_docs).alias("was"))
    a = after.select("h1", "h2", (F.col("n_docs") >= min_docs).alias("is"))
    changed = (b.join(a, ["h1", "h2"], "full").na.fill(False, ["was", "is"]).filter("was or is")
               .withColumn("shard", shard_of(F.col("h1"), n_shards)))

    def update(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else keys).shard.iloc[0])
        pick = lambda rows: (rows.h1.to_numpy(np.int64), rows.h2.to_numpy(np.int64))
        made = Cuckoo.read(int(old.n_buckets.iloc[0]), old.slots.iloc[0]) if len(old) else None
        if made is not None:
            made.delete(*pick(keys[keys.was & ~keys["is"]]))
        if made is None or not made.insert(*pick(keys[keys["is"] & ~keys.was])):
            made = Cuckoo.of(*pick(keys[keys["is"]]))
        return pd.DataFrame([made.row(shard)], columns=["shard", "n_buckets", "slots"])

    return filters.groupBy("shard").cogroup(changed.groupBy("shard")).applyInPandas(update, FILTERS)


class Filters:
    """All shards' filters side by side, probed in arrays."""

    def __init__(self, n_shards: int, rows: list, wrong: np.ndarray | None = None):
        self.n_shards = n_shards
        self.n_buckets = np.ones(n_shards, np.int64)
        self.start = np.full(n_shards, -1, np.int64)
        tables, at = [np.zeros((1, SLOTS), np.uint32)], 1
        for r in rows:
            tables.append(np.frombuffer(r["slots"], np.uint32).reshape(-1, SLOTS))
            self.n_buckets[r["shard"]], self.start[r["shard"]] = r["n_buckets"], at
            at += r["n_buckets"]
        self.slots = np.concatenate(tables)
        self.wrong = set(map(tuple, (np.empty((0, 2), np.int64) if wrong is None else wrong).tolist()))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        s = shard_of(h1, self.n_shards)
        n, start, f = self.n_buckets[s], self.start[s], fingerprint(h2)
        a = first_bucket(h1, n)
        b = other_bucket(a, f, n)
        there = start >= 0
        hit = np.zeros(len(h1), bool)
        for at in (a, b):
            hit |= (self.slots[np.where(there, start + at, 0)] == f[:, None]).any(axis=1)
        hit &= there
        for i in np.flatnonzero(hit) if self.wrong else ():
            hit[i] = (int(h1[i]), int(h2[i])) not in self.wrong
        return hit


# -- rewriting ----------------------------------------------------------------------------------------------------

_REWRITTEN = "struct<n_lines:bigint,n_dropped:bigint,kept:string,kept_sha256:string>"


def _rewrite(texts: list, drop, with_text: bool) -> pd.DataFrame:
    """``drop(i, digests)`` marks the lines to drop among the keyed lines of text i."""
    out = []
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        lines = raw.split(b"\n")
        keys = [x.strip(BLANK).lower() for x in lines]
        keyed = [j for j, k in enumerate(keys) if k]
        gone = [j for j, g in zip(keyed, drop(i, digests([keys[j] for j in keyed])).tolist()) if g] if keyed else []
        if gone:
            dropped = set(gone)
            raw = b"\n".join([x for j, x in enumerate(lines) if j not in dropped])
        out.append((len(lines), len(gone), (raw.decode() if gone else t) if with_text else None,
                    hashlib.sha256(raw).hexdigest()))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept", "kept_sha256"]).astype(
        {"n_lines": "int64", "n_dropped": "int64"})


def _exceptions(refs: DataFrame, min_docs: int, shared, limit: int) -> np.ndarray | None:
    """Keys below ``min_docs`` for which the filters answer; None if over ``limit``."""

    def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = shared.value
        for b in batches:
            hit = probe.has(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
            yield b.filter(pa.array(hit))

    rare = refs.filter(F.col("n_docs") < min_docs).select("h1", "h2").mapInArrow(wrong, "h1 bigint, h2 bigint")
    rows = rare.limit(limit + 1).collect()
    return None if len(rows) > limit else np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2)


def rewritten(docs: DataFrame, refs: DataFrame, filters: DataFrame, n_shards: int, min_docs: int,
              text: str = "text", with_text: bool = True, max_bytes: int = FILTER_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a struct (n_lines, n_dropped, kept, kept_sha256), and the struct's name."""
    out = fresh(docs, "rewritten")
    size = filters.agg(F.coalesce(F.sum(F.octet_length("slots")), F.lit(0))).first()[0]
    if size <= max_bytes:
        sc = docs.sparkSession.sparkContext
        rows = filters.collect()  # at most max_bytes
        wrong = _exceptions(refs, min_docs, sc.broadcast(Filters(n_shards, rows)), max_bytes // 128)
        if wrong is not None:
            shared = sc.broadcast(Filters(n_shards, rows, wrong))

            @F.pandas_udf(_REWRITTEN)
            def by_filter(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
                probe = shared.value
                for texts in batches:
                    yield _rewrite(texts.tolist(), lambda _, d: probe.has(*np.ascontiguousarray(d.T)), with_text)

            return docs.withColumn(out, by_filter(F.col(f"`{text}`"))), out
    return _rewritten_by_join(docs, refs, min_docs, text, with_text, out), out


def _rewritten_by_join(docs: DataFrame, refs: DataFrame, min_docs: int, text: str, with_text: bool, out: str):
    """As ``rewritten``, by joining the lines with the counts: any number of frequent keys.

    Frequent lines make frequent join keys; Spark splits those partitions (AQE
    skew join), as the other side has one row per key.
    """
    k, hit = fresh(docs, "line_doc"), fresh(docs, "line_hits")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digests({x for x in line_keys(t) if x}) for t in batch.column(1).to_pylist()]
            rows = np.concatenate([np.empty((0, 2), np.int64), *found])
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(np.ascontiguousarray(rows[:, i])) for i in (0, 1))],
                                             ["k", "h1", "h2"])

    t = F.col(f"`{text}`")
    lines = docs.select(F.xxhash64(t).alias("k"), t.alias("t")).mapInArrow(keys, "k bigint, h1 bigint, h2 bigint")
    frequent = refs.filter(F.col("n_docs") >= min_docs).select("h1", "h2")
    hits = (lines.join(frequent, ["h1", "h2"]).groupBy(F.col("k").alias(k))
            .agg(F.collect_set(F.struct("h1", "h2")).alias(hit)))

    @F.pandas_udf(_REWRITTEN)
    def by_hits(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        sets = [{(r["h1"], r["h2"]) for r in x} if x is not None else set() for x in found]
        return _rewrite(texts.tolist(), lambda i, d: np.array([x in sets[i] for x in map(tuple, d.tolist())], bool),
                        with_text)

    joined = docs.withColumn(k, F.xxhash64(t)).join(hits, k, "left")
    return joined.withColumn(out, by_hits(t, F.col(hit))).drop(k, hit)


def state(docs: DataFrame, min_docs: int = 10, text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """Reference counts and filters of a corpus, as tables in the shared folder."""
    refs = written(line_refs(docs, text), "line-refs")
    n_shards = shard_count(refs, min_docs)
    return refs, checkpointed(build_filters(refs, min_docs, n_shards)), n_shards


def dedup_lines(docs: DataFrame, min_docs: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without the lines found in at least ``min_docs`` documents.

    Columns stay; a column ``n_chars``, if there is one, follows the new text.
    """
    refs, filters, n_shards = state(docs, min_docs, text)
    done, out = rewritten(docs, refs, filters, n_shards, min_docs, text)
    cols = {c: F.col(f"`{c}`") for c in docs.columns}
    cols[text] = F.col(f"{out}.kept")
    if "n_chars" in cols and text != "n_chars":
        changed = F.col(f"{out}.n_dropped") > 0
        cols["n_chars"] = F.when(changed, F.length(cols[text])).otherwise(cols["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return done.select(*[v.alias(c) for c, v in cols.items()])
