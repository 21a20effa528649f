"""Best-fit packing of documents into sequences, planned on the length histogram.

Documents become pieces of at most ``seq_len`` tokens. The plan needs only the
histogram of piece lengths (``seq_len`` numbers, whatever the corpus):

1. enumerate patterns of one to three lengths that fill a sequence exactly;
2. fit how often to use each by non-negative least squares against the
   histogram, and round down to what the histogram has;
3. pack what is left by best fit, longest first, in groups of equal lengths.

Pieces are numbered within their length by their place in the written piece
table (partition, then order in it), and the plan's slots say which numbers of
a length go to which sequences. No piece is compared with another, and equal
lengths, however many, are spread over all tasks.

Cases: a null text is an empty document, its only token is ``end_id``; added
tokens of the vocabulary that stand in a text get their own ids; only
documents over ``seq_len`` tokens are cut, their first piece being the shorter
one; repeated rows are packed each; an empty table gives no sequences; other
columns do not matter.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorqc.llm.common import written
from sensorqc.llm.tokens import contract_encoder, vocabulary

SEQ_LEN = 1024
END_ID = 2
_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
           ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
_PIECES_DDL = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint")


def cut(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, end) of a document's pieces: all full but perhaps the first."""
    first = n % seq_len or min(n, seq_len)
    return [(0, first), *((a, a + seq_len) for a in range(first, n, seq_len))]


def pieces(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, with their number among the equal lengths of their partition.

    ``with_ids`` adds the ids themselves (little-endian unsigned 32-bit).
    """
    vocab = path or vocabulary()
    schema = pa.schema(_PIECES + [("ids", pa.binary())] * with_ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, seen = contract_encoder(vocab), TaskContext.get().partitionId(), [0] * (seq_len + 1)
        for batch in batches:
            rows: list[tuple] = []
            for d, t in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array([*(ids_of(t) if t else ()), end_id], "<u4")
                for k, (a, b) in enumerate(cut(len(ids), seq_len)):
                    raw = ids[a:b].tobytes()
                    rows.append((d, k, a, b - a, zlib.crc32(raw), part, seen[b - a], raw)[: len(schema)])
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)), schema)] if rows else
                                             [pa.array([], f.type) for f in schema], schema=schema)

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(encode, _PIECES_DDL + ", ids binary" * with_ids))


# -- the plan, on the histogram -----------------------------------------------------------------------------------


def patterns(seq_len: int) -> np.ndarray:
    """(p, 3) lengths of each pattern, 0 where it has fewer: single, all pairs, a fan of triples.

    For every length a the triples split the rest at a half, third, quarter and
    sixth, so every length is in a few of them.
    """
    found = {(seq_len, 0, 0)} | {(seq_len - a, a, 0) for a in range(1, seq_len // 2 + 1)}
    for a in range(1, seq_len - 1):
        for share in (2, 3, 4, 6):
            b = (seq_len - a) // share
            if b and seq_len - a - b:
                found.add(tuple(sorted((a, b, seq_len - a - b), reverse=True)))
    return np.array(sorted(found, reverse=True), np.int64)


def nnls(pats: np.ndarray, histogram: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Non-negative x that brings the patterns' lengths close to the histogram in least squares.

    Accelerated projected gradient; short lengths weigh less, as they find a
    place anyway.
    """
    n = len(histogram)
    weight = np.arange(n) / n  # 0 for absent lengths
    apply = lambda x: sum(np.bincount(c, x, n) for c in pats.T) * weight
    back = lambda r: (r * weight)[pats].sum(axis=1)
    want = histogram * weight
    v = np.ones(len(pats))
    for _ in range(30):  # the step: the largest eigenvalue
        v = back(apply(v / np.linalg.norm(v)))
    step = 1 / (np.linalg.norm(v) * 1.02)
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - want))
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, x = new + (was - 1) / t * (new - x), new
    return x


def best_fit(histogram: np.ndarray, seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs counts of equal lengths, longest first, each into the fullest sequences with room."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    room[seq_len] = {(): -1}  # as many empty sequences as needed

    def put(content: tuple[int, ...], left: int, n: int) -> None:
        if n:
            room[left][content] = room[left].get(content, 0) + n

    for length in range(seq_len, 0, -1):
        n = int(histogram[length])
        while n:
            space = min(r for r, groups in room.items() if groups and r >= length)
            content, there = next(iter(room[space].items()))
            fit = min(space // length, n)
            use = n // fit if there < 0 else min(there, n // fit)
            if there >= 0:
                if there == use:
                    del room[space][content]
                else:
                    room[space][content] = there - use
            put(content + (length,) * fit, space - fit * length, use)
            n -= use * fit
    return [(content, n) for groups in room.values() for content, n in groups.items() if content]


def plan(histogram: np.ndarray, seq_len: int = SEQ_LEN) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), using up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    pats = patterns(seq_len)
    there = np.append(left, 1)
    pats = pats[(there[np.where(pats == 0, seq_len + 1, pats)] > 0).all(axis=1)]
    used = []
    if len(pats):
        x = nnls(pats, left.astype(float))
        for i in np.argsort(-x, kind="stable"):
            lengths = tuple(int(a) for a in pats[i] if a)
            n = min([int(x[i]), *(int(left[a]) // lengths.count(a) for a in set(lengths))])
            if n > 0:
                for a in lengths:
                    left[a] -= n
                used.append((lengths, n))
    return used + best_fit(left, seq_len)


def slots(planned: list[tuple[tuple[int, ...], int]], seq_len: int = SEQ_LEN) -> dict[str, np.ndarray]:
    """Sorted by key (length, first number): the numbers from there on go to sequence, at offset."""
    taken, rows, sequence = [0] * (seq_len + 1), [], 0
    for lengths, n in planned:
        offset = 0
        for a in lengths:
            rows.append((a << 48 | taken[a], sequence - taken[a], offset))
            taken[a] += n
            offset += a
        sequence += n
    rows.sort()
    made = np.array(rows, np.int64).reshape(-1, 3)
    return {"key": made[:, 0], "shift": made[:, 1], "offset": made[:, 2]}


def place(piece_table: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """The pieces with sequence_id and offset; ``piece_table`` must be written, as its rows are read twice."""
    counts = piece_table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(seq_len + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most seq_len rows
        histogram[r["length"]] = r["n"]
    found = slots(plan(histogram, seq_len), seq_len)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    @F.pandas_udf(StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())]))
    def slot(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(found["key"], (length.to_numpy(np.int64) << 48) | number.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence_id": found["shift"][i] + number.to_numpy(np.int64), "offset": found["offset"][i]})

    return (piece_table.join(firsts, ["part", "length"])
            .withColumn("slot", slot("length", F.col("before") + F.col("nth")))
            .withColumns({"sequence_id": F.col("slot.sequence_id"), "offset": F.col("slot.offset")})
            .drop("part", "nth", "before", "slot"))


def pack(docs: DataFrame, path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    made = written(pieces(docs, path, seq_len, end_id, doc_id, text, with_ids), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return place(made, seq_len).select(*cols)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: sequence_id, ids (binary), doc_ids in order."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(inside.alias("p"))
            .select("sequence_id", F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))
