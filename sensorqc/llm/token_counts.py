"""Token counts from flat token files: a separator scan in blocks.

A token file is a plain run of little-endian ids (2 or 4 bytes each) in which
an end-of-document id closes every document; there is no index. The scan cuts
every file into byte blocks, whatever documents they cut, finds the separators
of a block in one vectorised comparison, and stitches the blocks with a prefix
scan: separators before a block give the ordinal of its first document, the
last separator before it gives that document's start. A document may span any
number of blocks.

Only blocks are ever in memory. Files are read by ``pyarrow.fs``, so any store
with a URI will do.

Cases: a null or empty text is a document of no tokens; tokens after the last
separator of a file are a document without an end (``closed`` is false); empty
files and tables give no rows; repeated rows are documents of their own; other
columns do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorqc.llm.tokens import encoder, vocabulary

END = 50256  # end of document; free in the vocabulary's ordinary ids
BLOCK = 4 << 20  # bytes
FILE = 256 << 20  # bytes after which a writer begins the next file

_ORDER = pa.schema([("path", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])
_BLOCKS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                     ("ends", pa.list_(pa.int64())), ("last_end", pa.int64())])


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END, doc_id: str = "doc_id",
                      text: str = "text", width: int = 2, file_bytes: int = FILE) -> DataFrame:
    """Writes token files below ``folder``; returns (path, ordinal, doc_id), the order of the documents.

    Run it once and keep its rows (as a written table): every attempt of a task
    writes files of its own names, and only those of the attempt that counted
    are in the rows.
    """
    vocab, kind = path or vocabulary(), {2: "<u2", 4: "<u4"}[width]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab)
        store, top = pafs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        out, name, size, ordinal = None, "", 0, 0
        for batch in batches:
            names, ordinals = [], []
            for t in batch.column(1).to_pylist():
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                    name, size, ordinal = f"{uuid.uuid4().hex}.tokens", 0, 0
                    out = store.open_output_stream(f"{top}/{name}")
                raw = np.array([*(encode(t) if t else ()), end], kind).tobytes()
                out.write(raw)
                names.append(name)
                ordinals.append(ordinal)
                size, ordinal = size + len(raw), ordinal + 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ordinals, pa.int64()),
                                              batch.column(0).cast(pa.int64())], schema=_ORDER)
        if out is not None:
            out.close()

    return (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(write, "path string, ordinal bigint, doc_id bigint"))


def scan_token_files(files: DataFrame, folder: str, end: int = END, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Documents of the files (path below ``folder``): path, ordinal, start, n_tokens, closed."""
    kind = {2: "<u2", 4: "<u4"}[width]
    block -= block % width

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        for b in batches:
            found = store.get_file_info([f"{top}/{p}" for p in b.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f.size for f in found], pa.int64())], ["path", "size"])

    def separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name, k in zip(*(c.to_pylist() for c in b.columns)):
                with store.open_input_file(f"{top}/{name}") as f:
                    ids = np.frombuffer(f.read_at(block, k * block), kind)
                first = k * block // width
                ends = np.flatnonzero(ids == end) + first
                yield pa.RecordBatch.from_pylist([{"path": name, "block": k, "first": first, "n_tokens": len(ids),
                                                   "ends": ends, "last_end": int(ends[-1]) if len(ends) else None}],
                                                 schema=_BLOCKS)

    cut = (files.select("path").distinct().mapInArrow(sizes, "path string, size bigint").filter("size > 0")
           .select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / block) - 1)).alias("block")))
    blocks = cut.repartition("path", "block").mapInArrow(
        separators, "path string, block bigint, first bigint, n_tokens bigint, ends array<bigint>, last_end bigint")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = blocks.select(
        "path", "ends", (F.col("first") + F.col("n_tokens")).alias("stop"),
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ordinal"),
        F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)).alias("start"),
        F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull().alias("last"))
    closed = stitched.select("path", "ordinal", "start", "ends", F.posexplode("ends").alias("i", "end")).select(
        "path", (F.col("ordinal") + F.col("i")).alias("ordinal"),
        F.when(F.col("i") == 0, F.col("start")).otherwise(F.get("ends", F.col("i") - 1) + 1).alias("start"), "end",
        F.lit(True).alias("closed"))
    rest = F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1).otherwise(F.col("start"))
    opened = stitched.filter("last").select("path", (F.col("ordinal") + F.size("ends")).alias("ordinal"),
                                            rest.alias("start"), F.col("stop").alias("end"), F.lit(False).alias("closed"))
    return (closed.unionByName(opened.filter("start < end"))
            .select("path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "closed"))
