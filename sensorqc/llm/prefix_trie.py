"""Prefix trie over conversations, by distributed burst tries.

A turn's id is 128 bits of a SHA-256 of its role and text; a conversation's
path is its turn ids in a row (16 bytes each), and its texts are not moved
beyond the ids. Conversations with equal paths are folded into one suffix with
its members' count, smallest id and digest, so copies cost nothing further.

Suffixes start in one container under the root. A container of more than
``capacity`` suffixes bursts: its head becomes a trie head, a suffix that ends
there stays with it, and every other suffix moves to the container named by
its next turn id. Heads burst level by level, all of a level in one job, until
no container is too large; only rows of oversized containers move again. The
remaining containers are dealt to tasks, sorted by path and swept with a
stack: a suffix leaves the nodes that it does not share with the one before,
and a node that is left knows its members and subtree. At last the trie heads
are summed from what hangs below them, from the deepest level up.

Scale: a container holds at most ``capacity`` suffixes (a bound on a task's
memory, with the longest conversation as the unit), a hot first turn is split
by the turns after it, and sums below a hot head are combined in the tasks. A
conversation's ids are one row (24 bytes a turn). Levels are as many as the turns that
more than ``capacity`` different conversations share. Members' ids of a path are
joined in blocks of 8,192 and hashed as a stream, so a path of
any number of copies needs no list of them in one place.

Cases: turns are ordered by turn, nulls first, ties by turn id; repeated rows
are turns of their own; a null role or text is empty; rows without a
conversation id belong to no conversation and are left out; an empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorqc.llm.common import only, runs, written

#: Most suffixes of a container that is not burst.
CAPACITY = 1024
#: Bytes of a turn id.
ID = 16
_NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
         ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
         ("top", pa.binary())]
_NODE_DDL = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
             "saved_tokens bigint, ends_sha256 string, top binary")
NO_ENDS = hashlib.sha256().hexdigest()


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, id, bytes): each conversation's turns in order, as ids and the UTF-8 bytes of their texts."""
    rows = only(rows, conv=conv, turn=turn, role=role, text=text).where("conv is not null")
    said, by = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    digest = F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256)
    ids = rows.select(F.col("conv").cast("long").alias("conv"), "turn", F.unhex(F.substring(digest, 1, 2 * ID)).alias("id"),
                      F.octet_length(said).cast("long").alias("bytes"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "id")
    return ids.select("conv", (F.row_number().over(order) - 1).alias("pos"), "id", "bytes")


def paths(placed: DataFrame) -> DataFrame:
    """(conv, path, sizes) from rows (conv, pos, id, bytes); a row without id only says that the conversation exists."""
    there = F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "id", "bytes"))))
    return (placed.groupBy("conv").agg(there.alias("t"))
            .select("conv", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("path"),
                    F.transform("t", lambda x: x["bytes"]).alias("sizes")))


def rebuilt(told: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """(conv, path, sizes) of conversations whose first h turns are those of conversation c - c % ``family``.

    h = crc32(c as text) % ``most``; a conversation's own turns follow after its first h.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = told.where("pos = 0").select("conv")
    own = told.where(F.col("pos") >= h)
    heirs = F.explode(F.sequence(F.col("conv") - (family - 1), F.col("conv") + (family - 1)))
    lent = (told.where(F.col("pos") < most - 1).where(F.col("conv") % family == 0)
            .select(F.col("conv").alias("base"), heirs.alias("conv"), "pos", "id", "bytes")
            .where((F.col("conv") - F.col("conv") % family == F.col("base")) & (F.col("pos") < h))
            .join(convs, "conv", "left_semi").select("conv", "pos", "id", "bytes"))
    here = convs.select("conv", F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("id"),
                        F.lit(None).cast("long").alias("bytes"))
    return paths(own.unionByName(lent).unionByName(here))


def fold(found: DataFrame) -> DataFrame:
    """(path, sizes, conv, n, ends): equal paths once, with their members' smallest id, number and digest."""
    key = F.sha2("path", 256)
    one = found.select(key.alias("key"), "conv", "path", "sizes")
    folded = one.groupBy("key").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"),
                                    F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    block = F.call_function("div", F.col("conv") - F.pmod("conv", F.lit(8192)), F.lit(8192))
    parts = (one.groupBy("key", block.alias("block"))
             .agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("ids")))
    ends = (parts.repartition("key").sortWithinPartitions("key", "block")
            .mapInArrow(_digests, "key string, ends string"))
    return folded.join(ends, "key").drop("key")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, digest of its parts joined by commas), a stream of rows sorted by key and place."""
    at, digest = None, None
    for batch in batches:
        keys, ends = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key == at:
                digest.update(b",")
            else:
                if digest:
                    keys.append(at)
                    ends.append(digest.hexdigest())
                at, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ends)], names=["key", "ends"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([digest.hexdigest()])], names=["key", "ends"])


def sweep(depth: int, suffixes: list[tuple[bytes, list[int], int, int, str]]) -> list[list]:
    """Nodes of one container as rows of ``_NODE``, without ``top``; the container's head (``depth`` turns) is the last.

    ``suffixes``: (path, sizes, conv, n, ends), sorted by path, different, all with the head's turns.
    """
    out: list[list] = []
    # An open node: [conv, depth, -, n_convs, n_children, n_leaves, saved, ends, its children's rows]
    start = lambda d: [None, d, None, 0, 0, 0, 0, NO_ENDS, []]
    stack, before, last = [start(depth)], b"", []

    def leave(to: int) -> None:
        while stack[-1][1] > to:
            node = stack.pop()
            close(node, last[node[1] - 1])
            above = stack[-1]
            above[0] = node[0] if above[0] is None else min(above[0], node[0])
            for k in (3, 5, 6):
                above[k] += node[k]
            above[4] += 1
            above[8].append(len(out) - 1)

    def close(node: list, size: int) -> None:
        node[5] = node[5] or 1  # a leaf
        node[6] += (node[3] - 1) * size
        for k in node.pop():
            out[k][2] = node[0]
        out.append(node)

    for path, sizes, conv, n, ends in suffixes:
        common = depth
        if before:
            a, b = np.frombuffer(before, f"V{ID}"), np.frombuffer(path, f"V{ID}")
            m = min(len(a), len(b))
            unlike = np.flatnonzero(a[depth:m] != b[depth:m])
            common = depth + int(unlike[0]) if len(unlike) else m
        leave(common)
        stack += [start(d) for d in range(common + 1, len(sizes) + 1)]
        node = stack[-1]
        node[0] = conv if node[0] is None else min(node[0], conv)
        node[3] += n
        node[7] = ends
        before, last = path, sizes
    leave(depth)
    close(stack[0], last[depth - 1] if depth else 0)
    return out


def _sweep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (head, path) -> nodes of each container; its head's row carries the head in ``top``."""
    schema = pa.schema(_NODE)
    for (head,), rows in runs(batches, ["head"]):
        columns = [rows.column(c).to_pylist() for c in ("path", "sizes", "conv", "n", "ends")]
        nodes = sweep(len(head) // ID, list(zip(*columns)))
        tops = [None] * (len(nodes) - 1) + [head]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*zip(*nodes), tops], schema)], schema=schema)


def _cut(path: str, d: int) -> Column:
    return F.substring(path, 1, ID * d)


def trie(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Nodes of the trie over (conv, path, sizes): one row per different prefix, the empty one included."""
    suffixes = written(fold(found), "suffixes")
    pending = suffixes.withColumn("head", F.lit(b"").cast("binary"))
    small: list[DataFrame] = []
    levels: list[tuple[DataFrame, DataFrame]] = []  # per level: (burst heads, suffixes that end there)
    while True:
        d = len(levels)
        sizes = pending.groupBy("head").agg(F.count(F.lit(1)).alias("held"),
                                            F.first(F.get("sizes", F.lit(d - 1)) if d else F.lit(0)).alias("own"))
        over = written(sizes.where(F.col("held") > capacity).select("head", F.col("own").cast("long")), "burst-heads")
        if over.isEmpty():
            small.append(pending)
            break
        if d:
            dealt = written(pending.join(over.select("head", F.lit(True).alias("burst")), "head", "left"), "burst")
            small.append(dealt.where("burst is null").drop("burst"))
            pending = dealt.where("burst").drop("burst")
        levels.append((over, pending.where(F.octet_length("path") == ID * d)))
        pending = (pending.where(F.octet_length("path") > ID * d).withColumn("head", _cut("path", d + 1)))
    containers = small[0]
    for more in small[1:]:
        containers = containers.unionByName(more)
    nodes = written(containers.repartition("head").sortWithinPartitions("head", "path").mapInArrow(_sweep_all, _NODE_DDL),
                    "trie-nodes")
    out = nodes.where("top is null").drop("top")
    tops = nodes.where("top is not null")  # of containers, at any depth
    above = tops
    for d in reversed(range(len(levels))):
        heads, ends = levels[d]
        below = above.where(F.col("depth") == d + 1).select(
            "conv_id", "n_convs", F.lit(1).alias("child"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"),
            _cut("top", d).alias("head"))
        here = ends.select(F.col("conv").alias("conv_id"), F.col("n").alias("n_convs"), F.lit(0).alias("child"),
                           F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), "ends", "head")
        sums = below.unionByName(here).groupBy("head").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.max("ends").alias("ends"))
        burst = written(sums.join(heads, "head").select(
            "conv_id", F.lit(d).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
            "n_children", "n_leaves", (F.col("saved") + (F.col("n_convs") - 1) * F.col("own")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), F.col("head").alias("top")), "trie-heads")
        # The tops of depth d + 1 now know their parent.
        children = above.where(F.col("depth") == d + 1)
        parents = burst.select(F.col("top").alias("head"), F.col("conv_id").alias("parent"))
        if d:
            named = children.withColumn("head", _cut("top", d)).join(parents, "head").drop("head")
        else:
            named = children.crossJoin(F.broadcast(parents.drop("head")))  # the root, one row
        out = out.unionByName(named.withColumn("parent_conv_id", F.col("parent")).drop("parent", "top"))
        above = above.where(F.col("depth") <= d).unionByName(burst)
    return out.unionByName(above.drop("top"))
