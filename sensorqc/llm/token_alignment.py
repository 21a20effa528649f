"""Alignment of two tokenizers' ids over the same text, with corpus-wide link counts.

Every document is encoded whole by both tokenizers. Byte offsets where a token
of each ends are shared ends. They cut the tokens into groups; a group links
every one of its A tokens with every one of its B tokens.

The corpus-wide part: an id pair counts the documents that hold it linked, and
each document is told the counts of its links.

1. A task gathers the distinct pairs of its documents in blocks of bounded
   size, deals them to shards by the pair's ids, and writes them in short rows
   (postings) together with the documents' own figures. Texts and tokens are
   read once and never shuffled.
2. Counts per pair are summed from the postings, where each row has already
   combined its documents; a pair is the best of its A id if no other has more.
3. Counts and postings meet by shard. A task streams the postings past the
   counts of one shard at a time and returns sums per document, packed by
   block; a task adds up the sums of one block at a time. A frequent
   pair has one entry per document, spread over as many rows; a shard's counts
   are its share of the distinct pairs, which the two vocabularies bound. As
   many shards are used as the session has shuffle partitions.

Encoding and alignment go by chunks, a chunk being a stretch between two spaces
that have a non-space on both sides. No match of the byte-level vocabulary's
pattern and no piece of the other vocabulary goes on from a non-space into a
space (the latter is looked up in the vocabulary; where one does, whole texts
are encoded), so the chunks' ids joined are the text's, every chunk ends in a
shared end, and its groups depend on itself alone. Documents are taken a few
megabytes at a time: a chunk that several of them hold is encoded and aligned
once, and remembered for those to come.

Cases: documents whose text is null or empty, or whose tokens do not spell
space + text (a text that holds U+2581, say), have no tokens: zeros and an
empty ``groups_sha256``. Repeated rows and clashing or null ids are documents of
their own. Special tokens' strings are plain text. Very long texts are
processed whole; chunks are remembered from the second time on, those over 64
tokens never. A text with a chunk that does not spell itself is compared
whole. An empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorqc.llm.common import written
from sensorqc.llm.tokens import encoder, token_bytes, vocabulary

#: More documents than a block has.
_DOCS = 1 << 16


_FIELDS = [("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
           ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
           ("shard", pa.int32()), ("codes", pa.list_(pa.int64())), ("n_docs", pa.list_(pa.int32())),
           ("docs", pa.list_(pa.int32())), ("links", pa.list_(pa.int32()))]
_SCHEMA = pa.schema(_FIELDS)
_DDL = ("block bigint, doc int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, groups string, shard int, codes array<bigint>, n_docs array<int>, docs array<int>, "
        "links array<int>")


class Bounds(NamedTuple):
    """What a task keeps at most; no bound changes results."""

    #: Chunks that a worker remembers before it starts anew.
    memo: int = 250_000
    #: Characters and tokens of a chunk that is remembered.
    memo_chars: int = 48
    memo_tokens: int = 64
    #: Links (an id pair as often as a document's chunks hold it) and documents (below 65,536) of a block; a document is not split.
    block_pairs: int = 1 << 20
    block_docs: int = (1 << 16) - 1
    #: Entries of a posting row.
    row_pairs: int = 1 << 10
    #: Bytes of the texts taken together; a text is not split.
    part_bytes: int = 1 << 21


class Repeats:
    """Which keys have been seen before, by one byte per hash: only those are worth remembering."""

    def __init__(self, size: int = 1 << 22):
        self.mask, self.marks, self.n = size - 1, bytearray(size), 0

    def of(self, keys: list) -> list:
        """The keys seen before; the others have been seen now."""
        if self.n > self.mask >> 2:
            self.__init__(self.mask + 1)
        marks, mask, out = self.marks, self.mask, []
        for key in keys:
            at = hash(key) & mask
            if marks[at]:
                out.append(key)
            else:
                marks[at] = 1
        self.n += len(keys) - len(out)
        return out


class Encoders:
    """Both tokenizers of a worker; ids are little-endian uint32."""

    #: Characters of chunks that are encoded in one call.
    call_chars = 1 << 12

    def __init__(self, path_a: str, path_b: str, bounds: Bounds = Bounds()):
        self.bounds = bounds
        self.of_a, self.of_b = encoder(path_a), encoder(path_b)
        self.bytes_a, self.bytes_b = token_bytes(path_a), token_bytes(path_b)
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # B's pieces must not go on from a non-space into a space.
        self.split = not any(b" " in piece.lstrip(b" ") for piece in self.bytes_b)
        # The space comes first in the pattern, which is searched for faster than a condition.
        self.chunks = re.compile(r" (?<=\S )(?=\S)").split if self.split else lambda text: [text]
        #: What A and B spell for the chunks encoded since it was cleared that they do not both spell as they are.
        self.odd: dict[str, tuple[bytes, bytes]] = {}

    def _encode(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids by A and by B, and whether both spell space + text."""
        a, b = self.of_a(f" {text}"), self.of_b(text)
        raw = f" {text}".encode()
        same = raw == b"".join([self.bytes_a[i] for i in a]) == b"".join([self.bytes_b[i] for i in b])
        return np.array(a, "<u4"), np.array(b, "<u4"), same

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, B ids, how many A and how many B ids each chunk has, whether they spell space + chunk).

        Most chunks are encoded by calls over many of them with spaces between.
        Only a text's first and last chunk can be empty or begin or end in white
        space; these are encoded alone, as are those with U+2581, which B gives
        back as a space.
        """
        n = np.zeros((2, len(chunks)), np.int64)
        same = np.ones(len(chunks), bool)
        ids: tuple[list, list] = ([], [])
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        alone = np.array([not c or c[0].isspace() or c[-1].isspace() or "▁" in c for c in chunks], bool) | (not self.split)
        calls = np.cumsum(lengths) // self.call_chars
        first = np.flatnonzero(np.r_[True, (calls[1:] != calls[:-1]) | alone[1:] | alone[:-1]][:len(chunks)]).tolist()
        for at, end in zip(first, [*first[1:], len(chunks)]):
            if end - at > 1:
                text = " ".join(chunks[at:end])
                a, b, spelled = self._encode(text)
                if spelled:
                    ends = np.cumsum(lengths[at:end] if text.isascii() else [len(c.encode()) + 1 for c in chunks[at:end]])
                    for side, sizes, x in ((0, self.len_a, a), (1, self.len_b, b)):
                        n[side, at:end] = np.diff(np.searchsorted(np.cumsum(sizes[x]), ends) + 1, prepend=0)
                        ids[side].append(x)
                    continue
            for k in range(at, end):
                *found, same[k] = self._encode(chunks[k])
                if not same[k]:
                    self.odd[chunks[k]] = tuple(b"".join([t[i] for i in x]) for t, x in zip((self.bytes_a, self.bytes_b), found))
                for side, x in enumerate(found):
                    n[side, k] = len(x)
                    ids[side].append(x)
        a, b = (np.concatenate([np.zeros(0, "<u4"), *x]) for x in ids)
        return a, b, n[0], n[1], same

    def spelled(self, parts: list[str]) -> bool:
        """Whether the ids of a text's chunks, some of them odd, together spell space + text."""
        raw = "".join([f" {c}" for c in parts]).encode()
        return all(raw == b"".join([self.odd[c][side] if c in self.odd else f" {c}".encode() for c in parts]) for side in (0, 1))

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of space + text by A and of text by B; None where they do not spell space + text."""
        parts = self.chunks(text)
        a, b, _, _, same = self.encode(parts)
        if not same.all() and not self.spelled(parts):
            return None
        return a, b


class Aligned(NamedTuple):
    """Alignments of some chunks or texts."""

    #: Four rows: A tokens, B tokens, groups (-1 where the ids spell something else) and links of each.
    figures: np.ndarray
    #: Their groups as text, each with a semicolon after it.
    texts: list[str]
    #: Where each one's pairs begin in ``pairs``, with the end; a pair stands there once per link.
    starts: np.ndarray
    pairs: np.ndarray
    #: Of some, by number, the pairs of their large groups, with links per pair.
    large: dict[int, list[tuple[np.ndarray, np.ndarray]]]


def _groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each A and each B token, whether it ends a group: whether both have an end there."""
    seen = np.zeros(int(ends_a[-1]) + 1, np.int8)
    seen[ends_a] = 1
    seen[ends_b] += 2
    return seen[ends_a] == 3, seen[ends_b] == 3


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of some ranges, one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Part(NamedTuple):
    """Alignments of some documents: the numbers in ``made`` of each one's chunks lie between its ``ends``."""

    made: Aligned
    numbers: np.ndarray
    ends: np.ndarray


class Chunks:
    """A worker's memo of chunk alignments. A pair of ids is one number: A's, then ``bits`` bits for B's."""

    #: Characters of chunks that are aligned in one go.
    align_chars = 1 << 18
    #: Links of a group beyond which its pairs are kept once each, with their number.
    large_links = 1 << 12

    def __init__(self, encoders: Encoders):
        self.encoders, self.bounds = encoders, encoders.bounds
        self.len_a, self.len_b = encoders.len_a, encoders.len_b
        self.bits = (len(self.len_b) - 1).bit_length()
        if (len(self.len_a) - 1).bit_length() + self.bits > 47:
            raise ValueError("vocabularies with more than 2^47 pairs of ids")
        # Ids as text with what follows: a comma inside a side, a bar after side A, a semicolon after side B.
        self.text_a, self.text_b = (np.array([f"{i}{end}" for end in f",{last}" for i in range(n)], object)
                                    for n, last in ((len(self.len_a), "|"), (len(self.len_b), ";")))
        self.repeats = Repeats()
        self._start()

    def _start(self) -> None:
        self.memo: defaultdict[str, int] = defaultdict()
        self.made = Aligned(np.zeros((4, 0), np.int64), [], np.zeros(1, np.int64), np.zeros(0, np.int64), {})

    def _align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, same: np.ndarray) -> Aligned:
        """Aligns chunks, given their ids in a row.

        Every chunk ends in an end of both, so the chunks' ids joined have the
        groups of the chunks in a row. Those not ``same`` have no groups.
        """
        if not same.all():
            a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
            n_a, n_b = np.where(same, n_a, 0), np.where(same, n_b, 0)
        figures = np.array([n_a, n_b, np.where(same, 0, -1), np.zeros(len(same))], np.int64)
        if not len(a):
            return Aligned(figures, [""] * len(same), np.zeros(len(same) + 1, np.int64), np.zeros(0, np.int64), {})
        last_a, last_b = _groups(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        end_a, end_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        # Groups up to each chunk's end.
        upto = np.r_[0, np.searchsorted(end_a, np.cumsum(n_a), side="right")]
        links = size_a * size_b
        summed = np.r_[0, np.cumsum(links)][upto]
        figures[2] += np.diff(upto)
        figures[3] = np.diff(summed)
        # Pairs of all small groups at once, of large groups by distinct ids.
        is_large = links > self.large_links
        small = np.where(is_large, 0, links)
        k = _ranges(np.zeros_like(small), small)
        per_b = np.repeat(size_b, small)
        of_a = k // per_b
        x = a[np.repeat(end_a - size_a, small) + of_a].astype(np.int64)
        pairs = (x << self.bits) + b[np.repeat(end_b - size_b, small) + k - of_a * per_b]
        large: dict[int, list] = {}
        for g in np.flatnonzero(is_large):
            (x, n), (y, m) = (np.unique(t[e - c:e], return_counts=True)
                              for t, e, c in ((a, end_a[g], size_a[g]), (b, end_b[g], size_b[g])))
            found = ((x.astype(np.int64)[:, None] << self.bits) + y).ravel()
            large.setdefault(int(np.searchsorted(upto, g, side="right")) - 1, []).append((found, np.outer(n, m).ravel()))
        # Text: of each group, side A and side B.
        pieces = np.empty(len(a) + len(b), object)
        pieces[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = self.text_a[a + last_a * len(self.len_a)]
        pieces[np.arange(len(b)) + np.repeat(end_a, size_b)] = self.text_b[b + last_b * len(self.len_b)]
        pieces, cuts = pieces.tolist(), [0, *np.cumsum(n_a + n_b).tolist()]
        texts = ["".join(pieces[p:q]) for p, q in zip(cuts, cuts[1:])]
        return Aligned(figures, texts, np.r_[0, np.cumsum(small)][upto], pairs, large)

    def _add(self, new: list[Aligned]) -> None:
        """Stores alignments under the next numbers."""
        all_made = [self.made, *new]
        numbers = np.cumsum([len(x.texts) for x in all_made])
        starts, first = [self.made.starts], self.made.starts[-1]
        for x in new:
            starts.append(first + x.starts[1:])
            first = starts[-1][-1]
        large = dict(self.made.large)
        for x, n in zip(new, numbers.tolist()):
            large |= {n + k: found for k, found in x.large.items()}
        self.made = Aligned(np.concatenate([x.figures for x in all_made], 1), [*chain.from_iterable(x.texts for x in all_made)],
                            np.concatenate(starts), np.concatenate([x.pairs for x in all_made]), large)

    def _keep(self, n: int, chunks: list[str], seen: np.ndarray) -> None:
        """Of the ``chunks`` with the numbers from ``n`` on, keeps those worth it, given how often each was seen."""
        made = self.made
        fits = np.fromiter(map(len, chunks), np.int64, len(chunks)) <= self.bounds.memo_chars
        figures = made.figures[:, n:n + len(chunks)]
        fits &= (figures[:2].sum(0) <= self.bounds.memo_tokens) & (figures[2] > 0)
        fits[[k - n for k in made.large if n <= k < n + len(chunks)]] = False
        once = self.repeats.of([chunks[k] for k in np.flatnonzero(fits & (seen == 1)).tolist()])
        seen[[self.memo[c] - n for c in once]] += 1
        kept = np.flatnonzero(fits & (seen > 1)).tolist()
        for c in chunks:
            del self.memo[c]
        self.memo.update(zip([chunks[k] for k in kept], range(n, n + len(kept))))
        at = np.array(kept, np.int64) + n
        sizes = made.starts[at + 1] - made.starts[at]
        first = made.starts[n]
        self.made = Aligned(np.concatenate([made.figures[:, :n], made.figures[:, at]], 1),
                            made.texts[:n] + [made.texts[k] for k in at.tolist()],
                            np.concatenate([made.starts[:n + 1], first + np.cumsum(sizes)]),
                            np.concatenate([made.pairs[:first], made.pairs[_ranges(made.starts[at], sizes)]]),
                            {k: x for k, x in made.large.items() if k < n})

    def documents(self, texts: list[str | None]) -> Part:
        """Aligns documents together; a chunk that several of them hold is encoded and aligned once."""
        if len(self.made.texts) > self.bounds.memo:
            self._start()
        parts = [self.encoders.chunks(t) if t else [] for t in texts]
        words = [*chain.from_iterable(parts)]
        ends = np.cumsum([len(p) for p in parts])
        memo, n = self.memo, len(self.made.texts)
        self.encoders.odd.clear()
        memo.default_factory = count(n).__next__  # new chunks get the next numbers
        numbers = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        new = [*islice(reversed(memo), max(0, int(numbers.max(initial=0)) + 1 - n))][::-1]
        if new:
            # Aligned by stretches, as working arrays are many times the ids.
            sizes = np.cumsum(np.fromiter(map(len, new), np.int64, len(new))) // self.align_chars
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(new)]
            self._add([self._align(*self.encoders.encode(new[p:q])) for p, q in zip(cuts, cuts[1:])])
        seen = np.bincount(numbers, minlength=n + len(new))[n:]
        odd = np.flatnonzero(self.made.figures[2, numbers] < 0)
        if len(odd):  # texts with a chunk that spells something else
            by_doc = np.split(numbers, ends[:-1])
            for d in np.unique(np.searchsorted(ends, odd, side="right")):
                by_doc[d] = np.zeros(0, np.int64)
                if self.encoders.spelled(parts[d]):
                    ids = self.encoders.ids(texts[d])
                    by_doc[d] = np.array([len(self.made.texts)])
                    self._add([self._align(*ids, *(np.array([len(x)]) for x in ids), np.array([True]))])
            numbers, ends = np.concatenate(by_doc), np.cumsum([len(x) for x in by_doc])
        part = Part(self.made, numbers, ends)
        self._keep(n, new, seen)
        return part


def _pairs_of(part: Part, lo: int, hi: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs with the document's number from ``lo`` on in the last 16 bits, in order, and links of each) of some documents."""
    first, last = (int(part.ends[d - 1]) if d else 0 for d in (lo, hi))
    numbers = part.numbers[first:last]
    docs = np.repeat(np.arange(hi - lo), np.diff(part.ends[lo:hi], prepend=first))
    sizes = part.made.starts[numbers + 1] - part.made.starts[numbers]
    summed, found, at = np.cumsum(sizes), [], 0
    while at < len(numbers):  # all at once, but for a very long document
        end = max(at + 1, int(np.searchsorted(summed, (summed[at - 1] if at else 0) + 2 * most)))
        n, some = sizes[at:end], numbers[at:end]
        keys = (part.made.pairs[_ranges(part.made.starts[some], n)] << 16) + np.repeat(docs[at:end], n)
        keys.sort()
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        found.append((keys[start], np.diff(start, append=len(keys))))
        at = end
    if part.made.large:
        for at in np.flatnonzero(np.isin(numbers, [*part.made.large])):
            found += [((pairs << 16) + docs[at], links) for pairs, links in part.made.large[int(numbers[at])]]
    if len(found) == 1:
        return found[0]
    keys, links = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ((), ())))
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[start], np.add.reduceat(links, start) if len(keys) else links


def _shard(a, b, shards: int):
    """The shard of a pair; the same arithmetic for numpy and columns."""
    return (a * 40_503 + b * 30_011) % 1_000_003 % shards


def _postings(block: int, keys: np.ndarray, links: np.ndarray, bits: int, shards: int, row_pairs: int) -> pa.RecordBatch:
    """A block's pairs (see ``_pairs_of``) as rows of one shard each, sorted by code."""
    pairs = keys >> 16
    start = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    sizes, pairs = np.diff(start, append=len(keys)), pairs[start]
    a, b = pairs >> bits, pairs & ((1 << bits) - 1)
    shard = _shard(a, b, shards).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    codes, shard, sizes = (a << 32 | b)[order], shard[order], sizes[order]
    at = _ranges(start[order], sizes)
    docs, links = (keys[at] & 0xFFFF).astype(np.int32), links[at]
    codes, shard = np.repeat(codes, sizes), np.repeat(shard, sizes)
    n, new = len(codes), np.r_[True, shard[1:] != shard[:-1]]
    within = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    row = within % row_pairs == 0
    new_code = row | np.r_[True, codes[1:] != codes[:-1]]
    rows, firsts = np.flatnonzero(row), np.flatnonzero(new_code)
    by_entry = pa.array(np.r_[rows, n], pa.int32())
    by_code = pa.array(np.r_[np.searchsorted(firsts, rows), len(firsts)], pa.int32())
    lists = {"codes": pa.ListArray.from_arrays(by_code, pa.array(codes[firsts])),
             "n_docs": pa.ListArray.from_arrays(by_code, pa.array(np.diff(np.r_[firsts, n]).astype(np.int32))),
             "docs": pa.ListArray.from_arrays(by_entry, pa.array(docs)),
             "links": pa.ListArray.from_arrays(by_entry, pa.array(links.astype(np.int32))),
             "block": pa.array(np.full(len(rows), block)), "shard": pa.array(shard[rows])}
    return _batch(len(rows), lists)


def _parts(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[tuple[list, list]]:
    """(ids, texts) of rows in turn, as many as the bounds allow at once."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for d, t in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(d)
            texts.append(t)
            size += len((t or "").encode())
            if size >= bounds.part_bytes or len(ids) >= bounds.block_docs:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _batch(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA],
                                      schema=_SCHEMA)


def encoded(docs: DataFrame, shards: int, path_a: str | None = None, path_b: str | None = None,
            doc_id: str = "doc_id", text: str = "text", with_groups: bool = False,
            bounds: Bounds = Bounds()) -> DataFrame:
    """Rows of two kinds: documents (``doc`` set: their figures, with ``groups`` if asked) and postings (``shard`` set)."""
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.tiktoken"), path_b or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(Encoders(path_a, path_b, bounds))
        block = TaskContext.get().partitionId() << 32
        for ids, texts in _parts(batches, bounds):
            part = chunks.documents(texts)
            del texts
            made, starts = part.made, np.r_[0, part.ends]
            figures = [np.diff(np.r_[0, np.cumsum(x[part.numbers])][starts]) for x in made.figures]
            sizes = np.r_[0, np.cumsum(made.starts[part.numbers + 1] - made.starts[part.numbers])][starts]
            numbers, cuts, lo = part.numbers.tolist(), starts.tolist(), 0
            while lo < len(ids):
                # Documents until one reaches a bound.
                hi = int(np.searchsorted(sizes, sizes[lo] + bounds.block_pairs))
                hi = max(lo + 1, min(hi, lo + bounds.block_docs, len(ids)))
                groups = ["".join([made.texts[k] for k in numbers[p:q]])[:-1] for p, q in zip(cuts[lo:hi], cuts[lo + 1:hi + 1])]
                shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                columns = {"block": np.full(hi - lo, block), "doc": np.arange(hi - lo, dtype=np.int32), "doc_id": ids[lo:hi],
                           "groups_sha256": shas, **dict(zip(("n_a", "n_b", "n_groups", "n_links"), (x[lo:hi] for x in figures)))}
                if with_groups:
                    columns["groups"] = groups
                yield _batch(hi - lo, {f.name: pa.array(columns[f.name], f.type) for f in _SCHEMA if f.name in columns})
                keys, links = _pairs_of(part, lo, hi, bounds.block_pairs)
                if len(keys):
                    yield _postings(block, keys, links, chunks.bits, shards, bounds.row_pairs)
                block, lo = block + 1, hi

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, _DDL))


def pair_counts(postings: DataFrame) -> DataFrame:
    """(code, n, best): documents that hold each pair linked; whether no pair of its A id has more."""
    counts = (postings.select(F.explode(F.arrays_zip("codes", "n_docs")).alias("x"))
              .groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.n_docs").alias("n")))
    of_a = Window.partitionBy(F.shiftright("code", 32))  # at most as many rows as B has ids
    return counts.select("code", "n", (F.max("n").over(of_a) == F.col("n")).alias("best"))


def _sums(rows: pa.RecordBatch, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Of some posting rows, given the counts of their shard: per block the documents, their count_sum and n_best."""
    codes, n_docs, docs, links = (rows.column(c).flatten().to_numpy() for c in ("codes", "n_docs", "docs", "links"))
    at = np.repeat(np.searchsorted(table[0], codes), n_docs)
    key = np.repeat(rows.column("block").to_numpy(), rows.column("docs").value_lengths().to_numpy()) * _DOCS + docs
    order = np.argsort(key, kind="stable")
    key, links, at = key[order], links[order].astype(np.int64), at[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    block = key[first] // _DOCS
    cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.r_[cut, len(first)], pa.int32()), pa.array(x))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cut]), lists((key[first] % _DOCS).astype(np.int32)),
         lists(np.add.reduceat(links * table[1][at], first)), lists(np.add.reduceat(links * table[2][at], first))],
        names=["block", "docs", "count_sums", "n_bests"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block -> one row per document with the sums of all its rows."""
    at, sums = None, None

    def done() -> pa.RecordBatch:
        docs = np.flatnonzero(sums[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), at, np.int64)), pa.array(docs.astype(np.int32)),
                                           pa.array(sums[0][docs]), pa.array(sums[1][docs])],
                                          names=["block", "doc", "count_sum", "n_best"])

    for batch in batches:
        for k, block in enumerate(batch.column("block").to_pylist()):
            if block != at:
                if sums is not None:
                    yield done()
                at, sums = block, np.zeros((2, _DOCS), np.int64)
            docs, count_sums, n_bests = (batch.column(c)[k].values.to_numpy() for c in ("docs", "count_sums", "n_bests"))
            sums[0][docs] += count_sums  # a row names a document once
            sums[1][docs] += n_bests
    if sums is not None:
        yield done()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, counts first): counts become a table, postings are looked up in it."""
    at, parts, table = None, [], None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        counts = batch.column("code").is_valid().to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (counts[1:] != counts[:-1])) + 1).tolist(), len(shard)]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi:
                continue
            rows = batch.slice(lo, hi - lo)
            if shard[lo] != at:
                at, parts, table = shard[lo], [], None
            if counts[lo]:
                parts.append([rows.column(c).to_numpy(zero_copy_only=False) for c in ("code", "n", "best")])
                continue
            if table is None:
                table = tuple(np.concatenate(x) for x in zip(*parts))
            yield _sums(rows, table)


def link_sums(postings: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """(block, doc, count_sum, n_best): over a document's links, the sum of their counts and how many are best."""
    a, b = F.shiftright("code", 32), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
    none = {c: F.lit(None).cast(t) for c, t in (("block", "bigint"), ("codes", "array<bigint>"), ("n_docs", "array<int>"),
                                                ("docs", "array<int>"), ("links", "array<int>"))}
    tables = counts.select(_shard(a, b, shards).cast("int").alias("shard"), "code", "n", "best",
                           *[c.alias(k) for k, c in none.items()])
    lists = postings.select("shard", F.lit(None).cast("bigint").alias("code"), F.lit(None).cast("bigint").alias("n"),
                            F.lit(None).cast("boolean").alias("best"), *none)
    met = (tables.unionByName(lists).repartition("shard")
           .sortWithinPartitions("shard", F.col("code").asc_nulls_last()))
    by_block = (met.mapInArrow(_probe, "block bigint, docs array<int>, count_sums array<bigint>, n_bests array<bigint>")
                .repartition("block").sortWithinPartitions("block"))
    return by_block.mapInArrow(_add_up, "block bigint, doc int, count_sum bigint, n_best bigint")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, doc_id: str = "doc_id",
          text: str = "text", with_groups: bool = False, shards: int | None = None,
          bounds: Bounds = Bounds()) -> DataFrame:
    """One row per document: its tokens, groups and links, and what the corpus says of its links."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(encoded(docs, shards, path_a, path_b, doc_id, text, with_groups, bounds), "token-alignment")
    postings = rows.where("shard is not null")
    sums = link_sums(postings, pair_counts(postings), shards)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (rows.where("doc is not null").join(sums, ["block", "doc"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256",
                    *["groups"] * with_groups))
