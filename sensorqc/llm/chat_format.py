"""Conversations of typed content parts as training text with a loss mask.

A turn's content is a plain text or a list of parts (text, image, audio,
document; documents may hold parts again). A visitor flattens the parts in
order into one text with placeholders; every attachment is recorded with its
reference and the tokens its placeholder expands to. The template marks turns::

    <|im_start|>role\\n ... text <|image|> text ... <|im_end|>\\n

Control strings inside texts are escaped reversibly: a ``<``, n backslashes and
a ``|`` get one backslash more (``<|`` becomes ``<\\|``), so ``<|`` in the output
is always the template's. In roles, backslashes and newlines are escaped too.
Adjacent texts are joined before they are escaped, as ``<`` and ``|`` may meet.
``read_back`` inverts all of it.

Scale: rows are range-partitioned by (conversation, turn, role, content), so a
conversation of any length is spread over tasks, and a task streams its turns
into chunks of bounded length: one chunk for nearly every conversation, several
(numbered in order) for a longer one or one on a border of two tasks. Nothing
larger than a chunk and a turn is held. ``digests`` reads chunks back where
they are; only chunks of conversations that may go on in another task are
brought together, and their texts pass as a stream.

Cases: turns are ordered by turn, nulls first, ties by role and content;
repeated rows are turns of their own; a null role or text is empty; a null
list has no parts and null parts are left out; parts of an unknown type become
the placeholder ``<|other|>`` with their reference; rows without a conversation id form
one conversation; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sensorqc.llm.common import only

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
KINDS = ("image", "audio", "document", "other")
#: Characters after which a chunk ends.
CHUNK_CHARS = 1 << 20

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_MARK = re.compile(r"<\|(?:" + "|".join(KINDS) + r")\|>")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FILE = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("turn", pa.int64()), ("tokens", pa.int64())])
_SCHEMA = pa.schema([("conv", pa.int64()), ("chunk", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                     ("formatted", pa.string()), ("loss", pa.list_(_SPAN)), ("attachments", pa.list_(_FILE)),
                     ("expanded_tokens", pa.int64())])
_DDL = ("conv bigint, chunk bigint, whole boolean, n_turns bigint, formatted string, "
        "loss array<struct<start:bigint,end:bigint>>, "
        "attachments array<struct<kind:string,ref:string,turn:bigint,tokens:bigint>>, expanded_tokens bigint")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Expansion(NamedTuple):
    """Tokens that a placeholder stands for."""

    patch: int = 28  # pixels of an image's side per token
    max_patches: int = 1 << 14
    per_second: float = 25.0
    per_page: int = 256


class Flattener:
    """Visits the parts of one turn: texts and placeholders in order, attachments beside them."""

    def __init__(self, expansion: Expansion = Expansion()):
        self.expansion = expansion
        self.pieces: list[tuple[bool, str]] = []  # (is text, text or kind)
        self.files: list[tuple[str, str | None, int]] = []

    def visit(self, part: dict | None) -> None:
        if part is not None:
            kind = (part.get("type") or "other").lower()
            getattr(self, f"visit_{kind}" if kind in ("text", *KINDS) else "visit_other")(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        if self.pieces and self.pieces[-1][0]:
            text = self.pieces.pop()[1] + text
        self.pieces.append((True, text))

    def visit_image(self, part: dict) -> None:
        w, h = (max(part.get(k) or 0, 0) for k in ("width", "height"))
        patches = math.ceil(w / self.expansion.patch) * math.ceil(h / self.expansion.patch)
        self._attach("image", part, min(max(patches, 1), self.expansion.max_patches))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(math.ceil((part.get("seconds") or 0) * self.expansion.per_second), 1))

    def visit_document(self, part: dict) -> None:
        """The document's own placeholder, then what it holds; pages count where nothing is given of them."""
        inner = [p for p in part.get("parts") or () if p is not None]
        pages = 0 if inner else max(part.get("pages") or 0, 0)
        self._attach("document", part, max(pages * self.expansion.per_page, 1))
        for p in inner:
            self.visit(p)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 1)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.pieces.append((False, kind))
        self.files.append((kind, part.get("ref"), tokens))


def format_turn(role: str, content: str | list | None, expansion: Expansion = Expansion()
                ) -> tuple[str, list[tuple[int, int]], list[tuple[str, str | None, int]]]:
    """(formatted turn, spans of its texts in it, attachments)."""
    flat = Flattener(expansion)
    for part in [{"type": "text", "text": content}] if isinstance(content, str) or content is None else content:
        flat.visit(part)
    out, spans = [START, _escape_role(role), NEWLINE], []
    at = sum(map(len, out))
    for is_text, x in flat.pieces:
        piece = escape(x) if is_text else f"<|{x}|>"
        if is_text and piece:
            spans.append((at, at + len(piece)))
        out.append(piece)
        at += len(piece)
    return "".join([*out, END, NEWLINE]), spans, flat.files


def read_back(formatted: str) -> Iterator[tuple[str, list[str]]]:
    """(role, texts between placeholders) of each turn of a formatted text."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        yield _unescape_role(m[1]), [unescape(x) for x in _MARK.split(m[2])]
    if at != len(formatted):
        raise ValueError(f"no turn begins at character {at}")


class _Chunk:
    """Turns of one conversation that a task has gathered."""

    def __init__(self, conv, first: bool):
        self.conv, self.first = conv, first  # first: the conversation may have begun in an earlier task
        self.n_chars = self.n_turns = 0
        self.text, self.loss, self.files = [], [], []

    def add(self, role: str, content, loss_role: str, expansion: Expansion) -> None:
        text, spans, files = format_turn(role, content, expansion)
        if role == loss_role:
            self.loss += [(self.n_chars + a, self.n_chars + b) for a, b in spans]
        self.files += [(k, r, self.n_turns, n) for k, r, n in files]
        self.text.append(text)
        self.n_chars += len(text)
        self.n_turns += 1

    def row(self, number: int, whole: bool) -> tuple:
        return (self.conv, number, whole, self.n_turns, "".join(self.text),
               [{"start": a, "end": b} for a, b in self.loss],
               [{"kind": k, "ref": r, "turn": t, "tokens": n} for k, r, t, n in self.files], sum(f[3] for f in self.files))


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         content: str = "text", loss_role: str = "assistant", expansion: Expansion = Expansion(),
                         chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunks of formatted conversations.

    ``content`` is a text column or an array of parts: structs with any of
    ``type, text, ref, width, height, seconds, pages, parts``. Out come
    ``conv``, ``chunk`` (in the conversation's order; the first of nearly all
    is the only one, then ``whole`` is set), ``n_turns``, ``formatted``,
    ``loss`` (spans of code points in ``formatted`` that texts of ``loss_role``
    take), ``attachments`` (in the order of their placeholders, with the turn
    within the chunk) and ``expanded_tokens`` (theirs).
    """
    rows = only(rows, conv=conv, turn=turn, role=role, content=content)
    parts = isinstance(rows.schema["content"].dataType, ArrayType)
    rows = rows.withColumn("conv", F.col("conv").cast("long")).withColumn("role", F.coalesce("role", F.lit("")))
    keys = ["conv", "turn", "role", F.to_json("content") if parts else "content"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "role", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, done, size = TaskContext.get().partitionId() << 32, None, [], 0
        for batch in batches:
            for c, r, x in zip(*(col.to_pylist() for col in batch.columns)):
                if held is None or held.conv != c or held.n_chars >= chunk_chars:
                    same = held is not None and held.conv == c
                    if held is not None:
                        done.append(held.row(number, not (held.first or same)))
                        size += held.n_chars
                        number += 1
                    held = _Chunk(c, held is None or same)
                held.add(r, x, loss_role, expansion)
                if size >= chunk_chars:
                    yield _rows(done)
                    done, size = [], 0
        if held is not None:
            done.append(held.row(number, False))  # it may go on in the next task
        if done:
            yield _rows(done)

    return dealt.mapInArrow(run, _DDL)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _SCHEMA)], schema=_SCHEMA)


class _Digest:
    """What is read back of one conversation, chunk by chunk."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: Iterable[dict]) -> None:
        for role, texts in read_back(formatted):
            self.turns.update(f"{role}\n{''.join(texts)}\n".encode())
            self.n_turns += 1
        for span in loss:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_OPEN = pa.schema([("conv", pa.int64()), ("chunk", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                   ("formatted", pa.string()), ("loss", pa.list_(_SPAN))])
_OPEN_DDL = ("conv bigint, chunk bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint, formatted string, loss array<struct<start:bigint,end:bigint>>")


def digests(chunks: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read back from formatted chunks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations become figures; chunks of others are passed on."""
        for batch in batches:
            out = []
            for conv, chunk, whole, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                figures = (None,) * 5
                if whole:
                    digest = _Digest()
                    digest.add(formatted, loss)
                    figures, formatted, loss = digest.row(), None, None
                out.append((conv, chunk, *figures, formatted, loss))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OPEN)], schema=_OPEN)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by conversation and chunk: figures pass, chunks are read in order."""
        schema, at, digest = pa.schema([("conv_id", pa.int64()), *[(f.name, f.type) for f in list(_OPEN)[2:7]]]), None, None

        def rows(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            done = []
            for conv, _, *figures, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is not None and at != conv:
                    done.append((at, *digest.row()))
                    digest = None
                if formatted is None:
                    done.append((conv, *figures))
                else:
                    at, digest = conv, digest or _Digest()
                    digest.add(formatted, loss)
            if done:
                yield rows(done)
        if digest is not None:
            yield rows([(at, *digest.row())])

    first = chunks.select("conv", "chunk", "whole", "formatted", "loss").mapInArrow(read, _OPEN_DDL)
    out = "conv_id bigint, " + ", ".join(x.strip() for x in _OPEN_DDL.split(",")[2:7])
    return first.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(join, out)
