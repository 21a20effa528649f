"""Hashed maximum-entropy language model with a class-factored softmax.

What is gathered from the corpus: the count of every distinct token of all
training documents (one distributed table that grows with the corpus), and the
model's weights, trained on every training document once.

Tokens are the words (A-Z lower-cased) and one end per text, held as 64-bit
hashes. The ``WORDS`` most frequent are modelled one by one, in ``CLASSES``
classes of equal size by rank; all others form one more class:

    P(token | history) = P(class | history) * P(token | class, history)

Both factors are softmaxes over sums of weight rows picked by features of the
history: the previous word, the word before it (a skip), and both together,
hashed into fixed tables. Inside the class of other words probability is
(c + 1) / (N' + V' + 1) with the class's own token and type numbers, so
unseen words have their share.

Training is distributed stochastic gradient: each task walks through its
documents in mini-batches, from the common weights; after a round the weights
are averaged row by row, each task weighing as often as it saw the feature.
The gradient's expected counts are estimated by one draw per token from the
model (unbiased). Rounds take disjoint parts of the training documents.

Counts of the ``HEAD`` most frequent tokens (a bounded table) go to all tasks.
Other tokens of a document are joined with the count table; as the frequent
ones are gone, no join key is hot.

Cases: a null or empty text is the end alone; texts are read whole; repeated
rows are scored each; a null doc_id is a training document; with no training
documents the counts are 0 and the score is the base score; an empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorqc.llm.common import written
from sensorqc.llm.shingles import mix, word_hashes

END = np.uint64(0x454E44)  # stands for the end of a text
HEAD = 1 << 18
CLASSES, MEMBERS = 32, 32
WORDS = CLASSES * MEMBERS
ROWS = 2048  # feature rows of each table for classes
WORD_ROWS = 256  # and for words
BATCH = 1 << 16  # tokens in a mini-batch
RATE = 0.15
COUNTED_AT_ONCE = 1 << 22  # tokens counted in a task before they are sent on


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 7 == 2, F.lit(False))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the texts' tokens, the end included."""
    words, bounds = word_hashes(texts)
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


# -- counts -------------------------------------------------------------------------------------------------------


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(h, c): how often each distinct token occurs; counted in tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                held.append(tokens(whole.column(0).slice(at, 256))[0])
                n += len(held[-1])
                if n >= COUNTED_AT_ONCE:
                    yield counted()
                    held, n = [], 0
        if n:
            yield counted()

    return (docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "h bigint, c bigint")
            .groupBy("h").agg(F.sum("c").alias("c")))


@dataclass
class Vocabulary:
    """Totals of the counts, and the head: the most frequent tokens sorted by hash, with rank and count."""

    n: int
    v: int
    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, head: int = HEAD) -> Vocabulary:
        """At most ``head`` tokens come to the driver: those above a level found on a coarse histogram."""
        level = F.floor(F.log2("c") * 16).cast("int")
        levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
        room, least = head, None
        for r in sorted(levels, key=lambda r: -r["level"]):
            if r["n"] > room:
                break
            room, least = room - r["n"], r["level"]
        top = counts.filter(level >= least).collect() if least is not None else []
        h, c = np.array([r["h"] for r in top], np.int64).view(np.uint64), np.array([r["c"] for r in top], np.int64)
        rank = np.empty(len(h), np.int32)
        rank[np.lexsort((h, -c))] = np.arange(len(h))
        order = np.argsort(h)
        return cls(sum(r["c"] for r in levels), sum(r["n"] for r in levels), h[order], rank[order], c[order])

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, count) of tokens; rank -1 for those not in the head."""
        if not len(self.hashes):
            return np.full(len(h), -1, np.int32), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        there = self.hashes[at] == h
        return np.where(there, self.ranks[at], -1), np.where(there, self.counts[at], 0)

    @property
    def modelled(self) -> tuple[int, int]:
        """Tokens and types modelled one by one."""
        there = self.ranks < WORDS
        return int(self.counts[there].sum()), int(there.sum())


# -- model --------------------------------------------------------------------------------------------------------


class Model:
    """Weight tables; ``w[0]`` is the bias row of the class factor, ``w[4]`` of the word factor."""

    SHAPES = [(1, CLASSES + 1)] + [(ROWS, CLASSES + 1)] * 3 + [(1, WORDS)] + [(WORD_ROWS, WORDS)] * 2

    def __init__(self, w: list[np.ndarray]):
        self.w = w

    @classmethod
    def unigram(cls, vocabulary: Vocabulary) -> Model:
        """Weights that give every class and word its share of the training tokens."""
        made = cls([np.zeros(s, np.float32) for s in cls.SHAPES])
        count = np.full(WORDS, 0.5)
        there = vocabulary.ranks < WORDS
        count[vocabulary.ranks[there]] += vocabulary.counts[there]
        made.w[4][0] = np.log(count)
        rest = max(vocabulary.n - vocabulary.modelled[0], 0) + 0.5
        made.w[0][0] = np.log(np.append(count.reshape(CLASSES, MEMBERS).sum(axis=1), rest))
        return made

    @classmethod
    def read(cls, raw: bytes) -> Model:
        flat, w, at = np.frombuffer(raw, np.float32), [], 0
        for rows, columns in cls.SHAPES:
            w.append(flat[at: at + rows * columns].reshape(rows, columns).copy())
            at += rows * columns
        return cls(w)

    def write(self) -> bytes:
        return b"".join(x.tobytes() for x in self.w)

    def class_chances(self, f: list[np.ndarray]) -> np.ndarray:
        z = self.w[1][f[0]]
        z += self.w[2][f[1]]
        z += self.w[3][f[2]]
        return _softmax(z + self.w[0])

    def word_chances(self, cls: np.ndarray, f: list[np.ndarray]) -> np.ndarray:
        """Chances of the members of class ``cls``."""
        z = self.w[4].reshape(CLASSES, MEMBERS)[cls]
        for table, g in zip(self.w[5:], f):
            z += table.reshape(WORD_ROWS, CLASSES, MEMBERS)[g % WORD_ROWS, cls]
        return _softmax(z)


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def features(h: np.ndarray, rank: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Rows of each token's history: previous word, the one before, both."""
    own = np.where((rank >= 0) & (rank < ROWS // 2), rank, ROWS // 2 + (h % np.uint64(ROWS // 2)).astype(np.int64))
    start = bounds[:-1]
    first = np.empty(len(h), np.int64)
    first[1:] = own[:-1]
    first[start] = ROWS - 1
    second = np.empty(len(h), np.int64)
    second[2:] = own[:-2]
    second[start] = ROWS - 1
    inner = start + 1
    second[inner[inner < bounds[1:]]] = ROWS - 1
    both = (mix((first * ROWS + second).astype(np.uint64)) % np.uint64(ROWS)).astype(np.int64)
    return [first, second, both]


class Trainer:
    """Mini-batch gradient steps (AdaGrad) on a task's documents."""

    def __init__(self, model: Model, seed: int):
        self.model = model
        self.seen = [np.zeros(s[0]) for s in Model.SHAPES]
        self.size = [np.full(s, 1e-2, np.float32) for s in Model.SHAPES]
        self.rng = np.random.default_rng(seed)

    def _draw(self, chances: np.ndarray) -> np.ndarray:
        np.cumsum(chances, axis=1, out=chances)
        return (chances[:, :-1] < self.rng.random(len(chances), np.float32)[:, None]).sum(axis=1)

    def _move(self, i: int, rows: np.ndarray | None, true: np.ndarray, drawn: np.ndarray) -> None:
        """A step on table i: counts of the true outcomes against those drawn from the model."""
        n, columns = Model.SHAPES[i]
        code = 0 if rows is None else rows * columns
        g = (np.bincount(code + true, minlength=n * columns) - np.bincount(code + drawn, minlength=n * columns))
        g = g.reshape(n, columns).astype(np.float32)
        self.size[i] += g * g
        self.model.w[i] += RATE * g / np.sqrt(self.size[i])
        self.seen[i] += len(true) if rows is None else np.bincount(rows, minlength=n)

    def step(self, rank: np.ndarray, f: list[np.ndarray]) -> None:
        modelled = (rank >= 0) & (rank < WORDS)
        cls = np.where(modelled, rank // MEMBERS, CLASSES)
        drawn = self._draw(self.model.class_chances(f))
        words = np.flatnonzero(modelled)
        cw, fw = cls[words], [g[words] for g in f[:2]]
        member = self._draw(self.model.word_chances(cw, fw)) + cw * MEMBERS
        self._move(0, None, cls, drawn)
        for i in range(3):
            self._move(1 + i, f[i], cls, drawn)
        self._move(4, None, rank[words], member)
        for i in range(2):
            self._move(5 + i, fw[i] % WORD_ROWS, rank[words], member)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = 2, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model of the documents; round r takes those whose id hashes to r."""
    sc = docs.sparkSession.sparkContext
    model, shared = Model.unigram(vocabulary), sc.broadcast(vocabulary)
    for r in range(rounds):
        start = sc.broadcast(model.write())

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, any_ = Trainer(Model.read(start.value), TaskContext.get().partitionId()), False
            held: list[tuple] = []
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    h, bounds = tokens(whole.column(0).slice(at, 256))
                    rank = shared.value.look(h)[0]
                    held.append((rank, *features(h, rank, bounds)))
                    if sum(len(x[0]) for x in held) >= BATCH:
                        any_ = _steps(trainer, held)
                        held = []
            if held:
                any_ = _steps(trainer, held)
            if any_:
                weight = [s[:, None].astype(np.float32) for s in trainer.seen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b"".join((a * x).astype(np.float32).tobytes() for a, x in zip(trainer.model.w, weight))]),
                     pa.array([b"".join(x.tobytes() for x in weight)])], ["moved", "weight"])

        part = docs.filter(F.pmod(F.xxhash64(F.col(f"`{doc_id}`")), F.lit(rounds)) == r)
        moved = (part.select(F.col(f"`{text}`").alias("text")).mapInArrow(learn, "moved binary, weight binary").rdd
                 .map(lambda x: tuple(np.frombuffer(y, np.float32) for y in x)))
        # A tree of depth 4 keeps what one task or the driver adds up to the fourth root of the number of tasks.
        total = moved.treeAggregate(None, _sum, _sum, depth=4)
        if total is not None:
            sums, at = Model.read(total[0].tobytes()).w, 0
            for i, (rows, _) in enumerate(Model.SHAPES):
                weight = total[1][at: at + rows][:, None]
                model.w[i] = np.where(weight > 0, sums[i] / np.maximum(weight, 1), model.w[i]).astype(np.float32)
                at += rows
    return model


def _sum(a: tuple | None, b: tuple | None) -> tuple | None:
    if a is None or b is None:
        return b if a is None else a
    return a[0] + b[0], a[1] + b[1]


def _steps(trainer: Trainer, held: list[tuple]) -> bool:
    rank, *f = (np.concatenate(x) for x in zip(*held))
    for at in range(0, len(rank), BATCH):
        cut = slice(at, at + BATCH)
        trainer.step(rank[cut], [g[cut] for g in f])
    return True


# -- scoring ------------------------------------------------------------------------------------------------------

_PARTS = ("uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_other bigint, "
          "head_log double, head_other_log double, model_log double, other array<bigint>, times array<int>")


def parts(docs: DataFrame, vocabulary: Vocabulary, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document all that head and model say, and its tokens outside the head with their numbers."""
    sc = docs.sparkSession.sparkContext
    shared, weights = sc.broadcast(vocabulary), sc.broadcast(model.write())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, m, uid = shared.value, Model.read(weights.value), TaskContext.get().partitionId() << 33
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                h, bounds = tokens(batch.column(2))
                rank, count = known.look(h)
                log_count, log_model = np.log10(count + 1.0), _log_model(m, h, rank, bounds)
                other = (rank < 0) | (rank >= WORDS)
                add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has an end
                tails, times = [], []
                for a, b in zip(bounds, bounds[1:]):
                    t, n = np.unique(h[a:b][rank[a:b] < 0], return_counts=True)
                    tails.append(t.view(np.int64))
                    times.append(n.astype(np.int32))
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(uid, uid + n)), batch.column(0), batch.column(1), pa.array(np.diff(bounds)),
                    pa.array(add((rank >= 0).astype(np.int64))), pa.array(add(other.astype(np.int64))),
                    pa.array(add(log_count)), pa.array(add(np.where(other, log_count, 0))), pa.array(add(log_model)),
                    pa.array(tails, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                    ["uid", "doc_id", "held_out", "n_tokens", "n_known", "n_other", "head_log", "head_other_log",
                     "model_log", "other", "times"])
                uid += n

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"),
                        F.col(f"`{text}`").alias("text")).mapInArrow(score, _PARTS))


def _log_model(m: Model, h: np.ndarray, rank: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log10 of the class's chance, and of the word's in it where it is modelled."""
    f, out = features(h, rank, bounds), np.zeros(len(h))
    for at in range(0, len(h), BATCH):
        cut = slice(at, at + BATCH)
        r, g = rank[cut], [x[cut] for x in f]
        modelled = (r >= 0) & (r < WORDS)
        cls = np.where(modelled, r // MEMBERS, CLASSES)
        out[cut] = np.log10(np.maximum(m.class_chances(g)[np.arange(len(r)), cls], 1e-30))
        words = np.flatnonzero(modelled)
        chance = m.word_chances(cls[words], [x[words] for x in g[:2]])[np.arange(len(words)), r[words] % MEMBERS]
        out[at + words] += np.log10(np.maximum(chance, 1e-30))
    return out


def score(docs: DataFrame, rounds: int = 2, head: int = HEAD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    training = docs.filter(~held_out(doc_id))
    counts = written(token_counts(training, text), "token-counts")
    known = Vocabulary.of(counts, head)
    every = written(parts(docs, known, train(training, known, rounds, doc_id, text), doc_id, text), "scores")
    tail = every.select("uid", F.explode(F.arrays_zip("other", "times")).alias("t")).select(
        "uid", F.col("t.other").alias("h"), F.col("t.times").alias("times"))
    rest = (tail.join(counts.hint("merge"), "h").groupBy("uid").agg(
        F.sum("times").alias("tail_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("tail_log")))
    n, v = known.modelled
    tail_log, other = F.coalesce("tail_log", F.lit(0.0)), F.lit(float(np.log10(known.n - n + known.v - v + 1)))
    base = F.col("head_log") + tail_log - F.col("n_tokens") * F.lit(float(np.log10(known.n + known.v + 1)))
    model = F.col("model_log") + F.col("head_other_log") + tail_log - F.col("n_other") * other
    return every.drop("other", "times").join(rest.hint("merge"), "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"), base.alias("base_score"),
        F.when(F.lit(known.n > 0), model).otherwise(base).alias("score"))
