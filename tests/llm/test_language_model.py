"""Language model: base columns against a plain count, gains on held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sensorqc.llm import language_model as lm
from tests.llm.conftest import AWKWARD, given


def words(text):
    return [*(text or "").encode().lower().split(), b"\0end"]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain(docs):
    count = Counter(w for d, t in docs if not is_held_out(d) for w in words(t))
    n, v = sum(count.values()), len(count)
    return n, [(d, is_held_out(d), len(words(t)), sum(count[w] > 0 for w in words(t)),
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words(t))) for d, t in docs]


def check(rows, docs):
    n, want = plain(docs)
    got = sorted(((r.doc_id or -1), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows)
    assert got == sorted(((d or -1), h, t, k, pytest.approx(b, abs=2e-5)) for d, h, t, k, b in want)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score <= 0 for r in rows)


@pytest.mark.parametrize("head", [lm.HEAD, 300])
def test_base_score_with_and_without_a_tail(spark, head):
    docs = [(r["doc_id"], r["text"]) for r in given("documents")]
    rows = lm.score(spark.createDataFrame(docs, "doc_id long, text string"), head=head).collect()
    check(rows, docs)


def test_model_beats_base_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = lm.score(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert np.mean([r.score > r.base_score for r in held]) > 0.8


def test_awkward(spark, awkward, no_docs):
    check(lm.score(awkward).collect(), [r[:2] for r in AWKWARD])
    assert lm.score(no_docs).collect() == []
    untrained = awkward.filter(lm.held_out())
    if untrained.count():
        assert all(r.train_tokens == 0 and r.score == r.base_score for r in lm.score(untrained).collect())


def test_chances_add_up_to_one(spark):
    """Over modelled words, known other words and the unseen share, after any history."""
    docs = spark.createDataFrame([(i, f"a b c{i % 7} d") for i in range(50)], "doc_id long, text string")
    counts = lm.token_counts(docs).cache()
    known = lm.Vocabulary.of(counts)
    model = lm.train(docs, known)
    f = [np.arange(5), np.arange(5), np.arange(5)]
    chances = model.class_chances(f)
    assert np.allclose(chances.sum(axis=1), 1, atol=1e-5)
    for c in range(lm.CLASSES):
        assert np.allclose(model.word_chances(np.full(5, c), f[:2]).sum(axis=1), 1, atol=1e-5)


def test_head_is_bounded(spark):
    counts = spark.range(5000).selectExpr("id * 7919 as h", "id % 50 + 1 as c")
    known = lm.Vocabulary.of(counts, head=1000)
    assert len(known.hashes) <= 1000 and known.v == 5000 and known.n == sum(i % 50 + 1 for i in range(5000))
    assert known.counts.min() > 40
