"""MinHash and embedding near-duplicates against all pairs."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest

from sensorqc.llm import embedding_dedup, minhash_dedup
from sensorqc.llm.graph import components
from sensorqc.llm.shingles import shingle_sets, word_hashes
from tests.llm.conftest import AWKWARD, given

import pyarrow as pa


def roots(ids, pairs):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def slow_sets(texts, k):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def slow_components(docs, k, percent=80):
    sets = dict(zip([d for d, _ in docs], slow_sets([t for _, t in docs], k)))
    linked = [(a, b) for a, b in itertools.combinations(sets, 2)
              if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return roots(sets, linked), {d: len(s) for d, s in sets.items()}


def edited(n, seed=0, words=120):
    """Copies of one text with growing numbers of words changed, among unlike texts."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    docs = []
    for i in range(n):
        w = list(base)
        for j in rng.choice(words, int(rng.integers(0, 14)), replace=False):
            w[j] = f"e{i}x{j}"
        docs.append((i * 3 + 1, " ".join(w)))
    return docs + [(1000 + i, " ".join(f"u{i}v{j % 40}" for j in range(60))) for i in range(20)]


def test_word_hashes_across_pieces(monkeypatch):
    texts = [None, "", "a", "One tWo\nthree", "x" * 5000 + " " + "y z " * 3000, "ü ü", " a"]
    whole = word_hashes(pa.array(texts))
    monkeypatch.setattr("sensorqc.llm.shingles.PIECE", 7)
    cut = word_hashes(pa.array(texts).slice(0))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert np.diff(whole[1]).tolist() == [0, 0, 1, 3, 6001, 2, 1]
    assert whole[0][0] == whole[0][-1]
    part = word_hashes(pa.array(texts).slice(2, 3))
    assert (part[0] == whole[0][whole[1][2]: whole[1][5]]).all()


@pytest.mark.parametrize("k", [1, 2, 5])
def test_shingle_sets_have_the_right_sizes(k):
    texts = [r["text"] for r in given("documents")] + [r[1] for r in AWKWARD]
    assert [len(s) for s in shingle_sets(pa.array(texts), k)] == [len(s) for s in slow_sets(texts, k)]


@pytest.mark.parametrize("k", [2, 5])
@pytest.mark.parametrize("block", [256, 8])
def test_components_of_edited_copies(spark, monkeypatch, k, block):
    """Also with tiny blocks: large buckets become stars, groups many tiles."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    docs = edited(40, seed=k)
    docs += [(5000 + d, t.upper()) for d, t in docs[:15]]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as bands", "3 as n_shingles")
    want, sizes = slow_components(docs, k)
    got = minhash_dedup.near_duplicates(df, k=k).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert 1 < len(set(want.values())) < len(want)


def test_minhash_awkward(spark, awkward, no_docs):
    got = minhash_dedup.near_duplicates(awkward, k=2).collect()
    by = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert len(got) == len(AWKWARD)
    assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8, 9: 9, 10: 10, 11: 11}
    kept = minhash_dedup.dedup(awkward, k=2)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 9, 10, 11]
    assert minhash_dedup.near_duplicates(no_docs).collect() == [] == minhash_dedup.dedup(no_docs).collect()


def test_signatures_estimate_similarity():
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words[:300]), " ".join(words[50:350])
    sets = shingle_sets(pa.array([a, b]), 1)
    sa, sb = (minhash_dedup.signature(s, 128) for s in sets)
    assert abs((sa == sb).mean() - 250 / 350) < 0.15


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(50)] + [(2, 2), (300, 301), (301, 300)]
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: r for i, r in roots({x for p in pairs for x in p}, pairs).items() if i != 2}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(n=700, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.15], (n, 1))
    hub = rng.normal(size=dim)
    x[: n // 3] = hub + rng.normal(size=(n // 3, dim)) * 0.12
    return [(i, v.astype(np.float32).tolist(), int(i % 2 + (i > n // 2))) for i, v in enumerate(x)]


def slow_vectors(rows, threshold=0.98):
    pairs = []
    fine = [(i, np.array(v, float), label) for i, v, label in rows
            if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    for (a, x, l1), (b, y, l2) in itertools.combinations(fine, 2):
        if l1 == l2 and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
            pairs.append((a, b))
    n = {i: 0 for i, _, _ in rows}
    for p in pairs:
        for i in p:
            n[i] += 1
    return n, roots([i for i, _, _ in rows], pairs)


def as_df(spark, rows):
    return (spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
            .selectExpr("*", "1 as id", "2 as v", "3 as cells", "4 as n"))


@pytest.mark.parametrize("block", [1024, 20])
@pytest.mark.parametrize("cells", [1, 12])
def test_vectors_against_all_pairs(spark, monkeypatch, block, cells):
    rows = vectors()
    monkeypatch.setattr(embedding_dedup, "fit_cells", lambda found, n, dim: embedding_dedup.spherical_kmeans(
        embedding_dedup.unit(np.array([v for _, v, _ in rows], float)), cells))
    monkeypatch.setattr(embedding_dedup.links, "__defaults__", (block,))
    n, part = slow_vectors(rows)
    margin = float(np.sqrt(2 - 2 * 0.98))  # exact
    got = embedding_dedup.near_duplicates(as_df(spark, rows), margin=margin).collect()
    assert {r.vec_id: r.n_links for r in got} == n and {r.vec_id: r.component_id for r in got} == part


def test_default_margin_finds_nearly_all(spark):
    rows = vectors(seed=9)
    n, _ = slow_vectors(rows)
    got = embedding_dedup.near_duplicates(as_df(spark, rows)).collect()
    assert sum(r.n_links for r in got) >= 0.99 * sum(n.values()) and all(r.n_links <= n[r.vec_id] for r in got)


def test_vectors_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0], 2), (11, [1.0, 2.0], 1),
            (12, [1e38, 2e38], 1), (13, [1.0, 2.0, 0.0], 1), (14, [1e-40, 2e-40], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(as_df(spark, rows)).collect()}
    linked = {8, 9, 11, 12, 14}
    for i, *_ in rows:
        assert got[i] == ((4, 8, i == 8) if i in linked else (0, i, True)), i
    assert embedding_dedup.near_duplicates(as_df(spark, rows).limit(0)).collect() == []
    same = embedding_dedup.near_duplicates(as_df(spark, [(1, [1.0, 2.0], 1)] * 3)).collect()
    assert [tuple(r) for r in same] == [(1, 2, 1, True)] * 3
    unnamed = [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (4, [2.0, 4.0], 1)]
    found = Counter(tuple(r) for r in embedding_dedup.near_duplicates(as_df(spark, unnamed)).collect())
    assert found == {(None, 0, None, True): 2, (3, 1, 3, True): 1, (4, 1, 3, False): 1}
    assert {tuple(r) for r in embedding_dedup.near_duplicates(as_df(spark, unnamed[:2])).collect()} == {(None, 0, None, True)}


@pytest.mark.parametrize("least", [0, 1])
def test_link_along_the_line_between_centroids(spark, monkeypatch, least):
    """In 768 dimensions, either vector of the pair being the nearer one to the border."""
    centroids = np.eye(768)[:2]
    monkeypatch.setattr(embedding_dedup, "fit_cells", lambda *_: centroids)
    shift, half = (0.02, -0.02)[least], 0.0995
    rows = [(i, [math.cos(a), math.sin(a)] + [0.0] * 766, 1)
            for i, a in enumerate((math.pi / 4 + shift - half, math.pi / 4 + shift + half, 0.0, math.pi / 2))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (0, 3)}
