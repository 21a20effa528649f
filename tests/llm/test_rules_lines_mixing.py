"""Quality rules, line dedup and mixing: awkward rows, reversibility, policies."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorqc.llm import line_dedup, mixing, quality_rules
from tests.llm.conftest import AWKWARD, CLASHES


def slow_measures(text):
    """The measurements as the definitions say, word by word."""
    blanks = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in blanks else c for c in text or "").split(" ")
    words = [w for w in words if w]
    chars = sum(map(len, words))
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("text", [None, "", "a a a a", "a b c a b", "x\n\nx\n x", "a b c d a b c d", "#*$ %&|<>", "ſK " * 5,
                                  "a b a b a c a b a"] + [r[1] for r in AWKWARD if r[1] and len(r[1]) < 5000])
def test_measures(text):
    assert quality_rules.measure(text)[:5] == slow_measures(text)


def test_ledger_and_policies(spark, awkward, no_docs):
    rows = quality_rules.ledger(awkward).collect()
    assert len(rows) == len(AWKWARD)
    few = {r.doc_id for r in rows if r.failed & 1}
    assert {1, 2, 3, 4, 5, 9} <= few and 10 not in few
    kept = quality_rules.keep(awkward)
    assert kept.columns == awkward.columns and kept.schema == awkward.schema
    assert [r.doc_id for r in kept.collect()] == [10]
    assert quality_rules.ledger(no_docs).collect() == [] and quality_rules.keep(no_docs).collect() == []


def test_ablations_follow_from_the_bits(spark, awkward):
    ledger = quality_rules.ledger(awkward).cache()
    bits = [r.failed for r in ledger.collect()]
    for version, policy in quality_rules.POLICIES.items():
        got = {r.rule: (r.n_failed, r.n_failed_alone, r.kept_without) for r in quality_rules.ablations(ledger, version).collect()}
        for r in quality_rules.RULES:
            bit = 1 << r.bit
            if policy & bit:
                want = (sum(b & bit > 0 for b in bits), sum(b & policy == bit for b in bits),
                        sum(b & policy & ~bit == 0 for b in bits))
                assert got[r.name] == want
            else:
                assert r.name not in got


def slow_dedup(texts, min_docs):
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower()
    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        kept = [x for x in (t or "").split("\n") if not key(x) or seen[key(x)] < min_docs]
        out.append(("\n".join(kept), (t or "").count("\n") + 1 - len(kept)))
    return out


def lines_df(spark, n=60):
    rng = np.random.default_rng(3)
    texts = ["\n".join(f"{'  ' * (i % 2)}Line {j}" for j in rng.integers(0, 40, 6)) + "\n" + f"own {i}" for i in range(n)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("max_bytes", [line_dedup.FILTER_BYTES, 0])
def test_line_dedup_by_filters_and_by_join(spark, max_bytes):
    texts, docs = lines_df(spark)
    refs, filters, n = line_dedup.state(docs, 10)
    done, out = line_dedup.rewritten(docs, refs, filters, n, 10, max_bytes=max_bytes)
    got = {r.doc_id: r[out] for r in done.collect()}
    for i, (kept, dropped) in enumerate(slow_dedup(texts, 10)):
        assert (got[i].kept, got[i].n_dropped) == (kept, dropped)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_deleting_documents_brings_lines_back(spark):
    texts, docs = lines_df(spark)
    refs, filters, n = line_dedup.state(docs, 10)
    some = docs.filter("doc_id < 25")
    left = line_dedup.remove_refs(refs, line_dedup.line_refs(some)).cache()
    filters = line_dedup.update_filters(filters, refs, left, 10, n)
    rest = docs.filter("doc_id >= 25")
    done, out = line_dedup.rewritten(rest, left, filters, n, 10)
    got = {r.doc_id: r[out].kept for r in done.collect()}
    assert [got[i] for i in range(25, 60)] == [k for k, _ in slow_dedup(texts[25:], 10)]
    # and adding them again gives the first state
    again = line_dedup.add_refs(left, line_dedup.line_refs(some))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, refs.collect()))
    filters = line_dedup.update_filters(filters, left, again, 10, n)
    done, out = line_dedup.rewritten(docs, again, filters, n, 10)
    assert {r.doc_id: r[out].kept for r in done.collect()} == dict(enumerate(k for k, _ in slow_dedup(texts, 10)))


def test_cuckoo_filter_deletes_only_what_it_was_told():
    keys = line_dedup.digests([b"%d" % i for i in range(3000)])
    h1, h2 = keys[:, 0].copy(), keys[:, 1].copy()
    made = line_dedup.Cuckoo.of(h1, h2)
    probe = lambda: line_dedup.Filters(1, [{"shard": 0, "n_buckets": made.n_buckets, "slots": made.slots.tobytes()}])
    assert probe().has(h1, h2).all()
    made.delete(h1[:1000], h2[:1000])
    assert probe().has(h1, h2)[1000:].all() and not probe().has(h1, h2)[:1000].any()
    assert made.insert(h1[:1000], h2[:1000]) and probe().has(h1, h2).all()


def test_exceptions_take_out_wrong_answers():
    keys = line_dedup.digests([b"a", b"b"])
    made = line_dedup.Cuckoo.of(keys[:1, 0].copy(), keys[:1, 1].copy())
    row = [{"shard": 0, "n_buckets": made.n_buckets, "slots": made.slots.tobytes()}]
    assert line_dedup.Filters(1, row).has(*np.ascontiguousarray(keys.T)).tolist() == [True, False]
    assert not line_dedup.Filters(1, row, keys[:1]).has(*np.ascontiguousarray(keys.T)).any()


def test_line_dedup_awkward(spark, awkward, no_docs):
    done = line_dedup.dedup_lines(awkward, min_docs=2)
    assert done.columns == awkward.columns
    got = defaultdict(list)
    for r in done.collect():
        got[r.doc_id].append(r.text)
    assert got[1] == [None] and got[2] == [""] and got[3] == [" \n\t "] and got[4] == [""] == got[5]
    assert got[8] == ["", ""] and got[9] == ["x" * 200_000] and got[11] == [""]
    assert all(r.n_chars == len(r.text) for r in done.filter("text is not null").collect())
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_mixing_targets_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 400)), s) for i, s in enumerate(rng.choice(["a", "b", "c", "d", None], 2000))]
    docs = spark.createDataFrame([(i, t, None if s is None else str(s)) for i, t, s in rows], "doc_id long, text string, source string")
    got = mixing.plan(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken in (0, r.size, 2 * r.size)
    total = sum(r.size for r in got)
    for s, rs in by.items():
        size = sum(r.size for r in rs)
        assert {r.source_size for r in rs} == {size}
        assert rs[0].target <= 2 * size and abs(sum(r.taken for r in rs) - rs[0].target) <= 2 * max(r.size for r in rs)
    targets = {s: rs[0].target for s, rs in by.items()}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    # fair levels: equal among those below their cap
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    free = [t / weight[s] for s, t in targets.items() if t < 2 * by[s][0].source_size - 1e-6]
    assert max(free) == pytest.approx(min(free))
    again = mixing.plan(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    mixed = Counter(r.doc_id for r in mixing.emit(docs, mixing.plan(docs)).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in got if r.copies})


def test_mixing_awkward(spark, awkward, no_docs):
    got = mixing.plan(awkward).collect()
    assert len(got) == len(AWKWARD)
    mixed = mixing.emit(awkward, mixing.plan(awkward))
    assert mixed.columns == awkward.columns and set(CLASHES) <= set(mixed.columns)
    assert all(n <= 4 for n in Counter(r.doc_id for r in mixed.collect()).values())
    assert mixing.plan(no_docs).collect() == []
    empty = awkward.filter("doc_id in (1, 2, 3)")
    assert {(r.size, r.target, r.taken) for r in mixing.plan(empty).collect()} == {(0, 0.0, 0)}
