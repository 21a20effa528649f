"""The pipeline, stage by stage, against a replay in plain Python."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.conftest import SF, given
from tests.llm.test_near_duplicates import slow_components
from tests.llm.test_rules_lines_mixing import slow_dedup, slow_measures
from tests.llm.test_tokens_and_packing import check_packed

BLANKS = " \t\n\x0b\x0c\r"


def replay_rules(docs):
    kept = []
    for d in docs:
        text = d["text"] or ""
        n, chars, symbols, dup, repeated = slow_measures(text)
        lines = sum(bool(x.strip(BLANKS)) for x in text.split("\n"))
        capitals = sum("A" <= c <= "Z" for c in text)
        if not (n < 50 or 100 * repeated > 50 * n or 10 * symbols > 3 * n or 2 * dup > lines
                or chars < 2 * n or chars > 20 * n or 2 * capitals > chars):
            kept.append(d)
    return kept


def replay_lines(docs):
    new = slow_dedup([d["text"] for d in docs], 10)
    return [d | {"text": t, "n_chars": len(t) if dropped else d["n_chars"]} for d, (t, dropped) in zip(docs, new)]


def replay_near(docs):
    part, _ = slow_components([(d["doc_id"], d["text"]) for d in docs], 5)
    return [d for d in docs if part[d["doc_id"]] == d["doc_id"]]


def replay_mix(docs):
    """Shares are dealt out again and again until no source is above twice its size."""
    words = lambda d: len((d["text"] or "").encode().split())
    by = defaultdict(list)
    for d in docs:
        by[d["source"]].append(d)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    size = {s: sum(map(words, by[s])) for s in names}
    target, open_, left = {}, set(names), 1.5 * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        for s in full or open_:
            target[s] = 2.0 * size[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    out = []
    for s in names:
        step = round(target[s] / size[s] * (1 << 24)) if size[s] else 0
        at = int(hashlib.md5(f"mix|{s or ''}".encode()).hexdigest()[:6], 16)
        for d in sorted(by[s], key=lambda d: (words(d), d["doc_id"])):
            out += [d] * (((at + step) >> 24) - (at >> 24))
            at += step
    return out


def rows(docs):
    return sorted((d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in docs)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_stages_equal_the_replay(spark, sf):
    docs, plain = spark.read.parquet(f"{sf}/documents.parquet"), given("documents", sf)
    columns = docs.columns
    for (name, stage), replay in zip(cp.STAGES, (replay_rules, replay_lines, replay_near, replay_mix)):
        before, plain = len(plain), replay(plain)
        docs = cp.written(stage(spark, docs, sf), "stage")
        assert docs.columns == columns, name
        got = rows(r.asDict() for r in docs.collect())
        assert got == rows(plain), name
        assert 0 < len(plain) and (name != "quality rules" or len(plain) < before)
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = cp.STAGES[-1][1](spark, docs, sf).collect()
    n = check_packed(packed, [(d["doc_id"], d["text"]) for d in plain],
                     lambda t: ids.encode(t or "", add_special_tokens=False).ids)
    assert n <= 1.05 * sum(r.length for r in packed) / 1024 + 1  # few documents leave gaps


def test_run_is_all_stages(spark):
    """Twice the same pieces (sequence numbers may differ)."""
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    a, b = (Counter(map(key, cp.run(spark, SF).collect())) for _ in range(2))
    assert a == b and a
    assert [name for name, _ in cp.STAGES] == ["quality rules", "line dedup", "near duplicates", "mixing", "packing"]


def test_awkward_and_empty_tables(spark, awkward, no_docs):
    docs = awkward
    for _, stage in cp.STAGES[1:]:
        docs = cp.written(stage(spark, docs, SF), "stage")
    assert {r.doc_id for r in docs.collect()} <= {None, *range(1, 12)} and docs.count() > 0
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, SF).collect() == []
