"""Separator scan and packing against the tokenizer run in one place."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorqc.llm import packing, queries, token_counts
from sensorqc.llm.common import shared_folder, written
from sensorqc.llm.tokens import contract_encoder, encoder, vocabulary
from tests.llm.conftest import AWKWARD, SF, given


@pytest.fixture(scope="module")
def ids():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids


def test_rank_file_gives_the_same_ids(ids):
    encode = encoder(vocabulary())
    for r in given("documents") + [{"text": r[1]} for r in AWKWARD]:
        assert not r["text"] or encode(r["text"]) == ids(r["text"])


def test_token_counts_query(spark, ids):
    got = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, SF).collect()}
    assert got == {r["doc_id"]: len(ids(r["text"])) for r in given("documents")}


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y ", "<|endoftext|", "  <|endoftext|>\n\n z",
         "<|endoftext|>'s <|<|endoftext|>|> ü", "word " * 70 + "<|endoftext|> " * 3 + "word " * 70]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_added_tokens_in_packed_texts(spark, ids, name):
    docs = list(enumerate(ADDED))
    assert [contract_encoder(vocabulary(name))(t) for t in ADDED] == [ids(t) for t in ADDED]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), vocabulary(name), seq_len=64).collect()
    check_packed(rows, docs, ids, 64)


def test_token_files_keep_the_literal_as_text(spark):
    """In the flat files the id ends a document, so a text must not hold it."""
    assert all(token_counts.END not in encoder(vocabulary())(t) for t in ADDED)


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.sampled_from(["<|endoftext|>", "<|", " ", "  ", "a", "'s", "\n", "12", "é", "endoftext|>"]), max_size=12))
def test_texts_split_at_added_tokens(ids, parts):
    assert contract_encoder(vocabulary())("".join(parts)) == ids("".join(parts))


def scanned(order, folder, **kw):
    return sorted(map(tuple, token_counts.scan_token_files(order, folder, **kw).collect()))


def test_blocks_do_not_matter(spark, awkward, ids):
    folder = shared_folder(spark, "t")
    order = written(token_counts.write_token_files(awkward, folder, file_bytes=1000), "t")
    whole = scanned(order, folder)
    assert whole == scanned(order, folder, block=64) == scanned(order, folder, block=7)
    lengths = {(p, o): n for p, o, _, n, _ in whole}
    got = sorted(((r.doc_id or 0), lengths[r.path, r.ordinal]) for r in order.collect())
    assert got == sorted(((r[0] or 0), len(ids(r[1]))) for r in AWKWARD)


def test_file_without_a_last_end(spark):
    folder = shared_folder(spark, "t")
    order = written(token_counts.write_token_files(spark.createDataFrame([(1, "one two")], "doc_id long, text string"),
                                                   folder, end=7), "t")
    # read with another end id, the file is one open document
    assert [r[2:] for r in scanned(order, folder, end=50256, block=2)] == [(0, 3, False)]


def test_no_documents(spark, no_docs):
    folder = shared_folder(spark, "t")
    order = written(token_counts.write_token_files(no_docs, folder), "t")
    assert scanned(order, folder) == []
    assert packing.pack(no_docs).collect() == []


def check_packed(rows, docs, ids, seq_len=1024):
    """Pieces cut as agreed, sequences gapless and not too long; returns the number of sequences."""
    want = sorted((d or 0, i, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes()))
                  for d, x in ((d, ids(t) + [2]) for d, t in docs) for i, (a, b) in enumerate(packing.cut(len(x), seq_len)))
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= seq_len
    return len(inside)


def test_packing_query(spark, ids):
    docs = [(r["doc_id"], r["text"]) for r in given("documents")]
    rows = queries.op8_pack(spark, SF).collect()
    n = check_packed(rows, docs, ids)
    assert n <= -(-sum(r.length for r in rows) // 1024) * 1.03 + 1


def test_packing_awkward(spark, awkward, ids):
    rows = packing.pack(awkward.repartition(3), seq_len=64).collect()
    check_packed(rows, [r[:2] for r in AWKWARD], ids, 64)


def test_sequences_hold_the_tokens(spark, ids):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(40)], "doc_id long, text string")
    packed = written(packing.pack(docs, seq_len=32, with_ids=True), "t")
    for r in packing.sequences(packed).collect():
        assert 0 < len(r.ids) <= 128
    total = sum(len(ids("some words " * i)) + 1 for i in range(40))
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == 4 * total


@pytest.mark.parametrize("n", [1, 2, 5, 1023, 1024, 1025, 2048, 5000])
def test_only_the_first_piece_is_short(n):
    cuts = packing.cut(n, 1024)
    assert cuts[0][0] == 0 and cuts[-1][1] == n
    assert all(b - a == 1024 for a, b in cuts[1:]) and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))


@settings(max_examples=40, deadline=None)
@cases(st.lists(st.tuples(st.integers(1, 32), st.integers(0, 500)), max_size=20))
def test_plan_uses_up_any_histogram(parts):
    histogram = np.zeros(33, np.int64)
    for length, n in parts:
        histogram[length] += n
    used = np.zeros(33, np.int64)
    for lengths, n in packing.plan(histogram, 32):
        assert 0 < sum(lengths) <= 32 and n > 0
        for a in lengths:
            used[a] += n
    assert (used == histogram).all()


def test_patterns_of_the_fit_fill_sequences():
    pats = packing.patterns(64)
    assert (pats.sum(axis=1) == 64).all()
    histogram = np.bincount(np.random.default_rng(0).integers(1, 65, 20_000), minlength=65)
    planned = packing.plan(histogram, 64)
    full = sum(n for lengths, n in planned if sum(lengths) == 64)
    sequences = sum(n for _, n in planned)
    assert full > 0.95 * sequences
    assert sequences <= 1.01 * int((histogram * np.arange(65)).sum()) / 64
