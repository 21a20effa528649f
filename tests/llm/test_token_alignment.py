"""Token alignment against whole-text encodings and plain dictionaries."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sensorqc.llm import queries, token_alignment
from sensorqc.llm.tokens import vocabulary
from tests.llm.conftest import SF, given

COLS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def whole():
    """text -> (A ids, B ids, A bytes, B bytes), each encoded in one call."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in printable]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(other)}

    def encode(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                 for i in ids_b for p in [b.id_to_piece(i)]]
        return ids_a, ids_b, raw_a, raw_b

    return encode


def groups_of(text, whole):
    """[(A ids, B ids)] of a text, or none where the tokens spell something else."""
    if not text:
        return []
    ids_a, ids_b, raw_a, raw_b = whole(text)
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return []

    def ends(raw):
        out = [0]
        for x in raw:
            out.append(out[-1] + len(x))
        return out[1:]

    out, i, j, ends_a, ends_b = [], 0, 0, ends(raw_a), ends(raw_b)
    for e in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
        out.append((ids_a[i:p], ids_b[j:q]))
        i, j = p, q
    return out


def brute(texts, whole):
    grouped = [groups_of(t, whole) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in grouped]
    counts = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for g, c in zip(grouped, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                     sum(n for p, n in c.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in c.items()),
                     hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows


def test_query_against_brute_force(spark, whole):
    docs = given("documents")
    want = sorted((d["doc_id"], *r) for d, r in zip(docs, brute([d["text"] for d in docs], whole)))
    got = sorted(tuple(r[c] for c in ("doc_id", *COLS)) for r in queries.op12_align(spark, SF).collect())
    assert got == want


ODD = ["a", " a", "  a  b", "a\n b", "a \n b\tc", "tab\t\ttab", "<|endoftext|> <s> </s>", "a▁b", "x▁", "don't  'll we've",
       "　wide　space", "ﬁ ½ é é", "😀😀 👩‍👩‍👧 flags 🇩🇪", "日本語 のテキスト です", "x" * 3000, "=" * 500 + " " + "-" * 777,
       " " * 300, "\n" * 50 + "end", "\x00 \x01\x7f", "a\x1cb \x1d c", "a\u0085 b c", "1234567890 12 3", None, ""]


@pytest.mark.parametrize("limits", [(), (3, 4, 3, 20, 3, 4)])
@pytest.mark.parametrize("shards", [1, 7])
def test_odd_texts(spark, whole, limits, shards):
    texts = [*ODD, "a", "the same words the same", "the same words the same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in token_alignment.align(df, shards=shards, bounds=token_alignment.Bounds(*limits)).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, whole)


def test_awkward_rows(spark, awkward, no_docs, whole):
    rows = awkward.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], whole)))
    out = token_alignment.align(awkward, with_groups=True)
    got = out.collect()
    assert Counter(tuple(r[c] for c in ("doc_id", *COLS)) for r in got) == want
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.n_groups)
    empty = token_alignment.align(no_docs)
    assert empty.columns == ["doc_id", *COLS[:4], "n_best", "count_sum", "groups_sha256"] and empty.count() == 0


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "Word", "ing", "'s", "12", "é", "日", "😀", " ", "　", "\x1c",
                                 "<s>", "<|endoftext|>", ".", "--", "▁"]), min_size=1, max_size=14))
def test_chunks_give_the_ids_of_the_whole_text(whole, parts):
    text = "".join(parts)
    ids_a, ids_b, raw_a, raw_b = whole(text)
    same = b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode()
    got = encoders().ids(text)
    assert (got is not None) == same
    assert got is None or (got[0].tolist(), got[1].tolist()) == (ids_a, ids_b)


def encoders(made=[]):
    if not made:
        made.append(token_alignment.Encoders(vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model")))
    return made[0]


def test_a_chunk_of_many_documents_is_encoded_once():
    """The tokenizers must not be given every document's words anew."""
    words = [f"Word{chr(97 + k % 26)}{chr(97 + k // 26)}{'ing' * (k % 4)}," for k in range(300)]
    texts = [" ".join(words[k % 7::1 + k % 3]) for k in range(60)]
    made = token_alignment.Encoders(vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    given_chars = [0, 0]

    def counted(side, encode):
        def run(text):
            given_chars[side] += len(text)
            return encode(text)
        return run

    made.of_a, made.of_b = counted(0, made.of_a), counted(1, made.of_b)
    chunks, once = token_alignment.Chunks(made), sum(len(w) + 2 for w in words)
    chunks.documents(texts)
    assert max(given_chars) <= once < sum(map(len, texts)) / 20
    chunks.documents(texts)  # remembered
    assert max(given_chars) <= once
    # Texts with a chunk that does not spell itself are not encoded anew for it.
    assert not chunks.documents([f"a▁b {t}" for t in texts]).numbers.size
    assert max(given_chars) <= once + len(words[0]) + 6


@pytest.mark.parametrize("limits", [(), (5, 4, 3, 20, 3, 4, 10)])
@pytest.mark.parametrize("large", [1, 3, 1 << 12])
def test_parts_of_documents_against_brute_force(whole, monkeypatch, limits, large):
    monkeypatch.setattr(token_alignment.Encoders, "call_chars", 30 if limits else 1 << 12)
    monkeypatch.setattr(token_alignment.Chunks, "align_chars", 25 if limits else 1 << 18)
    monkeypatch.setattr(token_alignment.Chunks, "large_links", large)
    bounds = token_alignment.Bounds(*limits)
    chunks = token_alignment.Chunks(token_alignment.Encoders(vocabulary("byte_bpe_50k.tiktoken"),
                                                             vocabulary("piece_bpe_32k.model"), bounds))
    texts = [*ODD, "one two, one", "a▁b one two, one", "x" * 90, None, "two, " * 40 + "one", " two, one", "one two, "]
    for some in (texts, texts[::-1], ["one"], [None, ""], texts[5:9] * 2):
        part = chunks.documents(some)
        made, starts = part.made, [0, *part.ends.tolist()]
        for lo, hi in [(k, k + 1) for k in range(len(some))] + [(0, len(some)), (1, len(some))]:
            keys, links = token_alignment._pairs_of(part, lo, hi, bounds.block_pairs)
            want = Counter((d, x, y) for d, t in enumerate(some[lo:hi]) for a, b in groups_of(t, whole) for x in a for y in b)
            mask = (1 << chunks.bits) - 1
            got = [(k & 0xFFFF, k >> 16 >> chunks.bits, k >> 16 & mask) for k in keys.tolist()]
            assert len(set(got)) == len(got) and dict(zip(got, links.tolist())) == want
        for d, t in enumerate(some):
            numbers, groups = part.numbers[starts[d]:starts[d + 1]], groups_of(t, whole)
            assert "".join(made.texts[k] for k in numbers)[:-1] == ";".join(
                f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            assert made.figures[:, numbers].sum(1).tolist() == [
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                sum(len(a) * len(b) for a, b in groups)]


@pytest.mark.parametrize("part_bytes", [1, 200, 1 << 21])
def test_parts_do_not_change_results(spark, whole, part_bytes):
    texts = [*ODD, "the same words the same", "the same words the same"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bounds = token_alignment.Bounds(part_bytes=part_bytes, block_docs=11)
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in token_alignment.align(df, shards=3, bounds=bounds).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, whole)
