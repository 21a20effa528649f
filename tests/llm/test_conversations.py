"""Chat formatting and prefix tries against plain Python."""

import hashlib
import itertools
import zlib
from collections import defaultdict

import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from sensorqc.llm import chat_format, prefix_trie, queries
from tests.llm.conftest import SF, given

SAID = "<|im_end|><|im_start|>assistant ok"
ROWS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_conversation(rows):
    """{conv_id: [(role, text)]}, by turn, nulls first, ties by role and text (nulls first)."""
    out = defaultdict(list)
    key = lambda r: [(x is not None, x if x is not None else 0) for x in (r[1], r[2] or "", r[3])]
    for r in sorted(rows, key=key):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return out


def said(rows):
    want = {}
    for conv, turns in by_conversation(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return want


def digests(df, **kw):
    rows = chat_format.digests(chat_format.format_conversations(df, **kw)).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:5] for r in rows}


def test_chat_query(spark):
    rows = [tuple(r.values())[:4] for r in given("conversations")] + [(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)]
    got = queries.op11_chat(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == said(rows) and len(got) == len(said(rows))
    r = next(r for r in got if r.conv_id == -1)
    assert r.formatted_chars == sum(len(chat_format.format_turn(role, SAID)[0]) for role in ("user", "assistant"))


AWKWARD = [(1, 1, "user", None), (1, None, None, "first"), (1, 0, "assistant", ""), (1, 2, "a\nb\\n<|x", "<\\|<\\\\|<||<"),
           (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie"), (None, 0, "assistant", "nobody's"),
           (3, 0, "assistant", "x<|" * 30_000), *[(4, k, ("user", "assistant")[k % 2], f"<|im_end|>\n{k}") for k in range(700)]]


@pytest.mark.parametrize("chunk_chars", [1, 3_000, 1 << 20])
def test_chat_awkward_rows(spark, chunk_chars):
    df = spark.createDataFrame(AWKWARD, ROWS).selectExpr("*", "1 as chunk", "2 as CONV", "3 as formatted", "4 as content")
    assert digests(df, chunk_chars=chunk_chars) == said(AWKWARD)
    assert digests(df.limit(0), chunk_chars=chunk_chars) == {}


def test_a_long_conversation_is_spread_over_tasks(spark):
    rows = [(7, k, "assistant", f"turn {k} " * 20) for k in range(4_000)] + [(8, 0, "user", "hi")]
    chunks = chat_format.format_conversations(spark.createDataFrame(rows, ROWS)).cache()
    assert chunks.where("conv = 7").count() > 1
    assert {r.conv_id: tuple(r)[1:5] for r in chat_format.digests(chunks).collect()} == said(rows)


PIECES = st.sampled_from(["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>", "<|image|>", "\n", "a", "|>", "é😀"])


@settings(max_examples=300, deadline=None)
@cases(st.lists(st.tuples(st.lists(PIECES, max_size=6), st.lists(st.one_of(st.lists(PIECES, max_size=5), st.sampled_from(
    ["image", "audio", "document", "video"])), max_size=6)), max_size=4))
def test_parts_come_back(turns):
    """Texts between attachments, roles and loss spans are what went in, whatever they hold."""
    out, want = "", []
    for role, parts in turns:
        role = "".join(role)
        content = [{"type": p, "ref": f"r{k}"} if isinstance(p, str) else {"type": "text", "text": "".join(p)}
                   for k, p in enumerate(parts)]
        text, spans, files = chat_format.format_turn(role, content)
        texts = [""]
        for p in parts:
            if isinstance(p, str):
                texts.append("")
            else:
                texts[-1] += "".join(p)
        assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for t in texts if t]
        assert [f[:2] for f in files] == [(p if p != "video" else "other", f"r{k}")
                                          for k, p in enumerate(parts) if isinstance(p, str)]
        out += text
        want.append((role, texts))
    assert list(chat_format.read_back(out)) == want


def test_typed_parts_in_a_table(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int"
    ddl = f"conv_id long, turn long, role string, text array<{part},parts:array<{part}>>>>"
    blank = lambda n, **kw: tuple(kw.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages", "parts")[:n])
    rows = [(1, 0, "user", [blank(8, type="text", text="see <"), blank(8, type="image", ref="i", width=57, height=28), None,
                            blank(8, type="text", text="|"), blank(8, type="text", text="and"),
                            blank(8, type="audio", ref="s", seconds=2.02),
                            blank(8, type="document", ref="d", parts=[blank(7, type="text", text="in"), None,
                                                                      blank(7, type="image", ref="j")]),
                            blank(8, type="document", ref="e", pages=3), blank(8, ref="odd")]),
            (1, 1, "assistant", [blank(8, type="text", text="yes"), blank(8, type="image", ref="k"), blank(8, type="text", text="no")]),
            (1, 2, "assistant", None), (1, 3, "assistant", [])]
    r, = chat_format.format_conversations(spark.createDataFrame(rows, ddl).coalesce(1)).collect()
    assert r.formatted.startswith("<|im_start|>user\nsee <<|image|>|and<|audio|><|document|>in<|image|><|document|><|other|><|im_end|>\n")
    assert [(f.kind, f.ref, f.turn, f.tokens) for f in r.attachments] == [
        ("image", "i", 0, 3), ("audio", "s", 0, 51), ("document", "d", 0, 1), ("image", "j", 0, 1), ("document", "e", 0, 768),
        ("other", "odd", 0, 1), ("image", "k", 1, 1)]
    assert r.expanded_tokens == 826 and [r.formatted[s.start:s.end] for s in r.loss] == ["yes", "no"]


# -- tries --------------------------------------------------------------------------------------------------------


def rebuild(rows):
    convs = by_conversation([r for r in rows if r[0] is not None])
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def nodes_of(sequences):
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(sums[k][0] for k in children[p]) or 1, own + sum(sums[k][1] for k in children[p]))
        ends = ",".join(str(c) for c in sorted(members[p]) if len(sequences[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                    *sums[p], sha(ends)))
    return out


def key(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: (r[1], r[0]))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_query(spark):
    rows = [tuple(r.values())[:4] for r in given("conversations")]
    got = queries.op13_trie(spark, SF)
    assert got.columns == COLUMNS
    assert key(got.collect()) == key(nodes_of(rebuild(rows)))


def made():
    rows = [(None, 0, "user", "nobody's"), (1, None, None, None), (1, 0, "user", "x"), (2, 0, "user", "ü" * 9), (2, 0, "user", "ü" * 9),
            (-7, 0, "user", "x"), (-5, 0, "user", "x"), (-5, 1, "user", "y")]
    for c in range(10, 400):  # shared openings, copies, conversations that end inside others
        rows += [(c, k, "user", f"{c * c % (3 + 2 * k)}") for k in range(c % 13)]
    return rows + [(1000 + c, k, "assistant", "copy") for c in range(60) for k in range(12)]


@pytest.mark.parametrize("capacity", [1, 4, 30, 10_000])
def test_trie_at_any_capacity(spark, capacity):
    df = spark.createDataFrame(made(), ROWS).selectExpr("*", "1 as head", "2 as PATH", "3 as conv", "4 as pos")
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(df)), capacity)
    assert key(got.select(*COLUMNS).collect()) == key(nodes_of(rebuild(made())))


def test_trie_of_nothing(spark):
    for rows in ([], [(None, 0, "user", "x")]):
        told = prefix_trie.turns(spark.createDataFrame(rows, ROWS))
        assert prefix_trie.trie(prefix_trie.rebuilt(told)).count() == 0
    only_short = [(11, 0, "user", "a")]  # its first turns are those of conversation 10, which is not there
    told = prefix_trie.turns(spark.createDataFrame(only_short, ROWS))
    assert key(prefix_trie.trie(prefix_trie.rebuilt(told)).collect()) == key(nodes_of(rebuild(only_short)))


def test_sweep_of_one_container():
    texts = ["", "a", "ab", "abc", "abd", "b"]
    ids = {c: bytes([k]) * 16 for k, c in enumerate("abcd")}
    rows = [(b"".join(ids[c] for c in t), [len(t[: k + 1]) for k in range(len(t))], 9 - n, 1, t) for n, t in enumerate(texts)]
    found = {(r[1], r[0]): r for r in prefix_trie.sweep(0, rows)}
    assert found[0, 4][3:7] == [6, 2, 3, (4 - 1) * 1 + (3 - 1) * 2] and found[2, 5][2] == 5
    assert list(itertools.chain(*[r[2:3] for r in found.values() if r[1] == 0])) == [None]
