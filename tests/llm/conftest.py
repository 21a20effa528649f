"""Small tables with every awkward case, and readers of the given ones."""

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
# Columns whose names clash with those that operators use inside.
CLASHES = ("measures", "failed", "rewritten", "size", "taken", "mix_key", "line_doc", "slot", "group", "bucket",
           "spans", "h", "n_docs", "COPIES")


def given(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


AWKWARD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", "de", "b"), (4, "one", "en", "a"), (5, "One", "en", "a"),
    (6, "wörter ünd ſigns 😀 " * 30, "de", "b"), (7, "wörter ünd ſigns 😀 " * 30, "de", None),
    (8, "same line\n" * 40, "en", "a"), (8, "same line\n" * 40, "en", "a"),
    (9, "x" * 200_000, "en", "c"), (10, " ".join(f"w{i}" for i in range(60_000)), "en", "c"),
    (None, "no id but some words here", "en", "a"), (11, "no id but some words here", None, "a"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """documents with nulls in every column, empty and long texts, ties, a repeated row and clashing columns."""
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in AWKWARD], cols)
    for i, c in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i} as `{c}`")
    return df


@pytest.fixture(scope="session")
def no_docs(awkward):
    return awkward.limit(0)
