"""Rule bitmask ledger: measure once, judge by versioned policies.

Every rule is evaluated once per document. The ledger keeps the measurements
and one integer whose bit r is set if rule r fails, so that a policy is a bit
mask: a document is kept if it fails none of the policy's rules. Other
policies, and the effect of leaving one rule out, are answered from the ledger
alone by bitwise aggregation.

Cases: a null or empty text has no words and fails ``few_words``; texts are
measured whole, whatever their length; repeated rows are measured alike; empty
tables give empty results; other columns, whatever their names, are left as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorqc.llm.common import fresh

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
_MEASURES = StructType([StructField(m, LongType()) for m in MEASURES])

# Characters counted as symbols, and ASCII capitals.
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements, true for a bad document."""

    bit: int
    name: str
    fails: str


#: Bits are never reused: a new rule takes the next one, a changed rule too.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule(5, "shouting", "2 * n_upper > word_chars"),
)


def mask(*names: str, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[n] for n in names)


#: Policy versions by number; a document is kept if no bit of the mask is set.
POLICIES = {
    1: mask("few_words", "repeated_words"),
    2: mask("few_words", "repeated_words", "many_symbols", "repeated_lines", "word_length", "shouting"),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[which] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at ASCII white space only
    blanks = len(raw) - sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text or "") - blanks, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(raw) - len(raw.translate(None, CAPITALS)))


@F.pandas_udf(_MEASURES)
def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


def failure_bits(m: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """The bit mask of the failed rules from the measurement struct ``m``."""
    bits = F.lit(0).cast("long")
    for r in rules:
        fails = r.fails
        for name in MEASURES:
            fails = fails.replace(name, f"`{m}`.{name}")
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def with_ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str, str]:
    """``docs`` with the measurement struct and failure bits, under free names."""
    m = fresh(docs, "measures")
    measured = docs.withColumn(m, _measures(F.col(f"`{text}`")))
    b = fresh(measured, "failed")
    return measured.withColumn(b, failure_bits(m, rules)), m, b


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, the measurements and ``failed`` (bits)."""
    measured, m, b = with_ledger(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                                 rules=rules)
    return measured.select("doc_id", f"{m}.*", F.col(b).alias("failed"))


def apply_policy(rows: DataFrame, version: int, failed: str = "failed") -> Column:
    """True for rows of the ledger that the policy keeps."""
    return F.col(failed).bitwiseAND(F.lit(POLICIES[version])) == 0


def ablations(rows: DataFrame, version: int, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents failing it, and failing nothing else.

    ``kept_without`` is what the policy would keep with the rule left out. One
    partial aggregation per pattern of bits (at most 2 ** rules) precedes it.
    """
    policy = POLICIES[version]
    patterns = (rows.select(F.col("failed").bitwiseAND(F.lit(policy)).alias("failed"))
                .groupBy("failed").agg(F.count(F.lit(1)).alias("n")))
    used = [r for r in rules if policy >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in used]))
    n = F.coalesce(F.col("n"), F.lit(0))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return (patterns.select("failed", "n", each.alias("r")).groupBy("r.rule")
            .agg(F.sum(F.when(hit, n).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("failed") == F.col("r.bit"), n).otherwise(0)).alias("n_failed_alone"),
                 F.sum(F.when((F.col("failed") == 0) | (F.col("failed") == F.col("r.bit")), n).otherwise(0))
                 .alias("kept_without")))


def keep(docs: DataFrame, version: int = 2, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns only."""
    measured, _, b = with_ledger(docs, text)
    return measured.filter(apply_policy(measured, version, b)).select(*[F.col(f"`{c}`") for c in docs.columns])
