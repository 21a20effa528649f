"""Incremental blob ledger for secret scans, in DataFrame operations only.

Texts are addressed by content: ``paths`` says which document holds which
blob, ``blobs`` stores every distinct text once, ``scans`` says which rule
versions have seen a blob and ``findings`` what they found. An update scans
only unseen pairs of blob and rule version (new texts under all rules, old
texts under new rule versions) and findings reach all paths by a join on the
digest. Copies of a text, however many, are scanned once.

A rule's spans are the leftmost non-overlapping matches of its pattern, from
which those whose tested group is too short are dropped. Spans are code points
of the whole match, end exclusive. A match's start is the length of all gaps
and matches before it, a running sum over one blob's matches.

Cases: a null text is an empty one, with no findings; texts are read whole;
repeated rows are paths of their own; rows with a null id keep it; an empty
table gives empty results; other columns do not matter. After a failed update
the next one repeats what was not recorded; findings are read distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorqc.llm.common import checkpointed


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters; ``needle`` is in every match (a quick test)."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    needle: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def any_case(pattern: str) -> str:
    """ASCII letters of the pattern in either case."""
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in pattern)


# The three base rules, in the order in which they are listed.
BASE = (
    Rule("assign", 1, "(" + any_case("password|passwd|secret|token|api_?key")
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=18, needle="AKIA"),
    # A run of 16 or more is the same match as a run of any length that passes the test.
    Rule("hex", 1, r"[0-9a-f]{16,}", least=16),
)
RULES = BASE + (
    # The header lines are those of encrypted keys; a key that is cut off has no END line.
    Rule("private_key", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\x20\x09-\x0D]*(?:Proc-Type:[^\x0A]*\x0A)?"
         r"(?:DEK-Info:[^\x0A]*\x0A)?[A-Za-z0-9+/=\x20\x09-\x0D]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
         needle="-----BEGIN "),
    Rule("code_host", 1, r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}", needle="gh"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", needle="xox"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needle="eyJ"),
    # Without the scheme, of any length, so that a long run of letters is not tried from each of them.
    Rule("url_login", 2, r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]{4,}@", needle="://"),
)

PATHS = "doc_id bigint, digest binary"
BLOBS = "digest binary, text string"
SCANS = "digest binary, rules array<string>"
FINDINGS = "digest binary, kind string, version int, start int, end int"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda x: F.length(x))


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, done: str = "done") -> DataFrame:
    """FINDINGS of blobs (digest, text, done: rule names not to apply again)."""
    text, seen = F.col("text"), F.coalesce(F.col(done), F.array().cast("array<string>"))
    hits = []
    for k, r in enumerate(rules):
        p = F.lit(r.pattern)
        quick = text.contains(r.needle) if r.needle else F.lit(True)
        hits.append(F.when(~F.array_contains(seen, r.name) & quick & text.rlike(r.pattern), F.struct(
            F.lit(k).alias("rule"),
            _lengths(F.split(text, r.pattern, -1)).alias("gaps"),
            _lengths(F.regexp_extract_all(text, p, F.lit(0))).alias("whole"),
            _lengths(F.regexp_extract_all(text, p, F.lit(r.group))).alias("tested"))))
    by_rule = (blobs.select("digest", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("h"))
               .select("digest", "h.rule", F.posexplode(F.arrays_zip("h.gaps", "h.whole", "h.tested"))))
    before = Window.partitionBy("digest", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("col.gaps") + F.coalesce(F.col("col.whole"), F.lit(0))).over(before)
    of = lambda x: F.element_at(F.array(*[F.lit(getattr(r, x)) for r in rules]), F.col("rule") + 1)
    return (by_rule.withColumn("end", end.cast("int")).filter(F.col("col.tested") >= of("least"))
            .select("digest", of("kind").alias("kind"), of("version").alias("version"),
                    (F.col("end") - F.col("col.whole")).alias("start"), "end"))


class BlobLedger:
    """The four tables of a ledger below ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, folder: str) -> BlobLedger:
        made = cls(spark, folder)
        for name, schema in (("paths", PATHS), ("blobs", BLOBS), ("scans", SCANS), ("findings", FINDINGS)):
            made._append(spark.createDataFrame([], schema), name)
        return made

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").option("compression", "zstd").parquet(f"{self.folder}/{name}")

    def table(self, name: str) -> DataFrame:
        schema = {"paths": PATHS, "blobs": BLOBS, "scans": SCANS, "findings": FINDINGS}[name]
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Records the documents' paths and stores texts that are not known yet."""
        rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                           F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        self._append(rows.select("doc_id", digest(F.col("text")).alias("digest")), "paths")
        self._append(rows.select(digest(F.col("text")).alias("digest"), "text").dropDuplicates(["digest"])
                     .join(self.table("blobs").select("digest"), "digest", "left_anti"), "blobs")

    def scan(self, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans the pairs of stored blob and rule version that are not recorded yet."""
        names = F.array(*[F.lit(r.name) for r in rules])
        seen = (self.table("scans").select("digest", F.explode("rules").alias("rule"))
                .groupBy("digest").agg(F.collect_set("rule").alias("done")))
        blobs = self.table("blobs").join(seen, "digest", "left")
        unseen = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
        todo = blobs.select("digest", unseen.alias("rules")).filter(F.size("rules") > 0)
        self._append(find(blobs, rules), "findings")
        self._append(todo, "scans")

    def report(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Per path: doc_id and ``spans``, structs (start, rule, end) in order, rules numbered as listed."""
        number = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
        # Checkpointed, both sides of the join come from shuffles of its own, which Spark can split at hot digests.
        found = checkpointed(
            self.table("findings").distinct()
            .withColumn("rule", number[F.concat_ws("@", "kind", F.col("version").cast("string"))])
            .filter(F.col("rule").isNotNull())
            .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))).alias("spans")))
        return self.table("paths").join(found, "digest", "left").select("doc_id", "spans")


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))))
