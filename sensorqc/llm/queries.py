"""The registered queries: every operator over its whole table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.llm import (chat_format, embedding_dedup, language_model, line_dedup, minhash_dedup, mixing, packing,
                          prefix_trie, quality_rules, secrets, token_alignment, token_counts, warc)
from sensorqc.llm.common import shared_folder, table, written


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    order = written(token_counts.write_token_files(table(spark, sf_dir, "documents"), folder), "token-order")
    counts = token_counts.scan_token_files(order, folder)
    return order.join(counts.hint("merge"), ["path", "ordinal"], "left").select("doc_id", "n_tokens")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality_rules.apply_policy(rows, 1)).alias("base_failed"),
                       quality_rules.apply_policy(rows, 2).alias("kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    refs, filters, n_shards = line_dedup.state(docs, min_docs=10)
    done, out = line_dedup.rewritten(docs, refs, filters, n_shards, min_docs=10, with_text=False)
    return done.select("doc_id", *[F.col(f"{out}.{c}").alias(c) for c in ("n_lines", "n_dropped", "kept_sha256")])


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.records(spark, folder).select("page_id", F.col("n_bytes").alias("payload_bytes"), "payload_digest",
                                              "record_type", "refers_to")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.BlobLedger.create(spark, shared_folder(spark, "secrets"))
    ledger.add(table(spark, sf_dir, "documents"))
    ledger.scan()
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,rule:int,end:int>>"))
    base = F.filter("spans", lambda s: s["rule"] < len(secrets.BASE))
    rules = F.transform("spans", lambda s: s["rule"])
    counts = [(F.size("spans") - F.size(F.array_remove(rules, k))).cast("long").alias(f"n_{r.kind}")
              for k, r in enumerate(secrets.BASE)]
    return (ledger.report().withColumn("spans", spans)
            .select("doc_id", *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                    secrets.span_text(F.col("spans")).alias("spans")))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), seq_len=1024, end_id=2)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_conversations(rows))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = written(prefix_trie.turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.trie(prefix_trie.rebuilt(told))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_mix": op2_mix,
    "op3_language_model": op3_language_model,
    "op4_rules": op4_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_warc": op6_warc,
    "op7_secrets": op7_secrets,
    "op8_pack": op8_pack,
    "op9_minhash": op9_minhash,
    "op10_embeddings": op10_embeddings,
    "op11_chat": op11_chat,
    "op12_align": op12_align,
    "op13_trie": op13_trie,
}
