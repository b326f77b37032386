"""The registered queries of this subpackage: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendline.llm import (chat, conversation_trie, decontam, filter_audit, html_extract, line_dedup, multi_index, ngram_join, packing, pii, secret_scan, toxicity, warc)
from spendline.llm.sql import ORACLES
from spendline.session import stage_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak benchmark items, and which."""
    leaks = decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select(F.col("id").alias("doc_id"), "item_id", "n_windows", "item_windows", "n_slots", "verbatim")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of the log, rendered."""
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in ten documents or more."""
    done = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside of the held-out fifth."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0))
    model = toxicity.fit(docs.where(fold != 0), _table(spark, sf_dir, "labels"))
    return toxicity.score(docs.withColumn("held_out", fold == 0), model).select("doc_id", "held_out", "score", "predicted")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set sizes and components of all documents."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), width=5, percent=75)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")     # noqa: E731
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")       # noqa: E731
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(named(F.filter("spans", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return multi_index.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures as read back from the archive of all pages."""
    path = stage_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_archive(spark, path, with_blocks=False))
    note = lambda name: F.regexp_extract("metadata.text", rf"(?m)^{name}: ([0-9-]*)\r?$", 1)     # noqa: E731
    whole = F.col("kind") == "response"
    return captures.select(
        F.nullif(note("page"), F.lit("")).cast("long").alias("page_id"),
        F.when(whole, F.col("block_bytes")).otherwise(note("payload-bytes").cast("long")).alias("payload_bytes"),
        F.when(whole, F.col("block_digest")).otherwise(F.col("digest")).alias("payload_digest"), F.col("kind").alias("record_type"),
        F.nullif(F.regexp_extract("refers_to", "^<urn:capture:response:([0-9-]*):", 1), F.lit("")).cast("long").alias("refers_to"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt on the first turns of its group's first conversation."""
    return conversation_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each language, in every order."""
    counts = filter_audit.outcomes(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents; a document is a repository, its source the owner."""
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    named = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")     # noqa: E731
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")       # noqa: E731
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secret_scan.BASE],
                        F.sha2(named(F.filter("spans", lambda x: x["base"])).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
                        named(F.filter("spans", lambda x: x["verdict"] == "live")).alias("live_spans"),
                        named(F.filter("spans", lambda x: x["verdict"] == "example")).alias("example_spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_html": op3_html,
    "op4_chat": op4_chat,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_pii": op8_pii,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_secrets": op13_secrets,
}
