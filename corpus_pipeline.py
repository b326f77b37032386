"""From raw documents to packed training sequences: each stage calls one operator on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendline.llm import decontam, line_dedup, ngram_join, packing, toxicity
from spendline.session import stage_path

FEW_KEYS = 500_000      # as many removed documents at most are broadcast



def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator, learned from all labels, does not reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in ten documents or more; `n_chars` follows the text. Every document stays, an emptied one with empty text."""
    done = line_dedup.dedup_lines(docs, min_docs=10)
    return done.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id. Documents without words or id have no group and stay."""
    path = stage_path(spark, "duplicates")
    groups = ngram_join.near_duplicates(docs, width=5, percent=75)
    groups.where("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct().write.parquet(path)
    gone = spark.read.parquet(path)
    if gone.count() <= FEW_KEYS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    leaks = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontam.decontaminate(docs, leaks)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 ids."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_duplicates", one_of_each_group), ("decontamination", drop_leaks), ("packing", pack)]

#: Learned scores, a similarity join and token ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = stage_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
