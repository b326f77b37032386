"""Fitted pipelines and scored tables below the shared folder, found again by what they were fitted on."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(df: DataFrame, *settings: object) -> str:
    """16 hex digits for the rows of a frame and the settings beside it.

    Rows are hashed where they are and combined without order, so neither partitioning nor row order matters; repeated rows do. Columns
    are taken by name. Two numbers (count and a sum of hashes modulo 2^61) reach the driver.
    """
    columns = sorted(df.columns)
    row = F.xxhash64(*[F.col(c).cast("string") for c in columns], *[F.col(c).isNull() for c in columns])
    mark = df.agg(F.count("*"), F.sum(F.pmod(row, F.lit((1 << 61) - 1)).cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr([columns, *mark, *map(str, settings)]).encode()).hexdigest()[:16]


class ModelStore:
    """Models and tables by name and key. An entry is registered after all of it is written, so an interrupted fit leaves no entry."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, kind: str, name: str, key: str) -> str:
        return f"{self.root}/{kind}/{name}/{key}"

    def has(self, name: str, key: str) -> bool:
        try:
            return not self.spark.read.parquet(self.path("registry", name, key)).isEmpty()
        except AnalysisException:       # no such path
            return False

    def register(self, name: str, key: str, kind: str) -> None:
        entry = self.spark.range(1).select(F.lit(name).alias("Name"), F.lit(key).alias("ModelKey"), F.lit(kind).alias("Kind"),
                                           F.lit(self.path(kind, name, key)).alias("Path"), F.current_timestamp().alias("SavedAt"))
        entry.coalesce(1).write.mode("overwrite").parquet(self.path("registry", name, key))

    def entries(self) -> DataFrame:
        """One row per stored model or table; none at first."""
        schema = "Name string, ModelKey string, Kind string, Path string, SavedAt timestamp"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/registry/*/*")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def model(self, name: str, key: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
        """The stored pipeline of this name and key; fitted and saved if there is none."""
        if not self.has(name, key):
            fit().write().overwrite().save(self.path("models", name, key))
            self.register(name, key, "models")
        return PipelineModel.load(self.path("models", name, key))

    def table(self, name: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of this name and key; built and written if there is none."""
        path = self.path("tables", name, key)
        if not self.has(name, key):
            build().write.mode("overwrite").parquet(path)
            self.register(name, key, "tables")
        return self.spark.read.parquet(path)
