"""Registry of named queries: a Spark plan over a mart, its output columns, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendline.plans import oracle
from spendline.plans.mart import Mart, mart


@dataclass(frozen=True)
class Query:
    plan: Callable[[Mart], DataFrame]
    columns: dict[str, str]
    sql: str | None

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        out = self.plan(mart(spark, directory))
        return out.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()]) if self.columns else out

    def oracle(self) -> str | None:
        return oracle.typed(self.sql, self.columns) if self.sql else None


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str = "", sql: str | None = None):
    """Register a plan. `columns` is "name:type name:type"; decimals are compared as double."""
    kinds = dict(part.split(":") for part in columns.split())

    def add(plan: Callable[[Mart], DataFrame]):
        if name in QUERIES:
            raise KeyError(f"{name} registered twice")
        QUERIES[name] = Query(plan, kinds, sql)
        return plan
    return add
