"""Aggregation, ordering and set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])


def rollup_flags(df: DataFrame, document: Sequence[str], group: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    """Lift item flags to documents (any item), then count documents per group."""
    per_doc = df.groupBy(*dict.fromkeys([*document, *group])).agg(
        *[F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in flags])
    return per_doc.groupBy(*group).agg(F.count("*").alias("DocumentCount"),
                                       *[F.sum(c).alias(n) for c, n in flags.items()])


def with_total(df: DataFrame, column: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Attach the total of a column over the group (or the whole frame) to each row.

    The total is aggregated with map-side combine and then looked up (a scalar subquery for the
    grand total), instead of a window that would bring a whole group into one task.
    """
    if not within:
        return df.withColumn(name, df.agg(F.sum(column)).scalar())
    return df.join(df.groupBy(*within).agg(F.sum(column).alias(name)), list(within), "left")


def share_of_total(df: DataFrame, column: str, name: str, within: Sequence[str] = (), digits: int = 2) -> DataFrame:
    out = with_total(df, column, "__total", within)
    share = F.when(F.col("__total") > 0,
                   F.round(F.col(column).cast("double") * 100.0 / F.col("__total").cast("double"), digits))
    return out.withColumn(name, share).drop("__total")


def quantile_sketch(df: DataFrame, spec: Mapping[str, tuple[str, float]], err: float = 0.01) -> DataFrame:
    """One row with values `{name: (column, p)}` whose rank is at most `err` * n away from p * n: a mergeable sketch of bounded size."""
    return df.agg(*[F.percentile_approx(c, F.lit(p), F.lit(int(round(1 / err)))).alias(n) for n, (c, p) in spec.items()])


def percentiles(df: DataFrame, by: Sequence[str], column: str, ps: Mapping[str, float], accuracy: int = 10000) -> DataFrame:
    """Mergeable-sketch percentiles per group: bounded state however large the group is."""
    arr = F.percentile_approx(column, F.array(*[F.lit(p) for p in ps.values()]), F.lit(accuracy))
    out = df.groupBy(*by).agg(arr.alias("__p"))
    return out.select(*by, *[F.col("__p")[i].alias(n) for i, n in enumerate(ps)])


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and share of every column, from a single pass."""
    counts = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("NullCount")) for c in columns])
    return (counts.select("__n", F.inline(pairs))
            .select("ColumnName", "NullCount", F.col("__n").alias("RowCount"),
                    F.round(F.col("NullCount") * 100.0 / F.col("__n"), 2).alias("NullPct")))


def max_across(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.agg(F.max(F.greatest(*columns)).alias(name))


def coverage(df: DataFrame, by: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("RowCount"),
                               *[F.round(F.avg(F.col(c).cast("double")) * 100.0, 2).alias(n) for c, n in flags.items()])


def first_last(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """First and last dated value per key by min_by / max_by: one combinable pass, no sort."""
    return df.groupBy(key).agg(
        F.min(date).alias("FirstDate"), F.min_by(value, date).alias("FirstValue"),
        F.max(date).alias("LastDate"), F.max_by(value, date).alias("LastValue"))


def order_by(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.orderBy(*columns)


def top_n(df: DataFrame, n: int, *columns: Column | str) -> DataFrame:
    """Sort + limit; Spark keeps the best n rows per partition, never the full sort."""
    return df.orderBy(*columns).limit(n)


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(*keys) for f in frames]).distinct()


def union_versions(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def replace_rows(df: DataFrame, where: Column, new: DataFrame) -> DataFrame:
    """Drop the rows that match and put `new` in their place."""
    return df.where(~F.coalesce(where, F.lit(False))).unionByName(new)

