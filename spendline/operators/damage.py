"""Deterministic damage: copies of tables that break a rule on known keys, so that a rule is proven by the count it reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = "01"       # two of sixteen last digits: an eighth of the keys


def struck(key: str | Column, mark: str, digits: str = DIGITS) -> Column:
    """Whether a key is one of those a mark strikes: by the last hex digit of the MD5 of mark, colon and key, which any engine computes alike.

    Null keys are not struck.
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.coalesce(F.substring(F.md5(F.concat(F.lit(f"{mark}:"), text)), 32, 1).isin(*digits), F.lit(False))


def struck_sql(key: str, mark: str, digits: str = DIGITS) -> str:
    """The same test in SQL."""
    return f"coalesce(right(md5('{mark}:' || CAST({key} AS VARCHAR)), 1) IN ({', '.join(repr(d) for d in digits)}), FALSE)"


def damaged(df: DataFrame, key: str, changes: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """A copy in which each mark replaces its columns in the rows whose key it strikes; marks apply in their order, to rows as they were."""
    new: dict[str, Column] = {}
    for mark, columns in changes.items():
        for name, value in columns.items():
            new[name] = F.when(struck(key, mark), value.cast(df.schema[name].dataType)).otherwise(new.get(name, F.col(name)))
    return df.withColumns(new)


def repeated(df: DataFrame, key: str, mark: str) -> DataFrame:
    """A copy with the struck rows twice."""
    return df.unionByName(df.where(struck(key, mark)))


def removed(df: DataFrame, key: str, mark: str) -> DataFrame:
    """A copy without the struck rows."""
    return df.where(~struck(key, mark))
