"""Joining rows with the facts of their key where few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 1000      # a key with at least 1/HOT of all rows is hot, so at most HOT keys are


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], rows_of: str, how: str = "left") -> DataFrame:
    """`rows` joined with `facts`, one row a key; `rows_of` is the column of `facts` with the key's number of rows.

    Facts of hot keys (at least a thousandth of the sum of `rows_of`, so at most a thousand of them) are broadcast; all other
    keys are joined by a shuffle, in which no key is large. `facts` is read three times and should be a written table. Null keys match nothing.
    """
    total = facts.agg(F.coalesce(F.sum(rows_of), F.lit(0))).first()[0]
    hot = F.col(rows_of) * HOT >= total
    names = [c for c in facts.columns if c not in keys]
    marked = rows.join(F.broadcast(facts.where(hot).withColumn("__hot", F.lit(True))), keys, "left")
    near = marked.where("__hot").drop("__hot")
    far = marked.where("__hot IS NULL").drop("__hot", *names).join(facts.where(~hot), keys, how)
    return near.unionByName(far)
