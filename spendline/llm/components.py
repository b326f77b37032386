"""Connected components of an edge table, by repeated stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.session import stage_path


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and `component` (the smallest node it can reach) of every node that has an edge to another.

    Each round points all larger neighbours of a node at its smallest neighbour, then all smaller ones; the rounds stop when nothing changes,
    after about log(n) of them. Every step is written in the shared folder. Minima are combined before the shuffle, and the joins that follow
    have plain tables on both sides, so Spark splits those of a node with many edges. Null ends are no edges.
    """
    spark = edges.sparkSession
    base = stage_path(spark, "components")
    step = 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        df.write.parquet(f"{base}/{step}")
        return spark.read.parquet(f"{base}/{step}")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    now = kept(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    before, state = None, mark(now)
    while state != before:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        smallest = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = kept(both.where("v > u").join(smallest, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        smallest = kept(large.groupBy("hi").agg(F.min("lo").alias("m")))
        joined = large.join(smallest, "hi")
        now = kept(joined.where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                   .unionByName(smallest.select("hi", F.col("m").alias("lo"))).distinct())
        before, state = state, mark(now)
    lows = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(lows)
