"""Chat formatting: logged snapshots of a growing conversation collapse into the longest. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendline.session import stage_path

BLOCK = 256     # turns that are numbered and hashed together; a conversation of any length is a chain of such blocks
_HASH = ["h1", "h2"]


def turn_prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per turn: `conv`, `block`, `nth` (from 1, in the order of turn, role and text), `role`, `text`, and `h1`, `h2`, the rolling
    128-bit hash of the conversation up to and with this turn.

    Each turn's hash holds its number; the rolling hash is the exclusive-or of those so far. Blocks are summed up by
    themselves and joined with what stands before them, so that no conversation needs one task.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"),
                        F.expr(f"coalesce(cast(`{turn_col}` as bigint), -1L) div {BLOCK}").alias("block"))
    within = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    upto = Window.partitionBy("conv", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "block").count().select("conv", "block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
    numbered = _with_block(rows.withColumn("nth", F.row_number().over(within)), sizes).withColumn("nth", F.col("nth") + F.col("start")).drop("start", "turn")
    hashed = numbered.withColumns({"h1": F.xxhash64("nth", "role", F.col("role").isNull(), "text", F.col("text").isNull()),
                                   "h2": F.xxhash64(F.lit(7), "nth", "role", F.col("role").isNull(), "text", F.col("text").isNull())})
    totals = hashed.groupBy("conv", "block").agg(*[F.bit_xor(h).alias(h) for h in _HASH]).select(
        "conv", "block", *[F.coalesce(F.bit_xor(h).over(earlier), F.lit(0)).alias(f"{h}_before") for h in _HASH])
    rolled = hashed.withColumns({h: F.bit_xor(h).over(upto) for h in _HASH})
    return _with_block(rolled, totals).withColumns({h: F.col(h).bitwiseXOR(F.col(f"{h}_before")) for h in _HASH}).drop("h1_before", "h2_before")


def _with_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    other = blocks.withColumnsRenamed({"conv": "__conv", "block": "__block"})
    return rows.join(other, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block"))).drop("__conv", "__block")


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """`conv`, `n_turns` and `n_copies` of the conversations that are no prefix of a longer one; of equal ones the smallest id."""
    ends = prefixes.groupBy("conv").agg(F.max("nth").alias("n_turns"))
    other = ends.withColumnRenamed("conv", "__conv")
    rows = prefixes.select("conv", "nth", *_HASH).join(other, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")
    last = rows.where("nth = n_turns").groupBy("n_turns", *_HASH).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    inner = rows.where("nth < n_turns").select(F.col("nth").alias("n_turns"), *_HASH).distinct()
    return last.join(inner, ["n_turns", *_HASH], "left_anti").select("conv", "n_turns", "n_copies")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 before_role: str = "<|im_start|>", after_role: str = "\n", after_text: str = "<|im_end|>\n") -> DataFrame:
    """Maximal conversations as text: the conversation's id, `n_turns`, `n_copies`, `part` and `rendered`.

    A part holds the turns of one block of `BLOCK` turn numbers; almost every conversation has one. Parts in order, joined without anything
    between, are the whole text. Null role or text: empty. A null conversation id is an id like any other, as is a null turn
    number, which comes first; repeated turns are turns. An empty table gives no rows.
    """
    spark = turns.sparkSession
    path = stage_path(turns.sparkSession, "turns")
    turn_prefixes(turns, conv_col, turn_col, role_col, text_col).write.parquet(path)
    prefixes = spark.read.parquet(path)
    kept = maximal_conversations(prefixes).withColumnRenamed("conv", "__conv")
    line = F.concat(F.lit(before_role), F.coalesce("role", F.lit("")), F.lit(after_role), F.coalesce("text", F.lit("")), F.lit(after_text))
    parts = (prefixes.join(kept, F.col("conv").eqNullSafe(F.col("__conv"))).groupBy("conv", "n_turns", "n_copies", F.col("block").alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct("nth", line.alias("line")))).alias("lines")))
    return parts.select(F.col("conv").alias(conv_col), "n_turns", "n_copies", "part", F.array_join(F.col("lines.line"), "").alias("rendered"))
