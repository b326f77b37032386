"""How filters interact: every order of application at once, by counting the paths through the lattice of filter subsets."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_BLANK = " \t\n\x0b\x0c\r"
_SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column, min_words: int = 200, distinct_percent: int = 50, capitals_percent: int = 3, signs: str = r"[#$%&*|]") -> list[Column]:
    """Failure conditions A to D of a text that is not null: few words, few distinct words, many capitals, any of the signs."""
    trimmed = F.trim(text, F.lit(_BLANK))
    words = F.split(trimmed, _SPACE)
    none = (trimmed == "").cast("int")
    n, distinct = F.size(words) - none, F.size(F.array_distinct(words)) - none
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [n < min_words, F.lit(100) * distinct < F.lit(distinct_percent) * n, F.lit(100) * capitals > F.lit(capitals_percent) * F.length(text), text.rlike(signs)]


def outcomes(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Number of documents by part and set of failed filters: `part`, `mask` (bit k: fails filter k), `docs`, `good`, `toxic`.

    A to D depend on the text alone. E (the same text under a smaller id) needs no look at the documents of a text together: they are
    counted by text, id and label, then by text and label, and all but those of the smallest id fail. A null id is not smaller than any and
    has none that is smaller; rows that repeat id and text are equally small. Null text is empty, null part the empty string.
    A document is good or toxic if any label row of its id says 1. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = text_failures(text)
    mask = sum((F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)        # noqa: E731
    same = ["h1", "h2", "part", "mask", "good", "toxic"]
    by_id = (rows.join(marks, "id", "left").select("id", "part", "mask", "h1", "h2", zero("good"), zero("toxic"))
             .groupBy(*same, "id").agg(F.count("*").alias("n")))
    by_text = by_id.groupBy(*same).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
                                       F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"))
    least = F.min("first").over(Window.partitionBy("h1", "h2"))     # as many rows as parts and labels, not as documents
    again = by_text.withColumn("again", F.col("known") - F.when(F.col("first") == least, F.col("n_first")).otherwise(0))
    both = again.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").bitwiseOR(1 << len(bits)).alias("mask"), F.col("again").alias("n")),
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("again")).alias("n")))).alias("x")).where("x.n > 0")
    return both.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("docs"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def lattice(n: int) -> list[tuple[int, int, int]]:
    """All edges (state, filter, orders) of the lattice of subsets of `n` filters: `orders` of the n! orders apply `filter` when exactly `state` is applied.

    Forward, a state is reached by as many orders as its smaller neighbours together; backward, it is left by as many as its larger
    ones. An edge lies on the product of the two.
    """
    full = (1 << n) - 1
    reach, leave = {0: 1}, {full: 1}
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return [(state, f, reach[state] * leave[state | (1 << f)]) for state in range(full + 1) for f in range(n) if not state >> f & 1]


def orders(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state before it, filter) of every order of the filters."""
    at = {name: k for k, name in enumerate(names)}
    rows = []
    for order in itertools.permutations(names):
        state = 0
        for step, name in enumerate(order, 1):
            rows.append(("".join(order), step, state, at[name]))
            state |= 1 << at[name]
    return rows


def edge_counts(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """`counts` (`part`, `mask`, `docs`, `good`, `toxic`) seen from each edge of the lattice: `part`, `state`, `filter`, `orders`, `kept`, `removed`, `redundant`,
    `unique_fails`, `good_lost`, `toxic_lost`."""
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(o).cast("long").alias("orders")) for s, f, o in lattice(len(names))])
    rows = counts.select("part", "mask", "docs", "good", "toxic", F.explode(edges).alias("e")).select("part", "mask", "docs", "good", "toxic", "e.*")
    bit = F.expr("shiftleft(1, filter)")
    earlier, fails = F.col("mask").bitwiseAND(F.col("state")) != 0, F.col("mask").bitwiseAND(bit) != 0
    tally = lambda name, which, what="docs": F.sum(F.when(which, F.col(what)).otherwise(0)).alias(name)       # noqa: E731
    return rows.groupBy("part", "state", "filter", "orders").agg(
        tally("kept", ~earlier & ~fails), tally("removed", ~earlier & fails), tally("redundant", earlier & fails), tally("unique_fails", F.col("mask") == bit),
        tally("good_lost", ~earlier & fails, "good"), tally("toxic_lost", ~earlier & fails, "toxic"))


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step; `shapley` is what the step's filter removes, summed over all orders.

    The counts must be one row per part and mask, as `outcomes` gives them; their number does not grow with the documents. Divided by n!, `shapley`
    is the Shapley value. No counts give no rows. Orders are n!, so `names` should stay short.
    """
    if not 1 <= len(names) <= 8 or len(set(names)) < len(names):
        raise ValueError("one to eight different filter letters")
    edges = edge_counts(counts, names)
    edges = edges.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter")))
    steps = counts.sparkSession.createDataFrame(orders(names), "filter_order string, step int, state int, filter int")
    steps = F.broadcast(steps)      # n * n! rows
    return edges.join(steps, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
