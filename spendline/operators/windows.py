"""Window operators, including whole-table ranks that never use a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendline.session import reliable

_ROW_BITS = 33      # monotonically_increasing_id keeps the row position in its low 33 bits


def prior_year(df: DataFrame, key: str, year: str, columns: Mapping[str, str]) -> DataFrame:
    """Value of the preceding calendar year; NULL when that year was not observed."""
    w = Window.partitionBy(key).orderBy(year)
    adjacent = F.lag(year).over(w) == F.col(year) - 1
    return df.withColumns({out: F.when(adjacent, F.lag(c).over(w)) for c, out in columns.items()})


def rolling_range(df: DataFrame, key: str, year: str, back: int, column: str, prefix: str) -> DataFrame:
    """Count, mean and sample deviation over the years `year - back .. year` by value, not by row."""
    w = Window.partitionBy(key).orderBy(F.col(year).cast("long")).rangeBetween(-back, 0)
    return df.withColumns({f"{prefix}ObservationCount": F.count(column).over(w),
                           f"{prefix}Average": F.avg(column).over(w),
                           f"{prefix}StdDev": F.stddev_samp(column).over(w)})


HOT_SHARE = 200     # a key that may hold 1/HOT_SHARE of the rows is summarised by day


def frequent_keys(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> list[Column]:
    """Per set of key columns the hashes of all keys that hold 1/`HOT_SHARE` of the rows (and of some that do not), as one array.

    One pass; a task hands on at most `HOT_SHARE` hashes a set.
    """
    names = [f"h{i}" for i in range(len(key_sets))]
    hashes = df.select(*[F.xxhash64(*keys).alias(n) for n, keys in zip(names, key_sets)])
    found = hashes.stat.freqItems(names, 1.0 / HOT_SHARE)
    return [found.select(f"{n}_freqItems").scalar() for n in names]


def dealt(keys: Sequence[str], date: str, hot: Column) -> Column:
    """Where a row is dealt to: its key, and its day if the key is among the `hot` ones (see `frequent_keys`).

    Structs are equal where their fields are equal or both NULL, and joins and windows over one struct share its partitioning.
    """
    often = F.coalesce(F.array_contains(hot, F.xxhash64(*keys)), F.lit(False))
    return F.struct(*keys, F.when(often, F.col(date)).alias("__day"), often.alias("__hot"))


def prior_stats(df: DataFrame, keys: Sequence[str], date: str, tie: str, value: str, prefix: str,
                extremes: bool = True, history: DataFrame | None = None, place: str | None = None,
                spread: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation (and min / max) over all strictly earlier rows of the key.

    "Earlier" is by (date, tie). A key may hold a third of the table, so no task sees the whole of such a key: its rows are dealt
    by day, every (key, day) is summarised with map-side combine, the daily summaries are accumulated over the days before (at
    most one row per calendar day and key), and only the rows of one day are ordered within a task. All other keys need no
    summaries: their rows are accumulated as they are, in one window. Either way the rows move once. Which keys are dealt by day
    decides about the work only, never about a result. `place` names a column of both frames made by `dealt` over the keys
    `spread`, a part of `keys`: statistics over the same place share one shuffle of the rows. Deviations are taken from the key's
    first value or daily mean, so the variance of nearly constant prices does not drown in rounding. `history` is the frame to
    summarise (same rows as `df`): when several statistics are chained, passing the common base spares recomputing the chain for
    each summary.
    """
    spread = list(keys if spread is None else spread)
    base, columns = df if history is None else history, df.columns
    if place is None:
        place, at = "__at", dealt(spread, date, frequent_keys(base, [spread])[0])
        df, base = df.withColumn(place, at), base.withColumn(place, at)
    rest = [k for k in keys if k not in spread]
    own = F.struct(*rest) if rest else F.lit(0)
    x = F.col(value).cast("double")
    daily = base.where(F.col(f"{place}.__hot")).groupBy(F.col(place).alias("__cat"), own.alias("__cown")).agg(
        F.count(value).alias("__n"), F.avg(x).alias("__m"), F.var_pop(x).alias("__v"),
        F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    daily = daily.withColumns({"__key": F.struct(*[F.col(f"__cat.{k}") for k in spread], "__cown"), "__day": F.col("__cat.__day")})
    days = Window.partitionBy("__key").orderBy("__day")
    whole = days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = days.rowsBetween(Window.unboundedPreceding, -1)
    shift = F.col("__m") - F.col("__c")
    carried = (daily.withColumn("__c", F.first("__m", ignorenulls=True).over(whole))
               .withColumns({"__d1": F.col("__n") * shift, "__d2": F.col("__n") * (F.col("__v") + shift * shift)})
               .select("__cat", "__cown", "__c", *[f(c).over(before).alias(o) for f, c, o in (
                   (F.sum, "__n", "__dn"), (F.sum, "__d1", "__ds"), (F.sum, "__d2", "__dq"), (F.min, "__lo", "__dlo"), (F.max, "__hi", "__dhi"))]))
    rows = Window.partitionBy(place, "__own").orderBy(date, tie)
    inside = rows.rowsBetween(Window.unboundedPreceding, -1)
    joined = df.withColumn("__own", own).join(carried, (F.col(place) == F.col("__cat")) & (F.col("__own") == F.col("__cown")), "left")
    first = F.first(x, ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    joined = joined.withColumn("__c", F.coalesce(F.col("__c"), first))
    zero = lambda c: F.coalesce(c, F.lit(0))
    dev = x - F.col("__c")
    out = joined.withColumns({
        "__n": zero(F.col("__dn")) + F.count(value).over(inside),
        "__s": zero(F.col("__ds")) + zero(F.sum(dev).over(inside)),
        "__q": zero(F.col("__dq")) + zero(F.sum(dev * dev).over(inside)),
        "__lo": F.least("__dlo", F.min(value).over(inside)),
        "__hi": F.greatest("__dhi", F.max(value).over(inside)),
    })
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    var = F.greatest(F.lit(0.0), q - s * s / n) / (n - 1)
    stats = {
        f"{prefix}HistoryCount": n,
        f"{prefix}HistoricalAvgPriceEUR": F.when(n > 0, F.col("__c") + s / n),
        f"{prefix}HistoricalStdDevPriceEUR": F.when(n > 1, F.when(F.col("__lo") == F.col("__hi"), F.lit(0.0)).otherwise(F.sqrt(var))),
    }
    if extremes:
        stats[f"{prefix}HistoricalMinPriceEUR"] = F.col("__lo")
        stats[f"{prefix}HistoricalMaxPriceEUR"] = F.col("__hi")
    return out.select(*columns, *[c.alias(name) for name, c in stats.items()])


def overlaps(df: DataFrame, key: str, start: str, end: str, order: str | None = None) -> DataFrame:
    """Versions that begin before the preceding version of the key has ended."""
    w = Window.partitionBy(key).orderBy(*dict.fromkeys([start, order or start]))
    return df.withColumn("PreviousEnd", F.lag(end).over(w)).where(F.col(start) <= F.col("PreviousEnd"))


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partitioned, sorted and pinned: each row knows its partition and its place in it.

    The pinned copy lives in the shared checkpoint folder: a recomputed range partitioning could
    draw other borders, and the places would not add up any more.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = reliable(ranged.withColumn("__pos", F.monotonically_increasing_id()))
    return numbered.withColumn("__part", F.shiftright("__pos", _ROW_BITS))


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """row_number over the whole table for a total order, fully distributed.

    Rank = place within the range partition + rows in all partitions before it. Only the
    partition counts (one row per partition) pass through a single task.
    """
    placed = _placed(df, order)
    counts = placed.groupBy("__part").agg(F.count("*").alias("__c"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"))
    place = F.col("__pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (placed.join(F.broadcast(offsets), "__part")
            .withColumn(name, (place + F.col("__off")).cast("long")).select(*df.columns, name))


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """row_number per key for a total order, without a window over a whole key.

    The table is ranked by (key, order) as a whole; the rank within a key is the distance to the
    key's first rank, which a map-side combined aggregate finds.
    """
    ranked = global_rank(df, [*[F.col(k).asc_nulls_first() for k in keys], *order], "__rank")     # over a pinned copy, so both uses agree
    starts = ranked.groupBy(*[F.col(k).alias(f"__by_{k}") for k in keys]).agg(F.min("__rank").alias("__start"))
    joined = ranked.join(starts, [F.col(k).eqNullSafe(F.col(f"__by_{k}")) for k in keys], "left")
    return joined.withColumn(name, F.col("__rank") - F.col("__start") + 1).select(*df.columns, name)


def cumulative_by_value(df: DataFrame, value: str | Sequence[str], weight: Column, name: str = "Cumulative") -> DataFrame:
    """Distinct values of a column (or of several) with the total weight at or below each (NULL sorts first)."""
    values = [value] if isinstance(value, str) else list(value)
    dense = df.groupBy(*values).agg(F.sum(weight).alias("Weight"))
    placed = _placed(dense, [F.col(v).asc_nulls_first() for v in values])
    totals = placed.groupBy("__part").agg(F.sum("Weight").alias("__c"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    return (placed.withColumn("__run", F.sum("Weight").over(within))
            .join(F.broadcast(offsets), "__part")
            .select(*values, "Weight", (F.col("__run") + F.col("__off")).alias(name)))


SKETCH = 1000       # a quantile is first known to within 1/SKETCH of the rows


def _around(df: DataFrame, spec: Mapping[str, tuple[str, float]]) -> dict[str, tuple[float | None, float | None]]:
    """Per quantile two values that it lies between, from one pass of mergeable sketches; None where there is no bound."""
    asked = {}
    for name, (column, p) in spec.items():
        v = F.col(column).cast("double")
        for side, q in (("lo", p - 2.0 / SKETCH), ("hi", p + 2.0 / SKETCH)):
            if 0.0 < q < 1.0:
                asked[f"{name}__{side}"] = F.percentile_approx(F.when(~F.isnan(v), v), q, SKETCH)
    found = df.agg(*[c.alias(k) for k, c in asked.items()]).first().asDict() if asked else {}
    return {name: (found.get(f"{name}__lo"), found.get(f"{name}__hi")) for name in spec}


def exact_quantiles(df: DataFrame, spec: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row with interpolated quantiles `{name: (column, p)}`; NULL for a column without values.

    A sketch says between which values each quantile lies; only values in between are told apart, those below and those above are
    counted. Should a quantile lie outside after all, all values are told apart. The frame is read twice.
    """
    row, missed = _quantiles(df, spec, _around(df, spec))
    return _quantiles(df, spec, {})[0] if missed else row


def _quantiles(df: DataFrame, spec: Mapping[str, tuple[str, float]], around: Mapping[str, tuple[float | None, float | None]]) -> tuple[DataFrame, bool]:
    """The row of quantiles, and whether one of them lies outside of its bounds.

    All quantiles go through one ladder of (quantile, side, distinct value), where values outside of the bounds are one step a side. The two values
    around position p * (n - 1) are looked up in it, so no task holds the values of a column.
    """
    def pair(name: str, column: str) -> Column:
        lo, hi = around.get(name, (None, None))
        v, side = F.col(column).cast("double"), F.lit(0)
        side = side if lo is None else F.when(v < lo, -1).otherwise(side)
        side = side if hi is None else F.when(v > hi, 1).otherwise(side)
        return F.struct(F.lit(name).alias("__c"), F.when(v.isNotNull() & ~F.isnan(v), side).alias("__s"), F.when(side == 0, v).alias("__v"))

    values = df.select(F.inline(F.array(*[pair(name, column) for name, (column, _) in spec.items()]))).where(F.col("__s").isNotNull())
    ladder = reliable(cumulative_by_value(values, ["__c", "__s", "__v"], F.lit(1)))
    spans = ladder.groupBy("__c").agg(F.min(F.col("Cumulative") - F.col("Weight")).alias("__from"), F.max("Cumulative").alias("__to"))
    placed = ladder.join(F.broadcast(spans), "__c")     # one row per quantile
    last = F.col("Cumulative") - F.col("__from") - 1
    first = last - F.col("Weight") + 1
    parts, outside = {}, F.lit(False)
    for name, (_, p) in spec.items():
        at = F.lit(float(p)) * (F.col("__to") - F.col("__from") - 1)
        own = F.col("__c") == name
        low, high = own & (first <= F.floor(at)) & (last >= F.floor(at)), own & (first <= F.ceil(at)) & (last >= F.ceil(at))
        outside = outside | ((low | high) & (F.col("__s") != 0))
        parts |= {f"{name}__lo": F.max(F.when(low, F.col("__v"))), f"{name}__hi": F.max(F.when(high, F.col("__v"))),
                  f"{name}__w": F.max(F.when(own, at - F.floor(at)))}
    row = placed.agg(*[c.alias(k) for k, c in parts.items()])
    lo, hi, w = (lambda n, s=s: F.col(f"{n}__{s}") for s in ("lo", "hi", "w"))
    out = row.select(*[F.when(lo(n) == hi(n), lo(n)).otherwise((1 - w(n)) * lo(n) + w(n) * hi(n)).alias(n) for n in spec])
    return out, bool(around) and placed.agg(F.coalesce(F.bool_or(outside), F.lit(False))).first()[0]


def global_percent_rank(df: DataFrame, column: str, name: str, scale: float = 100.0, source: DataFrame | None = None) -> DataFrame:
    """percent_rank over the whole table, NULLs first: (rows below) / (rows - 1).

    Ties collapse to one row per distinct value before anything is ordered. The way back is an
    equi join on the value, which AQE splits where one value dominates; rows without a value stand before all others, so their
    score is 0 and they take no part in the join key. `source` is a frame with the
    same rows to rank against: chained ranks over one base then read the base, not each other.
    """
    base = df if source is None else source
    ladder = cumulative_by_value(base, column, F.lit(1)).select(
        F.col(column).alias("__v"), (F.col("Cumulative") - F.col("Weight")).alias("__below"))
    others = base.agg(F.count("*") - 1).scalar()
    ranked = df.join(ladder.where(F.col("__v").isNotNull()), F.col(column) == F.col("__v"), "left")
    score = F.coalesce(F.try_divide(F.col("__below"), others), F.lit(0.0)) * scale
    return ranked.withColumn(name, score).select(*df.columns, name)


def global_percent_ranks(df: DataFrame, columns: Mapping[str, str], scale: float = 100.0) -> DataFrame:
    """`global_percent_rank` of several number columns (column -> output) from one ladder.

    The columns are unpivoted to (metric, value) counts, which one range sort puts in order; it is pinned once, and each column picks its
    steps from it. Values are compared as doubles.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("__m"), F.col(c).cast("double").alias("__v")) for k, c in enumerate(columns)])
    ladder = cumulative_by_value(df.select(F.inline(pairs)), ["__m", "__v"], F.lit(1)).withColumn("__before", F.col("Cumulative") - F.col("Weight"))
    ladder = reliable(ladder.select("__m", "__v", "__before"))
    starts = F.broadcast(ladder.groupBy("__m").agg(F.min("__before").alias("__start")))        # one row a column
    steps = ladder.join(starts, "__m").where(F.col("__v").isNotNull()).select("__m", "__v", (F.col("__before") - F.col("__start")).alias("__below"))
    others, out = df.agg(F.count("*") - 1).scalar(), df
    for k, (c, name) in enumerate(columns.items()):
        ranked = out.join(steps.where(F.col("__m") == k), F.col(c).cast("double") == F.col("__v"), "left")
        score = F.coalesce(F.try_divide(F.col("__below"), others), F.lit(0.0)) * scale
        out = ranked.withColumn(name, score).select(*out.columns, name)
    return out


def ladder_percentile(ladder: DataFrame, target: DataFrame, column: str, name: str) -> DataFrame:
    """Share (in %) of reference values at or below each target value, from a stored ladder: `column` and `Weight`, its number of reference rows.

    Reference and target values go through one ladder of distinct values in which only reference
    rows carry weight; the target picks its step by an equi join.
    """
    steps = (ladder.select(F.col(column), F.col("Weight").cast("long").alias("__w"))
             .unionByName(target.select(F.col(column), F.lit(0).cast("long").alias("__w"))).where(F.col(column).isNotNull()))
    summed = cumulative_by_value(steps, column, F.col("__w")).select(column, F.col("Cumulative").alias("__cum"))
    size = ladder.where(F.col(column).isNotNull()).agg(F.sum("Weight")).scalar()
    out = target.join(summed, column, "left")
    score = F.try_divide(F.col("__cum") * 100.0, size)
    return out.withColumn(name, F.least(F.lit(100.0), F.greatest(F.lit(0.0), score))).select(*target.columns, name)


def reference_percentile(reference: DataFrame, target: DataFrame, column: str, name: str) -> DataFrame:
    """Share (in %) of reference values at or below each target value; the reference rows are given as they are."""
    return ladder_percentile(reference.select(F.col(column), F.lit(1).alias("Weight")), target, column, name)
