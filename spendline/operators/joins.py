"""Join operators.

No join here is forced to broadcast: Catalyst broadcasts a side whose measured size is below
`spark.sql.autoBroadcastJoinThreshold`, and AQE splits skewed partitions of the sort-merge join
it uses beyond that. Foreign-key checks aggregate the child per key first, so a key that holds a
third of the rows costs one row after the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FanOut(RuntimeError):
    pass


def join_header_item(header: DataFrame, item: DataFrame, key: str) -> DataFrame:
    return item.join(header, key, "inner")


def lookup(df: DataFrame, ref: DataFrame, on: Mapping[str, str], columns: Mapping[str, str] | Sequence[str],
           found: str | None = None) -> DataFrame:
    """Left join to a reference: `on` = {df column: ref column}, `columns` = {ref column: output}.

    The reference's keys do not survive; `found` names an optional hit flag.
    """
    take = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    keys = {d: f"__ref_{r}" for d, r in on.items()}
    right = ref.select(*[F.col(r).alias(keys[d]) for d, r in on.items()],
                       *[F.col(r).alias(o) for r, o in take.items()])
    cond = [F.col(d) == F.col(k) for d, k in keys.items()]
    out = df.join(right, cond, "left")
    if found:
        out = out.withColumn(found, F.col(next(iter(keys.values()))).isNotNull())
    return out.drop(*keys.values())


HOT_SHARE = 200     # a key with at least 1/HOT_SHARE of the rows is hot, so at most so many keys are
SALTS = 32


def lookup_skewed(df: DataFrame, ref: DataFrame, on: Mapping[str, str], columns: Mapping[str, str] | Sequence[str],
                  found: str | None = None, salts: int = SALTS) -> DataFrame:
    """`lookup` for keys that are often NULL or of which a few hold most rows.

    Rows with a NULL key match nothing, so any partition will do: a salt from the whole row spreads them. Hot keys (counted with a
    map-side combine; at most `HOT_SHARE` of them, so their list is broadcast) are spread in the same way, and only their rows of the
    reference are repeated once per salt. All other keys have the salt 0. The salt is a hash of the row, so a recomputed task deals out the same rows.
    """
    take = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    keys = {d: f"__ref_{r}" for d, r in on.items()}
    known = [F.col(d).isNotNull() for d in on]
    counts = df.where(reduce(Column.__and__, known)).groupBy(*on).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*")).scalar()
    hot = counts.where(F.col("__n") * HOT_SHARE >= total).select(*on, F.lit(True).alias("__hot"))
    own = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)).cast("int")
    left = df.join(F.broadcast(hot), list(on), "left") if on else df
    lost = reduce(Column.__or__, [~k for k in known])
    left = left.withColumn("__salt", F.when(lost | F.coalesce("__hot", F.lit(False)), own).otherwise(0)).select(*df.columns, "__salt")
    right = ref.select(*[F.col(r).alias(keys[d]) for d, r in on.items()], *[F.col(r).alias(o) for r, o in take.items()])
    marks = hot.select(*[F.col(d).alias(keys[d]) for d in on], "__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.join(F.broadcast(marks), list(keys.values()), "left").withColumn("__ref_salt", F.explode(copies)).drop("__hot")
    out = left.join(right, [*[F.col(d) == F.col(k) for d, k in keys.items()], F.col("__salt") == F.col("__ref_salt")], "left")
    if found:
        out = out.withColumn(found, F.col(next(iter(keys.values()))).isNotNull())
    return out.drop(*keys.values(), "__salt", "__ref_salt")


def resolved_flag(df: DataFrame, ref: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    return lookup(df, ref.select(*on.values()).distinct(), on, {}, found=name)


def asof_versions(df: DataFrame, dim: DataFrame, key: str, date: str, take: Mapping[str, str],
                  dim_key: str | None = None, start: str = "EffectiveFromDate", end: str = "EffectiveToDate") -> DataFrame:
    """Left join to the version of `key` valid on `date`, both ends inclusive.

    The equi key carries the join; the date test is a residual over the few versions of one key.
    """
    right = dim.select(F.col(dim_key or key).alias("__k"), F.col(start).alias("__from"), F.col(end).alias("__to"),
                       *[F.col(c).alias(o) for c, o in take.items()])
    cond = (F.col(key) == F.col("__k")) & (F.col(date) >= F.col("__from")) & (F.col(date) <= F.col("__to"))
    return df.join(right, cond, "left").drop("__k", "__from", "__to")


def dim_at(dim: DataFrame, date: str | Column, start: str = "EffectiveFromDate", end: str = "EffectiveToDate") -> DataFrame:
    """Snapshot of a versioned dimension on one date; an open end is NULL."""
    day = F.to_date(F.lit(date)) if isinstance(date, str) else date
    return dim.where((F.col(start) <= day) & (F.col(end).isNull() | (F.col(end) >= day)))


def orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str],
            ignore_nulls: bool = True) -> DataFrame:
    """Child keys without a parent, with the number of rows that carry them."""
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(child_keys)]
    counted = child.groupBy(*keys).agg(F.count("*").alias("RecordCount"))
    names = [f"k{i}" for i in range(len(child_keys))]
    if ignore_nulls:
        counted = counted.dropna(subset=names)
    known = parent.select(*[F.col(p).alias(n) for p, n in zip(parent_keys, names)])
    missing = counted.join(known, names, "left_anti")
    return missing.select(*[F.col(n).alias(c) for n, c in zip(names, child_keys)], "RecordCount")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], eps: float) -> DataFrame:
    """Full outer comparison of two aggregates; one row per key with both values and a verdict."""
    left = a.select(*keys, *[F.col(c).alias(f"{c}Left") for c in columns])
    right = b.select(*keys, *[F.col(c).alias(f"{c}Right") for c in columns])
    out = left.join(right, list(keys), "full")
    gaps = {f"{c}Difference": F.coalesce(F.col(f"{c}Left"), F.lit(0)) - F.coalesce(F.col(f"{c}Right"), F.lit(0))
            for c in columns}
    worst = F.greatest(F.lit(0.0), *[F.abs(F.col(g)).cast("double") for g in gaps])
    return out.withColumns(gaps).withColumn("ReconciledFlag", worst <= F.lit(eps))


def pair_with_original(df: DataFrame, id_: str, original: str, columns: Sequence[str]) -> DataFrame:
    """Each copy next to the row it names as its original (NULLs where that row is missing)."""
    return lookup(df.where(F.col(original).isNotNull()), df, {original: id_},
                  {c: f"Original{c}" for c in columns}, found="OriginalFoundFlag")


def shift_join(features: DataFrame, outcome: DataFrame, key: str, year: str, columns: Mapping[str, str],
               outcome_year: str) -> DataFrame:
    """Features of year t with outcomes of year t + 1."""
    right = outcome.select(key, (F.col(year) - 1).alias(year), F.col(year).alias(outcome_year),
                           *[F.col(c).alias(o) for c, o in columns.items()])
    return features.join(right, [key, year], "inner")


def attach_scores(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    return df.join(scores, key, "left")


def treat_as(fact: DataFrame, keys: DataFrame, column: str, key_column: str | None = None) -> DataFrame:
    """Keep fact rows whose column value occurs in a key set."""
    return fact.join(keys.select(F.col(key_column or column).alias(column)), column, "left_semi")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("RecordCount")).where(F.col("RecordCount") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a join has multiplied rows; otherwise hand the frame back."""
    worst = duplicates(df, keys).limit(1).count()
    if worst:
        raise FanOut(f"rows repeat on {list(keys)}")
    return df
