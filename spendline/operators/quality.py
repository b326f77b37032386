"""Data-quality rules as data.

A table's row rules are folded into one aggregate, so a table with forty rules is scanned once.
Key, foreign-key and cross-table rules contribute one aggregate row each. Results are DataFrames:
nothing is collected until a gate asks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendline.operators.joins import orphans

ERROR, WARNING = "ERROR", "WARNING"
COLUMNS = ["TableName", "ValidationCategory", "ValidationRule", "Severity", "FailedRecordCount"]


class GateFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Rule:
    """A row violates the rule where `violation` is true; NULL is no violation."""

    name: str
    violation: Column
    category: str = "Business"
    severity: str = ERROR


def _shape(counts: DataFrame, table: str, meta: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn a one-row frame of counts c0..cn into one row per rule."""
    rows = [F.struct(F.lit(table).alias("TableName"), F.lit(cat).alias("ValidationCategory"),
                     F.lit(name).alias("ValidationRule"), F.lit(sev).alias("Severity"),
                     F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("FailedRecordCount"))
            for i, (cat, name, sev) in enumerate(meta)]
    return counts.select(F.inline(F.array(*rows)))


def row_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    counts = df.agg(*[F.count_if(r.violation).alias(f"c{i}") for i, r in enumerate(rules)])
    return _shape(counts, table, [(r.category, r.name, r.severity) for r in rules])


def agg_rules(df: DataFrame, table: str, rules: Mapping[str, Column], category: str = "Aggregate",
              severity: str = ERROR) -> DataFrame:
    """Rules whose failure count is itself an aggregate expression."""
    counts = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(rules.values())])
    return _shape(counts, table, [(category, n, severity) for n in rules])


def key_rule(df: DataFrame, table: str, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    """NULL key rows, and rows beyond the first per key."""
    grouped = df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("n"))
    null = reduce(Column.__or__, [F.col(f"k{i}").isNull() for i in range(len(keys))])
    counts = grouped.agg(F.sum(F.when(null, F.col("n")).otherwise(0)).alias("c0"),
                         F.sum(F.when(~null, F.col("n") - 1).otherwise(0)).alias("c1"))
    label = ", ".join(keys)
    return _shape(counts, table, [("Key", f"{label} not null", severity), ("Key", f"{label} unique", severity)])


def fk_rule(child: DataFrame, table: str, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str],
            parent_table: str, nullable: bool = False, severity: str = ERROR) -> DataFrame:
    """Rows whose key has no parent; a NULL key fails unless the edge is nullable."""
    bad = orphans(child, child_keys, parent, parent_keys, ignore_nulls=nullable)
    counts = bad.agg(F.sum("RecordCount").alias("c0"))
    return _shape(counts, table, [("Referential", f"{', '.join(child_keys)} in {parent_table}", severity)])


@dataclass(frozen=True)
class Reference:
    """An edge from columns of a child to columns of a parent; a NULL key is a violation unless the edge is nullable."""

    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]
    parent_table: str
    nullable: bool = False
    severity: str = ERROR


def reference_rules(child: DataFrame, table: str, edges: Sequence[Reference]) -> DataFrame:
    """All references of a child in one shuffle.

    The child is read once and unpivoted to (edge, key) counts, the parents' keys are added as rows without a count, and one aggregate by
    (edge, key), combined before its shuffle, tells which keys have no parent. A key that holds a third of the child is one row per task.
    """
    text = lambda c: F.col(c).cast("string")
    keys = F.array(*[F.struct(F.lit(k).alias("edge"), F.array(*map(text, e.columns)).alias("key")) for k, e in enumerate(edges)])
    rows = child.select(F.inline(keys)).withColumns({"n": F.lit(1).cast("long"), "known": F.lit(False)})
    for k, e in enumerate(edges):
        own = e.parent.select(F.lit(k).alias("edge"), F.array(*map(text, e.parent_columns)).alias("key")).where(~F.exists("key", F.isnull))
        rows = rows.unionByName(own.withColumns({"n": F.lit(0).cast("long"), "known": F.lit(True)}))
    lone = rows.groupBy("edge", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known")).where(~F.col("known"))
    null = F.exists("key", F.isnull)
    counts = lone.agg(*[F.sum(F.when((F.col("edge") == k) & (~null if e.nullable else F.lit(True)), F.col("n"))).alias(f"c{k}") for k, e in enumerate(edges)])
    return _shape(counts, table, [("Referential", f"{', '.join(e.columns)} in {e.parent_table}", e.severity) for e in edges])


def count_rule(bad: DataFrame, table: str, name: str, category: str = "Business", severity: str = ERROR) -> DataFrame:
    """Every row of `bad` is a violation."""
    return _shape(bad.agg(F.count("*").alias("c0")), table, [(category, name, severity)])


def schema_rule(df: DataFrame, table: str, required: Iterable[str], severity: str = ERROR) -> DataFrame:
    """Missing columns; decided from the schema, reported next to the table's row count."""
    missing = len([c for c in required if c not in df.columns])
    counts = df.agg(F.count("*").alias("n")).select(F.lit(missing).alias("c0"), F.when(F.col("n") == 0, 1).otherwise(0).alias("c1"))
    return _shape(counts, table, [("Schema", "required columns present", severity), ("Volume", "at least one row", severity)])


def row_count_rule(df: DataFrame, table: str, expected: int | DataFrame, name: str = "row count as expected") -> DataFrame:
    want = expected.agg(F.count("*")).scalar() if isinstance(expected, DataFrame) else F.lit(expected)
    counts = df.agg(F.count("*").alias("n")).select(F.abs(F.col("n") - want).alias("c0"))
    return _shape(counts, table, [("Volume", name, ERROR)])


def results(frames: Sequence[DataFrame]) -> DataFrame:
    """All rule outcomes with a status: PASSED, WARNING or FAILED."""
    out = reduce(DataFrame.unionByName, frames)
    status = (F.when(F.col("FailedRecordCount") == 0, "PASSED")
              .when(F.col("Severity") == WARNING, "WARNING").otherwise("FAILED"))
    return out.withColumn("ValidationStatus", status)


def numbered(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Result rows ready for the monitoring table: VAL00001, VAL00002, ... in table and rule order.

    One row per rule, so the ordering window holds a few hundred rows at most.
    """
    from pyspark.sql import Window
    n = F.row_number().over(Window.orderBy("TableName", "ValidationCategory", "ValidationRule"))
    out = df.withColumns({"ValidationID": F.concat(F.lit("VAL"), F.lpad(n.cast("string"), 5, "0")),
                          "ValidationDetails": F.lit(run_id).cast("string"), "ExecutionTimestamp": F.current_timestamp()})
    return out.select("ValidationID", *COLUMNS, "ValidationStatus", "ValidationDetails", "ExecutionTimestamp")


def gate(df: DataFrame) -> DataFrame:
    """Raise when any rule failed; pass the results on otherwise."""
    failed = [r["ValidationRule"] for r in df.where(F.col("ValidationStatus") == "FAILED").select("ValidationRule").collect()]    # one row per rule
    if failed:
        raise GateFailed("; ".join(failed))
    return df


def summary(df: DataFrame, by: Sequence[str]) -> DataFrame:
    count = lambda s: F.count_if(F.col("ValidationStatus") == s).alias(f"{s.title()}Rules")
    return df.groupBy(*by).agg(F.count("*").alias("RuleCount"), count("PASSED"), count("WARNING"), count("FAILED"),
                               F.sum("FailedRecordCount").alias("FailedRecordCount"))


# ---------------------------------------------------------------------- rule templates

def differ_rows(a: str | Column, b: str | Column, eps: float) -> Column:
    """Violation: the two amounts differ by more than eps, or exactly one of them is NULL."""
    x = (F.col(a) if isinstance(a, str) else a).cast("double")
    y = (F.col(b) if isinstance(b, str) else b).cast("double")
    return F.coalesce(F.abs(x - y) > F.lit(eps), x.isNull() != y.isNull())


def header_total_gap(header: DataFrame, item: DataFrame, key: str, total: str, line: str, eps: float) -> DataFrame:
    """Headers whose total differs from the sum of their lines."""
    sums = item.groupBy(key).agg(F.sum(line).alias("__lines"))
    gap = F.abs(F.col(total).cast("double") - F.coalesce(F.col("__lines"), F.lit(0)).cast("double"))
    return header.select(key, total).join(sums, key, "left").where(gap > F.lit(eps))


def disagreements(a: DataFrame, b: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Rows of `a` whose columns differ (null-safe) from those of the row of `b` they point to."""
    right = b.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in columns.values()])
    wrong = reduce(Column.__or__, [~F.col(l).eqNullSafe(F.col(f"__{r}")) for l, r in columns.items()])
    return a.join(right, F.col(key) == F.col("__k")).where(wrong)


def sum_gap(a: DataFrame, b: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: absolute difference of the column totals of two frames."""
    right = {c: b.agg(F.coalesce(F.sum(c), F.lit(0)).cast("double")).scalar() for c in set(columns.values())}
    left = a.agg(*[F.coalesce(F.sum(l), F.lit(0)).cast("double").alias(l) for l in columns])
    return left.select(*[F.abs(F.col(l) - right[r]).alias(l) for l, r in columns.items()])


def sums_reconciled(a: DataFrame, b: DataFrame, table: str, columns: Mapping[str, str], eps: float = 0.05) -> DataFrame:
    gaps = sum_gap(a, b, columns)
    counts = gaps.select(*[F.when(F.col(l) > F.lit(eps), 1).otherwise(0).alias(f"c{i}") for i, l in enumerate(columns)])
    return _shape(counts, table, [("Reconciliation", f"sum of {l}", ERROR) for l in columns])


def fresh_rule(df: DataFrame, table: str, date: str, days: int, today: Column | None = None) -> DataFrame:
    """Fails when the newest load is older than the allowed age (or there is none)."""
    age = F.datediff(today if today is not None else F.current_date(), F.max(F.to_date(date)))
    return agg_rules(df, table, {f"{date} at most {days} days old": F.when(F.coalesce(age <= days, F.lit(False)), 0).otherwise(1)},
                     category="Freshness")
