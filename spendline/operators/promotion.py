"""Promotion of prediction products to gold: staged, checked, then swapped in by prediction date, and safe to run again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendline.operators import quality as QL
from spendline.operators.model_store import fingerprint

_RUN_COLUMNS = ("PromotionBatchID", "PromotionTimestamp")
MONITORING = "TableName string, PromotionBatchID string, PredictionDate date, RowCount long, Checks long, Warnings long, Totals map<string,double>, PromotionTimestamp timestamp"


@dataclass(frozen=True)
class Product:
    """What a prediction table promises: its grain (beside the prediction date), keys that must be resolved, rules of a row, amounts that must survive the write.

    `soft_keys` may be missing, which is a warning: a supplier that left keeps its orders but has no version at the prediction date. References are
    checked for rows whose soft keys are there.
    """

    name: str
    grain: tuple[str, ...]
    keys: tuple[str, ...]
    rules: tuple[QL.Rule, ...]
    totals: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()        # further columns without repeats, such as ranks
    references: Mapping[str, str] = field(default_factory=dict)
    soft_keys: tuple[str, ...] = ()


def score_rules(score: str, flag: str | None = None) -> tuple[QL.Rule, ...]:
    """A score lies within 0 and 100, a flag is 0 or 1; neither is missing."""
    out = [QL.Rule(f"{score} within 0 and 100", F.col(score).isNull() | (F.col(score) < 0) | (F.col(score) > 100), "Range")]
    if flag:
        out.append(QL.Rule(f"{flag} is 0 or 1", F.col(flag).isNull() | ~F.col(flag).isin(0, 1), "Domain"))
    return tuple(out)


def product_checks(source: DataFrame, promoted: DataFrame, product: Product, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rule results of a product before it is written: rows preserved, grain, completeness, ranges, uniqueness, references.

    `parents` holds, for each reference of the product (column -> parent column), the frame it must be found in.
    """
    table = product.name
    rules = [QL.Rule(f"{k} resolved", F.col(k).isNull(), "Completeness") for k in product.keys]
    rules += [QL.Rule(f"{k} resolved", F.col(k).isNull(), "Completeness", QL.WARNING) for k in product.soft_keys]
    frames = [QL.row_count_rule(promoted, table, source, "source rows preserved"), QL.key_rule(promoted, table, [*product.grain, "PredictionDate"]),
              QL.row_rules(promoted, table, [*rules, *product.rules])]
    frames += [QL.key_rule(promoted, table, [c]) for c in product.unique]
    linked = promoted.dropna(subset=list(product.soft_keys)) if product.soft_keys else promoted
    frames += [QL.fk_rule(linked, table, [child], parents[child], [parent], f"parent of {child}") for child, parent in product.references.items()]
    return QL.results(frames)


class GoldStore:
    """Gold prediction tables below one folder, each partitioned by prediction date, with one monitoring table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException:       # nothing promoted yet
            return None

    def monitoring(self) -> DataFrame:
        try:
            return self.spark.read.schema(MONITORING).parquet(f"{self.root}/monitoring_ml_gold_promotion_results")
        except AnalysisException:
            return self.spark.createDataFrame([], MONITORING)

    def promote(self, promoted: DataFrame, source: DataFrame, product: Product, parents: Mapping[str, DataFrame] | None = None) -> str:
        """Write one prediction date of a product; the batch id, which is a fingerprint of its rows.

        1. The rows are staged under their batch id. 2. The staged copy is checked; a failed rule raises `GateFailed` and gold stays as it was.
        3. The partition of the prediction date is replaced, others stay. 4. Gold is read again and compared with the staged copy, rows and totals.
        5. One monitoring row is appended. The same rows again give the same batch: if gold and monitoring have it, nothing is written,
        and a run that was lost between two steps is taken up by running it again.
        """
        rows = promoted.drop(*_RUN_COLUMNS)
        batch = fingerprint(rows, product.name)
        gold, log = self.read(product.name), self.monitoring().where((F.col("TableName") == product.name) & (F.col("PromotionBatchID") == batch))
        written = gold is not None and not gold.where(F.col("PromotionBatchID") == batch).isEmpty()
        if written and not log.isEmpty():
            return batch
        stage = f"{self.root}/staged/{product.name}/{batch}"
        rows.withColumns({"PromotionBatchID": F.lit(batch), "PromotionTimestamp": F.current_timestamp()}).write.mode("overwrite").parquet(stage)
        staged = self.spark.read.parquet(stage)
        checks = product_checks(source, staged, product, parents).collect()     # one row per rule
        failed = [f"{r['TableName']}: {r['ValidationRule']} ({r['FailedRecordCount']})" for r in checks if r["ValidationStatus"] == "FAILED"]
        if failed:
            raise QL.GateFailed("; ".join(failed))
        dates = [r[0] for r in staged.select("PredictionDate").distinct().limit(2).collect()]
        if len(dates) != 1:
            raise ValueError("a promotion holds exactly one prediction date")
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("PredictionDate").parquet(self.path(product.name))
        back = self.read(product.name).where(F.col("PredictionDate") == F.lit(dates[0]))
        want, got = self._totals(staged, product.totals), self._totals(back, product.totals)
        if want != got:
            raise QL.GateFailed(f"{product.name}: gold has {got}, staged rows have {want}")
        if log.isEmpty():
            totals = F.create_map(*[x for c in product.totals for x in (F.lit(c), F.lit(want[c]))]) if product.totals else F.create_map().cast("map<string,double>")
            self.spark.range(1).select(
                F.lit(product.name).alias("TableName"), F.lit(batch).alias("PromotionBatchID"), F.lit(dates[0]).alias("PredictionDate"), F.lit(want["rows"]).cast("long").alias("RowCount"),
                F.lit(len(checks)).cast("long").alias("Checks"), F.lit(sum(r["ValidationStatus"] == "WARNING" for r in checks)).cast("long").alias("Warnings"),
                totals.alias("Totals"), F.current_timestamp().alias("PromotionTimestamp")).coalesce(1).write.mode("append").parquet(f"{self.root}/monitoring_ml_gold_promotion_results")
        return batch

    @staticmethod
    def _totals(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
        """Exact: amounts are summed as decimals, so the order of tasks does not matter."""
        row = df.agg(F.count("*").alias("rows"), *[F.coalesce(F.sum(F.col(c).cast("decimal(28,6)")), F.lit(0)).cast("double").alias(c) for c in columns]).first()
        return row.asDict()


def drifted(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """Rows of `a` whose partner in `b` (same keys, null-safe) has another value in one of `columns`: numbers by more than `eps`, others at all."""
    right = b.select(*[F.col(c).alias(f"__b_{c}") for c in dict.fromkeys([*keys, *columns])])
    numeric = {f.name for f in a.schema if f.dataType.typeName() in ("double", "float", "decimal")}
    wrong = F.lit(False)
    for c in columns:
        x, y = F.col(c), F.col(f"__b_{c}")
        differs = (F.abs(x - y) > eps) | (x.isNull() != y.isNull()) if c in numeric else ~x.eqNullSafe(y)
        wrong = wrong | F.coalesce(differs, F.lit(False))
    return a.join(right, [F.col(k).eqNullSafe(F.col(f"__b_{k}")) for k in keys]).where(wrong).select(*a.columns)
