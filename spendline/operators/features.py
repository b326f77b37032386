"""Leakage-safe feature engineering for supplier risk and price anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendline.operators.aggregates import quantile_sketch, with_total
from spendline.operators.joins import shift_join
from spendline.operators.windows import dealt, exact_quantiles, frequent_keys, prior_stats, prior_year, rolling_range

# Fixed values
ANNUALIZATION = 365.0 / 212.0
RISK_METRICS = ["SupplierOTDPct", "OverdueOpenDeliveryExposurePct", "InvoiceDisputePct", "InvoiceExceptionPct"]
MIN_HISTORY = {"Material": 5, "SupplierMaterial": 3, "Category": 20}
EXTREME_VARIANCE_PCT = 20.0
EXTREME_Z = 3.0


def _share(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d * 100.0)


def supplier_year_base(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Supplier-year measures as doubles, with the attributes of the version in force."""
    attributes = dim.select("SupplierKey", F.col("SupplierID").alias("DimSupplierID"), "SupplierName", "SupplierType", "Country",
                            "Region", F.col("PreferredSupplier").cast("int").alias("PreferredSupplierFlag"),
                            F.col("StrategicSupplier").cast("int").alias("StrategicSupplierFlag"), "ESGRating",
                            F.col("FinancialRiskScore").cast("double").alias("FinancialRiskScore"),
                            F.col("Status").alias("SupplierStatus"))
    numbers = ["EligibleSpendEUR", "ContractCompliancePct", "MaverickSpendPct", "SupplierOTDPct", "FullyReceivedPOItemCount",
               "OnTimeFullyReceivedPOItemCount", "OverdueOpenDeliveryCount", "SupplierQualityIndexPct", "InvoiceCount",
               "DisputedInvoiceCount", "DuplicateInvoicePct", "ThreeWayMatchPct", "InvoiceExceptionPct"]
    out = (fact.select("SupplierKey", "PerformanceYear", *[F.col(c).cast("double").alias(c) for c in numbers])
           .join(attributes, "SupplierKey", "left").withColumnRenamed("DimSupplierID", "SupplierID"))
    full, overdue = F.col("FullyReceivedPOItemCount"), F.col("OverdueOpenDeliveryCount")
    late = F.greatest(full - F.col("OnTimeFullyReceivedPOItemCount"), F.lit(0.0))
    return out.withColumns({
        "InvoiceDisputePct": _share(F.col("DisputedInvoiceCount"), F.col("InvoiceCount")),
        "LateFullyReceivedPOItemCount": late, "LateFullyReceivedPct": _share(late, full),
        "OverdueOpenDeliveryExposurePct": _share(overdue, full + overdue),
    })


def risk_features(fact: DataFrame, dim: DataFrame, scoring_year: int, factor: float = ANNUALIZATION) -> DataFrame:
    """Annualised activity, year-on-year change, three-year volatility, spend share, coverage."""
    out = supplier_year_base(fact, dim)
    partial = F.col("PerformanceYear") == scoring_year
    scale = F.when(partial, F.lit(factor)).otherwise(F.lit(1.0))
    out = out.withColumns({
        "IsPartialYearFlag": partial.cast("int"), "AnnualizationFactor": scale,
        **{f"Annualized{c}": F.col(c) * scale for c in ("EligibleSpendEUR", "FullyReceivedPOItemCount", "InvoiceCount",
                                                        "DisputedInvoiceCount", "OverdueOpenDeliveryCount")}})
    out = prior_year(out, "SupplierID", "PerformanceYear", {
        "PerformanceYear": "PriorAdjacentYear", "AnnualizedEligibleSpendEUR": "PriorYearSpendEUR",
        "SupplierOTDPct": "PriorYearOTDPct", "InvoiceDisputePct": "PriorYearInvoiceDisputePct",
        "MaverickSpendPct": "PriorYearMaverickSpendPct"})
    out = rolling_range(out, "SupplierID", "PerformanceYear", 2, "AnnualizedEligibleSpendEUR", "Rolling3Y").withColumnsRenamed(
        {"Rolling3YAverage": "Rolling3YAverageSpendEUR", "Rolling3YStdDev": "Rolling3YSpendStdDevEUR"})
    out = with_total(out, "AnnualizedEligibleSpendEUR", "__year", ["PerformanceYear"])
    spend, before = F.col("AnnualizedEligibleSpendEUR"), F.col("PriorYearSpendEUR")
    observed = sum((F.col(c).isNotNull().cast("int") for c in RISK_METRICS), F.lit(0))
    return out.withColumns({
        "YoYSpendChangePct": F.when(before > 0, (spend - before) / before * 100.0),
        "YoYOTDChangePp": F.col("SupplierOTDPct") - F.col("PriorYearOTDPct"),
        "YoYInvoiceDisputeChangePp": F.col("InvoiceDisputePct") - F.col("PriorYearInvoiceDisputePct"),
        "YoYMaverickSpendChangePp": F.col("MaverickSpendPct") - F.col("PriorYearMaverickSpendPct"),
        "SpendVolatilityPct": F.when((F.col("Rolling3YObservationCount") >= 2) & (F.col("Rolling3YAverageSpendEUR") > 0),
                                     F.col("Rolling3YSpendStdDevEUR") / F.col("Rolling3YAverageSpendEUR") * 100.0),
        "SupplierSpendSharePct": _share(spend, F.col("__year")),
        "LogAnnualizedEligibleSpendEUR": F.log1p(F.greatest(spend, F.lit(0.0))),
        "RiskMetricObservedCount": observed, "RiskMetricCoveragePct": observed / 4.0 * 100.0,
    }).drop("__year", "PriorAdjacentYear")


def future_outcomes(features: DataFrame, last_feature_year: int, last_outcome_year: int) -> DataFrame:
    """Features of year t joined with the observed outcome of year t + 1."""
    outcome = features.where(F.col("PerformanceYear") <= last_outcome_year)
    return shift_join(features.where(F.col("PerformanceYear") <= last_feature_year), outcome, "SupplierID", "PerformanceYear",
                      {c: f"Future{c}" for c in RISK_METRICS}, "FutureOutcomeYear")


def label_thresholds(candidates: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: the adverse quartile of every outcome metric over the training outcomes."""
    spec = {f"{c}Threshold": (f"Future{c}", 0.25 if i == 0 else 0.75) for i, c in enumerate(RISK_METRICS)}
    return quantile_sketch(candidates, spec, 0.001) if approximate else exact_quantiles(candidates, spec)


def risk_label(candidates: DataFrame, thresholds: DataFrame) -> DataFrame:
    """High risk next year when at least two outcomes fall in the adverse quartile.

    Rows with fewer than two observed outcomes carry no label and are left out.
    """
    limit = {c: thresholds.select(f"{c}Threshold").scalar() for c in RISK_METRICS}
    future = {c: F.col(f"Future{c}") for c in RISK_METRICS}
    adverse = {c: F.coalesce((future[c] <= limit[c]) if i == 0 else (future[c] >= limit[c]), F.lit(False)).cast("int")
               for i, c in enumerate(RISK_METRICS)}
    names = ["FutureLowOTDFlag", "FutureHighOverdueFlag", "FutureHighDisputeFlag", "FutureHighInvoiceExceptionFlag"]
    out = candidates.withColumns({
        "FutureRiskObservedMetricCount": sum((f.isNotNull().cast("int") for f in future.values()), F.lit(0)),
        **dict(zip(names, adverse.values()))})
    events = sum((F.col(n) for n in names), F.lit(0))
    return (out.withColumns({"FutureRiskEventCount": events, "HighRiskNextYearFlag": (events >= 2).cast("int")})
            .where(F.col("FutureRiskObservedMetricCount") >= 2))


def pricing_base(po_fact: DataFrame, as_of: str) -> DataFrame:
    """Priced order items up to the as-of date."""
    number = lambda c: F.col(c).cast("double").alias(c)
    return (po_fact.where((F.col("OrderDate") <= F.to_date(F.lit(as_of))) & (F.col("UnitPriceEUR") > 0) & (F.col("Quantity") > 0)
                          & F.col("MaterialID").isNotNull())
            .select("POItemID", "POID", "OrderDate", F.year("OrderDate").alias("OrderYear"), "SupplierID", "MaterialID",
                    "CategoryID", "ContractID", number("Quantity"), "UnitPriceEUR", number("LineAmountEUR"),
                    F.col("ContractPriceVariancePercentage").cast("double").alias("ContractPriceVariancePct"),
                    *[F.col(c).cast("int").alias(c) for c in ("ContractPriceWithinToleranceFlag", "ValidContractAtPOFlag",
                                                              "HasContractReferenceFlag", "PriceComplianceExceptionFlag")],
                    "ContractValidityStatusAtPO"))


HISTORY_KEYS = {"Material": ["MaterialID"], "SupplierMaterial": ["SupplierID", "MaterialID"], "Category": ["CategoryID"]}
HISTORY_SPREAD = {"Material": "MaterialID", "SupplierMaterial": "MaterialID", "Category": "CategoryID"}


def _history_only(df: DataFrame, year: int | None, needed: list[str]) -> DataFrame:
    """Rows of other years keep the columns that a history reads; the rest is NULL, so it takes no room in a shuffle."""
    return df if year is None else df.withColumns({c: F.when(F.col("OrderYear") == year, F.col(c)) for c in df.columns if c not in needed})


def price_features(po_fact: DataFrame, as_of: str, base: DataFrame | None = None, year: int | None = None) -> DataFrame:
    """Deviation of each price from strictly earlier prices, and from its contract.

    With `year` the rows of this order year come back; those of all other years still count as history. `base` is a stored `pricing_base` of the fact: the summaries then read a few of its columns instead of computing the fact anew.
    """
    base = pricing_base(po_fact, as_of) if base is None else base
    spread = sorted(set(HISTORY_SPREAD.values()))
    places = {f"__{k}": dealt([k], "OrderDate", hot) for k, hot in zip(spread, frequent_keys(base, [[k] for k in spread]))}
    base = out = base.withColumns(places)
    last, row = None, ["OrderYear", "OrderDate", "POItemID", "UnitPriceEUR"]
    for k, (prefix, keys) in enumerate(HISTORY_KEYS.items()):
        if HISTORY_SPREAD[prefix] != last:      # the rows move
            last, ahead = HISTORY_SPREAD[prefix], [*HISTORY_KEYS][k:]
            out = _history_only(out, year, [*row, *{f"__{HISTORY_SPREAD[p]}" for p in ahead}, *{c for p in ahead for c in HISTORY_KEYS[p] if c != HISTORY_SPREAD[p]}])
        out = prior_stats(out, keys, "OrderDate", "POItemID", "UnitPriceEUR", prefix, extremes=prefix != "Category", history=base,
                          place=f"__{HISTORY_SPREAD[prefix]}", spread=[HISTORY_SPREAD[prefix]])
    out = out.drop(*places) if year is None else out.drop(*places).where(F.col("OrderYear") == year)
    price = F.col("UnitPriceEUR").cast("double")
    cols: dict[str, Column] = {}
    for prefix in HISTORY_KEYS:
        avg, sd = F.col(f"{prefix}HistoricalAvgPriceEUR"), F.col(f"{prefix}HistoricalStdDevPriceEUR")
        usable = avg > 0
        cols[f"PriceVs{prefix}HistoricalAvgPct"] = F.when(usable, (price - avg) / avg * 100.0)
        cols[f"PriceTo{prefix}HistoricalRatio"] = F.when(usable, price / avg)
        cols[f"LogPriceTo{prefix}HistoricalRatio"] = F.when(usable & (price > 0), F.log(price / avg))
        cols[f"{prefix}PriceZScore"] = F.when(sd > 0, (price - avg) / sd)
        cols[f"Absolute{prefix}PriceDeviationPct"] = F.abs(F.when(usable, (price - avg) / avg * 100.0))
        cols[f"Has{prefix}HistoryFlag"] = (F.col(f"{prefix}HistoryCount") >= MIN_HISTORY[prefix]).cast("int")
    cv_avg = F.col("SupplierMaterialHistoricalAvgPriceEUR")
    variance = F.col("ContractPriceVariancePct")
    cols |= {
        "AbsoluteContractPriceVariancePct": F.abs(variance),
        "HasContractBenchmarkFlag": variance.isNotNull().cast("int"),
        "SupplierMaterialHistoricalCVPct": F.when(cv_avg > 0, F.col("SupplierMaterialHistoricalStdDevPriceEUR") / cv_avg * 100.0),
        "LogUnitPriceEUR": F.log1p(price), "LogQuantity": F.log1p("Quantity"),
        "LogLineAmountEUR": F.log1p(F.greatest(F.col("LineAmountEUR"), F.lit(0.0))),
    }
    out = out.withColumns(cols)
    coverage = sum((F.col(f"Has{p}Flag") for p in ("MaterialHistory", "SupplierMaterialHistory", "CategoryHistory",
                                                   "ContractBenchmark")), F.lit(0))
    extreme = F.coalesce(F.abs(variance) >= EXTREME_VARIANCE_PCT, F.lit(False))
    for z in ("MaterialPriceZScore", "SupplierMaterialPriceZScore"):
        extreme = extreme | F.coalesce(F.abs(z) >= EXTREME_Z, F.lit(False))
    return out.withColumns({"BenchmarkCoverageCount": coverage, "PricingModelEligibleFlag": (coverage >= 1).cast("int"),
                            "RuleBasedExtremePriceFlag": extreme.cast("int")})


def split_by_year(df: DataFrame, year: str, train_to: int, score: int) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(year) <= train_to), df.where(F.col(year) == score)
