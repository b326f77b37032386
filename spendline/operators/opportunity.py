"""Savings-opportunity engine and promotion of predictions to gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from spendline.functions.exprs import pct, surrogate_key
from spendline.operators.aggregates import with_total
from spendline.operators.joins import asof_versions, lookup
from spendline.operators.quality import Rule, key_rule, results, row_count_rule, row_rules
from spendline.operators.windows import global_percent_ranks, global_rank, rank_within
from spendline.sources.tables import from_rows

# Fixed values
MAX_VARIANCE_PCT = 50.0
MAVERICK_RATE = 0.03
MIN_ACTIONABLE_EUR = 5000.0
NEUTRAL_RISK = 50.0
WEIGHTS = {"SavingsPotentialScore": 0.45, "SpendScaleScore": 0.20, "PricingSignalScore": 0.15, "MaverickSignalScore": 0.10,
           "SupplierRiskPriorityScore": 0.05, "ConcentrationPriorityScore": 0.05}
BANDS = [(75, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM")]
MIXED_GAP = 0.20

SIGNALS = ["PricingAnomalyScore", "PricingAnomalyFlag", "PriceComplianceExceptionFlag", "ContractPriceVariancePct",
           "HasContractBenchmarkFlag", "HasMaterialHistoryFlag", "HasSupplierMaterialHistoryFlag",
           "PriceVsMaterialHistoricalAvgPct", "PriceVsSupplierMaterialHistoricalAvgPct", "BenchmarkCoverageCount"]


def _on(c: str) -> Column:
    return F.coalesce(F.col(c).cast("int"), F.lit(0)) == 1


def item_evidence(po_fact: DataFrame, scores: DataFrame, year: int, as_of: str) -> DataFrame:
    """Per order item: which benchmark shows an overpayment, and what could be recovered.

    A contract benchmark comes before the supplier's own history of the material, which comes
    before the material's history. An item with a pricing saving gives no maverick saving.
    """
    items = (po_fact.where((F.year("OrderDate") == year) & (F.col("OrderDate") <= F.to_date(F.lit(as_of))) & F.col("SpendEligibilityFlag"))
             .select("POItemID", "POID", "SupplierID", "CategoryID", "MaterialID", "ContractID", "OrderDate",
                     F.coalesce(F.col("EligibleSpendEUR").cast("double"), F.lit(0.0)).alias("EligibleSpendEUR"),
                     F.coalesce(F.col("MaverickSpendFlag").cast("int"), F.lit(0)).alias("MaverickSpendFlag"),
                     F.coalesce(F.col("ContractComplianceFlag").cast("int"), F.lit(0)).alias("ContractComplianceFlag")))
    out = items.join(scores.select("POItemID", *SIGNALS), "POItemID", "left").withColumns({
        "HasPricingSignalFlag": F.col("PricingAnomalyScore").isNotNull().cast("int"),
        "PricingAnomalyFlag": F.coalesce(F.col("PricingAnomalyFlag"), F.lit(0)),
        "PriceComplianceExceptionFlag": F.coalesce(F.col("PriceComplianceExceptionFlag"), F.lit(0))})
    odd, contract, own, any_ = (F.col("PricingAnomalyFlag") == 1, F.col("ContractPriceVariancePct"),
                                F.col("PriceVsSupplierMaterialHistoricalAvgPct"), F.col("PriceVsMaterialHistoricalAvgPct"))
    options = [("CONTRACT", contract, _on("HasContractBenchmarkFlag") & (odd | _on("PriceComplianceExceptionFlag"))),
               ("SUPPLIER_MATERIAL_HISTORY", own, odd & _on("HasSupplierMaterialHistoryFlag")),
               ("MATERIAL_HISTORY", any_, odd & _on("HasMaterialHistoryFlag"))]
    chosen = F.coalesce(*[F.when(test & (value > 0), F.struct(F.lit(name).alias("type"), value.alias("pct")))
                          for name, value, test in options])
    spend, capped = F.col("EligibleSpendEUR"), F.col("CappedPositivePriceVariancePct")
    only_if = lambda test, value: F.when(test, value).otherwise(F.lit(0.0))
    return (out.withColumn("__best", chosen).withColumns({
        "PricingSavingsBenchmarkType": F.col("__best.type"), "SelectedPositivePriceVariancePct": F.col("__best.pct"),
        "CappedPositivePriceVariancePct": F.when(F.col("__best").isNotNull(), F.least(F.col("__best.pct"), F.lit(MAX_VARIANCE_PCT))),
    }).drop("__best")
        .withColumn("PricingOpportunityYTDEUR", only_if(capped > 0, spend * (capped / (100.0 + capped))))
        .withColumn("MaverickNonPricingSpendYTDEUR",
                    only_if(_on("MaverickSpendFlag") & (F.col("PricingOpportunityYTDEUR") <= 0), spend))
        .withColumn("MaverickOpportunityYTDEUR", F.col("MaverickNonPricingSpendYTDEUR") * MAVERICK_RATE)
        .withColumns({
            "TotalOpportunityYTDEUR": F.col("PricingOpportunityYTDEUR") + F.col("MaverickOpportunityYTDEUR"),
            "PricingAnomalySpendYTDEUR": only_if(odd, spend), "MaverickSpendYTDEUR": only_if(_on("MaverickSpendFlag"), spend),
            "ContractPriceExceptionSpendYTDEUR": only_if(_on("PriceComplianceExceptionFlag"), spend)}))


def opportunities(items: DataFrame, risk: DataFrame, prediction_date: str, factor: float) -> DataFrame:
    """Supplier x category: year to date, annualised, rates, concentration, risk."""
    # Item amounts are summed as exact decimals, so the total does not depend on task order.
    money = lambda c: F.round(F.sum(F.col(c).cast("decimal(28,8)")), 2).cast("double").alias(c)
    out = items.groupBy("SupplierID", "CategoryID").agg(
        F.count("*").alias("POItemCount"), F.countDistinct("POID").alias("POCount"),
        F.countDistinct("MaterialID").alias("MaterialCount"), money("EligibleSpendEUR"), money("PricingAnomalySpendYTDEUR"),
        F.sum("PricingAnomalyFlag").alias("PricingAnomalyPOItemCount"),
        F.round(F.avg("PricingAnomalyScore"), 4).alias("AveragePricingAnomalyScore"),
        F.round(F.max("PricingAnomalyScore"), 4).alias("MaximumPricingAnomalyScore"), money("MaverickSpendYTDEUR"),
        F.sum("MaverickSpendFlag").alias("MaverickPOItemCount"), money("ContractPriceExceptionSpendYTDEUR"),
        F.sum("PriceComplianceExceptionFlag").alias("PriceComplianceExceptionCount"), money("PricingOpportunityYTDEUR"),
        money("MaverickOpportunityYTDEUR"), money("TotalOpportunityYTDEUR"),
        F.round(F.avg("BenchmarkCoverageCount"), 4).alias("AverageBenchmarkCoverageCount"))
    out = out.withColumnsRenamed({"EligibleSpendEUR": "EligibleSpendYTDEUR", "TotalOpportunityYTDEUR": "PotentialSavingsYTDEUR"})
    year = lambda c: F.round(F.col(c) * factor, 2)
    out = out.withColumns({
        "PredictionDate": F.to_date(F.lit(prediction_date)), "AnnualizationFactor": F.lit(factor),
        "AnnualizedEligibleSpendEUR": year("EligibleSpendYTDEUR"),
        "AnnualizedPricingOpportunityEUR": year("PricingOpportunityYTDEUR"),
        "AnnualizedMaverickOpportunityEUR": year("MaverickOpportunityYTDEUR")})
    out = out.withColumn("PotentialAnnualSavingsEUR", F.round(
        F.col("AnnualizedPricingOpportunityEUR") + F.col("AnnualizedMaverickOpportunityEUR"), 2))
    rate = lambda n, d: F.when(F.col(d) > 0, F.col(n) / F.col(d) * 100.0)
    out = out.withColumns({
        "PricingAnomalyRatePct": rate("PricingAnomalyPOItemCount", "POItemCount"),
        "MaverickSpendPct": rate("MaverickSpendYTDEUR", "EligibleSpendYTDEUR"),
        "PricingOpportunityPct": rate("AnnualizedPricingOpportunityEUR", "AnnualizedEligibleSpendEUR"),
        "PotentialSavingsPct": rate("PotentialAnnualSavingsEUR", "AnnualizedEligibleSpendEUR"),
        "__spend": F.col("AnnualizedEligibleSpendEUR").cast("decimal(28,2)"), "__one": F.lit(1)})
    out = with_total(out, "__spend", "CategoryAnnualizedSpendEUR", ["CategoryID"])
    out = with_total(out, "__one", "CategorySupplierCount", ["CategoryID"])
    out = out.withColumn("CategoryAnnualizedSpendEUR", F.col("CategoryAnnualizedSpendEUR").cast("double"))
    out = out.withColumn("SupplierCategorySpendSharePct", rate("AnnualizedEligibleSpendEUR", "CategoryAnnualizedSpendEUR"))
    out = rank_within(out.drop("__spend", "__one"), ["CategoryID"], [F.desc("AnnualizedEligibleSpendEUR"), F.asc("SupplierID")],
                      "CategorySpendRank")
    out = lookup(out, risk, {"SupplierID": "SupplierID"}, ["SupplierRiskScore", "PredictedHighRiskFlag"])
    return out.withColumns({"HasSupplierRiskScoreFlag": F.col("SupplierRiskScore").isNotNull().cast("int"),
                            "SupplierRiskScoreForPriority": F.coalesce(F.col("SupplierRiskScore"), F.lit(NEUTRAL_RISK))})


def prioritise(opp: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Weighted priority from whole-table percent ranks, band, driver, and three ranks."""
    out = global_percent_ranks(opp, {"PotentialAnnualSavingsEUR": "SavingsPotentialScore", "AnnualizedEligibleSpendEUR": "SpendScaleScore",
                                     "PricingOpportunityPct": "PricingSignalScore", "MaverickSpendPct": "MaverickSignalScore"})
    clamp = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(100.0))
    out = out.withColumns({
        "SupplierRiskPriorityScore": clamp(F.col("SupplierRiskScoreForPriority")),
        "ConcentrationPriorityScore": clamp(F.coalesce(F.col("SupplierCategorySpendSharePct"), F.lit(0.0)))})
    saving, pricing, maverick = (F.col("PotentialAnnualSavingsEUR"), F.col("AnnualizedPricingOpportunityEUR"),
                                 F.col("AnnualizedMaverickOpportunityEUR"))
    out = out.withColumn("NegotiationPriorityScoreRaw", sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0)))
    out = out.withColumn("NegotiationPriorityScore",
                         F.when(saving > 0, F.round("NegotiationPriorityScoreRaw", 2)).otherwise(F.lit(0.0)))
    score = F.col("NegotiationPriorityScore")
    band = F.coalesce(*[F.when(score >= at, F.lit(name)) for at, name in BANDS], F.when(saving > 0, F.lit("LOW")), F.lit("NONE"))
    close = (pricing > 0) & (maverick > 0) & (F.try_divide(F.abs(pricing - maverick), F.greatest(pricing, maverick)) <= MIXED_GAP)
    driver = (F.when(saving <= 0, "NONE").when(close, "MIXED").when(pricing >= maverick, "PRICING").otherwise("MAVERICK"))
    out = out.withColumns({"NegotiationPriority": band, "PrimaryOpportunityDriver": driver,
                           "ActionableOpportunityFlag": ((saving >= MIN_ACTIONABLE_EUR) & (score >= 40)).cast("int")})
    by_saving = [F.desc("PotentialAnnualSavingsEUR"), F.desc("NegotiationPriorityScore"), F.asc("SupplierID"), F.asc("CategoryID")]
    by_score = [F.desc("NegotiationPriorityScore"), F.desc("PotentialAnnualSavingsEUR"), F.asc("SupplierID"), F.asc("CategoryID")]
    out = global_rank(out, by_saving, "SavingsOpportunityRank")
    out = rank_within(out, ["CategoryID"], by_saving[:3], "CategorySavingsRank")
    return global_rank(out, by_score, "NegotiationPriorityRank")


SUMS = ["AnnualizedEligibleSpendEUR", "AnnualizedPricingOpportunityEUR", "AnnualizedMaverickOpportunityEUR", "PotentialAnnualSavingsEUR"]


def _sums() -> list[Column]:
    return [F.sum(F.col(c).cast("decimal(28,2)")).alias(c) for c in SUMS]


def portfolio(opp: DataFrame) -> DataFrame:
    out = opp.agg(F.count("*").alias("SupplierCategoryOpportunityCount"), F.countDistinct("SupplierID").alias("SupplierCount"),
                  F.countDistinct("CategoryID").alias("CategoryCount"),
                  F.sum("ActionableOpportunityFlag").alias("ActionableOpportunityCount"), *_sums())
    return out.withColumn("PortfolioPotentialSavingsPct", pct("PotentialAnnualSavingsEUR", "AnnualizedEligibleSpendEUR", 4))


def portfolio_by_priority(opp: DataFrame) -> DataFrame:
    return opp.groupBy("NegotiationPriority").agg(
        F.count("*").alias("OpportunityCount"), F.sum("ActionableOpportunityFlag").alias("ActionableOpportunityCount"), *_sums(),
        F.round(F.avg("NegotiationPriorityScore"), 2).alias("AveragePriorityScore"))


def run_metadata(spark, name: str, version: str, params: Mapping[str, float], metrics: DataFrame | None = None) -> DataFrame:
    """Parameters (literals) and metrics (columns of a one-row frame) as rows, with a load time."""
    schema = StructType([StructField("Kind", StringType()), StructField("Name", StringType()), StructField("Value", DoubleType())])
    out = from_rows(spark, [("PARAMETER", k, float(v)) for k, v in params.items()], schema)
    if metrics is not None:
        pairs = F.array(*[F.struct(F.lit("METRIC").alias("Kind"), F.lit(c).alias("Name"), F.col(c).cast("double").alias("Value"))
                          for c in metrics.columns])
        out = out.unionByName(metrics.select(F.inline(pairs)))
    return out.withColumns({"EngineName": F.lit(name), "EngineVersion": F.lit(version), "RunTimestamp": F.current_timestamp()})


def promote(preds: DataFrame, dims: Mapping[str, DataFrame], date: str, grain: list[str], batch: str,
            po_fact: DataFrame | None = None) -> DataFrame:
    """Replace business keys by gold keys as of the prediction date and add promotion lineage."""
    out = preds.withColumn("PredictionDate", F.to_date(F.lit(date)))
    out = asof_versions(out, dims["Supplier"], "SupplierID", "PredictionDate",
                        {"SupplierKey": "SupplierKey", "DimensionVersion": "SupplierDimensionVersion"})
    if "CategoryID" in preds.columns:
        out = lookup(out, dims["Category"], {"CategoryID": "CategoryID"}, ["CategoryKey"])
    if po_fact is not None:
        out = lookup(out, po_fact, {"POItemID": "POItemID"},
                     ["PurchaseOrderFactKey", "MaterialKey", "ContractKey"])
    return out.withColumns({"PredictionDateKey": F.date_format("PredictionDate", "yyyyMMdd").cast("int"),
                            "PredictionKey": surrogate_key(*grain, "PredictionDate"),
                            "PromotionBatchID": F.lit(batch), "PromotionTimestamp": F.current_timestamp()})


def promotion_checks(source: DataFrame, promoted: DataFrame, table: str, grain: list[str], score: str, keys: list[str]) -> DataFrame:
    """Grain, completeness, range and row reconciliation of a promoted product."""
    rules = [Rule(f"{k} resolved", F.col(k).isNull(), "Completeness") for k in keys]
    rules.append(Rule(f"{score} within 0 and 100", F.col(score).isNull() | (F.col(score) < 0) | (F.col(score) > 100), "Range"))
    return results([key_rule(promoted, table, [*grain, "PredictionDate"]), row_rules(promoted, table, rules),
                    row_count_rule(promoted, table, source, "source rows preserved")])
