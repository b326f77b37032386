"""Savings projects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import amount_if, clean, clean_id, pct, title_case, to_eur, year_month
from spendline.operators.fx import fx_resolve
from spendline.operators.joins import lookup, resolved_flag
from spendline.operators.shape import BRONZE_AUDIT, dedup_latest, rename_present, stamp

# Fixed values
STATUSES = ["Idea", "Validated", "Negotiation", "Implemented", "Cancelled"]
PIPELINE = ["Idea", "Validated", "Negotiation"]
CONFIDENCE = {"L0": "0.00", "L1": "0.25", "L2": "0.50", "L3": "1.00"}

MONEY = "decimal(20,2)"
IDS = ["SavingsProjectID", "SupplierID", "CategoryID", "BuyerID", "BusinessUnitID", "ContractID", "Currency", "SavingsLevel"]
DATES = ["ProjectCreatedDate", "PlannedStartDate", "PlannedCompletionDate", "ActualCompletionDate", "CancellationDate"]
AMOUNTS = ["BaselineSpend", "ForecastedSavings", "ApprovedSavings", "RealizedSavings"]


def clean_savings(df: DataFrame) -> DataFrame:
    out = df.withColumns({
        **{c: clean_id(c) for c in IDS},
        "SavingsProjectName": clean("SavingsProjectName"),
        **{c: title_case(c) for c in ("ProjectStatus", "SavingsType", "ApprovalStatus")},
        **{c: F.col(c).cast("date") for c in DATES},
        **{c: F.col(c).cast(MONEY) for c in AMOUNTS},
        "RecurringSavingsFlag": F.col("RecurringSavingsFlag").cast("boolean"),
    })
    order = [c for c in ("IngestionTimestamp", "SourceExtractDate") if c in out.columns] or \
            [c for c in out.columns if c != "SavingsProjectID"]
    return rename_present(dedup_latest(out, ["SavingsProjectID"], order), BRONZE_AUDIT)


def conform_savings(df: DataFrame, supplier: DataFrame, category: DataFrame, buyer: DataFrame, business_unit: DataFrame,
                    contract: DataFrame, as_of: str) -> DataFrame:
    """Cleaned projects with master data, contract agreement, status flags and durations.

    Durations count both end days. Contract agreement is NULL where no contract was found.
    """
    out = clean_savings(df)
    out = lookup(out, supplier, {"SupplierID": "SupplierID"},
                 ["SupplierName", "SupplierType", "Country", "Region", "PreferredSupplier", "StrategicSupplier",
                  "SupplierActiveFlag", "ESGRating", "FinancialRiskScore"])
    out = lookup(out, category, {"CategoryID": "CategoryID"}, ["CategoryName", "ProcurementType"])
    out = lookup(out, buyer, {"BuyerID": "BuyerID"},
                 {"BuyerName": "BuyerName", "BuyerRole": "BuyerRole", "BusinessUnitID": "BuyerBusinessUnitID"})
    out = resolved_flag(out, business_unit, {"BusinessUnitID": "BusinessUnitID"}, "BusinessUnitResolvedFlag")
    out = lookup(out, contract, {"ContractID": "ContractID"},
                 {"SupplierID": "ContractSupplierID", "CategoryID": "ContractCategoryID",
                  "ContractStartDate": "ContractStartDate", "ContractEndDate": "ContractEndDate",
                  "ContractType": "ContractType"}, found="ContractResolvedFlag")
    found, day = F.col("ContractResolvedFlag"), F.to_date(F.lit(as_of))
    planned, start = F.col("PlannedCompletionDate"), F.col("PlannedStartDate")
    running = F.col("ProjectStatus").isin(*PIPELINE)
    overdue = running & planned.isNotNull() & (planned < day)
    return out.withColumns({
        "ContractReferenceFlag": F.col("ContractID").isNotNull(),
        "ContractSupplierMatchFlag": F.when(found, F.col("SupplierID") == F.col("ContractSupplierID")),
        "ContractCategoryMatchFlag": F.when(found, F.col("CategoryID") == F.col("ContractCategoryID")),
        **{f"Is{s}Flag": F.col("ProjectStatus") == s for s in STATUSES},
        "ActivePipelineFlag": running,
        "OverdueProjectFlag": overdue,
        "PlannedDurationDays": F.datediff(planned, start) + 1,
        "ActualDurationDays": F.datediff("ActualCompletionDate", start) + 1,
        "DaysPastPlannedCompletion": F.when(overdue, F.datediff(day, planned)),
    })


def savings_amounts(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Confidence weighting, EUR amounts at the creation date, rates and pipeline amounts."""
    weights = F.create_map(*[F.lit(v) if i else F.lit(k) for k, v in CONFIDENCE.items() for i in (0, 1)])
    out = fx_resolve(df, "ProjectCreatedDate", "Currency", "Savings", rates)
    weight = F.try_element_at(weights, F.col("SavingsLevel")).cast("decimal(4,2)")
    out = out.withColumn("SavingsConfidenceWeight", weight).withColumn(
        "WeightedForecastSavings", F.round(F.col("ForecastedSavings") * F.col("SavingsConfidenceWeight"), 2).cast(MONEY))
    out = out.withColumns({f"{c}EUR": to_eur(c, "SavingsExchangeRateToEUR", 2, 20)
                           for c in [*AMOUNTS, "WeightedForecastSavings"]})
    return out.withColumns({
        "ForecastSavingsPctOfBaseline": pct("ForecastedSavingsEUR", "BaselineSpendEUR"),
        "ApprovedSavingsPctOfBaseline": pct("ApprovedSavingsEUR", "BaselineSpendEUR"),
        "RealizedSavingsPctOfBaseline": pct("RealizedSavingsEUR", "BaselineSpendEUR"),
        "SavingsAchievementPct": pct("RealizedSavingsEUR", "ApprovedSavingsEUR"),
        "SavingsAchievementVarianceEUR": (F.col("RealizedSavingsEUR") - F.col("ApprovedSavingsEUR")).cast(MONEY),
        "ActivePipelineForecastEUR": amount_if("ActivePipelineFlag", "ForecastedSavingsEUR", MONEY),
        "ActivePipelineWeightedForecastEUR": amount_if("ActivePipelineFlag", "WeightedForecastSavingsEUR", MONEY),
        "ImplementedSavingsEUR": amount_if("IsImplementedFlag", "RealizedSavingsEUR", MONEY),
        "ProjectCreatedYear": F.year("ProjectCreatedDate"), "ProjectCreatedMonth": F.month("ProjectCreatedDate"),
        "ProjectCreatedYearMonth": year_month("ProjectCreatedDate"), "PlannedStartYear": F.year("PlannedStartDate"),
        "PlannedCompletionYear": F.year("PlannedCompletionDate"), "ActualCompletionYear": F.year("ActualCompletionDate"),
    })


def build_savings(df: DataFrame, supplier: DataFrame, category: DataFrame, buyer: DataFrame, business_unit: DataFrame,
                  contract: DataFrame, rates: DataFrame, as_of: str) -> DataFrame:
    base = conform_savings(df, supplier, category, buyer, business_unit, contract, as_of)
    return stamp(savings_amounts(base, rates), "bronze_savings_project", "Silver", BRONZE_AUDIT.values())
