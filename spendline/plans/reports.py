"""Report queries: cards, pivots, rankings and trends over the measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.operators.aggregates import top_n
from spendline.operators.joins import lookup
from spendline.plans import measures as M
from spendline.plans.registry import query

SPEND = ["Total Eligible Spend", "Contract Compliant Spend", "Maverick Spend", "Contract Compliance %", "Maverick Spend %"]
PERFORMANCE = ["Supplier OTD %", "Overdue Open Delivery %", "Supplier Quality Index", "Three-Way Match %", "Invoice Dispute %", "Duplicate Invoice %"]
CARDS = ["Savings Opportunities", "Positive Savings Opportunities", "Actionable Savings Opportunities", "Opportunity Annualized Spend", "Potential Annual Savings",
         "Actionable Potential Annual Savings", "Savings Potential %"]
DRILLDOWN = ["Supplier OTD %", "Overdue Open Delivery %", "Supplier Quality Index", "Three-Way Match %", "Invoice Dispute %", "Invoice Exception %"]
YEAR_CARDS = ["Supplier OTD %", "Supplier Quality Index", "Three-Way Match %", "Invoice Dispute %", "Supplier Performance Eligible Spend"]
PIPELINE = ["Savings Projects", "Active Savings Projects", "Forecasted Savings", "Weighted Forecast Savings", "Approved Savings", "Realized Savings", "Savings Realization %"]


def name(measure: str) -> str:
    return M._slug(measure)


def report(m, fact: str, measures: list[str], by: list[str], take: dict[str, list[str]], where: str | None = None, totals: bool = False,
           role: str | None = None, frame: DataFrame | None = None) -> DataFrame:
    """Measures by dimension columns, optionally filtered, with subtotals, under a named date role."""
    out = M.star(m, fact, take, role=role, frame=frame)
    if where:
        out = out.where(where)
    grouped = out.rollup(*by) if totals else out.groupBy(*by)
    return grouped.agg(*[F.expr(M.BY_NAME[x].expression).alias(name(x)) for x in measures])


def _columns(measures: list[str]) -> str:
    return " ".join(f"{name(x)}:{M.BY_NAME[x].kind}" for x in measures)


def _sql(measures: list[str]) -> str:
    return ", ".join(f"{M.BY_NAME[x].sql} AS {name(x)}" for x in measures)


_CAT = "fact_po JOIN c_category USING (CategoryID)"
_LATEST_OPP = "(SELECT * FROM ml_opp WHERE PredictionDate = DATE '2001-07-31')"
_LATEST_RISK = "(SELECT * FROM ml_risk WHERE PredictionDate = DATE '2001-07-31')"
_LATEST_PRICE = "(SELECT * FROM ml_price WHERE PredictionDate = DATE '2001-07-31')"


@query("R01_spend_cards", _columns(SPEND), f"SELECT {_sql(SPEND)} FROM fact_po WHERE year(OrderDate) = 2000")
def _(m):
    return report(m, M.PO, SPEND, [], {"dim_date": ["Year"]}, "Year = 2000")


@query("R02_category_pivot", "CategoryName:string " + _columns(SPEND), f"SELECT CategoryName, {_sql(SPEND)} FROM {_CAT} GROUP BY ROLLUP (CategoryName)")
def _(m):
    return report(m, M.PO, SPEND, ["CategoryName"], {"dim_category": ["CategoryName"]}, totals=True)


@query("R03_opportunity_cards", _columns(CARDS), f"SELECT {_sql(CARDS)} FROM {_LATEST_OPP}")
def _(m):
    return report(m, M.OPP, CARDS, [], {}, frame=M.latest_snapshot(m[M.OPP]))


@query("R04_pipeline_cards", _columns(PIPELINE), f"SELECT {_sql(PIPELINE)} FROM fact_sav WHERE year(PlannedCompletionDate) = 2000")
def _(m):
    return report(m, M.SAV, PIPELINE, [], {"dim_date": ["Year"]}, "Year = 2000")


def _risk_with_spend(m) -> DataFrame:
    risk = M.latest_snapshot(m[M.RISK]).groupBy("SupplierID").agg(F.round(F.avg("SupplierRiskScore"), 4).alias("RiskScore"), F.max("PredictedHighRiskFlag").alias("HighRisk"))
    spend = m.narrow[M.PO].groupBy("SupplierID").agg(F.sum("EligibleSpendEUR").alias("Spend"))
    out = risk.join(spend, "SupplierID", "left")
    return lookup(out, M.dimension(m, "dim_supplier_current"), {"SupplierID": "SupplierID"}, ["SupplierName"])


_RISK_SPEND = f"""SELECT r.SupplierID, d.SupplierName, round(r.SupplierRiskScore, 4) AS RiskScore, r.PredictedHighRiskFlag AS HighRisk, e / 100.0 AS Spend FROM {_LATEST_RISK} r
    LEFT JOIN (SELECT POSupplierID, sum(elig_c) AS e FROM fact_po GROUP BY 1) p ON p.POSupplierID = r.SupplierID
    LEFT JOIN (SELECT * FROM dim_supplier WHERE IsCurrentFlag) d ON d.SupplierID = r.SupplierID"""


@query("R05_supplier_risk_table", "SupplierID:string SupplierName:string RiskScore:double Spend:double", _RISK_SPEND)
def _(m):
    return _risk_with_spend(m).orderBy(F.desc("RiskScore"), F.desc("Spend"), "SupplierID")


@query("R06_performance_cards", _columns(PERFORMANCE), f"SELECT {_sql(PERFORMANCE)} FROM fact_perf WHERE PerformanceYear = 2000")
def _(m):
    return report(m, M.PERF, PERFORMANCE, [], {}, "PerformanceYear = 2000")


@query("R07_anomaly_table", "SupplierID:string CategoryName:string Anomalies:long Items:long AnomalyRate:double AffectedSpend:double", f"""
    SELECT SupplierID, CategoryName, count(*) FILTER (PricingAnomalyFlag = 1) AS Anomalies, count(*) AS Items,
      count(*) FILTER (PricingAnomalyFlag = 1) / CAST(count(*) AS DOUBLE) AS AnomalyRate, CAST(coalesce(any_value(spend_c), 0) AS DOUBLE) / 100.0 AS AffectedSpend
    FROM {_LATEST_PRICE} JOIN c_category USING (CategoryID) LEFT JOIN (
      SELECT POSupplierID AS SupplierID, CategoryID, sum(elig_c) AS spend_c FROM fact_po WHERE POItemID IN ({M._ANOMALY_ITEMS}) GROUP BY 1, 2) USING (SupplierID, CategoryID)
    GROUP BY 1, 2""")
def _(m):
    f = M.star(m, M.PRICE, {"dim_category": ["CategoryName"]}, frame=M.latest_snapshot(m[M.PRICE]))
    per = f.groupBy("SupplierID", "CategoryID", "CategoryName").agg(F.count_if(F.col("PricingAnomalyFlag") == 1).alias("Anomalies"), F.count("*").alias("Items"))
    spend = M.spend_of_anomalies(m).groupBy("SupplierID", "CategoryID").agg(F.sum("EligibleSpendEUR").alias("AffectedSpend"))
    per = per.join(spend, ["SupplierID", "CategoryID"], "left").withColumns({"AnomalyRate": F.col("Anomalies") / F.col("Items"), "AffectedSpend": F.coalesce("AffectedSpend", F.lit(0))})
    return per.orderBy(F.desc("Anomalies"), F.desc("AffectedSpend"), "SupplierID", "CategoryName")


@query("R08_year_supplier_drilldown", "PerformanceYear:int SupplierName:string " + _columns(DRILLDOWN),
       f"SELECT PerformanceYear, SupplierName, {_sql(DRILLDOWN)} FROM fact_perf GROUP BY ROLLUP (PerformanceYear, SupplierName)")
def _(m):
    return report(m, M.PERF, DRILLDOWN, ["PerformanceYear", "SupplierName"], {"dim_supplier": ["SupplierName"]}, totals=True)


@query("R09_yearly_trend", "Year:int total_eligible_spend:double contract_compliance_pct:double", f"SELECT year(OrderDate) AS Year, {_sql([SPEND[0], SPEND[3]])} FROM fact_po GROUP BY 1")
def _(m):
    return report(m, M.PO, [SPEND[0], SPEND[3]], ["Year"], {"dim_date": ["Year"]}).orderBy("Year")


@query("R10_top_categories_by_opportunity", "CategoryName:string potential_annual_savings:double", f"""
    SELECT CategoryName, {_sql(['Potential Annual Savings'])} FROM {_LATEST_OPP} JOIN c_category USING (CategoryID) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(m):
    per = report(m, M.OPP, ["Potential Annual Savings"], ["CategoryName"], {"dim_category": ["CategoryName"]}, frame=M.latest_snapshot(m[M.OPP]))
    return top_n(per, 10, F.desc("potential_annual_savings"), "CategoryName")


@query("R11_risk_ranking", "SupplierID:string RiskScore:double HighRisk:int Spend:double", _RISK_SPEND + " WHERE r.PredictedHighRiskFlag = 1")
def _(m):
    return _risk_with_spend(m).where("HighRisk = 1").orderBy(F.desc("RiskScore"), "SupplierID")


@query("R12_sliced_spend", "Year:int BusinessUnitName:string CategoryName:string total_eligible_spend:double maverick_spend_pct:double", f"""
    SELECT year(OrderDate) AS Year, BusinessUnitName, CategoryName, {_sql([SPEND[0], SPEND[4]])} FROM fact_po JOIN c_category USING (CategoryID)
    JOIN c_bu USING (BusinessUnitID) WHERE year(OrderDate) IN (1999, 2000) GROUP BY 1, 2, 3""")
def _(m):
    return report(m, M.PO, [SPEND[0], SPEND[4]], ["Year", "BusinessUnitName", "CategoryName"],
                  {"dim_date": ["Year"], "dim_business_unit": ["BusinessUnitName"], "dim_category": ["CategoryName"]}, "Year IN (1999, 2000)")


@query("R13_top_maverick_categories", "CategoryName:string " + _columns(SPEND), f"SELECT CategoryName, {_sql(SPEND)} FROM {_CAT} GROUP BY 1")
def _(m):
    return report(m, M.PO, SPEND, ["CategoryName"], {"dim_category": ["CategoryName"]}).orderBy(F.desc(name(SPEND[2])), "CategoryName")


@query("R13_top_maverick_suppliers", "SupplierID:string " + _columns(SPEND), f"SELECT POSupplierID AS SupplierID, {_sql(SPEND)} FROM fact_po GROUP BY 1")
def _(m):
    return report(m, M.PO, SPEND, ["SupplierID"], {}).orderBy(F.desc(name(SPEND[2])), "SupplierID")


@query("R14_compliance_by_unit", "BusinessUnitName:string contract_compliance_pct:double maverick_spend_pct:double", f"""
    SELECT BusinessUnitName, {_sql(SPEND[3:])} FROM fact_po JOIN c_bu USING (BusinessUnitID) GROUP BY 1""")
def _(m):
    return report(m, M.PO, SPEND[3:], ["BusinessUnitName"], {"dim_business_unit": ["BusinessUnitName"]})


@query("R15_top_risk_suppliers", "SupplierID:string RiskScore:double", f"SELECT SupplierID, round(SupplierRiskScore, 4) AS RiskScore FROM {_LATEST_RISK} ORDER BY 2 DESC, 1 LIMIT 10")
def _(m):
    return top_n(_risk_with_spend(m), 10, F.desc("RiskScore"), "SupplierID")


@query("R15_top_overdue_suppliers", "SupplierID:string overdue_open_deliveries:long", "SELECT SupplierID, sum(OverdueOpenPOItemCount) AS overdue_open_deliveries FROM fact_perf WHERE SupplierID IS NOT NULL GROUP BY 1")
def _(m):
    return report(m, M.PERF, ["Overdue Open Deliveries"], ["SupplierID"], {}, "SupplierID IS NOT NULL").orderBy(F.desc("overdue_open_deliveries"), "SupplierID")


@query("R16_quality_trend", "PerformanceYear:int supplier_otd_pct:double supplier_quality_index:double", f"SELECT PerformanceYear, {_sql([PERFORMANCE[0], PERFORMANCE[2]])} FROM fact_perf GROUP BY 1")
def _(m):
    return report(m, M.PERF, [PERFORMANCE[0], PERFORMANCE[2]], ["PerformanceYear"], {}).orderBy("PerformanceYear")


@query("R17_performance_and_risk", "SupplierID:string " + _columns(YEAR_CARDS) + " RiskScore:double", f"""
    SELECT p.*, round(r.SupplierRiskScore, 4) AS RiskScore FROM (SELECT SupplierID, {_sql(YEAR_CARDS)} FROM fact_perf WHERE PerformanceYear = 2000 GROUP BY 1) p
    LEFT JOIN {_LATEST_RISK} r ON r.SupplierID = p.SupplierID""")
def _(m):
    year = report(m, M.PERF, YEAR_CARDS, ["SupplierID"], {}, "PerformanceYear = 2000")
    return year.join(_risk_with_spend(m).select("SupplierID", "RiskScore"), "SupplierID", "left")


@query("R18_top_anomaly_categories", "CategoryName:string pricing_anomalies:long", f"""
    SELECT CategoryName, {_sql(['Pricing Anomalies'])} FROM {_LATEST_PRICE} JOIN c_category USING (CategoryID) GROUP BY 1""")
def _(m):
    per = report(m, M.PRICE, ["Pricing Anomalies"], ["CategoryName"], {"dim_category": ["CategoryName"]}, frame=M.latest_snapshot(m[M.PRICE]))
    return per.orderBy(F.desc("pricing_anomalies"), "CategoryName")


@query("R18_anomaly_exposure", "SupplierID:string Items:long Anomalies:long AnomalyRate:double exposure:double", f"""
    SELECT SupplierID, count(*) AS Items, count(*) FILTER (PricingAnomalyFlag = 1) AS Anomalies, count(*) FILTER (PricingAnomalyFlag = 1) / CAST(count(*) AS DOUBLE) AS AnomalyRate,
      any_value(spend_c) / 100.0 AS exposure
    FROM {_LATEST_PRICE} JOIN (SELECT POSupplierID AS SupplierID, sum(elig_c) AS spend_c FROM fact_po WHERE POItemID IN ({M._ANOMALY_ITEMS}) GROUP BY 1) USING (SupplierID) GROUP BY 1""")
def _(m):
    spend = M.spend_of_anomalies(m).groupBy("SupplierID").agg(F.sum("EligibleSpendEUR").alias("exposure"))
    per = M.latest_snapshot(m[M.PRICE]).groupBy("SupplierID").agg(F.count("*").alias("Items"), F.count_if(F.col("PricingAnomalyFlag") == 1).alias("Anomalies"))
    return per.join(spend, "SupplierID").withColumn("AnomalyRate", F.col("Anomalies") / F.col("Items")).orderBy(F.desc("exposure"))


@query("R19_top_opportunities", "SupplierID:string CategoryName:string Savings:double ActionableSavings:double NegotiationPriority:string NegotiationPriorityScore:double", f"""
    SELECT SupplierID, CategoryName, saving AS Savings, CASE WHEN ActionableOpportunityFlag = 1 THEN saving ELSE 0 END AS ActionableSavings, NegotiationPriority, score AS NegotiationPriorityScore
    FROM {_LATEST_OPP} JOIN c_category USING (CategoryID)""")
def _(m):
    f = M.star(m, M.OPP, {"dim_category": ["CategoryName"]}, frame=M.latest_snapshot(m[M.OPP])).withColumn("Savings", F.col("PotentialAnnualSavingsEUR"))
    f = f.withColumn("ActionableSavings", F.when(F.col("ActionableOpportunityFlag") == 1, F.col("Savings")).otherwise(0))
    return f.orderBy(F.desc("Savings"), F.desc("NegotiationPriorityScore"), "SupplierID", "CategoryName")


@query("R20_savings_trend", "Year:int Forecast:double Approved:double Realized:double", """
    SELECT coalesce(a.y, b.y, c.y) AS Year, f / 100.0 AS Forecast, p / 100.0 AS Approved, r / 100.0 AS Realized
    FROM (SELECT year(PlannedStartDate) AS y, sum(fore_eur) AS f FROM fact_sav GROUP BY 1) a FULL JOIN (SELECT year(PlannedCompletionDate) AS y, sum(appr_eur) AS p FROM fact_sav GROUP BY 1) b ON a.y = b.y
    FULL JOIN (SELECT year(ActualCompletionDate) AS y, sum(real_eur) AS r FROM fact_sav WHERE ActualCompletionDate IS NOT NULL GROUP BY 1) c ON coalesce(a.y, b.y) = c.y""")
def _(m):
    def by(role, column, out):
        f = M.star(m, M.SAV, {"dim_date": ["Year"]}, role=role)
        return f.where("Year IS NOT NULL").groupBy("Year").agg(F.sum(column).alias(out))
    return (by("PlannedStartDateKey", "ForecastedSavingsEUR", "Forecast").join(by(None, "ApprovedSavingsEUR", "Approved"), "Year", "full")
            .join(by("ActualCompletionDateKey", "RealizedSavingsEUR", "Realized"), "Year", "full").orderBy("Year"))


@query("R21_weighted_by_category", "CategoryName:string weighted_forecast_savings:double", f"""
    SELECT CategoryName, {_sql(['Weighted Forecast Savings'])} FROM fact_sav JOIN c_category USING (CategoryID) GROUP BY 1""")
def _(m):
    per = report(m, M.SAV, ["Weighted Forecast Savings"], ["CategoryName"], {"dim_category": ["CategoryName"]})
    return per.orderBy(F.desc("weighted_forecast_savings"), "CategoryName")


@query("R21_approved_vs_realized", "BusinessUnitName:string approved_savings:double realized_savings:double", f"""
    SELECT BusinessUnitName, {_sql(['Approved Savings', 'Realized Savings'])} FROM fact_sav JOIN c_bu USING (BusinessUnitID) GROUP BY 1""")
def _(m):
    return report(m, M.SAV, ["Approved Savings", "Realized Savings"], ["BusinessUnitName"], {"dim_business_unit": ["BusinessUnitName"]})


@query("R22_project_list", "SavingsProjectID:string SavingsProjectName:string CategoryName:string BusinessUnitName:string ProjectStatus:string SupplierID:string Forecast:double Weighted:double Approved:double Realized:double", """
    SELECT SavingsProjectID, SavingsProjectName, CategoryName, BusinessUnitName, ProjectStatus, SupplierID, fore_eur / 100.0 AS Forecast,
      wf_eur / 100.0 AS Weighted, appr_eur / 100.0 AS Approved, real_eur / 100.0 AS Realized FROM fact_sav JOIN c_category USING (CategoryID) JOIN c_bu USING (BusinessUnitID)""")
def _(m):
    f = M.star(m, M.SAV, {"dim_category": ["CategoryName"], "dim_business_unit": ["BusinessUnitName"]})
    amounts = {"Forecast": "ForecastedSavingsEUR", "Weighted": "WeightedForecastSavingsEUR", "Approved": "ApprovedSavingsEUR", "Realized": "RealizedSavingsEUR"}
    return f.withColumns({k: F.col(c) for k, c in amounts.items()}).orderBy(F.desc("Forecast"), "SavingsProjectID")
