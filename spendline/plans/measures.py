"""Business measures over the star schema, and the relationship registry they rely on.

A measure is one aggregate expression over one fact. Groupings come from dimension columns reached
through the active relationships; an inactive date role is used only when a caller names it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import ratio
from spendline.operators.joins import treat_as
from spendline.plans.registry import query

# fact -> {key column: (dimension table, dimension key)}; all of these are active
RELATIONSHIPS = {
    "fact_purchase_order": {"SupplierKey": ("dim_supplier", "SupplierKey"), "CategoryKey": ("dim_category", "CategoryKey"),
                            "MaterialKey": ("dim_material", "MaterialKey"), "BuyerKey": ("dim_buyer", "BuyerKey"),
                            "BusinessUnitKey": ("dim_business_unit", "BusinessUnitKey"), "CurrencyKey": ("dim_currency", "CurrencyKey"),
                            "ContractKey": ("dim_contract", "ContractKey"), "OrderDateKey": ("dim_date", "DateKey")},
    "fact_invoice": {"SupplierKey": ("dim_supplier", "SupplierKey"), "CategoryKey": ("dim_category", "CategoryKey"),
                     "MaterialKey": ("dim_material", "MaterialKey"), "BuyerKey": ("dim_buyer", "BuyerKey"),
                     "BusinessUnitKey": ("dim_business_unit", "BusinessUnitKey"), "CurrencyKey": ("dim_currency", "CurrencyKey"),
                     "ContractKey": ("dim_contract", "ContractKey"), "InvoiceDateKey": ("dim_date", "DateKey")},
    "fact_savings": {"SupplierKey": ("dim_supplier", "SupplierKey"), "CategoryKey": ("dim_category", "CategoryKey"),
                     "BuyerKey": ("dim_buyer", "BuyerKey"), "BusinessUnitKey": ("dim_business_unit", "BusinessUnitKey"),
                     "CurrencyKey": ("dim_currency", "CurrencyKey"), "ContractKey": ("dim_contract", "ContractKey"),
                     "PlannedCompletionDateKey": ("dim_date", "DateKey")},
    "fact_supplier_performance": {"SupplierKey": ("dim_supplier", "SupplierKey")},
    "ml_supplier_risk_prediction": {"SupplierID": ("dim_supplier_current", "SupplierID")},
    "ml_pricing_anomaly_prediction": {"SupplierID": ("dim_supplier_current", "SupplierID"), "CategoryID": ("dim_category", "CategoryID")},
    "ml_savings_opportunity": {"SupplierID": ("dim_supplier_current", "SupplierID"), "CategoryID": ("dim_category", "CategoryID")},
}
# Inactive relationships to the calendar, by role
DATE_ROLES = {
    "fact_purchase_order": ["RequestedDeliveryDateKey"], "fact_invoice": ["DueDateKey", "PostingDateKey"],
    "fact_savings": ["ProjectCreatedDateKey", "ActualCompletionDateKey", "PlannedStartDateKey", "CancellationDateKey"],
    "ml_supplier_risk_prediction": ["PredictionDateKey"], "ml_pricing_anomaly_prediction": ["PredictionDateKey"],
    "ml_savings_opportunity": ["PredictionDateKey"],
}


def dimension(m, name: str) -> DataFrame:
    return m["dim_supplier"].where("IsCurrentFlag") if name == "dim_supplier_current" else m[name]


def star(m, fact: str, take: dict[str, list[str]], role: str | None = None, frame: DataFrame | None = None) -> DataFrame:
    """Left-join the named columns of the named dimensions along the fact's relationships.

    `take` is {dimension: columns}. `role` replaces the active date relationship by an inactive one.
    Only dimensions that are asked for are joined. Rows without a match keep NULL attributes.
    """
    out = m.narrow[fact] if frame is None else frame
    links = dict(RELATIONSHIPS[fact])
    if role:
        if role not in DATE_ROLES.get(fact, []):
            raise KeyError(f"{role} is no date role of {fact}")
        links = {k: v for k, v in links.items() if v[0] != "dim_date"} | {role: ("dim_date", "DateKey")}
    for key, (dim, dim_key) in links.items():
        if dim in take:
            ref = dimension(m, dim).select(F.col(dim_key).alias("__k"), *take[dim])
            out = out.drop(*[c for c in take[dim] if c in out.columns]).join(ref, F.col(key) == F.col("__k"), "left").drop("__k")
    return out


def latest_snapshot(df: DataFrame, date: str = "PredictionDate") -> DataFrame:
    """Rows of the newest snapshot of the whole table, whatever is filtered later."""
    return df.where(F.col(date) == df.agg(F.max(date)).scalar())


@dataclass(frozen=True)
class Measure:
    number: int
    name: str
    fact: str
    expression: str             # Spark SQL aggregate
    sql: str                    # the independent twin
    kind: str = "double"


def _distinct(column: str, where: str | None = None) -> str:
    return f"count(DISTINCT CASE WHEN {where} THEN {column} END)" if where else f"count(DISTINCT {column})"


def _rate(a: str, b: str) -> str:
    """A ratio that is NULL on a zero denominator."""
    return f"try_divide(CAST(({a}) AS DOUBLE), CAST(({b}) AS DOUBLE))"


def _m(number, name, fact, expression, sql, kind="double"):
    return Measure(number, name, fact, expression, sql, kind)


def _sum(c: str) -> str:
    return f"sum({c})"


PO, INV, SAV, PERF = "fact_purchase_order", "fact_invoice", "fact_savings", "fact_supplier_performance"
RISK, PRICE, OPP = "ml_supplier_risk_prediction", "ml_pricing_anomaly_prediction", "ml_savings_opportunity"
E_, C_, V_ = "EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR"
_pos, _inv, _items = _distinct("POID"), _distinct("InvoiceID"), _distinct("InvoiceItemID")
_gap = f"{_sum(E_)} - {_sum(C_)} - {_sum(V_)}"
_fully, _on, _late = _sum("FullyReceivedPOItemCount"), _sum("OnTimeFullyReceivedPOItemCount"), _sum("OverdueOpenDeliveryCount")
_n, _bad, _good = _sum("InvoiceCount"), _sum("DisputedInvoiceCount"), _sum("DisputeFreeInvoiceCount")
_it, _ok, _exc, _dup = _sum("InvoiceItemCount"), _sum("ThreeWayMatchedInvoiceItemCount"), _sum("InvoiceExceptionItemCount"), _sum("DuplicateInvoiceCount")
_scored, _odd = _distinct("POItemID"), _distinct("POItemID", "PricingAnomalyFlag = 1")
_count, _act = "count(*)", "count_if(ActionableOpportunityFlag = 1)"
_save, _spend = "sum(CAST(PotentialAnnualSavingsEUR AS DECIMAL(28,2)))", "sum(CAST(AnnualizedEligibleSpendEUR AS DECIMAL(28,2)))"
_sup, _high = _distinct("SupplierID"), _distinct("SupplierID", "PredictedHighRiskFlag = 1")


def _div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def _cents(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / 100.0"


_S = {"e": _cents("elig_c"), "c": _cents("comp_c"), "v": _cents("mav_c"), "gap": "(CAST(sum(elig_c) - sum(comp_c) - sum(mav_c) AS DOUBLE) / 100.0)",
      "save": "CAST(sum(CAST(saving AS DECIMAL(28,2))) AS DOUBLE)", "spend": "CAST(sum(CAST(spend_y AS DECIMAL(28,2))) AS DOUBLE)",
      "full": "sum(DeliveryCompletePOItemCount)", "on": "sum(OnTimeDeliveryPOItemCount)", "late": "sum(OverdueOpenPOItemCount)"}

MEASURES = [
    _m(1, "Total Eligible Spend", PO, _sum(E_), _S["e"]), _m(2, "Contract Compliant Spend", PO, _sum(C_), _S["c"]), _m(3, "Maverick Spend", PO, _sum(V_), _S["v"]),
    _m(4, "Contract Compliance %", PO, _rate(_sum(C_), _sum(E_)), _div(_S["c"], _S["e"])), _m(5, "Maverick Spend %", PO, _rate(_sum(V_), _sum(E_)), _div(_S["v"], _S["e"])),
    _m(6, "Purchase Orders", PO, _pos, "count(DISTINCT POID)", "long"), _m(7, "PO Items", PO, _distinct("POItemID"), "count(DISTINCT POItemID)", "long"),
    _m(8, "Average Eligible Spend per PO", PO, _rate(_sum(E_), _pos), _div(_S["e"], "count(DISTINCT POID)")),
    _m(9, "Spend Compliance Reconciliation", PO, _gap, _S["gap"]), _m(10, "Spend Compliance Reconciliation %", PO, _rate(_gap, _sum(E_)), _div(_S["gap"], _S["e"])),
    _m(11, "Invoices", INV, _inv, "count(DISTINCT InvoiceID)", "long"), _m(12, "Invoice Items", INV, _items, "count(DISTINCT InvoiceItemID)", "long"),
    _m(13, "Gross Invoice Amount", INV, _sum("GrossAmountEUR"), _cents("gross_eur")),
    _m(14, "Invoice Three-Way Matched Items", INV, _distinct("InvoiceItemID", "ThreeWayMatchFlag"), "count(DISTINCT InvoiceItemID) FILTER (ThreeWayMatchFlag)", "long"),
    _m(15, "Invoice Three-Way Match %", INV, _rate(_distinct("InvoiceItemID", "ThreeWayMatchFlag"), _items), _div("count(DISTINCT InvoiceItemID) FILTER (ThreeWayMatchFlag)", "count(DISTINCT InvoiceItemID)")),
    _m(16, "Invoice Exception Items - Detail", INV, _distinct("InvoiceItemID", "NOT ThreeWayMatchFlag"), "count(DISTINCT InvoiceItemID) FILTER (NOT ThreeWayMatchFlag)", "long"),
    _m(17, "Invoice Exception % - Detail", INV, _rate(_distinct("InvoiceItemID", "NOT ThreeWayMatchFlag"), _items), _div("count(DISTINCT InvoiceItemID) FILTER (NOT ThreeWayMatchFlag)", "count(DISTINCT InvoiceItemID)")),
    _m(18, "Invoice Exception Amount", INV, _sum("InvoiceExceptionAmountEUR"), _cents("exc_eur")),
    _m(19, "Invoice Exception Amount %", INV, _rate(_sum("InvoiceExceptionAmountEUR"), _sum("GrossAmountEUR")), _div(_cents("exc_eur"), _cents("gross_eur"))),
    _m(20, "Invoice Disputed Invoices", INV, _distinct("InvoiceID", "DisputedInvoiceItemFlag"), "count(DISTINCT InvoiceID) FILTER (DisputeFlag)", "long"),
    _m(21, "Invoice Dispute % - Detail", INV, _rate(_distinct("InvoiceID", "DisputedInvoiceItemFlag"), _inv), _div("count(DISTINCT InvoiceID) FILTER (DisputeFlag)", "count(DISTINCT InvoiceID)")),
    _m(22, "Savings Projects", SAV, _distinct("SavingsProjectID"), "count(DISTINCT SavingsProjectID)", "long"),
    _m(23, "Active Savings Projects", SAV, _distinct("SavingsProjectID", "ActivePipelineFlag"), "count(DISTINCT SavingsProjectID) FILTER (ActivePipelineFlag)", "long"),
    _m(24, "Forecasted Savings", SAV, _sum("ForecastedSavingsEUR"), _cents("fore_eur")), _m(25, "Weighted Forecast Savings", SAV, _sum("WeightedForecastSavingsEUR"), _cents("wf_eur")),
    _m(26, "Approved Savings", SAV, _sum("ApprovedSavingsEUR"), _cents("appr_eur")), _m(27, "Realized Savings", SAV, _sum("RealizedSavingsEUR"), _cents("real_eur")),
    _m(28, "Savings Realization %", SAV, _rate(_sum("RealizedSavingsEUR"), _sum("ApprovedSavingsEUR")), _div(_cents("real_eur"), _cents("appr_eur"))),
    _m(29, "Suppliers with Performance", PERF, _sup, "count(DISTINCT SupplierID)", "long"), _m(30, "Fully Received PO Items", PERF, _fully, _S["full"], "long"),
    _m(31, "On-Time Fully Received PO Items", PERF, _on, _S["on"], "long"), _m(32, "Supplier OTD %", PERF, _rate(_on, _fully), _div(_S["on"], _S["full"])),
    _m(33, "Overdue Open Deliveries", PERF, _late, _S["late"], "long"), _m(34, "Overdue Open Delivery %", PERF, _rate(_late, f"{_fully} + {_late}"), _div(_S["late"], f"{_S['full']} + {_S['late']}")),
    _m(35, "Supplier Invoice Count", PERF, _n, "sum(InvoiceCount)", "long"), _m(36, "Disputed Invoices", PERF, _bad, "sum(DisputedInvoiceCount)", "long"),
    _m(37, "Invoice Dispute %", PERF, _rate(_bad, _n), _div("sum(DisputedInvoiceCount)", "sum(InvoiceCount)")), _m(38, "Dispute-Free Invoices", PERF, _good, "sum(DisputeFreeInvoiceCount)", "long"),
    _m(39, "Supplier Quality Index", PERF, _rate(_good, _n), _div("sum(DisputeFreeInvoiceCount)", "sum(InvoiceCount)")), _m(40, "Three-Way Matched Invoice Items", PERF, _ok, "sum(MatchedInvoiceItemCount)", "long"),
    _m(41, "Supplier Invoice Items", PERF, _it, "sum(InvoiceItemCount)", "long"), _m(42, "Three-Way Match %", PERF, _rate(_ok, _it), _div("sum(MatchedInvoiceItemCount)", "sum(InvoiceItemCount)")),
    _m(43, "Invoice Exception Items", PERF, _exc, "sum(InvoiceExceptionItemCount)", "long"), _m(44, "Invoice Exception %", PERF, _rate(_exc, _it), _div("sum(InvoiceExceptionItemCount)", "sum(InvoiceItemCount)")),
    _m(45, "Duplicate Invoices", PERF, _dup, "sum(DuplicateInvoiceCount)", "long"), _m(46, "Duplicate Invoice %", PERF, _rate(_dup, _n), _div("sum(DuplicateInvoiceCount)", "sum(InvoiceCount)")),
    _m(47, "Supplier Performance Eligible Spend", PERF, _sum(E_), _S["e"]), _m(48, "Supplier Performance Maverick %", PERF, _rate(_sum(V_), _sum(E_)), _div(_S["v"], _S["e"])),
    _m(49, "Latest Pricing Anomaly Prediction Date", PRICE, "max(PredictionDate)", "max(PredictionDate)", "string"), _m(50, "Pricing Items Scored", PRICE, _scored, "count(DISTINCT POItemID)", "long"),
    _m(51, "Pricing Anomalies", PRICE, _odd, "count(DISTINCT POItemID) FILTER (PricingAnomalyFlag = 1)", "long"),
    _m(52, "Pricing Anomaly Rate", PRICE, _rate(_odd, _scored), _div("count(DISTINCT POItemID) FILTER (PricingAnomalyFlag = 1)", "count(DISTINCT POItemID)")),
    _m(55, "Average Pricing Anomaly Score", PRICE, "round(avg(PricingAnomalyScore), 8)", "round(avg(PricingAnomalyScore), 8)"),
    _m(56, "Latest Savings Opportunity Prediction Date", OPP, "max(PredictionDate)", "max(PredictionDate)", "string"), _m(57, "Savings Opportunities", OPP, _count, "count(*)", "long"),
    _m(58, "Positive Savings Opportunities", OPP, "count_if(PotentialAnnualSavingsEUR > 0)", "count(*) FILTER (saving > 0)", "long"),
    _m(59, "Actionable Savings Opportunities", OPP, _act, "count(*) FILTER (ActionableOpportunityFlag = 1)", "long"), _m(60, "Potential Annual Savings", OPP, _save, _S["save"]),
    _m(61, "Actionable Potential Annual Savings", OPP, "coalesce(sum(CASE WHEN ActionableOpportunityFlag = 1 THEN CAST(PotentialAnnualSavingsEUR AS DECIMAL(28,2)) END), 0)",
       "CAST(coalesce(sum(CAST(saving AS DECIMAL(28,2))) FILTER (ActionableOpportunityFlag = 1), 0) AS DOUBLE)"),
    _m(62, "Actionable Opportunity %", OPP, _rate(_act, _count), _div("count(*) FILTER (ActionableOpportunityFlag = 1)", "count(*)")), _m(63, "Opportunity Annualized Spend", OPP, _spend, _S["spend"]),
    _m(64, "Savings Potential %", OPP, _rate(_save, _spend), _div(_S["save"], _S["spend"])),
    _m(65, "Latest Supplier Risk Prediction Date", RISK, "max(PredictionDate)", "max(PredictionDate)", "string"), _m(66, "Suppliers Scored", RISK, _sup, "count(DISTINCT SupplierID)", "long"),
    _m(67, "Average Supplier Risk Score", RISK, "round(avg(SupplierRiskScore), 8)", "round(avg(SupplierRiskScore), 8)"),
    _m(68, "High-Risk Suppliers", RISK, _high, "count(DISTINCT SupplierID) FILTER (PredictedHighRiskFlag = 1)", "long"),
    _m(69, "High-Risk Supplier %", RISK, _rate(_high, _sup), _div("count(DISTINCT SupplierID) FILTER (PredictedHighRiskFlag = 1)", "count(DISTINCT SupplierID)")),
]
BY_NAME = {x.name: x for x in MEASURES}


def measure(df: DataFrame, names: list[str], by: list[str]) -> DataFrame:
    """Evaluate measures of one fact over a frame that already carries the grouping columns."""
    return df.groupBy(*by).agg(*[F.expr(BY_NAME[n].expression).alias(n) for n in names])


# fact -> (dimension columns to group by, SQL source, SQL grouping)
_GROUP = {
    PO: ({"dim_category": ["CategoryName"]}, "CategoryName", "fact_po JOIN c_category USING (CategoryID)", "CategoryName"),
    INV: ({"dim_date": ["Year"]}, "Year", "fact_inv", "year(InvoiceDate)"),
    SAV: ({"dim_business_unit": ["BusinessUnitName"]}, "BusinessUnitName", "fact_sav JOIN c_bu USING (BusinessUnitID)", "BusinessUnitName"),
    PERF: ({}, "PerformanceYear", "fact_perf", "PerformanceYear"),
    PRICE: ({"dim_category": ["CategoryName"]}, "CategoryName", "(SELECT * FROM ml_price WHERE PredictionDate = DATE '2001-07-31') JOIN c_category USING (CategoryID)", "CategoryName"),
    OPP: ({"dim_category": ["CategoryName"]}, "CategoryName", "(SELECT * FROM ml_opp WHERE PredictionDate = DATE '2001-07-31') JOIN c_category USING (CategoryID)", "CategoryName"),
    RISK: ({"dim_supplier_current": ["Region"]}, "Region", "(SELECT * FROM ml_risk WHERE PredictionDate = DATE '2001-07-31') LEFT JOIN (SELECT SupplierID, Region FROM dim_supplier WHERE IsCurrentFlag) USING (SupplierID)", "Region"),
}


def frame_of(m, fact: str) -> DataFrame:
    """The fact with its default grouping; predictions are cut to the latest snapshot first."""
    m = m.narrow
    base = latest_snapshot(m[fact]) if fact.startswith("ml_") else m[fact]
    return star(m, fact, _GROUP[fact][0], frame=base)


def _slug(name: str) -> str:
    return "_".join("".join(ch if ch.isalnum() else " " for ch in name.replace("%", " pct")).lower().split())


def _register(x: Measure) -> None:
    _, by, source, group = _GROUP[x.fact]
    if x.number in (27, 28):        # realised savings follow the actual-completion date
        sql = f"SELECT year(ActualCompletionDate) AS Year, {x.sql} AS Value FROM fact_sav GROUP BY 1"
        plan = lambda m: measure(star(m, SAV, {"dim_date": ["Year"]}, role="ActualCompletionDateKey"), [x.name], ["Year"])
        by = "Year"
    else:
        sql = f"SELECT {group} AS {by}, {x.sql} AS Value FROM {source} GROUP BY 1"
        plan = lambda m: measure(frame_of(m, x.fact), [x.name], [by])
    kind = "int" if by in ("Year", "PerformanceYear") else "string"
    query(f"M{x.number:02d}_{_slug(x.name)}", f"{by}:{kind} Value:{x.kind}", sql)(lambda m: plan(m).withColumnRenamed(x.name, "Value"))


for _measure in MEASURES:
    _register(_measure)


# ---------------------------------------------------------------------- spend of flagged keys

def spend_of_anomalies(m) -> DataFrame:
    flagged = latest_snapshot(m[PRICE]).where("PricingAnomalyFlag = 1").select("POItemID")
    return treat_as(m.narrow[PO], flagged, "POItemID")


def spend_of_high_risk(m) -> DataFrame:
    flagged = latest_snapshot(m[RISK]).where("PredictedHighRiskFlag = 1").select("SupplierID")
    return treat_as(m.narrow[PO], flagged, "SupplierID")


_ANOMALY_ITEMS = "SELECT POItemID FROM ml_price WHERE PredictionDate = DATE '2001-07-31' AND PricingAnomalyFlag = 1"
_RISKY = "SELECT SupplierID FROM ml_risk WHERE PredictionDate = DATE '2001-07-31' AND PredictedHighRiskFlag = 1"


def _flagged_spend(number: int, name: str, frame, test: str) -> None:
    amount = f"CAST(coalesce(sum(elig_c) FILTER ({test}), 0) AS DOUBLE) / 100.0"

    def both(m):
        year = F.year("OrderDate").alias("Year")
        part = frame(m).groupBy(year).agg(F.sum(E_).alias("part"))
        whole = m.narrow[PO].groupBy(year).agg(F.sum(E_).alias("whole"))
        return whole.join(part, "Year", "left").withColumn("part", F.coalesce("part", F.lit(0)))
    query(f"M{number}_{_slug(name)}", "Year:int Value:double", f"SELECT year(OrderDate) AS Year, {amount} AS Value FROM fact_po GROUP BY 1")(
        lambda m: both(m).withColumn("Value", F.col("part")))
    query(f"M{number + 1}_{_slug(name + ' %')}", "Year:int Value:double", f"SELECT year(OrderDate) AS Year, {_div(amount, _S['e'])} AS Value FROM fact_po GROUP BY 1")(
        lambda m: both(m).withColumn("Value", ratio("part", "whole")))


_flagged_spend(53, "Eligible Spend with Pricing Anomalies", spend_of_anomalies, f"POItemID IN ({_ANOMALY_ITEMS})")
_flagged_spend(70, "Spend with High-Risk Suppliers", spend_of_high_risk, f"POSupplierID IN ({_RISKY})")


# ---------------------------------------------------------------------- relationship model

@query("P98_star", "Year:int CategoryName:string Region:string spend:double", """
    SELECT year(OrderDate) AS Year, CategoryName, d.Region, sum(elig_c) / 100.0 AS spend FROM fact_po p JOIN c_category USING (CategoryID)
    LEFT JOIN dim_supplier d ON d.SupplierID = p.POSupplierID AND p.OrderDate BETWEEN d.EffectiveFromDate AND d.EffectiveToDate GROUP BY 1, 2, 3""")
def _(m):
    return star(m, PO, {"dim_date": ["Year"], "dim_category": ["CategoryName"], "dim_supplier": ["Region"]}).groupBy("Year", "CategoryName", "Region").agg(F.sum(E_).alias("spend"))


@query("P99_date_role", "YearMonth:string realized:double", "SELECT strftime(ActualCompletionDate, '%Y-%m') AS YearMonth, sum(real_eur) / 100.0 AS realized FROM fact_sav GROUP BY 1")
def _(m):
    return star(m, SAV, {"dim_date": ["YearMonth"]}, role="ActualCompletionDateKey").groupBy("YearMonth").agg(F.sum("RealizedSavingsEUR").alias("realized"))


@query("P100_latest_snapshot", "PredictionDate:string n:long mean:double", "SELECT PredictionDate, count(*) AS n, round(avg(SupplierRiskScore), 8) AS mean FROM ml_risk WHERE PredictionDate = (SELECT max(PredictionDate) FROM ml_risk) GROUP BY 1")
def _(m):
    return latest_snapshot(m[RISK]).groupBy("PredictionDate").agg(F.count("*").alias("n"), F.round(F.avg("SupplierRiskScore"), 8).alias("mean"))
