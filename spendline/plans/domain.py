"""Queries for the domain operators and the KPI tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendline.functions.exprs import count_where, pct
from spendline.operators import aggregates as A
from spendline.operators import contract as K
from spendline.operators import dims as D
from spendline.operators import facts as FA
from spendline.operators import features as FE
from spendline.operators import joins as J
from spendline.operators import matching as MA
from spendline.operators import opportunity as OP
from spendline.operators import savings as SA
from spendline.operators import scorecard as SC
from spendline.operators import spend as SP
from spendline.operators import windows as W
from spendline.operators.conform import conform, master_specs
from spendline.operators.fx import fx_resolve
from spendline.plans import mart as MT
from spendline.plans.registry import query

SCORE_SQL = """SELECT *, elig_c / 100.0 AS EligibleSpendEUR, comp_c / 100.0 AS ContractCompliantSpendEUR, mav_c / 100.0 AS MaverickSpendEUR,
    gross_c / 100.0 AS GrossInvoiceAmountEUR, exc_c / 100.0 AS InvoiceExceptionAmountEUR FROM score"""


# ---------------------------------------------------------------------- masters, rates, contracts

@query("O01_conform_supplier", "SupplierID:string SupplierName:string SupplierType:string Country:string Region:string ESGRating:string "
       "FinancialRiskScore:int CreatedDate:string Status:string SupplierActiveFlag:boolean PreferredSupplier:boolean", "SELECT * FROM c_supplier")
def _(m):
    return conform(m["bronze_supplier"], master_specs()["supplier"])


@query("O01_conform_masters", "TableName:string ID:string Label:string", """
    SELECT 'category' AS TableName, CategoryID AS ID, ProcurementType AS Label FROM c_category
    UNION ALL SELECT 'business_unit', BusinessUnitID, BusinessUnitName FROM c_bu UNION ALL SELECT 'buyer', BuyerID, BuyerRole FROM c_buyer
    UNION ALL SELECT 'material', MaterialID, Status FROM c_material""")
def _(m):
    labels = {"category": ("CategoryID", "ProcurementType"), "business_unit": ("BusinessUnitID", "BusinessUnitName"),
              "buyer": ("BuyerID", "BuyerRole"), "material": ("MaterialID", "Status")}
    return A.union_versions([conform(m[f"bronze_{t}"], master_specs()[t]).select(F.lit(t).alias("TableName"), F.col(i).alias("ID"), F.col(c).alias("Label"))
                             for t, (i, c) in labels.items()])


@query("O02_conform_rates", "RateDate:string Currency:string ExchangeRateToEUR:double RateYear:int RateMonth:int RateYearMonth:string IsEUR:boolean", """
    SELECT d AS RateDate, ccy AS Currency, ru / 1000000.0 AS ExchangeRateToEUR, year(d) AS RateYear, month(d) AS RateMonth,
      strftime(d, '%Y-%m') AS RateYearMonth, ccy = 'EUR' AS IsEUR FROM fx""")
def _(m):
    return conform(m["bronze_exchange_rate"], master_specs()["exchange_rate"])


@query("O03_fx_resolve", "POItemID:string POFXResolutionMethod:string POExchangeRateToEUR:double POFXRateDate:string "
       "ContractAtPOFXResolutionMethod:string ContractAtPOExchangeRateToEUR:double", """
    SELECT POItemID, po_method AS POFXResolutionMethod, po_ru / 1000000.0 AS POExchangeRateToEUR, po_rd AS POFXRateDate,
      co_method AS ContractAtPOFXResolutionMethod, co_ru / 1000000.0 AS ContractAtPOExchangeRateToEUR FROM po_valid""")
def _(m):
    df = m["silver_po_spend"].select("POItemID", "OrderDate", "POCurrency", "ContractCurrency")
    out = fx_resolve(df, "OrderDate", "POCurrency", "PO", m["silver_exchange_rate"], null_label="NOT_APPLICABLE")
    return fx_resolve(out, "OrderDate", "ContractCurrency", "ContractAtPO", m["silver_exchange_rate"], null_label="NOT_APPLICABLE")


@query("O04_to_eur", "POYear:int amount:double price:double", """
    SELECT POYear, sum(amt_eur) / 100.0 AS amount, sum(pu_eur) / 10000.0 AS price FROM po GROUP BY 1""")
def _(m):
    from spendline.functions.exprs import to_eur
    df = m["silver_po_spend"].select("POYear", to_eur("LineAmount", "POExchangeRateToEUR").alias("a"), to_eur("UnitPrice", "POExchangeRateToEUR", 4).alias("p"))
    return df.groupBy("POYear").agg(F.sum("a").alias("amount"), F.sum("p").alias("price"))


@query("O05_lifecycle", "ContractID:string ContractLifecycleStatus:string IsContractActiveAsOfDate:boolean ContractDurationDays:int "
       "DaysToExpiryAsOfDate:int ContractStatusConsistencyFlag:boolean", """
    SELECT *, SourceContractStatus = ContractLifecycleStatus AS ContractStatusConsistencyFlag FROM contract""")
def _(m):
    return K.lifecycle(K.conform_contract(m["bronze_contract"]), MT.AS_OF)


@query("O06_enrich_contract", "ContractID:string ContractOwnerName:string ContractOwnerRole:string SupplierName:string SupplierActiveFlag:boolean "
       "CategoryName:string ProcurementType:string ContractType:string", """
    SELECT c.ContractID, BuyerName AS ContractOwnerName, BuyerRole AS ContractOwnerRole, SupplierName, SupplierActiveFlag, CategoryName, ProcurementType, ContractType
    FROM c_contract c LEFT JOIN c_buyer b ON b.BuyerID = c.ContractOwnerBuyerID LEFT JOIN c_supplier s ON s.SupplierID = c.SupplierID
    LEFT JOIN c_category g ON g.CategoryID = c.CategoryID""")
def _(m):
    return K.enrich_contract(K.conform_contract(m["bronze_contract"]), *m.silver("buyer", "supplier", "category"))


@query("O06_contract_values", "ContractID:string ContractFXResolutionMethod:string ContractValueEUR:double NegotiatedUnitPriceEUR:double", """
    SELECT ContractID, CASE ct_method WHEN 'EXACT_DATE' THEN 'EXACT_CONTRACT_START_DATE' ELSE ct_method END AS ContractFXResolutionMethod,
      CAST((CAST(value_c AS HUGEINT) * ct_ru + 500000) // 1000000 AS BIGINT) / 100.0 AS ContractValueEUR,
      CAST((CAST(price_u AS HUGEINT) * ct_ru + 500000) // 1000000 AS BIGINT) / 10000.0 AS NegotiatedUnitPriceEUR FROM contract""")
def _(m):
    return K.contract_values(K.conform_contract(m["bronze_contract"]), m["silver_exchange_rate"])


# ---------------------------------------------------------------------- spend

@query("O07_po_spend_base", "POItemID:string POSupplierID:string SupplierName:string BuyerRole:string MaterialDescription:string CategoryName:string "
       "BusinessUnitResolvedFlag:boolean Quantity:double UnitPrice:double LineAmount:double", """
    SELECT POItemID, POSupplierID, SupplierName, BuyerRole, MaterialDescription, CategoryName, u.BusinessUnitID IS NOT NULL AS BusinessUnitResolvedFlag,
      q AS Quantity, pu / 10000.0 AS UnitPrice, amt / 100.0 AS LineAmount
    FROM po_items p LEFT JOIN c_supplier s ON s.SupplierID = POSupplierID LEFT JOIN c_buyer b ON b.BuyerID = p.BuyerID
    LEFT JOIN c_material t ON t.MaterialID = p.MaterialID LEFT JOIN c_category g ON g.CategoryID = p.CategoryID LEFT JOIN c_bu u ON u.BusinessUnitID = p.BusinessUnitID""")
def _(m):
    return SP.po_spend_base(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"],
                            *m.silver("supplier", "buyer", "material", "category", "business_unit"))


@query("O08_eligible", "POStatus:string POItemStatus:string SpendEligibilityFlag:boolean n:long", """
    SELECT POStatus, POItemStatus, SpendEligibilityFlag, count(*) AS n FROM po GROUP BY 1, 2, 3""")
def _(m):
    out = SP.eligible(SP.po_lines(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"]))
    return out.groupBy("POStatus", "POItemStatus", "SpendEligibilityFlag").agg(F.count("*").alias("n"))


@query("O09_contract_validity", "POItemID:string ContractValidityStatusAtPO:string ValidContractAtPOFlag:boolean", """
    SELECT POItemID, ContractValidityStatusAtPO, ValidContractAtPOFlag FROM po_valid""")
def _(m):
    lines = SP.po_lines(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"])
    return K.contract_validity(lines, m["silver_contract"])


@query("O10_spend_compliance", "POItemID:string SpendComplianceStatus:string ContractComplianceFlag:boolean MaverickSpendFlag:boolean", """
    SELECT POItemID, SpendComplianceStatus, ContractComplianceFlag, MaverickSpendFlag FROM po_priced""")
def _(m):
    lines = SP.eligible(SP.po_lines(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"]))
    return SP.spend_compliance(K.contract_validity(lines, m["silver_contract"]))


@query("O11_contract_price_variance", "POItemID:string ContractPriceComparisonEligibleFlag:boolean ContractPriceVarianceEUR:double "
       "ContractPriceVariancePercentage:double ContractPriceWithinToleranceFlag:boolean", """
    SELECT POItemID, ContractPriceComparisonEligibleFlag, CASE WHEN ContractPriceComparisonEligibleFlag THEN (pu_eur - cp_eur) / 10000.0 END AS ContractPriceVarianceEUR,
      ContractPriceVariancePercentage, abs(ContractPriceVariancePercentage) <= 3.0 AS ContractPriceWithinToleranceFlag FROM po""")
def _(m):
    lines = SP.eligible(SP.po_lines(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"]))
    return SP.contract_price_variance(K.contract_validity(lines, m["silver_contract"]), m["silver_exchange_rate"])


@query("O12_split_spend", "POItemID:string EligibleSpendEUR:double ContractCompliantSpendEUR:double MaverickSpendEUR:double POYear:int POYearMonth:string POQuarter:string", """
    SELECT POItemID, elig_c / 100.0 AS EligibleSpendEUR, comp_c / 100.0 AS ContractCompliantSpendEUR, mav_c / 100.0 AS MaverickSpendEUR, POYear,
      strftime(OrderDate, '%Y-%m') AS POYearMonth, 'Q' || quarter(OrderDate) AS POQuarter FROM po""")
def _(m):
    lines = SP.po_lines(m["bronze_purchase_order_header"], m["bronze_purchase_order_item"])
    return SP.classify_spend(lines, m["silver_contract"], m["silver_exchange_rate"])


# ---------------------------------------------------------------------- invoices

@query("O13_invoice_base", "InvoiceItemID:string POReferenceResolvedFlag:boolean InvoicePOSupplierMatchFlag:boolean InvoicePOBusinessUnitMatchFlag:boolean", """
    SELECT *, CASE WHEN POReferenceResolvedFlag THEN InvoiceBusinessUnitID = POBusinessUnitID ELSE FALSE END AS InvoicePOBusinessUnitMatchFlag FROM inv_base""")
def _(m):
    return MA.invoice_base(m["bronze_invoice_header"], m["bronze_invoice_item"], m.narrow["silver_po_spend"])


@query("O14_received_asof", "Receipts:long Invoices:long Received:double", """
    SELECT receipt_count AS Receipts, count(*) AS Invoices, sum(received_m) / 1000.0 AS Received FROM inv_received GROUP BY 1""")
def _(m):
    inv = m["bronze_invoice_item"].join(m["bronze_invoice_header"].select("InvoiceID", "InvoiceDate"), "InvoiceID").select("POItemID", "InvoiceDate")
    return MA.received_asof(inv, m["bronze_goods_receipt"]).groupBy(F.col("GoodsReceiptCountAtInvoiceDate").alias("Receipts")).agg(
        F.count("*").alias("Invoices"), F.sum("CalculatedReceivedQuantityAtInvoiceDate").alias("Received"))


@query("O15_invoice_variances", "InvoiceItemID:string CalculatedPriceVarianceAmount:double CalculatedPriceVariancePercentage:double InvoicePriceWithinToleranceFlag:boolean "
       "CalculatedQuantityVariance:double CalculatedQuantityVariancePercentage:double InvoiceQuantityWithinToleranceFlag:boolean", """
    SELECT InvoiceItemID, (ipu - po_pu) / 10000.0 AS CalculatedPriceVarianceAmount, price_pct AS CalculatedPriceVariancePercentage,
      abs(price_pct) <= 3 AS InvoicePriceWithinToleranceFlag, (iq - received_m) / 1000.0 AS CalculatedQuantityVariance, qty_pct AS CalculatedQuantityVariancePercentage,
      abs(qty_pct) <= 2 AS InvoiceQuantityWithinToleranceFlag FROM inv_base""")
def _(m):
    return MA.invoice_variances(m.narrow["silver_invoice_matching"])


@query("O16_duplicate_flag", "DerivedDuplicateInvoiceFlag:boolean n:long", "SELECT DerivedDuplicateInvoiceFlag, count(*) AS n FROM inv_base GROUP BY 1")
def _(m):
    return MA.duplicate_flag(m["silver_invoice_matching"]).groupBy("DerivedDuplicateInvoiceFlag").agg(F.count("*").alias("n"))


@query("O17_three_way_match", "InvoiceItemID:string DerivedThreeWayMatchStatus:string ThreeWayMatchFlag:boolean InvoiceExceptionAmountEUR:double GrossAmountEUR:double", """
    SELECT InvoiceItemID, DerivedThreeWayMatchStatus, ThreeWayMatchFlag, exc_eur / 100.0 AS InvoiceExceptionAmountEUR, gross_eur / 100.0 AS GrossAmountEUR FROM inv""")
def _(m):
    base = MA.received_asof(MA.invoice_base(m["bronze_invoice_header"], m["bronze_invoice_item"], m.narrow["silver_po_spend"]), m["bronze_goods_receipt"])
    return MA.invoice_amounts(MA.three_way_match(MA.duplicate_flag(MA.invoice_variances(base))), m["silver_exchange_rate"])


# ---------------------------------------------------------------------- supplier performance

@query("O18_spend_by_supplier_year", "SupplierID:string PerformanceYear:int POCount:long POItemCount:long EligibleSpendEUR:double", """
    SELECT *, elig_c / 100.0 AS EligibleSpendEUR FROM sy_spend""")
def _(m):
    return SC.spend_by_supplier_year(m["silver_po_spend"])


@query("O19_delivery", "POItemID:string ReceivedPOItemFlag:boolean CalculatedDeliveryCompleteFlag:boolean OnTimeDeliveryFlag:boolean LateDeliveryFlag:boolean "
       "OverdueOpenDeliveryFlag:boolean DaysLate:int", """
    SELECT POItemID, n > 0 AS ReceivedPOItemFlag, done AS CalculatedDeliveryCompleteFlag, coalesce(on_time, FALSE) AS OnTimeDeliveryFlag,
      coalesce(late, FALSE) AS LateDeliveryFlag, NOT done AS OverdueOpenDeliveryFlag, DaysLate FROM deliv""")
def _(m):
    return SC.delivery(m["silver_po_spend"], m["bronze_goods_receipt"], MT.AS_OF)


@query("O20_delivery_by_supplier_year", "SupplierID:string PerformanceYear:int DuePOItemCount:long DeliveryCompletePOItemCount:long OnTimeDeliveryPOItemCount:long "
       "LateDeliveryPOItemCount:long OverdueOpenPOItemCount:long AverageDaysLate:double MaximumDaysLate:int", "SELECT * FROM sy_deliv")
def _(m):
    return SC.delivery_by_supplier_year(SC.delivery(m["silver_po_spend"], m["bronze_goods_receipt"], MT.AS_OF))


@query("O21_invoice_by_supplier_year", "SupplierID:string PerformanceYear:int InvoiceItemCount:long MatchedInvoiceItemCount:long GrossInvoiceAmountEUR:double "
       "InvoiceCount:long DisputedInvoiceCount:long DuplicateInvoiceCount:long DisputeFreeInvoiceCount:long", """
    SELECT i.SupplierID, i.PerformanceYear, InvoiceItemCount, MatchedInvoiceItemCount, gross_c / 100.0 AS GrossInvoiceAmountEUR, InvoiceCount, DisputedInvoiceCount,
      DuplicateInvoiceCount, InvoiceCount - DisputedInvoiceCount AS DisputeFreeInvoiceCount
    FROM sy_items i JOIN sy_docs d ON i.SupplierID = d.SupplierID AND i.PerformanceYear = d.PerformanceYear""")
def _(m):
    inv = m.narrow["silver_invoice_matching"]
    return SC.invoice_items_by_supplier_year(inv).join(SC.invoices_by_supplier_year(inv), SC.KEYS)


@query("O22_scorecard", "SupplierID:string PerformanceYear:int POCount:long DuePOItemCount:long InvoiceCount:long EligibleSpendEUR:double GrossInvoiceAmountEUR:double "
       "ContractCompliancePct:double MaverickSpendPct:double SupplierOnTimeDeliveryPct:double OverdueOpenDeliveryPct:double SupplierQualityIndexPct:double "
       "InvoiceDisputePct:double DuplicateInvoicePct:double ThreeWayMatchPct:double InvoiceExceptionPct:double InvoiceExceptionAmountPct:double AverageDaysLate:double",
       SCORE_SQL)
def _(m):
    return SC.stamped_scorecard(*m.scorecard_parts(), m.narrow["silver_supplier"])


ANNUAL_SQL = """
    SELECT *, CASE WHEN e > 0 THEN round((c / 100.0::DOUBLE) * 100.0 / (e / 100.0::DOUBLE), 2) END AS ContractCompliancePct,
      CASE WHEN e > 0 THEN round((v / 100.0::DOUBLE) * 100.0 / (e / 100.0::DOUBLE), 2) END AS MaverickSpendPct,
      round(ot * 100.0::DOUBLE / nullif(dc, 0), 2) AS SupplierOnTimeDeliveryPct, round((ic - bad) * 100.0::DOUBLE / nullif(ic, 0), 2) AS SupplierQualityIndexPct,
      round(mi * 100.0::DOUBLE / nullif(ii, 0), 2) AS ThreeWayMatchPct, e / 100.0 AS EligibleSpendEUR
    FROM (SELECT PerformanceYear, count(DISTINCT SupplierID) AS SupplierCount, sum(elig_c) AS e, sum(comp_c) AS c, sum(mav_c) AS v, sum(DeliveryCompletePOItemCount) AS dc,
        sum(OnTimeDeliveryPOItemCount) AS ot, sum(InvoiceCount) AS ic, sum(DisputedInvoiceCount) AS bad, sum(InvoiceItemCount) AS ii, sum(MatchedInvoiceItemCount) AS mi
      FROM score GROUP BY 1)"""
ANNUAL_COLUMNS = ("PerformanceYear:int SupplierCount:long EligibleSpendEUR:double ContractCompliancePct:double MaverickSpendPct:double "
                  "SupplierOnTimeDeliveryPct:double SupplierQualityIndexPct:double ThreeWayMatchPct:double")


@query("O23_scorecard_by_year", ANNUAL_COLUMNS, ANNUAL_SQL)
def _(m):
    return SC.scorecard_by_year(m["silver_supplier_performance"])


# ---------------------------------------------------------------------- savings

@query("O24_conform_savings", "SavingsProjectID:string SavingsProjectName:string SupplierID:string ContractID:string ProjectStatus:string SavingsType:string "
       "ApprovalStatus:string ActivePipelineFlag:boolean OverdueProjectFlag:boolean PlannedDurationDays:int ActualDurationDays:int DaysPastPlannedCompletion:int "
       "ContractSupplierMatchFlag:boolean ContractCategoryMatchFlag:boolean", """
    SELECT s.*, s.ProjectStatus IN ('Idea', 'Validated', 'Negotiation') AS ActivePipelineFlag,
      s.ProjectStatus IN ('Idea', 'Validated', 'Negotiation') AND PlannedCompletionDate < DATE '2001-07-31' AS OverdueProjectFlag,
      PlannedCompletionDate - PlannedStartDate + 1 AS PlannedDurationDays, ActualCompletionDate - PlannedStartDate + 1 AS ActualDurationDays,
      CASE WHEN s.ProjectStatus IN ('Idea', 'Validated', 'Negotiation') AND PlannedCompletionDate < DATE '2001-07-31'
        THEN DATE '2001-07-31' - PlannedCompletionDate END AS DaysPastPlannedCompletion,
      s.SupplierID = c.SupplierID AS ContractSupplierMatchFlag, s.CategoryID = c.CategoryID AS ContractCategoryMatchFlag
    FROM savings s LEFT JOIN c_contract c ON s.ContractID = c.ContractID""")
def _(m):
    return SA.conform_savings(m["bronze_savings_project"], *m.silver("supplier", "category", "buyer", "business_unit", "contract"), MT.AS_OF)


@query("O25_savings_amounts", "SavingsProjectID:string SavingsConfidenceWeight:double WeightedForecastSavings:double BaselineSpendEUR:double ForecastedSavingsEUR:double "
       "ApprovedSavingsEUR:double RealizedSavingsEUR:double WeightedForecastSavingsEUR:double ForecastSavingsPctOfBaseline:double SavingsAchievementPct:double "
       "SavingsAchievementVarianceEUR:double ActivePipelineForecastEUR:double ImplementedSavingsEUR:double", """
    SELECT SavingsProjectID, w100 / 100.0 AS SavingsConfidenceWeight, wf_c / 100.0 AS WeightedForecastSavings, base_eur / 100.0 AS BaselineSpendEUR,
      fore_eur / 100.0 AS ForecastedSavingsEUR, appr_eur / 100.0 AS ApprovedSavingsEUR, real_eur / 100.0 AS RealizedSavingsEUR, wf_eur / 100.0 AS WeightedForecastSavingsEUR,
      CASE WHEN base_eur > 0 THEN round((fore_eur / 100.0::DOUBLE) * 100.0 / (base_eur / 100.0::DOUBLE), 2) END AS ForecastSavingsPctOfBaseline,
      CASE WHEN appr_eur > 0 THEN round((real_eur / 100.0::DOUBLE) * 100.0 / (appr_eur / 100.0::DOUBLE), 2) END AS SavingsAchievementPct,
      (real_eur - appr_eur) / 100.0 AS SavingsAchievementVarianceEUR, CASE WHEN k % 5 < 3 THEN fore_eur ELSE 0 END / 100.0 AS ActivePipelineForecastEUR,
      CASE WHEN k % 5 = 3 THEN real_eur ELSE 0 END / 100.0 AS ImplementedSavingsEUR FROM savings""")
def _(m):
    base = SA.conform_savings(m["bronze_savings_project"], *m.silver("supplier", "category", "buyer", "business_unit", "contract"), MT.AS_OF)
    return SA.savings_amounts(base, m["silver_exchange_rate"])


# ---------------------------------------------------------------------- dimensions and facts

@query("O26_dim_date", "Date:string DateKey:int ISOWeekdayNumber:int DayName:string WeekOfYear:int MonthName:string MonthShortName:string YearMonth:string "
       "YearMonthSort:int Quarter:string YearQuarter:string Year:int DayOfYear:int IsWeekendFlag:boolean MonthStartDate:string YearStartDate:string", """
    SELECT d AS Date, CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, isodow(d) AS ISOWeekdayNumber, dayname(d) AS DayName, week(d) AS WeekOfYear,
      monthname(d) AS MonthName, strftime(d, '%b') AS MonthShortName, strftime(d, '%Y-%m') AS YearMonth, year(d) * 100 + month(d) AS YearMonthSort,
      'Q' || quarter(d) AS Quarter, year(d) || '-Q' || quarter(d) AS YearQuarter, year(d) AS Year, dayofyear(d) AS DayOfYear, isodow(d) >= 6 AS IsWeekendFlag,
      CAST(date_trunc('month', d) AS DATE) AS MonthStartDate, CAST(date_trunc('year', d) AS DATE) AS YearStartDate FROM cal""")
def _(m):
    return m.build("dim_date")


@query("O27_scd2_supplier", "SupplierID:string SupplierName:string FinancialRiskScore:int DimensionVersion:int EffectiveFromDate:string EffectiveToDate:string IsCurrentFlag:boolean",
       "SELECT * FROM dim_supplier")
def _(m):
    return m.build("dim_supplier")


@query("O28_dim_type1", "Entity:string n:long keys:long", """
    SELECT 'Category' AS Entity, count(*) AS n, count(DISTINCT CategoryID) AS keys FROM c_category UNION ALL SELECT 'Material', count(*), count(DISTINCT MaterialID) FROM c_material
    UNION ALL SELECT 'Buyer', count(*), count(DISTINCT BuyerID) FROM c_buyer UNION ALL SELECT 'BusinessUnit', count(*), count(DISTINCT BusinessUnitID) FROM c_bu
    UNION ALL SELECT 'Contract', count(*), count(DISTINCT ContractID) FROM c_contract""")
def _(m):
    return A.union_versions([D.dim_type1(m[MT.ENTITY_SOURCE[e]], e).agg(F.count("*").alias("n"), F.countDistinct(f"{e}Key").alias("keys"))
                             .select(F.lit(e).alias("Entity"), "n", "keys") for e in MT.ENTITY_SOURCE])


@query("O28_dim_currency", "CurrencyCode:string FirstAvailableRateDate:string LastAvailableRateDate:string AvailableRateDateCount:long IsBaseCurrencyFlag:boolean", """
    SELECT ccy AS CurrencyCode, lo AS FirstAvailableRateDate, hi AS LastAvailableRateDate, days AS AvailableRateDateCount, ccy = 'EUR' AS IsBaseCurrencyFlag FROM fx_ends""")
def _(m):
    return D.dim_currency(m["silver_exchange_rate"])


@query("O29a_po_fact", "POItemID:string OrderDateKey:int RequestedDeliveryDateKey:int SupplierDimensionVersion:int ContractResolved:boolean EligibleSpendEUR:double "
       "PriceComplianceExceptionFlag:boolean HasContractReferenceFlag:boolean", """
    SELECT POItemID, CAST(strftime(OrderDate, '%Y%m%d') AS INT) AS OrderDateKey, CAST(strftime(RequestedDeliveryDate, '%Y%m%d') AS INT) AS RequestedDeliveryDateKey,
      SupplierDimensionVersion, contract_ok AS ContractResolved, elig_c / 100.0 AS EligibleSpendEUR, PriceComplianceExceptionFlag, ContractID IS NOT NULL AS HasContractReferenceFlag FROM fact_po""")
def _(m):
    return FA.build_po_fact(m["silver_po_spend"], m.dims()).withColumn("ContractResolved", F.col("ContractKey").isNotNull())


@query("O29b_invoice_fact", "InvoiceItemID:string InvoiceDateKey:int DueDateKey:int SupplierDimensionVersion:int PurchaseOrderFactResolvedFlag:boolean "
       "MatchedInvoiceAmountEUR:double DisputedInvoiceItemFlag:boolean DuplicateInvoiceItemFlag:boolean", """
    SELECT InvoiceItemID, CAST(strftime(InvoiceDate, '%Y%m%d') AS INT) AS InvoiceDateKey, CAST(strftime(DueDate, '%Y%m%d') AS INT) AS DueDateKey, SupplierDimensionVersion,
      POReferenceResolvedFlag AS PurchaseOrderFactResolvedFlag, CASE WHEN ThreeWayMatchFlag THEN gross_eur ELSE 0 END / 100.0 AS MatchedInvoiceAmountEUR,
      DisputeFlag AS DisputedInvoiceItemFlag, DerivedDuplicateInvoiceFlag AS DuplicateInvoiceItemFlag FROM fact_inv""")
def _(m):
    return FA.build_invoice_fact(m["silver_invoice_matching"], m["fact_purchase_order"], m.dims())


@query("O29c_savings_fact", "SavingsProjectID:string ProjectCreatedDateKey:int ActualCompletionDateKey:int CancellationDateKey:int SupplierDimensionVersion:int "
       "ContractResolved:boolean ProjectCount:long ActivePipelineProjectCount:long ImplementedProjectCount:long", """
    SELECT SavingsProjectID, CAST(strftime(ProjectCreatedDate, '%Y%m%d') AS INT) AS ProjectCreatedDateKey, CAST(strftime(ActualCompletionDate, '%Y%m%d') AS INT) AS ActualCompletionDateKey,
      CAST(strftime(CancellationDate, '%Y%m%d') AS INT) AS CancellationDateKey, SupplierDimensionVersion, contract_ok AS ContractResolved, 1 AS ProjectCount,
      CAST(ActivePipelineFlag AS BIGINT) AS ActivePipelineProjectCount, CAST(ProjectStatus = 'Implemented' AS BIGINT) AS ImplementedProjectCount FROM fact_sav""")
def _(m):
    return FA.build_savings_fact(m["silver_savings_project"], m.dims()).withColumn("ContractResolved", F.col("ContractKey").isNotNull())


@query("O29d_performance_fact", "SupplierID:string PerformanceYear:int PerformancePeriodStartDateKey:int PerformancePeriodEndDate:string SupplierDimensionVersion:int "
       "FullyReceivedPOItemCount:long DisputeFreeInvoiceCount:long SupplierWithSpendCount:long SupplierWithInvoiceActivityCount:long", """
    SELECT SupplierID, PerformanceYear, PerformanceYear * 10000 + 101 AS PerformancePeriodStartDateKey, PeriodEnd AS PerformancePeriodEndDate, SupplierDimensionVersion,
      DeliveryCompletePOItemCount AS FullyReceivedPOItemCount, DisputeFreeInvoiceCount, CAST(elig_c > 0 AS BIGINT) AS SupplierWithSpendCount,
      CAST(InvoiceCount > 0 AS BIGINT) AS SupplierWithInvoiceActivityCount FROM fact_perf""")
def _(m):
    return FA.build_performance_fact(m["silver_supplier_performance"], m.dims(), MT.AS_OF)


# ---------------------------------------------------------------------- features

@query("O30_risk_features", "SupplierID:string PerformanceYear:int spend:double yoy:double otd_change:double dispute:double late:double exposure:double volatility:double share:double", """
    SELECT SupplierID, PerformanceYear, round(spend, 4) AS spend, round(YoYSpendChangePct, 6) AS yoy, round(YoYOTDChangePp, 6) AS otd_change, round(InvoiceDisputePct, 8) AS dispute,
      round(LateFullyReceivedPct, 8) AS late, round(OverdueOpenDeliveryExposurePct, 8) AS exposure, round(SpendVolatilityPct, 6) AS volatility, round(SupplierSpendSharePct, 6) AS share
    FROM risk WHERE SupplierID IS NOT NULL""")
def _(m):
    f = FE.risk_features(m["fact_supplier_performance"], m["dim_supplier"], MT.SCORING_YEAR).where(F.col("SupplierID").isNotNull())
    r = lambda c, n, d: F.round(c, d).alias(n)
    return f.select("SupplierID", "PerformanceYear", r("AnnualizedEligibleSpendEUR", "spend", 4), r("YoYSpendChangePct", "yoy", 6), r("YoYOTDChangePp", "otd_change", 6),
                    r("InvoiceDisputePct", "dispute", 8), r("LateFullyReceivedPct", "late", 8), r("OverdueOpenDeliveryExposurePct", "exposure", 8),
                    r("SpendVolatilityPct", "volatility", 6), r("SupplierSpendSharePct", "share", 6))


@query("O31_risk_label", "SupplierID:string PerformanceYear:int FutureRiskObservedMetricCount:int FutureRiskEventCount:int HighRiskNextYearFlag:int", """
    SELECT SupplierID, PerformanceYear, observed AS FutureRiskObservedMetricCount, events AS FutureRiskEventCount, HighRiskNextYearFlag FROM risk_labels""")
def _(m):
    candidates = m["risk_candidates"]
    return FE.risk_label(candidates, FE.label_thresholds(candidates))


@query("O32_price_features", "POItemID:string MaterialHistoryCount:long SupplierMaterialHistoryCount:long CategoryHistoryCount:long vs_material:double vs_category:double "
       "z_material:double z_category:double BenchmarkCoverageCount:int RuleBasedExtremePriceFlag:int", """
    SELECT POItemID, MaterialHistoryCount, SupplierMaterialHistoryCount, CategoryHistoryCount, round(PriceVsMaterialHistoricalAvgPct, 4) AS vs_material,
      round(PriceVsCategoryHistoricalAvgPct, 4) AS vs_category, round(MaterialPriceZScore, 4) AS z_material, round(CategoryPriceZScore, 4) AS z_category,
      BenchmarkCoverageCount, RuleBasedExtremePriceFlag FROM price_feat""")
def _(m):
    f = FE.price_features(m.narrow["fact_purchase_order"], MT.AS_OF, m["pricing_base"])
    r = lambda c, n: F.round(c, 4).alias(n)
    return f.select("POItemID", "MaterialHistoryCount", "SupplierMaterialHistoryCount", "CategoryHistoryCount", r("PriceVsMaterialHistoricalAvgPct", "vs_material"),
                    r("PriceVsCategoryHistoricalAvgPct", "vs_category"), r("MaterialPriceZScore", "z_material"), r("CategoryPriceZScore", "z_category"),
                    "BenchmarkCoverageCount", "RuleBasedExtremePriceFlag")


@query("O33_split_by_year", "Part:string n:long", """
    SELECT CASE WHEN OrderYear <= 2000 THEN 'train' ELSE 'score' END AS Part, count(*) AS n FROM price_feat GROUP BY 1""")
def _(m):
    train, score = FE.split_by_year(m.narrow["price_features"], "OrderYear", 2000, 2001)
    return A.union_versions([train.agg(F.count("*").alias("n")).select(F.lit("train").alias("Part"), "n"),
                             score.agg(F.count("*").alias("n")).select(F.lit("score").alias("Part"), "n")])


# ---------------------------------------------------------------------- opportunities

@query("O39_reference_percentile", "POItemID:string Score:double", """
    SELECT POItemID, round(n * 100.0::DOUBLE / (SELECT count(*) FROM price_feat WHERE OrderYear <= 2000), 8) AS Score
    FROM (SELECT t.POItemID, r.n FROM price_feat t JOIN (SELECT v, max(n) AS n FROM (SELECT UnitPriceEUR AS v, sum(CAST(OrderYear <= 2000 AS INT)) OVER (ORDER BY UnitPriceEUR) AS n
      FROM price_feat WHERE OrderYear <= 2001) GROUP BY 1) r ON r.v = t.UnitPriceEUR WHERE t.OrderYear = 2001)""")
def _(m):
    f = m["price_features"].select("POItemID", "OrderYear", F.col("UnitPriceEUR").cast("double").alias("UnitPriceEUR"))
    train, score = FE.split_by_year(f, "OrderYear", 2000, 2001)
    return W.reference_percentile(train, score, "UnitPriceEUR", "Score").withColumn("Score", F.round("Score", 8))


@query("O40_proxy_eval", "RowCount:long FlaggedCount:long ProxyPrevalence:double Precision:double Recall:double PrecisionLift:double ExceptionRate:double ExceptionLift:double", """
    SELECT n AS RowCount, f AS FlaggedCount, p / n AS ProxyPrevalence, fp / f AS Precision, fp / p AS Recall, (fp / f) / (p / n) AS PrecisionLift, e / n AS ExceptionRate,
      (fe / f) / (e / n) AS ExceptionLift
    FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(PricingAnomalyFlag) AS DOUBLE) AS f, CAST(sum(RuleBasedExtremePriceFlag) AS DOUBLE) AS p,
      CAST(sum(PriceComplianceExceptionFlag) AS DOUBLE) AS e, CAST(count(*) FILTER (PricingAnomalyFlag = 1 AND RuleBasedExtremePriceFlag = 1) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (PricingAnomalyFlag = 1 AND PriceComplianceExceptionFlag = 1) AS DOUBLE) AS fe FROM pscores)""")
def _(m):
    from spendline.operators.ml import proxy_eval
    return proxy_eval(m["pricing_scores"], "PricingAnomalyFlag", "RuleBasedExtremePriceFlag", "PriceComplianceExceptionFlag")


@query("O41_item_evidence", "POItemID:string PricingSavingsBenchmarkType:string capped:double pricing:double maverick:double", """
    SELECT POItemID, btype AS PricingSavingsBenchmarkType, round(CASE WHEN btype IS NOT NULL THEN capped END, 6) AS capped, round(pricing, 4) AS pricing, round(mav_saving, 4) AS maverick FROM evidence""")
def _(m):
    e = OP.item_evidence(m["fact_purchase_order"], m["pricing_scores"], MT.SCORING_YEAR, MT.AS_OF)
    return e.select("POItemID", "PricingSavingsBenchmarkType", F.round("CappedPositivePriceVariancePct", 6).alias("capped"),
                    F.round("PricingOpportunityYTDEUR", 4).alias("pricing"), F.round("MaverickOpportunityYTDEUR", 4).alias("maverick"))


@query("O42_opportunities", "SupplierID:string CategoryID:string POItemCount:long POCount:long MaterialCount:long EligibleSpendYTDEUR:double AnnualizedEligibleSpendEUR:double "
       "PotentialAnnualSavingsEUR:double MaverickSpendPct:double share:double CategorySpendRank:long SupplierRiskScore:double", """
    SELECT SupplierID, CategoryID, items AS POItemCount, pos AS POCount, materials AS MaterialCount, spend_c AS EligibleSpendYTDEUR, spend_y AS AnnualizedEligibleSpendEUR,
      saving AS PotentialAnnualSavingsEUR, MaverickSpendPct, round(share_pct, 8) AS share, CategorySpendRank, SupplierRiskScore FROM opp""")
def _(m):
    return OP.opportunities(m["item_evidence"], m["risk_scores"], MT.AS_OF, FE.ANNUALIZATION).withColumn("share", F.round("SupplierCategorySpendSharePct", 8))


@query("O43_prioritise", "SupplierID:string CategoryID:string NegotiationPriorityScore:double NegotiationPriority:string PrimaryOpportunityDriver:string ActionableOpportunityFlag:int "
       "SavingsOpportunityRank:long CategorySavingsRank:long NegotiationPriorityRank:long", "SELECT *, score AS NegotiationPriorityScore FROM prio")
def _(m):
    return OP.prioritise(m["opportunities"])


@query("O44_portfolio", "SupplierCategoryOpportunityCount:long SupplierCount:long CategoryCount:long ActionableOpportunityCount:long AnnualizedEligibleSpendEUR:double "
       "PotentialAnnualSavingsEUR:double PortfolioPotentialSavingsPct:double", """
    SELECT *, round(PotentialAnnualSavingsEUR * 100.0 / AnnualizedEligibleSpendEUR, 4) AS PortfolioPotentialSavingsPct FROM (
      SELECT count(*) AS SupplierCategoryOpportunityCount, count(DISTINCT SupplierID) AS SupplierCount, count(DISTINCT CategoryID) AS CategoryCount,
        sum(ActionableOpportunityFlag) AS ActionableOpportunityCount, CAST(sum(CAST(spend_y AS DECIMAL(28,2))) AS DOUBLE) AS AnnualizedEligibleSpendEUR,
        CAST(sum(CAST(saving AS DECIMAL(28,2))) AS DOUBLE) AS PotentialAnnualSavingsEUR FROM prio)""")
def _(m):
    return OP.portfolio(m["prioritised"])


@query("O44_portfolio_by_priority", "NegotiationPriority:string OpportunityCount:long ActionableOpportunityCount:long PotentialAnnualSavingsEUR:double AveragePriorityScore:double", """
    SELECT NegotiationPriority, count(*) AS OpportunityCount, sum(ActionableOpportunityFlag) AS ActionableOpportunityCount,
      sum(CAST(saving AS DECIMAL(28,2))) AS PotentialAnnualSavingsEUR, round(avg(score), 2) AS AveragePriorityScore FROM prio GROUP BY 1""")
def _(m):
    return OP.portfolio_by_priority(m["prioritised"])


@query("O45_run_metadata", "EngineName:string Kind:string Name:string Value:double", """
    SELECT 'SupplierCategorySavings' AS EngineName, Kind, Name, Value FROM (
      SELECT 'PARAMETER' AS Kind, 'MaxVariancePct' AS Name, 50.0 AS Value UNION ALL SELECT 'PARAMETER', 'MaverickRate', 0.03
      UNION ALL SELECT 'METRIC', 'Opportunities', count(*) FROM prio UNION ALL SELECT 'METRIC', 'Actionable', sum(ActionableOpportunityFlag) FROM prio)""")
def _(m):
    metrics = m["prioritised"].agg(F.count("*").alias("Opportunities"), F.sum("ActionableOpportunityFlag").alias("Actionable"))
    return OP.run_metadata(m.spark, "SupplierCategorySavings", "1.0", {"MaxVariancePct": OP.MAX_VARIANCE_PCT, "MaverickRate": OP.MAVERICK_RATE}, metrics)


@query("O46_promote", "POItemID:string SupplierDimensionVersion:int PredictionDateKey:int HasFactKey:boolean PromotionBatchID:string", """
    SELECT s.POItemID, d.DimensionVersion AS SupplierDimensionVersion, 20010731 AS PredictionDateKey, TRUE AS HasFactKey, 'batch-1' AS PromotionBatchID
    FROM pscores s LEFT JOIN dim_supplier d ON s.SupplierID = d.SupplierID AND DATE '2001-07-31' BETWEEN d.EffectiveFromDate AND d.EffectiveToDate""")
def _(m):
    preds = m["pricing_scores"].select("POItemID", "SupplierID", "CategoryID", "PricingAnomalyScore", "PricingAnomalyFlag")
    out = OP.promote(preds, m.dims(), MT.AS_OF, ["POItemID"], "batch-1", m["fact_purchase_order"])
    return out.withColumn("HasFactKey", F.col("PurchaseOrderFactKey").isNotNull())


# ---------------------------------------------------------------------- KPI tables

YEARLY = """SELECT POYear AS Year, e / 100.0 AS EligibleSpendEUR, c / 100.0 AS ContractCompliantSpendEUR, v / 100.0 AS MaverickSpendEUR,
    CASE WHEN e > 0 THEN round((c / 100.0::DOUBLE) * 100.0 / (e / 100.0::DOUBLE), 2) END AS ContractCompliancePct,
    CASE WHEN e > 0 THEN round((v / 100.0::DOUBLE) * 100.0 / (e / 100.0::DOUBLE), 2) END AS MaverickSpendPct
    FROM (SELECT POYear, sum(elig_c) AS e, sum(comp_c) AS c, sum(mav_c) AS v FROM po GROUP BY 1)"""


def annual_spend(po):
    out = po.groupBy(F.col("POYear").alias("Year")).agg(*[F.sum(c).alias(c) for c in ("EligibleSpendEUR", "ContractCompliantSpendEUR", "MaverickSpendEUR")])
    return SC.add_rates(out, ["ContractCompliancePct", "MaverickSpendPct"]).orderBy("Year")


@query("Q01_annual_spend", "Year:int EligibleSpendEUR:double ContractCompliantSpendEUR:double MaverickSpendEUR:double ContractCompliancePct:double MaverickSpendPct:double", YEARLY)
def _(m):
    return annual_spend(m["silver_po_spend"])


@query("Q02_spend_by_scenario", "SimulationContractScenario:string POItemCount:long Spend:double SharePct:double", """
    SELECT SimulationContractScenario, n AS POItemCount, e / 100.0 AS Spend, round((e / 100.0::DOUBLE) * 100.0 / (sum(e) OVER () / 100.0::DOUBLE), 2) AS SharePct
    FROM (SELECT SimulationContractScenario, count(*) AS n, sum(elig_c) AS e FROM po WHERE SpendEligibilityFlag GROUP BY 1)""")
def _(m):
    per = m["silver_po_spend"].where("SpendEligibilityFlag").groupBy("SimulationContractScenario").agg(F.count("*").alias("POItemCount"), F.sum("EligibleSpendEUR").alias("Spend"))
    return A.share_of_total(per, "Spend", "SharePct")


@query("Q03_compliance_diagnostic", "ContractValidityStatusAtPO:string SpendComplianceStatus:string POItemCount:long Spend:double", """
    SELECT ContractValidityStatusAtPO, SpendComplianceStatus, count(*) AS POItemCount, coalesce(sum(elig_c), 0) / 100.0 AS Spend FROM po GROUP BY 1, 2""")
def _(m):
    return m["silver_po_spend"].groupBy("ContractValidityStatusAtPO", "SpendComplianceStatus").agg(
        F.count("*").alias("POItemCount"), F.coalesce(F.sum("EligibleSpendEUR"), F.lit(0)).alias("Spend"))


@query("Q04_maverick_by_reason", "SpendComplianceStatus:string POItemCount:long Spend:double SharePct:double", """
    SELECT SpendComplianceStatus, n AS POItemCount, e / 100.0 AS Spend, round((e / 100.0::DOUBLE) * 100.0 / (sum(e) OVER () / 100.0::DOUBLE), 2) AS SharePct
    FROM (SELECT SpendComplianceStatus, count(*) AS n, sum(mav_c) AS e FROM po WHERE MaverickSpendFlag GROUP BY 1)""")
def _(m):
    per = m["silver_po_spend"].where("MaverickSpendFlag").groupBy("SpendComplianceStatus").agg(F.count("*").alias("POItemCount"), F.sum("MaverickSpendEUR").alias("Spend"))
    return A.share_of_total(per, "Spend", "SharePct")


def _spend_by(key: str):
    sql_key = {"SupplierID": "POSupplierID"}.get(key, key)
    sql = f"""SELECT {sql_key} AS {key}, e / 100.0 AS EligibleSpendEUR, v / 100.0 AS MaverickSpendEUR,
        CASE WHEN e > 0 THEN round((v / 100.0::DOUBLE) * 100.0 / (e / 100.0::DOUBLE), 2) END AS MaverickSpendPct
        FROM (SELECT {sql_key}, sum(elig_c) AS e, sum(mav_c) AS v FROM po GROUP BY 1)"""

    def plan(m):
        per = m.narrow["fact_purchase_order"].groupBy(key).agg(F.sum("EligibleSpendEUR").alias("EligibleSpendEUR"), F.sum("MaverickSpendEUR").alias("MaverickSpendEUR"))
        return SC.add_rates(per, ["MaverickSpendPct"]).orderBy(F.desc("EligibleSpendEUR"))
    query(f"Q05_spend_by_{key.removesuffix('ID').lower()}", f"{key}:string EligibleSpendEUR:double MaverickSpendEUR:double MaverickSpendPct:double", sql)(plan)


_spend_by("SupplierID")
_spend_by("CategoryID")


@query("Q06_annual_match_rate", "InvoiceYear:int Items:long Matched:long MatchPct:double ExceptionAmountEUR:double", """
    SELECT InvoiceYear, n AS Items, k AS Matched, round(k * 100.0::DOUBLE / n, 2) AS MatchPct, x / 100.0 AS ExceptionAmountEUR
    FROM (SELECT InvoiceYear, count(*) AS n, count(*) FILTER (ThreeWayMatchFlag) AS k, sum(exc_eur) AS x FROM inv GROUP BY 1)""")
def _(m):
    per = m.narrow["silver_invoice_matching"].groupBy("InvoiceYear").agg(F.count("*").alias("Items"), count_where("ThreeWayMatchFlag").alias("Matched"),
                                                                         F.sum("InvoiceExceptionAmountEUR").alias("ExceptionAmountEUR"))
    return per.withColumn("MatchPct", pct("Matched", "Items"))


@query("Q07_annual_invoice_kpis", "Year:int Items:long MatchPct:double Invoices:long DisputePct:double DuplicatePct:double", """
    SELECT y AS Year, n AS Items, round(k * 100.0::DOUBLE / n, 2) AS MatchPct, i AS Invoices, round(d * 100.0::DOUBLE / i, 2) AS DisputePct, round(u * 100.0::DOUBLE / i, 2) AS DuplicatePct
    FROM (SELECT year(InvoiceDate) AS y, count(*) AS n, count(*) FILTER (ThreeWayMatchFlag) AS k, count(DISTINCT InvoiceID) AS i,
      count(DISTINCT InvoiceID) FILTER (DisputeFlag) AS d, count(DISTINCT InvoiceID) FILTER (DerivedDuplicateInvoiceFlag) AS u FROM inv GROUP BY 1)""")
def _(m):
    f = m.narrow["fact_invoice"].withColumn("Year", F.year("InvoiceDate"))
    items = f.groupBy("Year").agg(F.count("*").alias("Items"), count_where("ThreeWayMatchFlag").alias("Matched"))
    docs = A.rollup_flags(f, ["InvoiceID"], ["Year"], {"DisputedInvoiceItemFlag": "Disputed", "DuplicateInvoiceItemFlag": "Duplicate"})
    out = items.join(docs.withColumnRenamed("DocumentCount", "Invoices"), "Year")
    return out.withColumns({"MatchPct": pct("Matched", "Items"), "DisputePct": pct("Disputed", "Invoices"), "DuplicatePct": pct("Duplicate", "Invoices")})


@query("Q08_exceptions_by_supplier", "SupplierID:string SupplierName:string Exceptions:long AmountEUR:double", """
    SELECT i.InvoiceSupplierID AS SupplierID, SupplierName, n AS Exceptions, x / 100.0 AS AmountEUR FROM (
      SELECT InvoiceSupplierID, count(*) FILTER (InvoiceExceptionFlag) AS n, sum(exc_eur) AS x FROM inv GROUP BY 1) i LEFT JOIN c_supplier s ON s.SupplierID = i.InvoiceSupplierID""")
def _(m):
    per = m.narrow["fact_invoice"].groupBy("SupplierID").agg(count_where("InvoiceExceptionFlag").alias("Exceptions"), F.sum("InvoiceExceptionAmountEUR").alias("AmountEUR"))
    return J.lookup(per, m["silver_supplier"], {"SupplierID": "SupplierID"}, ["SupplierName"]).orderBy(F.desc("AmountEUR"))


@query("Q09_annual_performance", "PerformanceYear:int OTDPct:double QualityPct:double MatchPct:double", """
    SELECT PerformanceYear, round(ot * 100.0::DOUBLE / nullif(dc, 0), 2) AS OTDPct, round((ic - bad) * 100.0::DOUBLE / nullif(ic, 0), 2) AS QualityPct, round(mi * 100.0::DOUBLE / nullif(ii, 0), 2) AS MatchPct
    FROM (SELECT PerformanceYear, sum(DeliveryCompletePOItemCount) AS dc, sum(OnTimeDeliveryPOItemCount) AS ot, sum(InvoiceCount) AS ic, sum(DisputedInvoiceCount) AS bad,
      sum(InvoiceItemCount) AS ii, sum(MatchedInvoiceItemCount) AS mi FROM score GROUP BY 1)""")
def _(m):
    sums = ["FullyReceivedPOItemCount", "OnTimeFullyReceivedPOItemCount", "InvoiceCount", "DisputeFreeInvoiceCount", "InvoiceItemCount", "ThreeWayMatchedInvoiceItemCount"]
    out = m["fact_supplier_performance"].groupBy("PerformanceYear").agg(*[F.sum(c).alias(c) for c in sums])
    return out.withColumns({"OTDPct": pct(sums[1], sums[0]), "QualityPct": pct(sums[3], sums[2]), "MatchPct": pct(sums[5], sums[4])})


@query("Q10_supplier_trend", "SupplierID:string PerformanceYear:int SupplierName:string SupplierOTDPct:double SupplierQualityIndexPct:double", """
    SELECT SupplierID, PerformanceYear, SupplierName, SupplierOnTimeDeliveryPct AS SupplierOTDPct, SupplierQualityIndexPct FROM fact_perf""")
def _(m):
    return (J.lookup(m["fact_supplier_performance"], m["dim_supplier"], {"SupplierKey": "SupplierKey"}, ["SupplierName"])
            .orderBy("SupplierID", "PerformanceYear"))


def _savings_by_role(name: str, date: str, out: str, measures: dict[str, str], sql_measures: dict[str, str]):
    cols = f"{out}:int Projects:long " + " ".join(f"{c}:double" for c in measures)
    sql = (f"SELECT year({date}) AS {out}, count(*) AS Projects, " + ", ".join(f"sum({e}) / 100.0 AS {c}" for c, e in sql_measures.items())
           + f" FROM fact_sav WHERE {date} IS NOT NULL GROUP BY 1")

    def plan(m):
        roles = m["dim_date"].select(F.col("DateKey").alias(f"{date}Key"), F.col("Year").alias(out))
        joined = m["fact_savings"].join(roles, f"{date}Key")
        return joined.groupBy(out).agg(F.count("*").alias("Projects"), *[F.sum(e).alias(c) for c, e in measures.items()])
    query(name, cols, sql)(plan)


_savings_by_role("Q11_savings_by_planned_start", "PlannedStartDate", "PlannedYear",
                 {"Forecasted": "ForecastedSavingsEUR", "Weighted": "WeightedForecastSavingsEUR", "Approved": "ApprovedSavingsEUR"},
                 {"Forecasted": "fore_eur", "Weighted": "wf_eur", "Approved": "appr_eur"})
_savings_by_role("Q12_realized_by_completion", "ActualCompletionDate", "CompletionYear", {"Realized": "RealizedSavingsEUR"}, {"Realized": "real_eur"})


def _savings_by(key: str):
    sql = f"""SELECT {key}, count(*) AS Projects, sum(fore_eur) / 100.0 AS Forecasted, sum(real_eur) / 100.0 AS Realized FROM fact_sav GROUP BY 1"""
    query(f"Q13_savings_by_{key.removesuffix('ID').lower()}", f"{key}:string Projects:long Forecasted:double Realized:double", sql)(
        lambda m: m["fact_savings"].groupBy(key).agg(F.count("*").alias("Projects"), F.sum("ForecastedSavingsEUR").alias("Forecasted"),
                                                     F.sum("RealizedSavingsEUR").alias("Realized")).orderBy(F.desc("Realized")))


_savings_by("CategoryID")
_savings_by("SupplierID")


@query("Q14_class_balance", "PerformanceYear:int HighRiskNextYearFlag:int n:long SharePct:double", """
    SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY PerformanceYear), 2) AS SharePct FROM (
      SELECT PerformanceYear, HighRiskNextYearFlag, count(*) AS n FROM risk_labels GROUP BY 1, 2)""")
def _(m):
    per = m["risk_labelled"].groupBy("PerformanceYear", "HighRiskNextYearFlag").agg(F.count("*").alias("n"))
    return A.share_of_total(per, "n", "SharePct", ["PerformanceYear"])


@query("Q14_class_balance_overall", "HighRiskNextYearFlag:int n:long SharePct:double", """
    SELECT HighRiskNextYearFlag, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM risk_labels), 2) AS SharePct FROM risk_labels GROUP BY 1""")
def _(m):
    return A.share_of_total(m["risk_labelled"].groupBy("HighRiskNextYearFlag").agg(F.count("*").alias("n")), "n", "SharePct")


@query("Q15_feature_profile", "OrderYear:int n:long Suppliers:long Materials:long AvgUnitPrice:double MinUnitPrice:double MaxUnitPrice:double AvgMaterialHistory:double AvgCoverage:double NoHistory:long", """
    SELECT OrderYear, count(*) AS n, count(DISTINCT SupplierID) AS Suppliers, count(DISTINCT MaterialID) AS Materials, round(CAST(sum(pu_eur) AS DOUBLE) / 10000.0::DOUBLE / count(*), 6) AS AvgUnitPrice,
      min(pu_eur) / 10000.0::DOUBLE AS MinUnitPrice, max(pu_eur) / 10000.0::DOUBLE AS MaxUnitPrice, round(CAST(sum(MaterialHistoryCount) AS DOUBLE) / count(*), 6) AS AvgMaterialHistory,
      round(CAST(sum(BenchmarkCoverageCount) AS DOUBLE) / count(*), 6) AS AvgCoverage, count(*) FILTER (MaterialHistoryCount = 0) AS NoHistory
    FROM price_feat GROUP BY 1""")
def _(m):
    price, mean = F.col("UnitPriceEUR"), lambda c: F.round(F.sum(c).cast("double") / F.count("*"), 6)        # noqa: E731
    return m["price_features"].groupBy("OrderYear").agg(
        F.count("*").alias("n"), F.countDistinct("SupplierID").alias("Suppliers"), F.countDistinct("MaterialID").alias("Materials"), mean(price.cast("decimal(28,4)")).alias("AvgUnitPrice"),
        F.min(price).cast("double").alias("MinUnitPrice"), F.max(price).cast("double").alias("MaxUnitPrice"), mean(F.col("MaterialHistoryCount")).alias("AvgMaterialHistory"),
        mean(F.col("BenchmarkCoverageCount")).alias("AvgCoverage"), F.count_if(F.col("MaterialHistoryCount") == 0).alias("NoHistory"))


@query("Q15_benchmark_coverage", "OrderYear:int POItemCount:long MaterialPct:double SupplierMaterialPct:double CategoryPct:double ContractPct:double RulePct:double", """
    SELECT OrderYear, count(*) AS POItemCount, round(avg(CAST(HasMaterialHistoryFlag AS DOUBLE)) * 100.0, 2) AS MaterialPct,
      round(avg(CAST(HasSupplierMaterialHistoryFlag AS DOUBLE)) * 100.0, 2) AS SupplierMaterialPct, round(avg(CAST(HasCategoryHistoryFlag AS DOUBLE)) * 100.0, 2) AS CategoryPct,
      round(avg(CAST(HasContractBenchmarkFlag AS DOUBLE)) * 100.0, 2) AS ContractPct, round(avg(CAST(RuleBasedExtremePriceFlag AS DOUBLE)) * 100.0, 2) AS RulePct
    FROM price_feat GROUP BY 1""")
def _(m):
    flags = {"HasMaterialHistoryFlag": "MaterialPct", "HasSupplierMaterialHistoryFlag": "SupplierMaterialPct", "HasCategoryHistoryFlag": "CategoryPct",
             "HasContractBenchmarkFlag": "ContractPct", "RuleBasedExtremePriceFlag": "RulePct"}
    return A.coverage(m.narrow["price_features"], ["OrderYear"], flags).withColumnRenamed("RowCount", "POItemCount").orderBy("OrderYear")


@query("Q16_unresolved_keys", "SupplierID:string n:long first:string last:string", """
    SELECT POSupplierID AS SupplierID, count(*) AS n, min(OrderDate) AS first, max(OrderDate) AS last FROM fact_po WHERE NOT supplier_ok GROUP BY 1""")
def _(m):
    return (m["fact_purchase_order"].where(F.col("SupplierKey").isNull()).groupBy("SupplierID")
            .agg(F.count("*").alias("n"), F.min("OrderDate").alias("first"), F.max("OrderDate").alias("last")))


