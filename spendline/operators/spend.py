"""Purchase-order spend: base, eligibility, compliance, price variance, spend split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import amount_if, quarter_label, to_eur, year_month
from spendline.operators.contract import CONTRACT_ATTRIBUTES, contract_validity
from spendline.operators.fx import fx_resolve
from spendline.operators.joins import join_header_item, lookup, resolved_flag
from spendline.operators.shape import stamp

PRICE_TOLERANCE_PCT = 3.0

SUPPLIER_ATTRIBUTES = ["SupplierName", "SupplierType", "SupplierActiveFlag", "PreferredSupplier", "StrategicSupplier",
                       "ESGRating", "FinancialRiskScore"]
BUYER_ATTRIBUTES = {"BuyerName": "BuyerName", "BuyerRole": "BuyerRole", "BusinessUnitID": "BuyerBusinessUnitID"}
MATERIAL_ATTRIBUTES = {"MaterialDescription": "MaterialDescription", "CategoryID": "MaterialCategoryID",
                       "StandardCost": "StandardCost", "UnitOfMeasure": "MaterialUnitOfMeasure",
                       "Manufacturer": "Manufacturer", "Status": "MaterialStatus"}


def po_lines(header: DataFrame, item: DataFrame) -> DataFrame:
    """Order items with the columns of their header."""
    head = header.select("POID", F.col("SupplierID").alias("POSupplierID"), "BuyerID", "BusinessUnitID", "OrderDate",
                         F.col("Currency").alias("POCurrency"), "POStatus", F.col("TotalAmount").alias("POHeaderTotalAmount"),
                         F.col("AmountReconciliationStatus").alias("POAmountReconciliationStatus"))
    line = item.select(
        "POItemID", "POID", "POLineNumber", "MaterialID", "CategoryID", "ContractID",
        F.col("Quantity").cast("decimal(18,3)").alias("Quantity"), "OrderUnit",
        F.col("UnitPrice").cast("decimal(18,4)").alias("UnitPrice"),
        F.col("LineAmount").cast("decimal(18,2)").alias("LineAmount"),
        F.col("Currency").alias("POItemCurrency"), "RequestedDeliveryDate", "POItemStatus",
        "SimulationContractScenario", "SimulationPriceAnomalyFlag")
    return join_header_item(head, line, "POID")


def po_attributes(lines: DataFrame, supplier: DataFrame, buyer: DataFrame, material: DataFrame, category: DataFrame,
                  business_unit: DataFrame) -> DataFrame:
    """Order lines with supplier, buyer, material and category attributes.

    Materials grow with the orders, the others hardly: the join that may shuffle the lines comes first, while they are narrow.
    """
    out = lookup(lines, material, {"MaterialID": "MaterialID"}, MATERIAL_ATTRIBUTES)
    out = lookup(out, supplier, {"POSupplierID": "SupplierID"}, SUPPLIER_ATTRIBUTES)
    out = lookup(out, buyer, {"BuyerID": "BuyerID"}, BUYER_ATTRIBUTES)
    out = lookup(out, category, {"CategoryID": "CategoryID"}, ["CategoryName", "ProcurementType"])
    out = resolved_flag(out, business_unit, {"BusinessUnitID": "BusinessUnitID"}, "BusinessUnitResolvedFlag")
    return out.select(*lines.columns, *SUPPLIER_ATTRIBUTES, *BUYER_ATTRIBUTES.values(), *MATERIAL_ATTRIBUTES.values(),
                      "CategoryName", "ProcurementType", "BusinessUnitResolvedFlag")


def po_spend_base(header: DataFrame, item: DataFrame, supplier: DataFrame, buyer: DataFrame, material: DataFrame,
                  category: DataFrame, business_unit: DataFrame) -> DataFrame:
    """Order items with header, supplier, buyer, material and category attributes."""
    return po_attributes(po_lines(header, item), supplier, buyer, material, category, business_unit)


def eligible(df: DataFrame) -> DataFrame:
    return df.withColumn("SpendEligibilityFlag", (F.col("POStatus") != "Cancelled") & (F.col("POItemStatus") != "Cancelled"))


def spend_compliance(df: DataFrame) -> DataFrame:
    """Split eligible spend into compliant and maverick, with the reason."""
    ok, valid = F.col("SpendEligibilityFlag"), F.col("ValidContractAtPOFlag")
    reasons = [("EXCLUDED_CANCELLED", ~ok), ("COMPLIANT", ok & valid),
               ("MAVERICK_NO_CONTRACT", ~F.col("ContractReferenceFlag")),
               ("MAVERICK_CONTRACT_NOT_FOUND", ~F.col("ContractFoundFlag")),
               ("MAVERICK_SUPPLIER_MISMATCH", ~F.col("ContractSupplierMatchFlag")),
               ("MAVERICK_CATEGORY_MISMATCH", ~F.col("ContractCategoryMatchFlag")),
               ("MAVERICK_INVALID_CONTRACT_DATE", ~F.col("ContractDateValidAtPOFlag"))]
    status = F.coalesce(*[F.when(test, F.lit(label)) for label, test in reasons], F.lit("MAVERICK_OTHER"))
    return df.withColumns({"ContractComplianceFlag": ok & valid, "MaverickSpendFlag": ok & ~valid,
                           "SpendComplianceStatus": status})


def contract_price_variance(df: DataFrame, rates: DataFrame, tolerance: float = PRICE_TOLERANCE_PCT) -> DataFrame:
    """Order price against the negotiated price, both in EUR at the order date."""
    out = fx_resolve(df, "OrderDate", "POCurrency", "PO", rates, null_label="NOT_APPLICABLE")
    out = fx_resolve(out, "OrderDate", "ContractCurrency", "ContractAtPO", rates, null_label="NOT_APPLICABLE")
    out = out.withColumns({
        "UnitPriceEUR": to_eur("UnitPrice", "POExchangeRateToEUR", 4),
        "LineAmountEUR": to_eur("LineAmount", "POExchangeRateToEUR", 2),
        "ContractNegotiatedUnitPriceEURAtPODate": F.when(
            F.col("ContractFoundFlag"), to_eur("ContractNegotiatedUnitPrice", "ContractAtPOExchangeRateToEUR", 4)),
    })
    paid, agreed = F.col("UnitPriceEUR"), F.col("ContractNegotiatedUnitPriceEURAtPODate")
    comparable = F.col("ValidContractAtPOFlag") & paid.isNotNull() & agreed.isNotNull() & F.coalesce(agreed > 0, F.lit(False))
    pct = F.round((paid - agreed) * 100 / agreed, 2).cast("double")
    return out.withColumn("ContractPriceComparisonEligibleFlag", comparable).withColumns({
        "ContractPriceVarianceEUR": F.when(F.col("ContractPriceComparisonEligibleFlag"),
                                           (paid - agreed).cast("decimal(18,4)")),
        "ContractPriceVariancePercentage": F.when(F.col("ContractPriceComparisonEligibleFlag"), pct),
    }).withColumn("ContractPriceWithinToleranceFlag", F.abs("ContractPriceVariancePercentage") <= F.lit(tolerance))


def split_spend(df: DataFrame) -> DataFrame:
    amount = "LineAmountEUR"
    return df.withColumns({
        "EligibleSpendEUR": amount_if("SpendEligibilityFlag", amount),
        "ContractCompliantSpendEUR": amount_if("ContractComplianceFlag", amount),
        "MaverickSpendEUR": amount_if("MaverickSpendFlag", amount),
        "POYear": F.year("OrderDate"), "POMonth": F.month("OrderDate"),
        "POYearMonth": year_month("OrderDate"), "POQuarter": quarter_label("OrderDate"),
    })


def classify_spend(base: DataFrame, contract: DataFrame | None, rates: DataFrame) -> DataFrame:
    """Eligibility, validity, compliance, price variance and split on any order-item frame (no contract: its attributes are there)."""
    return split_spend(contract_price_variance(spend_compliance(contract_validity(eligible(base), contract)), rates))


def build_po_spend(header: DataFrame, item: DataFrame, supplier: DataFrame, buyer: DataFrame, material: DataFrame,
                   category: DataFrame, business_unit: DataFrame, contract: DataFrame, rates: DataFrame) -> DataFrame:
    """The contract joins the narrow lines first; its columns take their place after the eligibility flag again."""
    lines = po_lines(header, item)
    agreed = lookup(lines, contract, {"ContractID": "ContractID"}, CONTRACT_ATTRIBUTES)
    out = classify_spend(po_attributes(agreed, supplier, buyer, material, category, business_unit), None, rates)
    taken = set(CONTRACT_ATTRIBUTES.values())
    rest = [c for c in out.columns if c not in taken]
    at = rest.index("SpendEligibilityFlag") + 1
    return stamp(out.select(*rest[:at], *CONTRACT_ATTRIBUTES.values(), *rest[at:]), "bronze_purchase_order_item", "Silver")
