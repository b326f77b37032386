"""Contract conforming, lifecycle, and validity at order date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import all_of, canonical, title_case, to_eur
from spendline.operators.fx import fx_resolve
from spendline.operators.joins import lookup
from spendline.operators.shape import BRONZE_AUDIT, dedup_latest, normalize_strings, rename_present, stamp, upper_cols


def conform_contract(df: DataFrame) -> DataFrame:
    out = upper_cols(normalize_strings(df), ["ContractID", "SupplierID", "CategoryID", "ContractOwnerBuyerID", "Currency"])
    out = rename_present(out, {"ContractStatus": "SourceContractStatus", "ContractOwner": "SourceContractOwner"})
    out = out.withColumns({
        "ContractStartDate": F.col("ContractStartDate").cast("date"),
        "ContractEndDate": F.col("ContractEndDate").cast("date"),
        "ContractValue": F.col("ContractValue").cast("decimal(18,2)"),
        "NegotiatedUnitPrice": F.col("NegotiatedUnitPrice").cast("decimal(18,4)"),
        "PaymentTermsDays": F.col("PaymentTermsDays").cast("int"),
        "AutoRenewalFlag": F.col("AutoRenewalFlag").cast("boolean"),
        "SourceContractStatus": canonical("SourceContractStatus", ["Active", "Expired", "Future"]),
        "ContractType": title_case("ContractType"),
    })
    order = [c for c in ("IngestionTimestamp", "SourceRecordHash") if c in out.columns] or \
            [c for c in out.columns if c != "ContractID"]
    return rename_present(dedup_latest(out, ["ContractID"], order), BRONZE_AUDIT)


def lifecycle(df: DataFrame, as_of: str) -> DataFrame:
    """Status and durations on a day; the duration counts both end days."""
    day, start, end = F.to_date(F.lit(as_of)), F.col("ContractStartDate"), F.col("ContractEndDate")
    status = F.when(start > day, "Future").when(end < day, "Expired").otherwise("Active")
    return df.withColumns({
        "ContractLifecycleStatus": status,
        "IsContractActiveAsOfDate": (start <= day) & (end >= day),
        "ContractDurationDays": F.datediff(end, start) + 1,
        "ContractStartYear": F.year(start),
        "ContractEndYear": F.year(end),
        "DaysToExpiryAsOfDate": F.datediff(end, day),
        "ContractStatusConsistencyFlag": F.col("SourceContractStatus") == status,
        "ContractValidityWindowFlag": start.isNotNull() & end.isNotNull() & F.coalesce(end >= start, F.lit(False)),
    })


def enrich_contract(df: DataFrame, buyer: DataFrame, supplier: DataFrame, category: DataFrame) -> DataFrame:
    out = lookup(df, buyer, {"ContractOwnerBuyerID": "BuyerID"},
                 {"BuyerName": "ContractOwnerName", "BuyerRole": "ContractOwnerRole",
                  "BusinessUnitID": "ContractOwnerBusinessUnitID"})
    out = lookup(out, supplier, {"SupplierID": "SupplierID"}, ["SupplierName", "SupplierType", "SupplierActiveFlag"])
    return lookup(out, category, {"CategoryID": "CategoryID"}, ["CategoryName", "ProcurementType"])


def contract_values(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Contract value and price in EUR at the rate of the start date."""
    out = fx_resolve(df, "ContractStartDate", "Currency", "__c", rates, exact_label="EXACT_CONTRACT_START_DATE")
    out = out.withColumnsRenamed({"__cFXResolutionMethod": "ContractFXResolutionMethod",
                                  "__cExchangeRateToEUR": "ExchangeRateToEURAtContractStart",
                                  "__cFXRateDate": "ContractFXRateDate"})
    rate = "ExchangeRateToEURAtContractStart"
    return out.withColumns({"ContractValueEUR": to_eur("ContractValue", rate, 2),
                            "NegotiatedUnitPriceEUR": to_eur("NegotiatedUnitPrice", rate, 4)})


def build_contract(df: DataFrame, buyer: DataFrame, supplier: DataFrame, category: DataFrame, rates: DataFrame,
                   as_of: str) -> DataFrame:
    out = enrich_contract(lifecycle(conform_contract(df), as_of), buyer, supplier, category)
    return stamp(contract_values(out, rates), "bronze_contract", "Silver", BRONZE_AUDIT.values())


CONTRACT_ATTRIBUTES = {
    "ContractID": "ResolvedContractID", "SupplierID": "ContractSupplierID", "CategoryID": "ContractCategoryID",
    "ContractStartDate": "ContractStartDate", "ContractEndDate": "ContractEndDate", "Currency": "ContractCurrency",
    "NegotiatedUnitPrice": "ContractNegotiatedUnitPrice", "ContractType": "ContractType",
    "ContractLifecycleStatus": "ContractLifecycleStatus",
}


def contract_validity(df: DataFrame, contract: DataFrame | None = None, supplier: str = "POSupplierID",
                      category: str = "CategoryID", date: str = "OrderDate") -> DataFrame:
    """Was the referenced contract valid for this supplier and category on the order date?

    NULL supplier or category on a found contract gives a NULL verdict and the status UNKNOWN, not
    a mismatch.
    """
    if contract is not None:
        df = lookup(df, contract, {"ContractID": "ContractID"}, CONTRACT_ATTRIBUTES)
    found, day = F.col("ResolvedContractID").isNotNull(), F.col(date)
    start, end = F.col("ContractStartDate"), F.col("ContractEndDate")
    when_found = lambda test: F.when(found, test).otherwise(F.lit(False))
    referenced = F.col("ContractID").isNotNull()
    supplier_ok = when_found(F.col(supplier) == F.col("ContractSupplierID"))
    category_ok = when_found(F.col(category) == F.col("ContractCategoryID"))
    date_ok = when_found((day >= start) & (day <= end))
    valid = all_of([found, supplier_ok, category_ok, date_ok])
    # First reason that applies decides, in this order.
    reasons = [("NO_CONTRACT_REFERENCE", ~referenced), ("CONTRACT_NOT_FOUND", ~found),
               ("SUPPLIER_MISMATCH", ~supplier_ok), ("CATEGORY_MISMATCH", ~category_ok),
               ("CONTRACT_NOT_YET_ACTIVE", day < start), ("CONTRACT_EXPIRED", day > end), ("VALID_CONTRACT", valid)]
    status = F.coalesce(*[F.when(test, F.lit(label)) for label, test in reasons], F.lit("UNKNOWN"))
    return df.withColumns({
        "ContractReferenceFlag": referenced, "ContractFoundFlag": found,
        "ContractSupplierMatchFlag": supplier_ok, "ContractCategoryMatchFlag": category_ok,
        "ContractDateValidAtPOFlag": date_ok, "ValidContractAtPOFlag": valid,
        "ContractValidityStatusAtPO": status,
    })
