"""Gold dimensions: calendar, type-1 dimensions, and the type-2 supplier dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import iso_weekday, quarter_label, record_hash, surrogate_key, year_month
from spendline.operators.aggregates import union_versions
from spendline.sources.tables import calendar

OPEN_END = "9999-12-31"
SUPPLIER_TRACKED = ["SupplierName", "SupplierType", "Country", "Region", "PreferredSupplier", "StrategicSupplier",
                    "ESGRating", "FinancialRiskScore", "Status", "SupplierActiveFlag"]

TYPE1_COLUMNS = {
    "Category": ["CategoryID", "CategoryName", "CategoryManager", "CommodityGroup", "ProcurementType"],
    "Material": ["MaterialID", "MaterialDescription", "CategoryID", "StandardCost", "UnitOfMeasure", "Manufacturer", "Status"],
    "Buyer": ["BuyerID", "BuyerName", "Email", "Department", "BuyerRole", "BusinessUnitID"],
    "BusinessUnit": ["BusinessUnitID", "BusinessUnitName", "Country", "Region"],
    "Contract": ["ContractID", "SupplierID", "CategoryID", "ContractStartDate", "ContractEndDate", "Currency", "ContractValue",
                 "NegotiatedUnitPrice", "ContractOwnerBuyerID", "SourceContractOwner", "ContractType", "SourceContractStatus",
                 "PaymentTermsDays", "AutoRenewalFlag", "ContractLifecycleStatus", "IsContractActiveAsOfDate",
                 "ContractDurationDays", "ContractStartYear", "ContractEndYear", "DaysToExpiryAsOfDate"],
}


class SnapshotOrder(ValueError):
    pass


def dim_date(bounds: DataFrame, start, end) -> DataFrame:
    """One row per day with week, month, quarter and year attributes (ISO weekdays)."""
    d, year, quarter = F.col("Date"), F.year("Date"), F.quarter("Date")
    attributes = {
        "DateKey": F.date_format(d, "yyyyMMdd").cast("int"), "DayOfMonth": F.dayofmonth(d), "DayOfYear": F.dayofyear(d),
        "ISOWeekdayNumber": iso_weekday(d), "DayName": F.date_format(d, "EEEE"), "WeekOfYear": F.weekofyear(d),
        "MonthNumber": F.month(d), "MonthName": F.date_format(d, "MMMM"), "MonthShortName": F.date_format(d, "MMM"),
        "YearMonth": year_month(d), "YearMonthSort": year * 100 + F.month(d), "QuarterNumber": quarter,
        "Quarter": quarter_label(d), "YearQuarter": F.concat_ws("-", year.cast("string"), quarter_label(d)), "Year": year,
        "IsWeekendFlag": iso_weekday(d) >= 6, "MonthStartDate": F.trunc(d, "month"), "YearStartDate": F.trunc(d, "year"),
    }
    return calendar(bounds, start, end).withColumns(attributes)


def dim_type1(df: DataFrame, entity: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Current attributes under a hash key of the business id."""
    take = columns or TYPE1_COLUMNS[entity]
    return df.select(*take, surrogate_key(f"{entity}ID").alias(f"{entity}Key"))


def dim_currency(rates: DataFrame) -> DataFrame:
    return (rates.groupBy(F.col("Currency").alias("CurrencyCode"))
            .agg(F.min("RateDate").alias("FirstAvailableRateDate"), F.max("RateDate").alias("LastAvailableRateDate"),
                 F.countDistinct("RateDate").alias("AvailableRateDateCount"))
            .withColumns({"CurrencyKey": surrogate_key("CurrencyCode"), "IsBaseCurrencyFlag": F.col("CurrencyCode") == "EUR"}))


def scd2(existing: DataFrame | None, snapshot: DataFrame, date: str, tracked: Sequence[str] = tuple(SUPPLIER_TRACKED),
         key: str = "SupplierID", first_date: str | Column | None = None) -> DataFrame:
    """Fold one snapshot into a versioned dimension; returns the new dimension.

    First load: version 1 from `first_date`. Later: a new or changed key opens a version on the
    snapshot date, a changed or vanished one is closed on the day before. Running the same snapshot
    again changes nothing; a snapshot that would close a version before it began is refused, which
    is what a change on the day a version opened amounts to.
    """
    name = key.removesuffix("ID")
    hash_, surrogate = f"{name}AttributeHash", f"{name}Key"
    source = snapshot.select(key, *tracked).withColumn(hash_, record_hash(list(tracked)))

    def opened(df: DataFrame, version, start: str | Column) -> DataFrame:
        return df.withColumns({
            "DimensionVersion": version, "EffectiveFromDate": F.to_date(F.lit(start)),
            "EffectiveToDate": F.to_date(F.lit(OPEN_END)), "IsCurrentFlag": F.lit(True),
        }).withColumn(surrogate, surrogate_key(key, "EffectiveFromDate", "DimensionVersion"))

    if existing is None:
        return opened(source, F.lit(1), date if first_date is None else first_date)

    closing_before_start = F.col("EffectiveFromDate") >= F.to_date(F.lit(date))
    current = existing.where("IsCurrentFlag")
    incoming = source.select(key, F.col(hash_).alias("__new"))
    touched = current.join(incoming, key, "left").where(F.col("__new").isNull() | (F.col("__new") != F.col(hash_)))
    if touched.where(closing_before_start).limit(1).count():
        raise SnapshotOrder(f"a version that began on or after {date} would be closed")

    # The closed versions are the current ones that the snapshot no longer confirms; everything
    # else is kept. One pass over the dimension decides both.
    judged = existing.join(incoming, key, "left")
    stale = F.col("IsCurrentFlag") & (F.col("__new").isNull() | (F.col("__new") != F.col(hash_)))
    kept = judged.withColumn("__stale", stale).withColumns({
        "EffectiveToDate": F.when(F.col("__stale"), F.date_sub(F.to_date(F.lit(date)), 1)).otherwise(F.col("EffectiveToDate")),
        "IsCurrentFlag": F.col("IsCurrentFlag") & ~F.col("__stale"),
    }).drop("__new", "__stale")
    # A key that had vanished and comes back is numbered like any unseen key.
    latest = current.select(key, F.col(hash_).alias("__old"), F.col("DimensionVersion").alias("__version"))
    fresh = source.join(latest, key, "left").where(F.col("__old").isNull() | (F.col("__old") != F.col(hash_)))
    version = (F.coalesce(F.col("__version"), F.lit(0)) + 1).cast("int")
    return union_versions([kept, opened(fresh, version, date).select(*existing.columns)])
