"""Master-data conforming: one generic pipeline driven by a specification per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendline.functions.exprs import canonical, year_month
from spendline.operators.shape import BRONZE_AUDIT, dedup_latest, normalize_strings, rename_present, stamp, upper_cols


@dataclass(frozen=True)
class Spec:
    """How a source table becomes a conformed one."""

    source: str
    keys: tuple[str, ...]
    ids: tuple[str, ...]
    labels: dict[str, tuple[str, ...]] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    derived: dict[str, Column] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ("IngestionTimestamp", "SourceRecordHash")


ACTIVITY = ("Active", "Inactive")


def master_specs() -> dict[str, Spec]:
    """The six master tables. Label lists are fixed values."""
    return {
        "category": Spec("bronze_category", ("CategoryID",), ("CategoryID",),
                         labels={"ProcurementType": ("Direct", "Indirect", "Capital")}),
        "business_unit": Spec("bronze_business_unit", ("BusinessUnitID",), ("BusinessUnitID",)),
        "buyer": Spec("bronze_buyer", ("BuyerID",), ("BuyerID", "BusinessUnitID"),
                      labels={"BuyerRole": ("Operational Buyer", "Senior Buyer", "Strategic Buyer",
                                            "Category Manager", "Procurement Manager")}),
        "supplier": Spec("bronze_supplier", ("SupplierID",), ("SupplierID",),
                         labels={"Status": ACTIVITY,
                                 "SupplierType": ("Manufacturer", "Distributor", "Service Provider",
                                                  "Logistics Provider", "Utility Provider", "Contractor")},
                         derived={"SupplierActiveFlag": F.col("Status") == "Active"}),
        "material": Spec("bronze_material", ("MaterialID",), ("MaterialID", "CategoryID", "UnitOfMeasure"),
                         labels={"Status": ACTIVITY}, casts={"StandardCost": "decimal(18,2)"}),
        "exchange_rate": Spec("bronze_exchange_rate", ("RateDate", "Currency"), ("Currency",),
                              renames={"ExchangeRateEUR": "ExchangeRateToEUR"},
                              casts={"ExchangeRateToEUR": "decimal(18,8)"},
                              derived={"RateYear": F.year("RateDate"), "RateMonth": F.month("RateDate"),
                                       "RateYearMonth": year_month("RateDate"), "IsEUR": F.col("Currency") == "EUR"}),
    }


def conform(df: DataFrame, spec: Spec, lineage: bool = True) -> DataFrame:
    """Clean strings, upper-case ids, canonicalise labels, cast, derive, keep the latest row per key."""
    out = upper_cols(normalize_strings(rename_present(df, spec.renames)), spec.ids)
    if spec.casts or spec.labels:
        out = out.withColumns({**{c: F.col(c).cast(t) for c, t in spec.casts.items()},
                               **{c: canonical(c, values) for c, values in spec.labels.items()}})
    if spec.derived:
        out = out.withColumns(spec.derived)
    order = [c for c in spec.order if c in out.columns]
    if not order:
        # No audit column to order by: take the greatest row, so that a rerun picks the same one.
        order = [c for c in out.columns if c not in spec.keys]
    out = rename_present(dedup_latest(out, spec.keys, order), BRONZE_AUDIT)
    return stamp(out, spec.source, "Silver", BRONZE_AUDIT.values()) if lineage else out
