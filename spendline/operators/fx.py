"""Currency conversion with as-of rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.operators.aggregates import first_last


def fx_resolve(df: DataFrame, date: str, currency: str, prefix: str, rates: DataFrame,
               exact_label: str = "EXACT_DATE", null_label: str | None = None) -> DataFrame:
    """Rate of `currency` on `date`, falling back to the nearest end of the published range.

    Adds `<prefix>FXResolutionMethod`, `<prefix>ExchangeRateToEUR`, `<prefix>FXRateDate`. The date
    is first clamped to the currency's range (one row per currency), so a single equi join finds
    exact and boundary rates alike. A gap inside the range finds nothing and stays UNRESOLVED: it
    is not forward-filled.
    """
    ends = first_last(rates, "Currency", "RateDate", "ExchangeRateToEUR").select(
        F.col("Currency").alias("__bc"), F.col("FirstDate").alias("__lo"), F.col("LastDate").alias("__hi"))
    known = rates.select(F.col("Currency").alias("__rc"), F.col("RateDate").alias("__rd"),
                         F.col("ExchangeRateToEUR").alias("__rate"))
    day = F.least(F.greatest(F.col(date), F.col("__lo")), F.col("__hi"))
    clamped = (df.join(ends, F.col(currency) == F.col("__bc"), "left")
               .withColumn("__day", F.when(F.col(date).isNotNull(), day)))
    joined = clamped.join(known, (F.col(currency) == F.col("__rc")) & (F.col("__day") == F.col("__rd")), "left")
    method = (F.when(F.col("__rate").isNull(), "UNRESOLVED")
              .when(F.col(date) < F.col("__lo"), "EARLIEST_AVAILABLE_RATE")
              .when(F.col(date) > F.col("__hi"), "LATEST_AVAILABLE_RATE")
              .otherwise(exact_label))
    if null_label:
        method = F.when(F.col(currency).isNull(), null_label).otherwise(method)
    return (joined.withColumns({f"{prefix}FXResolutionMethod": method,
                                f"{prefix}ExchangeRateToEUR": F.col("__rate"),
                                f"{prefix}FXRateDate": F.col("__rd")})
            .drop("__bc", "__lo", "__hi", "__day", "__rc", "__rd", "__rate"))
