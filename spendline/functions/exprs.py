"""Column-level building blocks. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SEPARATOR = "||"
HASH_NULL = "__NULL__"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: str | Column) -> Column:
    """Collapse white space, trim, and turn an empty string into NULL."""
    return F.nullif(F.trim(F.regexp_replace(col(c), r"\s+", " ")), F.lit(""))


def clean_id(c: str | Column) -> Column:
    return F.upper(clean(c))


def title_case(c: str | Column) -> Column:
    return F.initcap(F.lower(F.trim(col(c))))


def canonical(c: str | Column, values: Iterable[str]) -> Column:
    """Give a label its canonical spelling whatever its case; unknown labels pass unchanged."""
    spelling = [F.lit(x) for v in values for x in (v.lower(), v)]
    return F.coalesce(F.try_element_at(F.create_map(*spelling), F.lower(col(c))), col(c))


def any_of(preds: Sequence[Column]) -> Column:
    return reduce(or_, preds)


def all_of(preds: Sequence[Column]) -> Column:
    return reduce(and_, preds)


def not_in_domain(c: str | Column, values: Iterable[str]) -> Column:
    """True for NULL and for anything outside the domain."""
    return col(c).isNull() | ~col(c).isin(*values)


def same(a: str | Column, b: str | Column) -> Column:
    """Null-safe equality."""
    return col(a).eqNullSafe(col(b))


def differs(a: str | Column, b: str | Column, eps: float) -> Column:
    return F.abs(col(a).cast("double") - col(b).cast("double")) > F.lit(eps)


def amount_if(flag: str | Column, amount: str | Column, type_: str = "decimal(18,2)") -> Column:
    """The amount where the flag holds, zero where it is false or unknown."""
    return F.when(col(flag), col(amount)).otherwise(F.lit(0)).cast(type_)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Fraction as double; NULL when the denominator is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """100 * num / den, rounded; NULL unless the denominator is positive."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when(d > 0, F.round(n * 100.0 / d, digits))


def to_eur(amount: str | Column, rate: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Convert at a rate; exact decimal product, rounded half up."""
    return F.round(col(amount) * col(rate), scale).cast(f"decimal({precision},{scale})")


def count_where(flag: str | Column) -> Column:
    return F.count_if(col(flag))


def year_month(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def quarter_label(c: str | Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(c)))


def iso_weekday(c: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(col(c)) + 1


def date_key(c: str | Column, start: str | Column | None = None, end: str | Column | None = None) -> Column:
    """yyyymmdd as int, NULL outside the calendar: the same answer as a calendar join, unjoined."""
    d = col(c)
    inside = d.isNotNull()
    if start is not None and end is not None:
        inside = (d >= F.to_date(F.lit(start))) & (d <= F.to_date(F.lit(end)))
    return F.when(inside, F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the text of the columns, NULL spelled out."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def surrogate_key(*columns: str | Column) -> Column:
    return F.xxhash64(*[col(c).cast("string") for c in columns])
