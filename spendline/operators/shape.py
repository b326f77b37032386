"""Projection, cleaning, de-duplication and lineage operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from spendline.functions.exprs import clean, record_hash

# Names of the audit columns after each layer
BRONZE_AUDIT = {
    "SourceSystem": "BronzeSourceSystem",
    "SourceExtractDate": "BronzeSourceExtractDate",
    "IngestionTimestamp": "BronzeIngestionTimestamp",
    "LoadDate": "BronzeLoadDate",
    "SourceRecordHash": "BronzeSourceRecordHash",
}


def project(df: DataFrame, spec: Mapping[str, str | tuple[str | Column, str]]) -> DataFrame:
    """`{output: source}` or `{output: (source, type)}` in one select."""
    out = []
    for name, item in spec.items():
        source, type_ = item if isinstance(item, tuple) else (item, None)
        c = F.col(source) if isinstance(source, str) else source
        out.append((c.cast(type_) if type_ else c).alias(name))
    return df.select(*out)


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def normalize_strings(df: DataFrame) -> DataFrame:
    return df.select(*[clean(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def upper_cols(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.col(c)) for c in columns if c in df.columns})


def flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    return df.withColumn(name, predicate)


def _plain(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch.isalnum())


def resolve_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate present in the frame, ignoring case and punctuation."""
    present = {_plain(c): c for c in reversed(df.columns)}
    hit = next((present[_plain(c)] for c in candidates if _plain(c) in present), None)
    if hit is None and required:
        raise KeyError(f"none of {list(candidates)} among {df.columns}")
    return hit


def resolve(df: DataFrame, spec: Mapping[str, tuple[Sequence[str], str, bool]], typed: bool = True) -> DataFrame:
    """`{logical: (candidates, type, required)}`; an absent optional column becomes a typed NULL. Untyped: found columns keep their own type."""
    out = []
    for logical, (candidates, type_, required) in spec.items():
        hit = resolve_column(df, candidates, required)
        out.append((F.col(hit).cast(type_) if hit and typed else F.col(hit) if hit else F.lit(None).cast(type_)).alias(logical))
    return df.select(*out)


def fill_defaults(df: DataFrame, groups: Mapping[str, Iterable[str]]) -> DataFrame:
    """`{type: columns}`: NULL becomes 0, cast to the type."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(t) for t, cs in groups.items() for c in cs})


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that is greatest in `order` (NULL counts as smallest).

    An aggregate rather than a window: copies of a hot key are combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return (df.groupBy(*keys).agg(best)
            .select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns]))


def stamp(df: DataFrame, source: str, layer: str, exclude: Iterable[str] = ()) -> DataFrame:
    """Lineage columns of a layer: source table, load time and a hash over the business columns."""
    own = {f"{layer}LoadTimestamp", f"{layer}LoadDate", f"{layer}RecordHash"}
    skip = own | set(exclude)
    hashed = [c for c in df.columns if c not in skip]
    origin = "BronzeSourceTable" if layer == "Silver" else f"{layer}SourceTable"
    return df.withColumns({
        origin: F.lit(source),
        f"{layer}LoadTimestamp": F.current_timestamp(),
        f"{layer}LoadDate": F.current_date(),
        f"{layer}RecordHash": record_hash(hashed),
    })
