"""Scans, sinks and table bookkeeping over the catalog and over Parquet paths."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendline.functions.exprs import record_hash


class TableMissing(LookupError):
    pass


class WriteMismatch(RuntimeError):
    pass


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_path(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small table of literals (thresholds, run metadata) with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def one_row(spark: SparkSession, columns: Mapping[str, Column]) -> DataFrame:
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def calendar(bounds: DataFrame, start: str | Column, end: str | Column, out: str = "Date") -> DataFrame:
    """One row per day between two dates held in (or literal to) a one-row relation."""
    as_col = lambda v: F.to_date(F.lit(v)) if isinstance(v, str) else v
    return bounds.select(F.explode(F.sequence(as_col(start), as_col(end))).alias(out))


def overwrite(df: DataFrame, path: str, partition_by: Iterable[str] = (), compression: str | None = None) -> DataFrame:
    """Replace a table, schema included, and return a scan of what was written. Without a codec the session's applies."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=compression)
    return scan_path(df.sparkSession, path)


def overwrite_verified(df: DataFrame, path: str) -> DataFrame:
    """Overwrite, and compare the rows that passed into the writer with those that read back; the source runs once."""
    seen = Observation()
    written = overwrite(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
    expected, found = seen.get["n"], written.count()
    if expected != found:
        raise WriteMismatch(f"expected {expected} rows, found {found}")
    return written


def append(df: DataFrame, path: str) -> DataFrame:
    """Append history rows; the returned scan merges the schemas of all batches."""
    df.write.mode("append").parquet(path)
    return scan_path(df.sparkSession, path, merge_schema=True)


def update_matched(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of `target` whose key occurs in `source` take its values; all others stay.

    `source` must be unique per key. A matched NULL overwrites, as an update would.
    """
    new = source.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = target.join(new, keys, "left")
    pick = {c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(pick).select(*target.columns)


def ensure_audit(df: DataFrame, source_system: str, load_date: str, hash_columns: list[str]) -> DataFrame:
    """Add the audit columns that are missing, and fill those that are NULL."""
    wanted = {
        "SourceSystem": F.lit(source_system),
        "IngestionTimestamp": F.to_timestamp(F.lit(load_date)),
        "LoadDate": F.to_date(F.lit(load_date)),
        "SourceRecordHash": record_hash(hash_columns),
    }
    return df.withColumns({
        name: F.coalesce(F.col(name), value) if name in df.columns else value
        for name, value in wanted.items()
    })


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise TableMissing(", ".join(missing))


def verify_written(df: DataFrame, written: DataFrame) -> int:
    """Compare what was meant to be written with what reads back, in row count."""
    expected, found = df.count(), written.count()
    if expected != found:
        raise WriteMismatch(f"expected {expected} rows, found {found}")
    return found


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, as one job over all tables."""
    rows = [t.agg(F.count("*").alias("RowCount"))
             .select(F.lit(n).alias("TableName"), "RowCount", F.lit(len(t.columns)).alias("ColumnCount"))
            for n, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)
