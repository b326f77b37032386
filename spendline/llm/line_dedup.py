"""Repeated lines, found by sorted ranges of line hashes and handed back as bitmaps. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendline.session import stage_path

SALTS = 64      # a line that is everywhere is spread over so many ranges
_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]
_DOC = ["doc", "version"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A document is its id and the hash of its text: rows that share both are one document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep_first: bool = False,
                 min_chars: int = 1) -> DataFrame:
    """Per document with a dropped line: `doc`, `version` (hash of the text) and `dropped`, a map from 64-line block to the
    bits of its dropped lines. Blocks without dropped lines are absent, so most documents cost nothing.

    Lines are compared by their key: white space stripped at both ends, A-Z lower-cased. A key of at least `min_chars` code
    points that stands in at least `min_docs` documents loses all its lines, or with `keep_first` all but the first in the
    order of document and position.

    Hashes (128 bits) are dealt out by range together with a salt from the document and sorted by document and position, so that
    a scan meets each key's documents in order; a key that fills a third of all lines lies in many ranges. Only the counts
    and the first line of each range are brought together by key.
    """
    spark = docs.sparkSession
    base = stage_path(spark, "lines")
    lowered = F.split(F.translate("text", _UPPER, _LOWER), "\n")
    lines = (_keyed(docs, id_col, text_col).select(*_DOC, F.posexplode(lowered).alias("position", "line"))
             .withColumn("key", F.trim("line", F.lit(_BLANK))).where(F.length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"), *_DOC, "position"))
    lines.write.parquet(f"{base}/hashes")
    ranged = (spark.read.parquet(f"{base}/hashes").withColumn("salt", F.pmod("version", F.lit(SALTS)))
              .repartitionByRange(*_HASH, "salt"))
    scan = Window.partitionBy(*_HASH, "salt").orderBy(*_DOC, "position")
    before = F.lag(F.struct(*_DOC)).over(scan)
    scanned = ranged.select(*_HASH, *_DOC, "position", (before.isNull() | ~before.eqNullSafe(F.struct(*_DOC))).cast("int").alias("new"),
                            F.row_number().over(scan).alias("nth"))
    keys = scanned.groupBy(*_HASH).agg(F.sum("new").alias("docs")).where(F.col("docs") >= min_docs)
    keys.write.parquet(f"{base}/keys")
    keys = spark.read.parquet(f"{base}/keys").select(*_HASH)
    hits = spark.read.parquet(f"{base}/hashes").join(keys, _HASH, "left_semi")
    if keep_first:
        leaders = scanned.where("nth = 1").join(keys, _HASH, "left_semi")
        first = leaders.withColumn("nth", F.row_number().over(Window.partitionBy(*_HASH).orderBy(*_DOC, "position"))).where("nth = 1")
        same = [F.col(f"hits.{c}").eqNullSafe(F.col(f"first.{c}")) for c in [*_HASH, *_DOC, "position"]]
        hits = hits.alias("hits").join(first.alias("first"), same, "left_anti")
    blocks = (hits.groupBy(*_DOC, F.expr("cast(position div 64 as int)").alias("block"))
              .agg(F.bit_or(F.expr("shiftleft(1L, position % 64)")).alias("bits")))
    return blocks.groupBy(*_DOC).agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("dropped"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `kept` (the text without dropped lines), `n_lines` and `n_dropped`; every row stays, and so does every column.

    New columns replace those of the same name. A null text is one empty line.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    maps = bitmaps.select(*[F.col(c).alias(f"__{c}") for c in [*_DOC, "dropped"]])
    joined = docs.join(maps, F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__version")), "left")
    gone = F.coalesce(F.aggregate(F.map_values("__dropped"), F.lit(0), lambda n, bits: n + F.bit_count(bits)), F.lit(0))
    lines = F.split(text, "\n")
    bit = "filter(split({t}, '\\n'), (line, i) -> coalesce(shiftrightunsigned(element_at(__dropped, cast(i div 64 as int)), i % 64) & 1L, 0L) = 0L)"
    kept = F.when(F.col("__dropped").isNull(), text).otherwise(F.array_join(F.expr(bit.format(t=f"coalesce(`{text_col}`, '')")), "\n"))
    return (joined.withColumns({"kept": kept, "n_lines": F.size(lines).cast("long"), "n_dropped": gone.cast("long")})
            .drop(*maps.columns))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep_first: bool = False,
                min_chars: int = 1) -> DataFrame:
    """Both steps: bitmaps of all documents, applied to the same documents.

    Null or empty text: one empty line, which has no key and stays. Null ids and repeated rows: rows with equal id and text
    are one document and lose the same lines. An empty table gives no rows.
    """
    return drop_lines(docs, line_bitmaps(docs, id_col, text_col, min_docs, keep_first, min_chars), id_col, text_col)
