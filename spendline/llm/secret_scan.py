"""Secrets: exact patterns, and opaque strings that the whole corpus shows to belong to few owners."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendline.llm.lookup import join_facts
from spendline.session import stage_path

#: Base kinds in their order. A run of the class is taken whole, so the minimum lengths can stand in the last two patterns.
BASE = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]{14,}"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
}
#: Further kinds: wide patterns for candidates, whose value is the last group.
WIDE = {
    "opaque": re.compile(r"([A-Za-z0-9+/_-]{20,})"),
    "login": re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:([^\x00-\x20/:@]+)@"),
}
KINDS = [*BASE, *WIDE]
_HINT = ("passw", "secret", "token", "apikey", "api_key")
_ISSUERS = ("ghp_", "gho_", "ghu_", "ghs_", "glpat-", "sk-", "xoxa-", "xoxb-", "xoxp-", "AIza", "eyJ", "AKIA", "ASIA")
LEAST_ASSIGNED, LEAST_LOGIN = 12, 8
_SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean,value:binary,random:boolean>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_()),
                             ("value", pa.binary()), ("random", pa.bool_())]))


def looks_random(value: str) -> bool:
    """Whether two characters drawn from the value are equal at most once in eight: collision entropy of at least three bits."""
    return 8 * sum(n * n for n in Counter(value).values()) <= len(value) ** 2


def _opaque(value: str) -> bool:
    kinds = sum(bool(re.search(c, value)) for c in ("[A-Z]", "[a-z]"))
    return value.startswith(_ISSUERS) or kinds == 2 and len(re.findall("[0-9]", value)) >= 2


def scan(text: str) -> list[dict]:
    """All base spans, and wide candidates that overlap none of them, sorted by start, then kind."""
    spans = []

    def add(kind: str, match: re.Match, value: str) -> None:
        spans.append({"start": match.start(), "rank": KINDS.index(kind), "kind": kind, "end": match.end(), "base": kind in BASE,
                      "value": hashlib.md5(value.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest(), "random": looks_random(value)})

    lowered = text.lower()
    if any(h in lowered for h in _HINT):
        for m in BASE["assign"].finditer(text):
            if len(m[1]) >= LEAST_ASSIGNED:
                add("assign", m, m[1])
    for kind in ("access", "hex"):
        for m in BASE[kind].finditer(text):
            add(kind, m, m[0])
    borders = sorted((s["start"], s["end"]) for s in spans)
    for kind, pattern in WIDE.items():
        if kind == "login" and "://" not in text:
            continue
        at, reached = 0, 0      # the base spans that start before the end of this match, and how far they reach
        for m in pattern.finditer(text):
            while at < len(borders) and borders[at][0] < m.end():
                reached = max(reached, borders[at][1])
                at += 1
            if reached <= m.start() and (_opaque(m[1]) if kind == "opaque" else len(m[1]) >= LEAST_LOGIN):
                add(kind, m, m[1])
    return sorted(spans, key=lambda s: (s["start"], s["rank"]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [scan(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "doc", "repo", "owner")] + [pa.array(found, _ARROW)], ["row", "doc", "repo", "owner", "found"])


def ownership(occurrences: DataFrame) -> DataFrame:
    """How far each value is spread: `value`, `places` (rows), `repos` and `owners`, both distinct. A repository is named within its owner.

    Counted in three steps, each combined before its shuffle: by value, owner and repository, by value and owner, by value. A null owner or
    repository is one like any other.
    """
    return (occurrences.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
            .groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
            .groupBy("value").agg(F.sum("n").alias("places"), F.sum("repos").alias("repos"), F.count("*").alias("owners")))


def verdict(owners: Column, random: Column, max_owners: int, example_owners: int) -> Column:
    """`example` (many owners have it), `live` (few owners, and it looks random), else `unclear`."""
    return F.when(owners >= example_owners, "example").when((owners <= max_owners) & random, "live").otherwise("unclear")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", max_owners: int = 2,
                 example_owners: int = 3) -> DataFrame:
    """One row per row of `docs`: the id and `spans`, an array of (`start`, `rank`, `kind`, `end`, `base`, `verdict`, `places`, `repos`, `owners`) sorted by start, then kind.

    Base kinds are exact patterns, and always stay. Candidates of the further kinds (`opaque` strings and `login` passwords in addresses) overlap no base span; they
    become spans if the whole corpus shows them to be live: their value stands with at most `max_owners` owners and looks random. A value
    with `example_owners` owners or more is an example that people copy. Base spans get the same verdict, as a column only.

    Null or empty text: no spans. Null ids, repositories and owners are values like any other; repeated rows are rows of their own but
    the same repository. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base = stage_path(spark, "secrets")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), F.col(repo_col).cast("string").alias("repo"),
                       F.col(owner_col).cast("string").alias("owner"), F.col(text_col).alias("text"))
    schema = f"row bigint, doc {docs.schema[id_col].dataType.simpleString()}, repo string, owner string, found {_SPAN}"
    rows.mapInArrow(_scan_batches, schema).write.parquet(f"{base}/found")
    found = spark.read.parquet(f"{base}/found")
    spans = found.select("row", "doc", "repo", "owner", F.explode("found").alias("s")).select("row", "doc", "repo", "owner", "s.*")
    ownership(spans).write.parquet(f"{base}/owners")
    judged = join_facts(spans, spark.read.parquet(f"{base}/owners"), ["value"], "places").withColumn("verdict", verdict(F.col("owners"), F.col("random"), max_owners, example_owners))
    kept = judged.where((F.col("base")) | (F.col("verdict") == "live"))
    span = ["start", "rank", "kind", "end", "base", "verdict", "places", "repos", "owners"]
    some = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(*span))).alias("spans"))     # of one text
    bare = found.select("row", "doc", (F.size("found") == 0).alias("none"))
    empty = F.array().cast(some.schema["spans"].dataType)
    with_spans = bare.where("NOT none").join(some, "row", "left").select("doc", F.coalesce("spans", empty).alias("spans"))
    return bare.where("none").select("doc", empty.alias("spans")).unionByName(with_spans).select(F.col("doc").alias(id_col), "spans")
