"""Benchmark decontamination by templates: numbers, units and names become typed slots, windows of templates are hash-joined."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.llm.words import drop_others, hash_words, mix, portions, rolling, split_words
from spendline.session import stage_path

FILTER_BITS = 23        # the filter of benchmark windows has 2^23 bits (1 MB), whatever the number of items
LEAST_TOKENS = 3        # an item with fewer tokens is no evidence inside of a text: it matches a text that is the same words and nothing else
FEW_KEYS = 500_000      # as many flagged documents at most are broadcast

# Fixed words of slots.
UNITS = set("% mm cm m km mi ft in yd kg g mg lb lbs oz t l ml cl s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month "
            "months year years usd eur gbp dollar dollars euro euros pound pounds cent cents percent meter meters metre metres kilometer kilometers kilometre "
            "kilometres mile miles foot feet inch inches gram grams kilogram kilograms liter liters litre litres degree degrees".split())
NUMBERS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty "
              "forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice".split())
_CORE = re.compile(r"^[\W_]+|[\W_]+$")
_LITERAL, _NUMBER, _UNIT, _NAME, _NOTHING = range(5)
_SLOT = mix(np.arange(11, 15, dtype=np.uint64))


def _classify(word: str) -> tuple[int, str, bool, bool]:
    """(class, bare lower-case word, begins with a capital, ends a sentence) of a word."""
    letters = word.isalpha()        # nothing to strip, and no digit
    bare = word if letters or word == "%" else _CORE.sub("", word)
    ends = word[-1:] in ".!?:" or word[-2:-1] in ".!?"
    if not bare:
        return _NOTHING, "", False, ends
    lowered = bare.lower()
    if not letters and any(c.isdigit() for c in bare) or lowered in NUMBERS:
        return _NUMBER, lowered, False, ends
    if lowered in UNITS:
        return _UNIT, lowered, False, ends
    return _LITERAL, lowered, bare[0].isupper() and bare[1:].islower(), ends


def templates(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """For each text its tokens: template hashes, word hashes, whether each is a slot, and its number in the list of bare words. A word of punctuation is no token.

    A capitalised word inside a sentence is a name.
    """
    distinct, at, counts = split_words(texts, lower=False)
    described = [_classify(w) for w in distinct.to_pylist()]
    bare = [d[1] for d in described]
    kinds = np.array([d[0] for d in described], np.int64)
    capital, ends = np.array([d[2] for d in described], bool), np.array([d[3] for d in described], bool)
    hashes = hash_words(pa.array(bare, pa.string()))
    out, start = [], 0
    for n in counts.tolist():
        codes = at[start:start + n]
        start += n
        kind = kinds[codes].copy()
        if n > 1:
            kind[1:][(kind[1:] == _LITERAL) & capital[codes[1:]] & ~ends[codes[:-1]]] = _NAME
        real = kind != _NOTHING
        codes, kind = codes[real], kind[real]
        own = hashes[codes]
        out.append((np.where(kind == _LITERAL, own, _SLOT[np.maximum(kind, 1) - 1]), own, kind != _LITERAL, codes, bare))
    return out


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """The tokens of `templates` for all texts in one run: template hashes, word hashes, slots, numbers of bare words, the bare words, and the tokens of each text."""
    distinct, at, counts = split_words(texts, lower=False)
    described = [_classify(w) for w in distinct.to_pylist()]
    bare = [d[1] for d in described]
    kinds = np.array([d[0] for d in described], np.int64)
    capital, ends = np.array([d[2] for d in described], bool), np.array([d[3] for d in described], bool)
    kind, text = kinds[at], np.repeat(np.arange(len(counts)), counts)
    if len(at) > 1:
        kind[1:][(kind[1:] == _LITERAL) & capital[at[1:]] & ~ends[at[:-1]] & (text[1:] == text[:-1])] = _NAME
    real = kind != _NOTHING
    codes, kind, own = at[real], kind[real], hash_words(pa.array(bare, pa.string()))[at[real]]
    return np.where(kind == _LITERAL, own, _SLOT[np.maximum(kind, 1) - 1]), own, kind != _LITERAL, codes, bare, np.bincount(text[real], minlength=len(counts))


def _hits(texts: pa.Array, widths: list[int], least_literals: float, bits: np.ndarray) -> Iterator[tuple[int, int, int, int, list[str]]]:
    """(text, hash, place, windows of the text, slots) of each window of any of the widths that passes the filter; a text of fewer than `LEAST_TOKENS` tokens is one window.

    The hash of a width follows from that of the width below it, for all texts of a portion at once.
    """
    h, own, slot, codes, bare, counts = _tokens(texts)
    starts = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    left = (starts + counts)[text] - np.arange(len(h))      # tokens of the text from here on
    slots_before = np.concatenate([[0], np.cumsum(slot)])
    whole = counts[text]
    sums = [np.zeros(len(h), np.uint64), np.zeros(len(h), np.uint64)]
    for width in range(1, max(widths) + 1):
        n = len(h) - width + 1
        if n <= 0:
            return
        sums = [s[:n] * np.uint64(0x9E3779B97F4A7C15) + x[width - 1:] for s, x in zip(sums, (h, own))]
        if width >= LEAST_TOKENS and width not in widths:
            continue
        at = np.flatnonzero(left[:n] >= width if width >= LEAST_TOKENS else whole[:n] == width)
        at = at[left[at] == width] if width < LEAST_TOKENS else at
        exact = slots_before[at + width] - slots_before[at] > (width * (1 - least_literals) if width >= LEAST_TOKENS else -1)
        found = mix(mix(np.where(exact, sums[1][at], sums[0][at])) + np.uint64(width))
        where = (found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        for k in np.flatnonzero((bits[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1).tolist():
            a = int(at[k])
            values = [] if exact[k] else [bare[codes[x]] for x in range(a, a + width) if slot[x]]
            yield int(text[a]), int(found[k].view(np.int64)), a - int(starts[text[a]]), int(counts[text[a]]) - width + 1, values


def _windows(frame: DataFrame, widths: list[int], least_literals: float, sent: Broadcast | None) -> DataFrame:
    """`id`, `version`, `h` (hash of the window), `at`, `n` (windows of the text) and `slots` of all windows, or of those that pass the filter `sent`.

    A window with too few literals for a template, or of fewer than `LEAST_TOKENS` tokens, is hashed by its bare words and has no `slots`. With a filter, a text has
    windows of every width, each once. Without one, it has windows of the largest width that fits it, and those with a template by their bare words too,
    as the same words can be other slots beside other neighbours. A text of fewer than `LEAST_TOKENS` tokens is one window.
    """
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others()
        bits = sent.value if sent else None
        for batch in batches:
            for part in portions(batch):
                rows: list[tuple] = []
                if bits is not None:
                    rows.extend(_hits(part.column("text"), widths, least_literals, bits))
                for k, (h, own, slot, codes, bare) in enumerate(templates(part.column("text")) if bits is None else ()):
                    fitting = [w for w in widths if w <= len(h)] or ([len(h)] if 0 < len(h) < LEAST_TOKENS else [])
                    slots_before = np.concatenate([[0], np.cumsum(slot)])
                    for width in fitting[-1:]:
                        exact = slots_before[width:] - slots_before[:-width] > (width * (1 - least_literals) if width >= LEAST_TOKENS else -1)
                        words_hash = mix(rolling(own, width) + np.uint64(width))
                        run_hash = np.where(exact, words_hash, mix(rolling(h, width) + np.uint64(width)))
                        rows += [(k, int(words_hash[a].view(np.int64)), a, len(exact), []) for a in np.flatnonzero(words_hash != run_hash).tolist()]
                        for a in range(len(run_hash)):
                            values = [] if exact[a] else [bare[codes[x]] for x in range(a, a + width) if slot[x]]
                            rows.append((k, int(run_hash[a].view(np.int64)), a, len(exact), values))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array([r[0] for r in rows], pa.int64())), part.column("version").take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                     pa.array([r[4] for r in rows], pa.list_(pa.string()))], names=["id", "version", "h", "at", "n", "slots"])

    return frame.mapInArrow(run, f"id {kind}, version long, h long, at long, n long, slots array<string>")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 width: int = 8, least_literals: float = 0.5, min_windows: int = 1) -> DataFrame:
    """One row per document and benchmark item that it leaks: `id`, `version` (hash of the text), `item_id`, `n_windows` (matched windows of the
    item), `item_windows`, `n_slots` (distinct slot values) and `verbatim` (no slot value was changed).

    Windows of `width` template tokens are compared, items with fewer tokens as a whole. If less than the share `least_literals` of a window is
    literal, its bare words must be the same (no slots, so `n_slots` does not count them). Items of fewer than `LEAST_TOKENS` tokens match texts of the same words. A window with
    the item's own slot values, or without slots, counts by itself. Along one alignment of document and item the slots of all other windows must map one to one: a
    value of the item stands for one value of the document and the other way round, else these windows are another text with the same frame and do not count.

    A filter of fixed size keeps windows that no item has from being shuffled; what passes is joined by hash.

    Null or empty texts leak nothing. Rows that share id and text are one document, as are equal item ids; null ids are ids. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    base = stage_path(spark, "decontam")
    widths = list(range(LEAST_TOKENS, width + 1))
    items = _windows(_texts(benchmark, item_col, item_text_col), widths, least_literals, None)
    items.select(F.col("id").alias("item_id"), "h", F.col("at").alias("item_at"), F.col("n").alias("item_windows"), F.col("slots").alias("item_slots")).write.parquet(f"{base}/items")
    items = spark.read.parquet(f"{base}/items")
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    words = items.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - FILTER_BITS}) % 64 as int))")).alias("bits")).toArrow()
    filled = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    used = spark.sparkContext.broadcast(filled.view(np.uint8))
    # only the widths that items have; a single-window item may be a short one
    searched = widths if items.where(F.col("item_windows") == 1).limit(1).count() else [width]
    _windows(_texts(docs, id_col, text_col), searched, least_literals, used).write.parquet(f"{base}/hits")
    hits = spark.read.parquet(f"{base}/hits").drop("n").join(items, "h")
    changed = F.col("item_slots") != F.col("slots")
    same = hits.withColumn("changed", changed).withColumn("pair", F.explode_outer(F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))))
    distinct = lambda column, where: F.count_distinct(F.when(where, F.col(column)))      # noqa: E731
    aligned = same.groupBy("id", "version", "item_id", "item_windows", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        distinct("item_at", ~F.col("changed")).alias("equal"), distinct("item_at", F.col("changed")).alias("others"), distinct("pair", F.col("changed")).alias("pairs"),
        distinct("pair.item", F.col("changed")).alias("left"), distinct("pair.doc", F.col("changed")).alias("right"),
        distinct("pair", ~F.col("changed")).alias("equal_slots"), F.count_distinct("pair").alias("all_slots"))
    one_to_one = (F.col("pairs") == F.col("left")) & (F.col("pairs") == F.col("right"))
    good = aligned.select("id", "version", "item_id", "item_windows", (F.col("equal") + F.when(one_to_one, F.col("others")).otherwise(0)).alias("n_windows"),
                          F.when(one_to_one, F.col("all_slots")).otherwise(F.col("equal_slots")).alias("slots"), (F.col("others") == 0).alias("verbatim")).where("n_windows > 0")
    return (good.groupBy("id", "version", "item_id").agg(F.sum("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"),
                                                          F.max("slots").alias("n_slots"), F.bool_or("verbatim").alias("verbatim"))
            .where(F.col("n_windows") >= min_windows))


def decontaminate(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the documents that `leaks` (of `contaminated`) names; all columns stay."""
    spark = docs.sparkSession
    path = stage_path(spark, "leaks")
    leaks.select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct().write.parquet(path)
    keys = spark.read.parquet(path)
    if keys.count() <= FEW_KEYS:
        keys = F.broadcast(keys)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__version"))
    return docs.join(keys, same, "left_anti")
