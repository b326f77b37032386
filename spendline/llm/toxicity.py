"""Toxicity: a lexicon learned from labels, matched through a trie and Levenshtein automata, weighed by context."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.llm.ngram_join import linked, min_hashes, parities, possible, set_hashes
from spendline.llm.words import drop_others, kept, portions, shingles
from spendline.session import stage_path

LEAST_SHARE = 0.01      # share of the toxic documents (three at least) in which a term must stand: less may be one text and its edited copies
KNOWN_SHARE = 1 / 50_000    # share of the clean documents from which on a word near a term is a word of its own, if toxic documents do not have it more often
SAMPLE = 20_000         # labelled documents from which the weights of the contexts are fitted
LABELS_SENT = 2_000_000  # as many labels at most are broadcast (48 MB); beyond, Spark joins by shuffle
COPY_WIDTH, COPY_PERCENT = 5, 75    # documents of one label are near copies from this Jaccard similarity of their sets of word shingles on
STEMS = range(3, 8)     # lengths of word starts that can be terms
CACHE = 400_000         # matched words that a worker remembers (60 MB)

_WORD = re.compile(r"[^\W\d_]+")
#: Quotations within a line; the opening sign cannot stand inside, so unclosed ones cost no second look.
_QUOTES = re.compile("\"[^\"\\n]*\"|\u201c[^\u201c\u201d\\n]*\u201d|\u201e[^\u201e\u201c\\n]*\u201c|\u00ab[^\u00ab\u00bb\\n]*\u00bb")
#: Digits and signs that stand for letters inside of a word. Fixed values.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_ODD = re.compile(r"[013457@$!](?=[^\W\d_])")      # before a letter: cheap to look for, and most texts have none
_ODD_WORD = re.compile(r"[^\W_@$!]*(?:[@$!]+[^\W_@$!]+)+|[^\W_@$!]+")
#: Words that report what others said; within the window before a term they mark quotation.
REPORTING = set("said says say quote quoted quotes quoting called calls wrote writes word words term terms slur meaning means defined definition "
                "sagte nannte wort dit appelle mot dijo llama palabra".split())
WINDOW = 5
PRIOR = np.array([-3.0, 4.5, 2.5, 1.0])     # bias, plain hits, misspelled hits, quoted hits
PRIOR_WEIGHT = 0.5                          # how many labelled rows the prior is worth in each direction


class LevenshteinAutomaton:
    """Reads a term letter by letter; a state is the row of distances to all starts of the word, cut off above `most`."""

    def __init__(self, word: str, most: int):
        self.word, self.most = word, most

    def start(self) -> tuple[int, ...]:
        return tuple(range(len(self.word) + 1))

    def step(self, state: tuple[int, ...], letter: str) -> tuple[int, ...]:
        row = [state[0] + 1]
        for k, own in enumerate(self.word):
            row.append(min(row[k] + 1, state[k + 1] + 1, state[k] + (own != letter)))
        return tuple(min(x, self.most + 1) for x in row)

    def alive(self, state: tuple[int, ...]) -> bool:
        return min(state) <= self.most

    def accepts(self, state: tuple[int, ...]) -> bool:
        return state[-1] <= self.most


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """Terms with strengths: whole words, and word starts (`stem*`). `known` are words of clean documents, which are no misspellings."""

    def __init__(self, terms: dict[str, float], known: set[str]):
        self.words = {t: s for t, s in terms.items() if not t.endswith("*")}
        self.stems = {t[:-1]: s for t, s in terms.items() if t.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.known = known
        self.trie: dict = {}
        for term in self.words:
            node = self.trie
            if allowed_edits(term):
                for letter in term:
                    node = node.setdefault(letter, {})
                node[""] = term
        self._parts = self._automaton()
        self._cache: dict[str, tuple[str, float, bool] | None] = {}

    def _automaton(self):
        """A misspelled word holds at least one of the parts into which its term is cut, unchanged."""
        import ahocorasick
        parts = ahocorasick.Automaton()
        for term in self.words:
            edits = allowed_edits(term)
            if edits:
                cuts = [round(len(term) * k / (edits + 1)) for k in range(edits + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    parts.add_word(term[a:b], 1)
        parts.make_automaton()
        return parts

    def match(self, word: str) -> tuple[str, float, bool] | None:
        """The term a word stands for, its strength, and whether it is spelled otherwise."""
        try:
            return self._cache[word]
        except KeyError:
            if len(self._cache) >= CACHE:
                self._cache.clear()
            found = self._cache[word] = self._find(word)
            return found

    def _find(self, word: str) -> tuple[str, float, bool] | None:
        best = (word, self.words[word], False) if word in self.words else None
        for n in self.lengths:
            if n > len(word):
                break
            strength = self.stems.get(word[:n])
            if strength and (best is None or strength > best[1]):
                best = (word[:n] + "*", strength, False)
        if best or len(word) < 4 or word in self.known or not self.trie or next(self._parts.iter(word), None) is None:
            return best
        term = self._walk(self.trie, LevenshteinAutomaton(word, 2), None)
        return (term, self.words[term], True) if term else None

    def match_odd(self, word: str) -> tuple[str, float, bool] | None:
        """The term that a word of letters and look-alikes stands for, read letter by letter (a one may be an l, too)."""
        if word.isalpha() or not any(c.isalpha() for c in word):
            return None
        folded = "".join(LOOKALIKES.get(c, c) for c in word)
        for reading in (folded, "".join("l" if c == "1" else LOOKALIKES.get(c, c) for c in word)):
            if reading.isalpha() and (hit := self.match(reading)) and not hit[2]:
                return hit[0], hit[1], True
        return None

    def _walk(self, node: dict, automaton: LevenshteinAutomaton, state: tuple[int, ...] | None) -> str | None:
        """Trie and automaton side by side; of all accepted terms the strongest, then the first in the alphabet."""
        state = automaton.start() if state is None else state
        best = None
        for letter, child in node.items():
            if letter == "":
                if state[-1] <= allowed_edits(child):
                    best = min(filter(None, (best, child)), key=lambda t: (-self.words[t], t))
                continue
            following = automaton.step(state, letter)
            if automaton.alive(following):
                below = self._walk(child, automaton, following)
                best = min(filter(None, (best, below)), key=lambda t: (-self.words[t], t), default=None)
        return best

    def features(self, text: str) -> tuple[float, float, float]:
        """Strengths of the distinct terms of a text, damped: plain, misspelled, and quoted only."""
        lowered = text.lower()
        distinct = set(_WORD.findall(lowered))
        hits = {w: m for w in distinct if (m := self.match(w))}
        odd = {w: m for w in set(_ODD_WORD.findall(lowered)) if (m := self.match_odd(w))} if _ODD.search(lowered) else {}
        if not hits and not odd:
            return 0.0, 0.0, 0.0
        quoted = [m.span() for m in _QUOTES.finditer(lowered)]
        words = list(_WORD.finditer(lowered))
        if odd:
            words = sorted([*words, *(m for m in _ODD_WORD.finditer(lowered) if m[0] in odd)], key=lambda m: m.start())
            hits |= odd
        strengths: dict[str, tuple[float, int]] = {}     # term -> strength and rank: 0 quoted, 1 misspelled, 2 plain
        for k, found in enumerate(words):
            hit = hits.get(found[0])
            if hit is None:
                continue
            inside = _within(quoted, found.start())
            reported = any(w[0] in REPORTING for w in words[max(0, k - WINDOW):k])
            rank = 0 if inside or reported else 1 if hit[2] else 2
            if rank > strengths.get(hit[0], (0.0, -1))[1]:
                strengths[hit[0]] = (hit[1], rank)
        sums = [0.0, 0.0, 0.0]
        for strength, rank in strengths.values():
            sums[2 - rank] += strength
        return tuple(math.log1p(x) for x in sums)


def _within(spans: list[tuple[int, int]], at: int) -> bool:
    low, high = 0, len(spans)
    while low < high:
        mid = (low + high) // 2
        if spans[mid][1] <= at:
            low = mid + 1
        else:
            high = mid
    return low < len(spans) and spans[low][0] <= at


@dataclass
class ToxicityModel:
    terms: dict[str, float]
    known: set[str] = field(default_factory=set)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def score(self, features: tuple[float, float, float]) -> float:
        z = float(self.weights @ np.array([1.0, *features]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms_of(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if n < len(w)}


def _fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards `PRIOR`; hits never count against toxicity."""
    w = PRIOR.copy()
    x = np.c_[np.ones(len(x)), x]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + PRIOR_WEIGHT * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + PRIOR_WEIGHT * np.eye(4), gradient)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return np.r_[w[0], np.maximum(w[1:], 0)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn lexicon and weights from the labelled documents (null labels are none; of several labels of a document the largest holds).

    Near copies count once (see `first_copies`). A term is a word or a
    word start that is significantly more frequent in toxic documents. Counts cover all labelled documents; only the four
    weights come from a sample of at most `SAMPLE` (those with the smallest hash of their id).
    """
    spark = docs.sparkSession
    base = stage_path(spark, "toxicity")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known.write.parquet(f"{base}/labels")
    known = spark.read.parquet(f"{base}/labels")
    few = known.count() <= LABELS_SENT
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(known) if few else known, "id")
    kind = joined.schema["id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole)):
            sets = shingles(batch.column("text"), COPY_WIDTH)
            s1, s2 = zip(*map(set_hashes, sets))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(s) for s in sets], pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array([min_hashes(s) for s in sets], pa.list_(pa.int64())), pa.array([parities(s) for s in sets], pa.binary())],
                names=[*batch.schema.names, "n", "s1", "s2", "sketch", "parity"])

    joined.select("id", "text", "toxic", F.monotonically_increasing_id().alias("key")).mapInArrow(
        signed, f"id {kind}, text string, toxic int, key long, n long, s1 long, s2 long, sketch array<long>, parity binary").write.parquet(f"{base}/labelled")
    labelled = spark.read.parquet(f"{base}/labelled")
    chosen = first_copies(labelled, base, few)
    train = labelled.join(F.broadcast(chosen) if few else chosen, "key", "left_semi")
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel({})

    def count(batches: Iterator[pa.RecordBatch], among: set[str] | None) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                terms = _terms_of(text.as_py())
                total.update(terms if among is None else among & terms)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    least = max(3, math.ceil(LEAST_SHARE * toxic))
    found = (train.where("toxic = 1").select("text").mapInArrow(lambda b: count(b, None), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= least).toArrow())     # a hundred times the terms of a document at most
    in_toxic = dict(zip(found.column("term").to_pylist(), found.column("n").to_pylist()))
    sent = spark.sparkContext.broadcast(set(in_toxic))
    counted = (train.where("toxic = 0").select("text").mapInArrow(lambda b: count(b, sent.value), "term string, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    in_clean = dict(zip(counted.column("term").to_pylist(), counted.column("n").to_pylist()))
    terms = choose_terms(in_toxic, in_clean, toxic, clean)
    model = ToxicityModel(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Lexicon(terms, set())
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                total.update(w for w in set(_WORD.findall(text.as_py().lower())) if (m := probe.match(w)) and m[2])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    if terms:
        words = [train.where(F.col("toxic") == k).select("text").mapInArrow(near, "word string, n long").groupBy("word").agg(F.sum("n").alias(name)) for k, name in enumerate(("c", "t"))]
        met = words[0].where(F.col("c") >= KNOWN_SHARE * clean).join(words[1], "word", "left").where(F.col("c") * toxic >= F.coalesce("t", F.lit(0)) * clean)
        model.known = set(met.select("word").toArrow().column("word").to_pylist())
        sample = train.orderBy(F.xxhash64("id"), "id").select("key").limit(SAMPLE)

        def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon = Lexicon(terms, model.known)
            for batch in batches:
                rows = [lexicon.features(t.as_py()) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]],
                                                 names=["toxic", "plain", "misspelled", "quoted"])

        rows = (train.join(F.broadcast(sample), "key", "left_semi").select("text", "toxic")
                .mapInArrow(described, "toxic int, plain double, misspelled double, quoted double").toArrow())
        x = np.stack([rows.column(c).to_numpy() for c in ("plain", "misspelled", "quoted")], 1)
        model.weights = _fit_weights(x, rows.column("toxic").to_numpy().astype(float))
    return model


def first_copies(labelled: DataFrame, base: str, few: bool) -> DataFrame:
    """`key` and `toxic` of the rows of `labelled` that are no near copies of a row of the same label with a smaller id.

    Of equal shingle sets the smallest id stays. A row is a near copy if its set reaches `COPY_PERCENT` with the set of the first row in one of its min-hash
    buckets; every such pair is verified, so rows that only share a passage stay. `few`: the keys may be broadcast.
    """
    spark = labelled.sparkSession
    first = F.min(F.struct("id", "key"))["key"]
    labelled.groupBy("s1", "s2", "n", "toxic").agg(first.alias("key")).select("key").write.parquet(f"{base}/distinct")
    distinct = spark.read.parquet(f"{base}/distinct")
    sets = labelled.drop("text").join(F.broadcast(distinct) if few else distinct, "key", "left_semi")
    buckets = sets.select("id", "key", "toxic", F.posexplode("sketch").alias("k", "value"))
    buckets.groupBy("k", "value", "toxic").agg(first.alias("a"), F.count("*").alias("m")).where("m > 1").drop("m").write.parquet(f"{base}/leaders")
    pairs = buckets.join(spark.read.parquet(f"{base}/leaders"), ["k", "value", "toxic"]).where("a <> key").select("a", F.col("key").alias("b")).distinct()
    possible(pairs, sets.select(F.col("key").alias("id"), "n", "parity"), COPY_PERCENT).write.parquet(f"{base}/pairs")
    pairs = spark.read.parquet(f"{base}/pairs")
    met = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    texts = labelled.select("key", "text").join(F.broadcast(met) if few else met, "key", "left_semi").select(F.col("key").alias("id"), "text")
    linked(pairs, texts, COPY_WIDTH, COPY_PERCENT).select(F.col("b").alias("key")).distinct().write.parquet(f"{base}/near")
    near = spark.read.parquet(f"{base}/near")
    sets.select("key", "toxic").join(F.broadcast(near) if few else near, "key", "left_anti").write.parquet(f"{base}/chosen")
    return spark.read.parquet(f"{base}/chosen")


def choose_terms(in_toxic: dict[str, int], in_clean: dict[str, int], toxic: int, clean: int) -> dict[str, float]:
    """Terms whose share in toxic documents is beyond chance, with strengths in (0, 1].

    A term needs a likelihood ratio of at least what the best of so many candidates reaches by chance, a log-odds of at least 2.5, and three toxic documents
    for each clean one. Of word starts and words that lie in each other, those with the larger ratio stay; of equals the longest.
    """
    def ratio(t: int, c: int) -> float:
        all_rows, out = toxic + clean, 0.0
        for seen, expected in ((t, (t + c) * toxic / all_rows), (c, (t + c) * clean / all_rows),
                               (toxic - t, (all_rows - t - c) * toxic / all_rows), (clean - c, (all_rows - t - c) * clean / all_rows)):
            if seen > 0 and expected > 0:
                out += seen * math.log(seen / expected)
        return 2 * out

    bar = 2 * math.log(max(len(in_toxic), 10))
    scored = {}
    for term, t in in_toxic.items():
        c = in_clean.get(term, 0)
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if odds >= 2.5 and t >= 3 * c * toxic / clean and (value := ratio(t, c)) >= bar and t > 3 * c:
            scored[term] = (value, odds)
    kept: dict[str, float] = {}
    for term in sorted(scored, key=lambda x: (-scored[x][0], -len(x.rstrip("*")), x)):
        stem = term.rstrip("*")
        if any(stem[:n] + "*" in kept for n in range(2, len(stem) + 1)):
            continue
        if term.endswith("*") and any(k.rstrip("*").startswith(stem) for k in kept):
            continue
        kept[term] = min(1.0, scored[term][1] / 5)
    return kept


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from 0.5 on) instead of columns of those names.

    Null and empty texts get the score of a text without terms. Every row and column stays, and whole texts are read, one at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(_LEXICON)
        lexicon = _lexicon(model)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            scores = [model.score(lexicon.features(t.as_py() or "")) for t in batch.column(at)]
            kept = [(f.name, c) for f, c in zip(batch.schema, batch.columns) if f.name not in ("score", "predicted")]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                             names=[n for n, _ in kept] + ["score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("score", "predicted")]
    return docs.mapInArrow(run, ", ".join([*fields, "score double, predicted int"]))


_LEXICON: dict[int, Lexicon] = kept({})


def _lexicon(model: ToxicityModel) -> Lexicon:
    """The worker's lexicon, at most one: the tasks that a worker runs one after the other share its matched words."""
    key = hash((frozenset(model.terms.items()), frozenset(model.known)))
    if key not in _LEXICON:
        _LEXICON.clear()
        _LEXICON[key] = Lexicon(model.terms, model.known)
    return _LEXICON[key]
