"""Personal data: exact patterns, and further spans from labelers whose reliability is estimated without labels. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendline.session import stage_path

_OPEN, _CLOSE = "\x01", "\x02"      # marks around a match; where a text has them, they are taken as another control character
AROUND = 48                         # characters before and after a span that labelers see

#: Base kinds in their order. The patterns are the plain ones, written so that Java neither backtracks into a run nor nests calls.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a pattern to be tried at all.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]", "secret": r"[0-9]", "local": r"[0-9]", "name": r"[A-Z]"}
#: Further kinds: wide patterns for candidates.
WIDE = {
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,512}+(?![A-Za-z0-9_+/-])",
    "local": r"(?<![0-9+.(-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])(?:[0-9]{2,4}[\x20.-]){0,3}[0-9]{3,4}(?![0-9.-])",
    "name": r"(?<![A-Za-z\xC0-\xFF'-])[A-Z\xC0-\xDE][a-z\xDF-\xFF]{1,20}+(?:[\x20-][A-Z\xC0-\xDE][a-z\xDF-\xFF]{1,20}+){1,2}(?![A-Za-z\xC0-\xFF])",
}
# Gazetteers and context words.
FIRST_NAMES = ("james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah anna maria peter "
               "hans klaus ursula karin jean pierre marie nathalie sophie luc jose carmen juan ana luis pilar carlos lucia").split()
TITLES = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Sir|Herr|Frau|Monsieur|Madame|M|Mme|Don|Se[\xF1n]or|Se[\xF1n]ora|Sr|Sra)\.?\x20)$"

#: Labelers of a kind (`span`, `before`, `after` are columns); each votes for the span or not at all.
LABELERS = {
    "secret": {
        "hex": lambda s, b, a: s.rlike(r"^[0-9a-f]{32,128}$"),
        "issuer": lambda s, b, a: s.rlike(r"^(?:AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-|AIza)"),
        "context": lambda s, b, a: F.lower(b).rlike(r"(?:token|secret|passw|pwd|api|key|bearer|auth|credential)[^\n]{0,16}$"),
        "assigned": lambda s, b, a: b.rlike(r"[=:]\x20?[\"']?$"),
        "mixed": lambda s, b, a: s.rlike(r"^(?:[^0-9]*[0-9]){4}") & s.rlike(r"^(?:[^A-Za-z]*[A-Za-z]){4}"),
    },
    "local": {
        "context": lambda s, b, a: F.lower(b).rlike(r"(?:phone|tel|call|fax|mobile|cell|dial|rufnummer|t\xE9l|tel\xE9fono)[^\n]{0,12}$"),
        "area": lambda s, b, a: s.rlike(r"^\([0-9]{2,5}\)"),
        "grouped": lambda s, b, a: s.rlike(r"^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"),
        "length": lambda s, b, a: F.length(F.regexp_replace(s, "[^0-9]", "")).between(9, 12),
    },
    "name": {
        "title": lambda s, b, a: b.rlike(TITLES),
        "gazetteer": lambda s, b, a: F.lower(F.regexp_extract(s, r"^([^\x20-]+)", 1)).isin(FIRST_NAMES),
        "context": lambda s, b, a: F.lower(b).rlike(r"(?:name is|named|contact|signed|sincerely|regards|author|by:|mein name ist|je m'appelle|me llamo)[\x20:,\n]{0,3}$"),
        "verb": lambda s, b, a: a.rlike(r"^\x20(?:said|says|wrote|asked|lives|born|sagte|a dit|dijo)\b"),
    },
}
#: Shape of a span, for the final classifier.
SHAPES = {
    "long": lambda s: F.length(s) >= 24,
    "digits": lambda s: F.length(F.regexp_replace(s, "[^0-9]", "")) * 2 >= F.length(s),
    "separators": lambda s: s.rlike(r"[\x20./_+-]"),
}
KINDS = [*BASE, *WIDE]


def _parts(text: Column, kind: str) -> Column:
    """The text cut at the borders of all matches: even places lie between matches, odd ones are matches."""
    marked = F.regexp_replace(text, (BASE | WIDE)[kind], f"{_OPEN}$0{_CLOSE}")
    return F.when(text.rlike(_HINT[kind]), F.split(marked, f"[{_OPEN}{_CLOSE}]")).otherwise(F.array().cast("array<string>"))


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document and pattern match: `row`, `doc`, `kind`, `start`, `end` (code points, end exclusive), `span`, `before`, `after`; one with null kind for a
    document without matches."""
    spark = docs.sparkSession
    path = stage_path(spark, "pii-parts")
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), _OPEN + _CLOSE, "\x03\x03")
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), text.alias("text"))
    kinds = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), _parts(F.col("text"), k).alias("parts")) for k in KINDS]), lambda x: F.size(x["parts"]) > 1)
    cut = base.select("row", "doc", F.explode_outer(kinds).alias("x")).select("row", "doc", "x.kind", F.posexplode_outer("x.parts").alias("at", "part"))
    odd = F.col("at") % 2 == 1
    cut.select("row", "doc", "kind", "at", F.length("part").alias("n"), F.when(odd, F.col("part")).alias("span"),
               F.when(~odd, F.expr(f"right(part, {AROUND})")).alias("tail"), F.when(~odd, F.expr(f"left(part, {AROUND})")).alias("head")).write.parquet(path)
    order = Window.partitionBy("row", "kind").orderBy("at")
    placed = spark.read.parquet(path).select(
        "row", "doc", "kind", "at", "span", F.sum("n").over(order).alias("end"), "n", F.lag("tail").over(order).alias("before"), F.lead("head").over(order).alias("after"))
    return placed.where("kind IS NULL OR at % 2 = 1").select("row", "doc", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "span", "before", "after")


def _valid_base() -> Column:
    """Which matches of a base kind hold; the others are dropped."""
    span, kind = F.col("span"), F.col("kind")
    digits = F.regexp_replace(span, "[^0-9]", "")
    n = F.length(digits)
    parts_ok = F.forall(F.split(span, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})$"))
    single = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    doubled = F.aggregate(F.transform(single, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + x)
    return (F.when(kind == "email", True).when(kind == "ip", parts_ok).when(kind == "card", F.when(n.between(12, 19), doubled % 10 == 0).otherwise(False))
            .when(kind == "phone", n.between(9, 15)).otherwise(False))


def _bits(columns: list[Column]) -> Column:
    return F.concat(*[F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0") for c in columns])


def _pattern(kind: str) -> Column:
    s, b, a = F.col("span"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    return _bits([f(s, b, a) for f in LABELERS[kind].values()] + [f(s) for f in SHAPES.values()])


def estimate_reliabilities(counts: dict[str, int], labelers: int, rounds: int = 100) -> tuple[float, list[tuple[float, float]], dict[str, float]]:
    """Expectation-maximisation over vote patterns: share of true spans, each labeler's rate of votes on (true, false) ones, and each pattern's posterior.

    Starts from how many labelers vote; rates are smoothed by half a vote.
    """
    posterior = {p: (0.05, 0.4, 0.9)[min(2, p[:labelers].count("1"))] for p in counts}
    share, rates = 0.5, []
    for _ in range(rounds):
        true = sum(n * posterior[p] for p, n in counts.items())
        false = sum(n * (1 - posterior[p]) for p, n in counts.items())
        share = (true + 1) / (true + false + 2)
        rates = [((sum(n * posterior[p] for p, n in counts.items() if p[k] == "1") + 0.5) / (true + 1),
                  (sum(n * (1 - posterior[p]) for p, n in counts.items() if p[k] == "1") + 0.5) / (false + 1)) for k in range(labelers)]
        rates = [(max(t, f), min(t, f)) for t, f in rates]      # a vote never speaks against a span
        for p in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(t / f) if p[k] == "1" else math.log((1 - t) / (1 - f)) for k, (t, f) in enumerate(rates))
            posterior[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, rates, posterior


def train_classifier(counts: dict[str, int], posterior: dict[str, float], rounds: int = 300) -> list[float]:
    """Logistic weights (bias first) over votes and shapes, fitted to the posteriors; plain gradient steps on at most a few hundred patterns."""
    width, total = len(next(iter(counts))), sum(counts.values())
    w = [0.0] * (width + 1)
    for _ in range(rounds):
        gradient = [0.001 * x for x in w]
        for p, n in counts.items():
            x = [1.0] + [float(c) for c in p]
            miss = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x)))))) - posterior[p]
            for k, value in enumerate(x):
                gradient[k] += n / total * miss * value
        w = [a - 2.0 * g for a, g in zip(w, gradient)]
    return w


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id and `spans`, an array of (`start`, `order`, `kind`, `end`, `base`) sorted by start, then kind.

    Base kinds are exact patterns with their checks (parts of an address, Luhn sum, number of digits); matches that fail are
    dropped. Candidates of the further kinds (`secret`, `local` numbers, `name`) come from wide patterns. Regex,
    gazetteer and context labelers vote on them; all candidates of all documents are counted by vote pattern, expectation-maximisation over
    these counts (at most 256 a kind) gives each labeler's reliability and each pattern a posterior, and a logistic classifier over votes and shape, trained on
    the posteriors, decides. Further spans that overlap a base span are left out; base spans always stay.

    Null or empty text: no spans. Null ids and repeated rows are rows of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    base_path = stage_path(spark, "pii")
    found = matches(docs, id_col, text_col)
    pattern = F.lit(None).cast("string")
    for kind in WIDE:
        pattern = F.when(F.col("kind") == kind, _pattern(kind)).otherwise(pattern)
    found.select("row", "doc", "kind", "start", "end", pattern.alias("pattern"), F.when(F.col("kind").isin(*BASE), _valid_base()).alias("valid")).write.parquet(base_path)
    found = spark.read.parquet(base_path)
    tallies: dict[str, dict[str, int]] = {}
    for r in found.where("pattern IS NOT NULL").groupBy("kind", "pattern").count().collect():
        tallies.setdefault(r["kind"], {})[r["pattern"]] = r["count"]
    accepted = []
    for kind, counts in tallies.items():
        _, _, posterior = estimate_reliabilities(counts, len(LABELERS[kind]))
        weights = train_classifier(counts, posterior)
        accepted += [f"{kind}:{p}" for p in counts if "1" in p[:len(LABELERS[kind])] and weights[0] + sum(w for w, c in zip(weights[1:], p) if c == "1") >= 0]
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    good = F.when(F.col("kind").isin(*BASE), F.col("valid")).otherwise(F.concat_ws(":", "kind", "pattern").isin(*accepted) if accepted else F.lit(False))
    span = F.when(good, F.struct("start", order.alias("order"), "kind", "end", F.col("kind").isin(*BASE).alias("base")))
    rows = found.groupBy("row", "doc").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    base_spans = F.filter("spans", lambda x: x["base"])
    kept = F.filter("spans", lambda x: x["base"] | ~F.exists(base_spans, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return rows.select(F.col("doc").alias(id_col), kept.alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first is named and the rest swallowed."""
    def step(acc: Column, x: Column) -> Column:
        gap = F.when(x["start"] > acc["at"], F.substring(text, acc["at"] + 1, (x["start"] - acc["at"]).cast("int"))).otherwise("")
        name = F.when(x["start"] >= acc["at"], F.concat(F.lit("["), x["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(acc["out"], gap, name).alias("out"), F.greatest(acc["at"], x["end"].cast("int")).alias("at"))

    return F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
