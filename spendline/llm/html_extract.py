"""Main text of web pages: the best-scoring contiguous run of words (positive) and tags (negative)."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements whose content is no text, elements that are never main text, inline elements, void elements.
RAW = "script style noscript template textarea iframe svg math object canvas audio video select title head".split()
NOT_MAIN = "nav header footer aside form dialog menu button fieldset".split()
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter q ruby s samp small span strike "
             "strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class or id, and roles, of elements that are never main text.
NOT_MAIN_NAMES = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert "
                     "sidebar menu navbar navigation nav breadcrumb breadcrumbs footer header masthead topbar comment comments respond disqus reply replies share "
                     "sharing social related recommended recommendations popup modal overlay subscribe newsletter signup login search toolbar widget pagination "
                     "pager skip hidden".split())
NOT_MAIN_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

WORDS = {"article": 2.0, "plain": 1.0, "link": -1.0, "outside": -2.0}      # before any page is seen
TAGS = {"article": -0.1, "plain": -0.3, "link": -0.3, "outside": -1.0}
DROPPED = -3.0                                                              # a word or tag inside an element that is never main text, beside the page's article


def _excluded(name: str, attributes: str) -> bool:
    if name in NOT_MAIN:
        return True
    for key, *values in _NAMES.findall(attributes) if attributes else ():
        value, key = "".join(values).lower(), key.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in NOT_MAIN_ROLES:
            return True
        if key in ("class", "id") and name not in ("html", "body", "main", "article") and NOT_MAIN_NAMES.intersection(_SPLIT.split(value)):
            return True
    return False


def scan(page: str) -> list[tuple[str, str, str]]:
    """Tokens of a page in order: (kind, value, context).

    Kinds: `text`, `block` (a tag that ends a block), `inline`. Contexts: `dropped` (inside an element that is never main text), `inset` (the
    same, in an article or main element or on a page with neither: left out, but no reason to end the region), `article` (inside the page's article, or its main element when it has no article), `outside` (of that element), `link`,
    `plain` (on a page with neither).
    """
    tokens: list[tuple[str, str, int, bool, bool, bool]] = []      # kind, value, dropped depth, in article, in main, in link
    dropping, depth, article, main, link, at = "", 0, 0, 0, 0, 0
    closers = Counter(m.lower() for m in re.findall(r"</([a-zA-Z][^\s/>]*)", page))
    skip_to = 0
    for match in _TOKEN.finditer(page):
        if match.start() < skip_to:
            continue
        if match.start() > at:
            tokens.append(("text", page[at:match.start()], depth, article > 0, main > 0, link > 0))
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        closing = bool(match[1])
        if closing:
            closers[name] -= 1
        tokens.append(("inline" if name in INLINE else "block", name, depth, article > 0, main > 0, link > 0))
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                skip_to = at = end.end()
                closers[name] -= 1
            continue
        if name in VOID or match[3].endswith("/") and name not in INLINE:
            continue
        if depth:
            if name == dropping:
                depth += -1 if closing else 1
            continue
        if not closing and (_excluded(name, match[3]) or name == "article" and article) and closers[name] > (name == "article"):
            dropping, depth = name, 1
            tokens[-1] = tokens[-1][:2] + (1,) + tokens[-1][3:]
            continue
        step = -1 if closing else 1
        if name == "article":
            article = max(0, article + step)
        elif name == "main":
            main = max(0, main + step)
        elif name == "a":
            link = max(0, min(1, link + step))
    if at < len(page):
        tokens.append(("text", page[at:], depth, article > 0, main > 0, link > 0))
    has_article = any(k == "text" and a and not d and v.strip() for k, v, d, a, _, _ in tokens)
    has_main = any(k == "text" and m and not d and v.strip() for k, v, d, _, m, _ in tokens)
    out = []
    for kind, value, dropped, in_article, in_main, in_link in tokens:
        if dropped:
            context = "dropped" if (has_article or has_main) and not (in_article or in_main) else "inset"
        elif has_article or has_main:
            context = "article" if (in_article if has_article else in_main) else "outside"
        else:
            context = "link" if in_link else "plain"
        out.append((kind, value, context))
    return out


def count_tokens(page: str) -> Counter:
    """How many words and tags of each context a page has; the page's own article element is its label."""
    counts: Counter = Counter()
    for kind, value, context in scan(page):
        counts["word" if kind == "text" else "tag", context] += len(value.split()) if kind == "text" else 1
    return counts


def fit_weights(pages: DataFrame, html_col: str = "html") -> dict[str, dict[str, float]]:
    """Weights of words and tags by context, from all pages that mark their article themselves.

    Every word in a marked article is positive, each outside of it negative; a tag's weight follows from how often tags come
    with words in and outside of articles. Contexts that no marked page has keep their weight from before. Tasks count, Spark adds up, and the driver gets at most ten
    numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(count_tokens(page.as_py() or ""))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.string()), pa.array([c for _, c in total], pa.string()),
                                          pa.array(list(total.values()), pa.int64())], names=["kind", "context", "n"])

    rows = pages.select(html_col).mapInArrow(run, "kind string, context string, n long").groupBy("kind", "context").agg(F.sum("n").alias("n")).collect()
    n = {(r["kind"], r["context"]): r["n"] for r in rows}
    words, tags = dict(WORDS), dict(TAGS)
    inside, outside = n.get(("word", "article"), 0), n.get(("word", "outside"), 0)
    if inside:
        share = (inside + 1) / (inside + outside + 2)
        words["article"] = max(1.0, min(4.0, 1 + math.log(share / (1 - share))))
        words["outside"] = -words["article"]
        tags["article"] = -min(0.5, 0.1 * (n.get(("tag", "article"), 0) + 1) / (inside + 1))
        tags["outside"] = -min(4.0, (n.get(("tag", "outside"), 0) + 1) / (outside + 1))
    return {"words": words, "tags": tags}


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the first contiguous run with the largest positive sum; (0, 0) if no score is positive."""
    best, region, current, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if current <= 0:
            current, start = 0.0, k
        current += score
        if current > best:
            best, region = current, (start, k + 1)
    return region


def extract(page: str, weights: dict[str, dict[str, float]]) -> str:
    """The text of the best region: blocks joined by line ends, references decoded, white space made single spaces."""
    tokens = scan(page)
    scores = []
    for kind, value, context in tokens:
        if context == "inset":
            scores.append(0.0)
        elif context == "dropped":
            scores.append(DROPPED * (len(value.split()) if kind == "text" else 0.1))
        elif kind == "text":
            scores.append(weights["words"][context] * len(value.split()))
        else:
            scores.append(weights["tags"][context])
    start, end = best_region(scores)
    blocks, parts = [], []
    for kind, value, context in tokens[start:end] + [("block", "", "")]:
        if kind == "block":
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append(text)
            parts = []
        elif context in ("dropped", "inset"):
            continue
        elif kind == "text":
            parts.append(value)
        elif value == "br":
            parts.append(" ")
    return "\n".join(blocks)


def extract_main_text(pages: DataFrame, weights: dict[str, dict[str, float]] | None = None, html_col: str = "html") -> DataFrame:
    """`pages` with `text` (empty if a page has none) and `n_chars` (its code points) instead of columns of those names.

    Weights are fitted on the same pages unless given. Null or empty pages: empty text. Repeated rows and null ids are carried
    along; every other column stays. An empty table gives no rows. Nothing is shuffled; a page is one row, whatever its length.
    """
    weights = weights or fit_weights(pages, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(html_col)
            texts = [extract(x.as_py() or "", weights) for x in batch.column(at)]
            kept = [(f, c) for f, c in zip(batch.schema, batch.columns) if f.name not in ("text", "n_chars")]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[f.name for f, _ in kept] + ["text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name not in ("text", "n_chars")]
    return pages.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))
