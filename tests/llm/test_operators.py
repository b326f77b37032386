"""The training-data operators against brute force, on small hand-made rows with nulls, empties, ties, repeats and clashing columns."""

import base64
import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendline.llm import chat, components, decontam, html_extract, line_dedup, multi_index, ngram_join, packing, pii, tokens, toxicity, warc
from spendline.llm.words import PORTION, portions
from spendline.session import stage_path

DOC = "doc_id long, text string, lang string, score double, id long, version long"      # clashing names on purpose
RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choice("abcdeilnorst") for _ in range(RANDOM.randint(2, 8))) for _ in range(400)]


def words(n):
    return " ".join(RANDOM.choice(VOCABULARY) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", 0.5, 1, 2) for i, t in rows], DOC)


# ---------------------------------------------------------------------- tokens and packing

ODD = ["", " ", "  a", "a  b", "a \n b", "\n", " \n\n x", "it's he'll", "a\tb  c", "é ü", "<|endoftext|> a", "x\0y", "a a a a ", "b \n", "a  b", "  x", "日本 語", "🙂 ok"]


def test_ids_equal_those_of_tokenizers():
    public = pytest.importorskip("public_tokenizers")
    reference = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ODD + [words(50) for _ in range(20)]
    flat, sizes = tokens.encoder().encode(pa.array(texts))
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_added_tokens_have_their_own_ids(spark):
    public = pytest.importorskip("public_tokenizers")
    reference = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, end * 2, f"x{end}y", f" {end} ", f"a  {end}  b\n{end}", "plain", "", "<|endoftext|", f"{end} some more words", f"a \n {end}\n b "]
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    flat, sizes = tokens.encoder().encode(pa.array([*texts, None]))
    assert sizes.tolist() == [len(x) for x in want] + [0] and flat.tolist() == [i for x in want for i in x]
    out = packing.pack_documents(documents(spark, list(enumerate(texts)))).collect()
    assert all([i for r in sorted(out, key=lambda r: r.start) if r.doc_id == k for i in r.ids] == [*ids, 0] for k, ids in enumerate(want))


def test_packing_keeps_every_id_once(spark):
    rows = [(i, words(RANDOM.choice([1, 3, 40, 900]))) for i in range(150)] + [(None, "x y"), (500, None), (501, ""), (7, "again"), (7, "again")] + list(enumerate(ODD, 600))
    out = packing.pack_documents(documents(spark, rows).repartition(3)).collect()
    encode = tokens.encoder()
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
    for key, texts in itertools.groupby(sorted(rows, key=lambda x: (x[0] is None, x[0])), key=lambda x: x[0]):
        want = Counter()
        for _, text in texts:
            want.update(Counter([tuple(encode.encode(pa.array([text or ""]))[0].tolist() + [0])]))
        joined = sorted(pieces[key], key=lambda r: r.start)
        if sum(want.values()) == 1:
            assert tuple(i for r in joined for i in r.ids) == next(iter(want))
            assert all(r.doc_tokens == len(next(iter(want))) for r in joined)
        else:
            assert sum(r.length for r in joined) == sum(len(k) * n for k, n in want.items())
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    padding = total = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        total += at
    assert padding < 0.03 * total


def test_packing_limits_hold_at_once(spark):
    frame = spark.createDataFrame([(i, words(RANDOM.randint(1, 60)), RANDOM.choice([None, 0, 10, 500])) for i in range(80)] + [(99, words(700), 600)], "doc_id int, text string, skip int")
    out = packing.pack_documents(frame, loss_from_col="skip", capacity=128, max_segments=3, max_loss=50).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r.sequence_id].append(r)
    for members in groups.values():
        assert sum(r.length for r in members) <= 128 and len(members) <= 3 and sum(r.loss_tokens for r in members) <= 50
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())
    assert packing.pack_documents(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(frame, capacity=0)


# ---------------------------------------------------------------------- line dedup

def strip_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup_equals_brute_force(spark, keep_first):
    pool = ["All rights reserved.", " all RIGHTS reserved.\t", "Ärger", "ärger", "", "  ", "x", "unique"] + [words(4) for _ in range(20)]
    rows = [(i, "\n".join(RANDOM.choice(pool) for _ in range(RANDOM.randint(1, 90)))) for i in range(60)] + [(100, None), (101, ""), (102, "\n\n"), (None, "x\nAll rights reserved.")]
    rows += [(5, rows[5][1])]      # a repeated row is the same document
    docs = list(dict.fromkeys(rows))
    holders = defaultdict(list)
    order = lambda d: (d[0] is not None, d[0] or 0)     # noqa: E731
    for d in sorted(docs, key=order):
        for position, line in enumerate((d[1] or "").split("\n")):
            if strip_key(line):
                holders[strip_key(line)].append((d, position))
    common = {k for k, v in holders.items() if len({d for d, _ in v}) >= 8}
    first = {v[0] for k, v in holders.items() if k in common} if keep_first else set()
    want = []
    for d in rows:
        lines = (d[1] or "").split("\n")
        kept = [x for p, x in enumerate(lines) if strip_key(x) not in common or (d, p) in first]
        want.append((d[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    out = line_dedup.dedup_lines(documents(spark, rows), min_docs=8, keep_first=keep_first)
    assert sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == sorted(want, key=str)
    assert set(DOC.replace(",", "").split()[::2]) <= set(out.columns)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


# ---------------------------------------------------------------------- n-gram join

def brute_sets(rows, width=5):
    out = {}
    for i, text in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        out.setdefault(i, []).append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute_components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def edited(text, n):
    w = text.split()
    for _ in range(n):
        w[RANDOM.randrange(len(w))] = RANDOM.choice(VOCABULARY)
    return " ".join(w)


def test_ngram_join_equals_brute_force(spark):
    rows, key = [], itertools.count()
    passage = words(60)
    for _ in range(12):
        original = words(RANDOM.choice([3, 8, 30, 120, 300]))
        for _ in range(RANDOM.randint(1, 8)):
            copy = edited(original, RANDOM.choice([0, 0, 1, 2, 4]))
            rows.append((next(key), RANDOM.choice([copy, copy.upper(), "  " + copy.replace(" ", "\t\n")])))
    rows += [(next(key), f"{words(30)} {passage} {words(RANDOM.choice([2, 5, 40]))}") for _ in range(25)]
    rows += [(next(key), t) for t in (None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d e f")]
    rows += [(3, rows[3][1]), (4, words(40))]      # a repeated row, and an id with two texts
    sets = brute_sets(rows)
    links = [(a, b) for (a, xs), (b, ys) in itertools.combinations(sets.items(), 2) for x in xs for y in ys if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    group = brute_components(sets, links)
    got = [tuple(r) for r in ngram_join.near_duplicates(documents(spark, rows + [(None, passage)]).repartition(4)).collect()]
    want = [(i, len(s), group[i]) for i, xs in sets.items() for s in xs]
    assert sorted(x for x in got if x[0] is not None) == sorted(want)
    assert [x for x in got if x[0] is None] == [(None, 56, None)]
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0


def test_tree_overlaps_equal_plain_intersections():
    rng = np.random.default_rng(3)
    for percent in (50, 75, 90):
        hub = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        members = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(60)] + [hub, hub[:-1], hub[1:]]
        want = [100 * len(np.intersect1d(hub, m)) >= percent * len(np.union1d(hub, m)) for m in members]
        assert ngram_join.tree_overlaps(hub, members, percent) == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges + [(None, 5)], "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 199: 199, 200: 199}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------------- decontamination

def test_templates_find_changed_slots_and_refuse_mixed_ones(spark):
    item = "If Anna buys 12 apples and gives 5 apples to Peter then how many apples does Anna have after 12 days of the long journey home"
    other = item.replace("12", "30").replace("5", "7").replace("Anna", "Maria").replace("Peter", "Luis")
    # no window of eight words is unchanged, and twelve stands for two numbers
    mixed = "If Maria buys 30 apples and gives 7 apples to Luis then how many apples does Maria have after 44 days of the long journey home"
    item, other, mixed = (x.replace(" of the long journey home", " or so") for x in (item, other, mixed))
    noise = "some quite ordinary words before . "
    rows = [(1, noise + item + " . and after"), (2, noise + other), (3, noise + mixed), (4, words(60)), (5, None), (6, ""), (7, item.upper()), (None, item), (8, "tiny item text"), (1, noise + item + " . and after")]
    benchmark = spark.createDataFrame([(10, item), (11, None), (12, "ab"), (13, "tiny item text"), (14, "")], "item_id long, text string")
    leaks = decontam.contaminated(documents(spark, rows), benchmark)
    got = {(r.id, r.item_id): r for r in leaks.collect()}
    assert set(got) == {(1, 10), (2, 10), (7, 10), (None, 10), (8, 13)}
    assert got[1, 10].verbatim and not got[2, 10].verbatim and got[2, 10].n_slots >= 3
    assert not any(r.n_windows > 0 for k, r in got.items() if k[0] == 3)
    kept = [r.doc_id for r in decontam.decontaminate(documents(spark, rows), leaks).collect()]
    assert sorted(kept) == [3, 4, 5, 6]
    assert decontam.contaminated(documents(spark, []), benchmark).count() == 0
    assert decontam.contaminated(documents(spark, rows), benchmark.limit(0)).count() == 0


def test_a_changed_slot_does_not_hide_unchanged_windows(spark):
    passage = " ".join(VOCABULARY[:30])
    item = f"Take 12 steps {passage} and then go 12 steps on along the old road to the river"
    frame = "the box of {} holds more than the box of {} but less than the box of {}"
    rows = [(1, item.replace("go 12", "go 44")), (2, passage), (3, item), (4, item.replace("12", "44")), (5, frame.format(1, 2, 2)), (6, frame.format(4, 5, 6))]
    benchmark = spark.createDataFrame([(10, item), (11, frame.format(1, 2, 3))], "item_id long, text string")
    got = {(r.id, r.item_id): r for r in decontam.contaminated(documents(spark, rows), benchmark).collect()}
    assert set(got) == {(1, 10), (2, 10), (3, 10), (4, 10), (5, 11), (6, 11)}
    assert got[2, 10].n_windows < got[1, 10].n_windows == got[3, 10].n_windows and not got[1, 10].verbatim and got[2, 10].verbatim
    reused = frame.format(7, 7, 8)      # changed windows alone, and not one to one
    assert decontam.contaminated(documents(spark, [(7, reused)]), benchmark).count() == 0


def test_items_that_are_mostly_slots_match_word_for_word(spark):
    items = {20: "Compute 12 + 7 * 3 - 4 / 2", 21: "Who Wrote The Famous Novel War And Peace In Russia", 22: "Convert 5 km 30 m 12 cm to 7 ft", 23: "Why not", 24: "3 1 4 1 5 9 2 6 5 3 5"}
    rows = [(k, f"some quite ordinary words before . {text} . and after") for k, text in items.items()] + [(30, "Compute 12 + 7 * 3 - 4 / 9"), (31, "why NOT?"), (32, items[21].lower()), (33, "")]
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.id, r.item_id): r for r in decontam.contaminated(documents(spark, rows), benchmark).collect()}
    assert set(got) == {(20, 20), (21, 21), (22, 22), (24, 24), (31, 23), (32, 21)} and all(r.verbatim for r in got.values())


# ---------------------------------------------------------------------- main text

WEIGHTS = {"words": html_extract.WORDS, "tags": html_extract.TAGS}
PAGES = {
    "article": ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
                "<main><article><h1>T&amp;C</h1><p>Hello <b>wor</b>ld &eacute;\n x<p>Two<br>lines<script>var a='</p>'</script><div class=ad>buy now</div><ul><li>one<li>two</ul></article>"
                "<section id=comments><article>nice post</article></section></main><aside>side</aside><footer>foot</footer></body></html>", "T&C\nHello world é x\nTwo lines\none\ntwo"),
    "plain": ("<body><div id=menu><ul><li><a>Home</a></ul></div><h2>Title</h2><p>Some long text of the page.</p><p>And more.</p><form><label>Name</label></form><div class=footer>f</div>",
              "Title\nSome long text of the page.\nAnd more."),
    "nested": ("<article><p>first words here</p><article class=reply>a reader</article><p>last words</p></article>", "first words here\nlast words"),
    "text": ("only words", "only words"), "empty": ("", ""), "tags": ("<p></p>", ""),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_main_text(name):
    assert html_extract.extract(PAGES[name][0], WEIGHTS) == PAGES[name][1]


@pytest.mark.parametrize("block", ["<div class=ad>five words of an advert</div>", "<form><label>your name here please now</label><input></form>", "<aside><p>" + "more of it " * 90 + "</aside>",
                                   "<div class=share><a>share</a><a>send</a></div><div class='cookie-notice'>" + "we use cookies " * 30 + "</div>"])
def test_a_left_out_block_does_not_end_the_region_of_a_plain_page(block):
    short, long = "<p>ten words of text that stand before what is inserted</p>", "<p>" + "and then twice as many words of it " * 3 + "</p>"
    text = lambda *parts: "\n".join(" ".join(p[3:-4].split()) for p in parts)      # noqa: E731
    for before, after in ((short, long), (long, short), (long, long)):
        assert html_extract.extract(f"<body><div id=menu>Home</div>{before}{block}{after}<footer>end</footer></body>", WEIGHTS) == text(before, after)
    assert html_extract.extract(f"<article>{long}</article>{block}<div><p>other</p></div>", WEIGHTS) == text(long)


def test_main_text_of_a_table(spark):
    rows = [(k, f"http://x/{k}", page, "old", 3) for k, (page, _) in enumerate(PAGES.values())] + [(None, None, None, None, None), (0, "again", PAGES["article"][0], "", 0)]
    out = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert {r.page_id: r.text for r in out if r.url != "again"}[0] == PAGES["article"][1] and {r.page_id: r.text for r in out}[None] == ""
    assert html_extract.extract_main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_best_region_equals_all_regions():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.randint(-3, 3) for _ in range(rng.randint(0, 12))]
        start, end = html_extract.best_region(scores)
        assert sum(scores[start:end]) == max([0] + [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)])


# ---------------------------------------------------------------------- chats

def test_snapshots_collapse(spark):
    a = [("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", None)]
    talks = {1: a[:2], 2: a, 3: a[:1], 4: a, 5: [("user", "hi"), ("assistant", "no")], 6: [(None, "hi")], 7: [("user", "hi"), ("user", "yes")], None: [("user", "alone")]}
    long_talk = [("user", str(k)) for k in range(600)]
    talks |= {8: long_talk, 9: long_talk[:300], 10: long_talk[:299] + [("user", "x")]}
    rows = [(c, k, r, t, "extra") for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    RANDOM.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string")
    out = chat.format_chats(frame).collect()
    got = {c: "".join(r.rendered for r in sorted((x for x in out if x.conv_id == c), key=lambda r: r.part)) for c in {r.conv_id for r in out}}
    show = lambda turns: "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)       # noqa: E731
    assert got == {c: show(talks[c]) for c in (2, 5, 6, 7, 8, 10, None)}
    assert {r.conv_id: r.n_copies for r in out}[2] == 2 and {r.conv_id: r.n_turns for r in out}[8] == 600
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ---------------------------------------------------------------------- toxicity

@pytest.mark.parametrize("word,term,edits", [("idiot", "idiot", 0), ("idoit", "idiot", 2), ("idot", "idiot", 1), ("idioot", "idiot", 1), ("xdiot", "idiot", 1), ("", "ab", 2)])
def test_levenshtein_automaton(word, term, edits):
    for most in (0, 1, 2):
        automaton = toxicity.LevenshteinAutomaton(word, most)
        state = automaton.start()
        for letter in term:
            state = automaton.step(state, letter)
        assert automaton.accepts(state) == (edits <= most)


def test_lexicon_matches_like_brute_force():
    terms = {"idiot": 1.0, "worthless": 0.9, "scum": 0.8, "vequ*": 0.7}
    lexicon = toxicity.Lexicon(terms, {"idiom"})
    assert lexicon.match("idiot") == ("idiot", 1.0, False) and lexicon.match("idiott") == ("idiot", 1.0, True) and lexicon.match("idiom") is None
    assert lexicon.match("wrothless") == ("worthless", 0.9, True) and lexicon.match("scvm") is None and lexicon.match("vequais") == ("vequ*", 0.7, False)
    assert lexicon.features('the word "idiot" is')[0] == 0 < lexicon.features("you idiot")[0] and lexicon.features("you idi0t idiott")[1] > 0
    assert lexicon.features("") == (0.0, 0.0, 0.0)


def test_look_alikes_and_long_quotations():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "scum": 0.8, "belly": 0.5, "vequ*": 0.7}, set())
    assert lexicon.match_odd("1d10t") == ("idiot", 1.0, True) and lexicon.match_odd("be11y") == ("belly", 0.5, True) and lexicon.match_odd("v3qual$") == ("vequ*", 0.7, True)
    assert all(lexicon.match_odd(w) is None for w in ("idiot", "1010", "x3y", "", "$$$", "id10tt5"))
    assert lexicon.features("you 1d10t!")[1] > 0 and lexicon.features("id10t")[1] > 0 == lexicon.features("at 10 am, 5x5, idi- 0t")[1] and lexicon.features('he said "you 1d10t"')[1] == 0
    long = "lorem " * 2000
    assert lexicon.features(f'they wrote: "{long} scum {long}" yesterday')[0] == 0 < lexicon.features(f'"{long}" and you scum "{long}"')[0]
    start = time.perf_counter()
    lexicon.features("scum " + "\u201e\u00ab\u201c x " * 200_000)
    assert time.perf_counter() - start < 20


def test_portions_keep_every_row_in_order():
    texts = [None, "", "x" * (3 << 20), *["y" * 5000] * 900, "z"]
    parts = list(portions(pa.RecordBatch.from_pydict({"k": list(range(len(texts))), "text": pa.array(texts)})))
    assert [k for p in parts for k in p.column("k").to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= PORTION for p in parts) and len(parts) < 12


def test_toxicity_learns_from_labels(spark):
    rows = [(i, words(30) + (" grumpf " + words(5) + " blorgen" if i % 4 == 0 else "")) for i in range(240)] + [(900, None), (901, ""), (None, words(5)), (902, words(200) + " grumpff, blorgen")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)] + [(3, 0, None), (None, 1, 1), (5000, 0, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    model = toxicity.fit(docs, labels)
    assert {"grumpf", "blorgen"} <= set(model.terms) and len(model.terms) < 6
    out = toxicity.score(docs, model)
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(240)) and got[902].predicted == 1
    assert got[900].predicted == got[901].predicted == got[None].predicted == 0 and 0 <= got[900].score == got[901].score < 0.5
    assert out.columns == ["doc_id", "text", "lang", "id", "version", "score", "predicted"]
    assert toxicity.fit(docs, labels.limit(0)).terms == {} and toxicity.fit(docs.limit(0), labels).terms == {}


def test_only_verified_copies_count_once(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))      # noqa: E731
    passage, body = some(60), some(80)
    # a shared passage makes no copies; equal sets and one changed word do
    rows = [(k, f"{passage} {some(40)} grumpf {some(5)}") for k in range(30)] + [(100 + k, f"{passage} {some(40)}") for k in range(40)]
    rows += [(200, f"{body} grumpf"), (201, f"{body} GRUMPF"), (202, f"{body} grumpf x"), (202, f"{body} grumpf x"), (203, f"{body} grumpf"), (204, ""), (205, " ")]
    labels = spark.createDataFrame([(i, int("grumpf" in t.lower() and i != 203)) for i, t in dict(rows).items()], "doc_id long, toxic int")
    seen, choose = {}, toxicity.choose_terms

    def spy(in_toxic, in_clean, toxic, clean):
        seen.update(grumpf=in_toxic["grumpf"], toxic=toxic, clean=clean, among=in_clean.get("grumpf"))
        return choose(in_toxic, in_clean, toxic, clean)

    toxicity.choose_terms = spy
    try:
        model = toxicity.fit(documents(spark, rows).repartition(3), labels)
    finally:
        toxicity.choose_terms = choose
    assert seen == {"grumpf": 31, "toxic": 31, "clean": 42, "among": 1} and "grumpf" in model.terms


# ---------------------------------------------------------------------- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_patterns(spark):
    alphabet = "a.@-_0159 +()%\n\x01é🙂"
    texts = ["".join(RANDOM.choice(alphabet) for _ in range(RANDOM.randint(0, 60))) for _ in range(400)]
    texts += ["me@x.org, you@y.co.uk_z@w.de", "x@abc@def.com", "1.2.3.4.5.6.7.8 256.1.1.1 0010.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112", "call +1 (755) 555-9729 now", "1" * 5000, "1 " * 5000,
              "a" * 5000 + "@", "+1" + "2" * 20, None, "", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']
    rows = list(enumerate(texts)) + [(None, "me@x.org"), (0, texts[0])]
    got = pii.find_spans(documents(spark, rows))
    answers = sorted(((r.doc_id, [(s["start"], s["order"] - 1, s["kind"], s["end"]) for s in r.spans if s["base"]]) for r in got.collect()), key=str)
    assert answers == sorted(((i, brute_spans(t)) for i, t in rows), key=str)
    assert pii.find_spans(documents(spark, [])).count() == 0


def test_labelers_agree_on_secrets(spark):
    secret = lambda: "".join(RANDOM.choice("0123456789abcdef") for _ in range(40))      # noqa: E731
    rows = [(i, f'{words(6)} token = "{secret()}" {words(4)}') for i in range(30)] + [(100 + i, f"{words(5)} {words(2).replace(' ', '')}abcdefghijk{i} {words(4)}") for i in range(30)]
    spans = {r.doc_id: [s["kind"] for s in r.spans] for r in pii.find_spans(documents(spark, rows)).collect()}
    assert all("secret" in spans[i] for i in range(30)) and not any(spans[100 + i] for i in range(30))
    masked = pii.find_spans(documents(spark, [(1, "to me@x.org now")])).withColumn("text", F.lit("to me@x.org now")).select(pii.mask(F.col("text"), F.col("spans"))).first()[0]
    assert masked == "to [email] now"


def test_estimation_separates_patterns():
    counts = {"111": 50, "110": 20, "000": 500, "100": 30, "001": 15}
    share, rates, posterior = pii.estimate_reliabilities(counts, 3)
    assert posterior["111"] > 0.9 > 0.5 > posterior["000"] and 0 < share < 0.5 and all(t >= f for t, f in rates)
    weights = pii.train_classifier(counts, posterior)
    assert weights[0] < 0 < weights[0] + sum(weights[1:])


# ---------------------------------------------------------------------- embeddings

def test_multi_index_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    vectors = [base[k % 60] + rng.normal(scale=0.03 if k >= 60 else 0, size=16) for k in range(400)] + [base[0]] * 30 + [base[1] * 7.0]
    rows = [(k, [float(x) for x in v], k % 3) for k, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] + [1.0] * 15, 1), (1003, [None] + [1.0] * 15, 1), (1004, rows[0][1], None), (1005, rows[0][1][:8], 0),
             (1006, [1e300] * 16, 2), (1007, [2e300] * 16, 2), (1008, [], 1), (None, rows[0][1], 0), (1009, [float("inf")] * 16, 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, copies string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(frame, codewords=8, target_recall=1.0).collect()}
    good = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = {i: np.array(v) / np.abs(v).max() for i, v, _ in good}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = [(a[0], b[0]) for a, b in itertools.combinations(good, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and unit[a[0]] @ unit[b[0]] >= 0.98]
    degree, group = Counter(x for pair in links for x in pair), brute_components([r[0] for r in rows if r[0] is not None], links)
    for i in group:
        assert got[i] == (degree[i], group[i], group[i] == i)
    assert got[None][0] == 0 and len(got) == len(rows)
    assert multi_index.near_duplicates(frame.limit(0)).count() == 0


def test_grid_reaches_the_target():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(3000, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    grid = multi_index.Grid(unit, 16, 0.98, 0.95)
    row, i, j = grid.visits(unit)
    assert len(set(zip(row.tolist(), i.tolist(), j.tolist()))) == len(row) < 3000 * 60
    home = set(zip(range(3000), *[x.tolist() for x in grid.home(unit)]))
    assert home <= set(zip(row.tolist(), i.tolist(), j.tolist()))


# ---------------------------------------------------------------------- WARC

def test_archive_round_trip(spark):
    rows = [(1, "http://a", "<p>x</p>", "z"), (2, "http://b", "<p>x</p>", "z"), (3, "http://c\r\nEvil: 1", "é\r\n\r\nWARC/1.1\r\n\r\n", "z"), (4, None, None, None), (5, "http://e", "", ""),
            (None, "http://n", "<p>x</p>", ""), (None, "http://m", "only null", ""), (7, "http://g", "x" * 300_000, "")]
    path = stage_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3), path)
    records = warc.read_archive(spark, path)
    assert records.count() == 3 * len(rows)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(rows) and all(c.request and c.metadata for c in captures)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()     # noqa: E731
    by_page = {re.search("page: (.*)", c.metadata["text"])[1].strip() + c.digest[:4]: c for c in captures}
    originals = {2, 3, 5, 7}
    for page, _, text, _ in rows:
        c = by_page[("" if page is None else str(page)) + sha(text)[:4]]
        assert c.digest == sha(text)
        if page in originals or text == "only null":
            assert (c.kind, bytes(c.block).decode(), c.refers_to) == ("response", text or "", None)
        else:
            assert c.kind == "revisit" and c.refers_to is not None
    orphan = records.where("kind = 'request'").limit(1)
    assert warc.assemble(orphan).select("kind", "request").first()[0] is None
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    empty = stage_path(spark, "test-warc-empty")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), empty)


def test_parities_bound_the_overlap():
    rng = np.random.default_rng(8)
    for _ in range(100):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        both = len(np.intersect1d(a, b))
        assert both <= ngram_join.most_overlap(ngram_join.parities(a), ngram_join.parities(b), len(a) + len(b)) <= min(len(a), len(b)) + max(len(a), len(b)) // 2 + 1
    assert ngram_join.most_overlap(ngram_join.parities(a), ngram_join.parities(a), 2 * len(a)) == len(a)
