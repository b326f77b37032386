"""Prefix trie, filter audit and secret scans against brute force, on small rows with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendline.llm import conversation_trie, filter_audit, lookup, secret_scan
from spendline.session import stage_path

TURN = "conv_id long, turn long, role string, text string, depth long, at long, conv long"      # clashing names on purpose
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------------- prefix trie

def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, tie, (role, text)))
    turns = {c: [t[-1] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    members = defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(WORD.findall(k[-1][1])) if k else 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k)))).encode()).hexdigest()) for k, m in members.items())


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURN)
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in conversation_trie.prefix_trie(frame).collect())


ODD_TURNS = [(c, t, r, x) for c in range(30) for t, r, x in [(1, "user", "hello there"), (2, "bot", "hi"), (3, "user", f"number {c % 3}"), (4, None, None)]][:-6] + [
    (40, None, "user", "first"), (40, 0, "", ""), (40, 0, None, None), (40, 5, "user", "a\tb  c"), (41, 1, "user", "x"), (41, 1, "user", "x"), (-5, 1, "user", "minus"), (0, 9, "bot", "end"),
    (None, 1, "user", "nobody"), (61, 1, "user", "one turn"), (62, 1, "user", "one turn"), (63, 1, "user", "one turn"), (99, 2, "user", ""), (99, 2, "user", None)]


def test_trie_equals_brute_force(spark):
    assert trie(spark, ODD_TURNS) == brute_trie(ODD_TURNS)
    assert trie(spark, ODD_TURNS + ODD_TURNS) == brute_trie(ODD_TURNS + ODD_TURNS)
    assert trie(spark, []) == []
    assert trie(spark, [(5, 1, "user", "alone")]) == brute_trie([(5, 1, "user", "alone")])


def test_trie_of_long_and_hot_conversations(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(7, t, "user", "long " * (t % 3)) for t in range(900)] + [(27, t, "user", "long " * (t % 3)) for t in range(700)]     # chains over several pieces
    rows += [(100 + c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]                                          # one conversation in many copies
    rows += [(1000 + c, t, "user", f"word {rng.randint(0, 2)}") for c in range(60) for t in range(rng.randint(0, 6))] + [(1000, 0, "bot", "x " * 200_000)]
    want = brute_trie(rows)
    assert trie(spark, rows) == want
    monkeypatch.setattr(conversation_trie, "sketch_width", lambda n: conversation_trie.SKETCH_BLOCK)       # a sketch that proves little changes nothing
    monkeypatch.setattr(conversation_trie, "SKETCH_BLOCK", 64)
    assert trie(spark, rows) == want


def test_sketch_never_calls_a_shared_prefix_unique(spark):
    rows = [(c, t, "user", f"{c % 40} {t}") for c in range(400) for t in range(5)]
    base = stage_path(spark, "test-trie")
    chained = conversation_trie.rebuild(conversation_trie.turn_pieces(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURN), base, "conv_id", "turn", "role", "text"), base)
    found = conversation_trie.screen(spark, chained, conversation_trie.met_twice(chained, conversation_trie.sketch_width(2000)), base)
    counts = found.groupBy("depth", "d1", "d2").agg(F.count("*").alias("n"), F.max("kind").alias("kind"))
    assert counts.where("n > 1 AND kind > 0").count() == 0
    assert conversation_trie.sketch_width(10 ** 12) == conversation_trie.MOST_CELLS


# ---------------------------------------------------------------------- filter audit

AUDIT_DOC = "doc_id long, text string, lang string, id long, mask int, part string"


def brute_audit(rows, labels):
    seen = defaultdict(set)
    for i, t, _ in rows:
        if i is not None:
            seen[t or ""].add(i)
    facts = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {f for f, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
                                               i is not None and min(seen[t]) < i)) if bad}
        own = [x for x in labels if i is not None and x[0] == i]
        facts.append((lang or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {f[0] for f in facts}:
        mine, removed = [f for f in facts if f[0] == part], Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                              sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        out += [(*x[:-1], removed[x[-1]]) for x in lines]
    return sorted(out)


def test_audit_equals_all_orders_one_by_one(spark):
    rng = random.Random(4)
    texts = [None, "", "short", "short", "a # b", " ".join(f"w{k}" for k in range(200)), " ".join(["same"] * 300), "BIG " * 250, "x" * 100_000 + " " + " ".join(f"v{k}" for k in range(400)),
             "\t" + " ".join(f"w{k}" for k in range(199)) + "\n", "É   x"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += rows[:20]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(30), *range(5), None]]
    frame = spark.createDataFrame([(*r, 1, 2, "p") for r in rows], AUDIT_DOC)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.outcomes(frame, marks)).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, labels)
    assert filter_audit.audit(filter_audit.outcomes(frame.limit(0), marks)).count() == 0
    assert filter_audit.audit(filter_audit.outcomes(frame, marks.limit(0))).where("good_lost > 0").count() == 0


def test_paths_through_the_lattice():
    for n in range(1, 6):
        edges = filter_audit.lattice(n)
        assert len(edges) == n * 2 ** (n - 1)
        for f in range(n):
            assert sum(o for _, g, o in edges if g == f) == len(list(itertools.permutations(range(n))))
    with pytest.raises(ValueError):
        filter_audit.audit(None, "AAB")


# ---------------------------------------------------------------------- secrets

SECRET_DOC = "doc_id long, text string, source string, value string, spans string"
KEY = "aB3dE6gH9jK2mN5pQ8sT1vW4"


def base_spans(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 12 else []
    for rank, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        found += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def hostile(rng):
    parts = ["token", "TOKEN", "api_key", "ApiKey", "passwd", "ſecret", "secret", '"', "'", " ", ":", "=", "abcdefabcdef", "AKIA", "A1B2C3D4", "0123456789abcdef", "\n", "x", ".", "é", "🙂", KEY]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_base_spans_equal_the_plain_patterns(spark):
    rng = random.Random(6)
    texts = [hostile(rng) for _ in range(3000)] + ["token=" * 3000 + "a" * 50_000, "a" * 300_000, "f" * 300_000]
    for t in texts:
        assert [(s["start"], s["rank"], s["end"]) for s in secret_scan.scan(t) if s["base"]] == base_spans(t), t[:200]
        further = [s for s in secret_scan.scan(t) if not s["base"]]
        assert not any(a < s["end"] and s["start"] < b for s in further for a, _, b in base_spans(t))


def test_owner_specific_values_are_live_and_copied_ones_are_examples(spark):
    rows = [(i, f"see {KEY} here", f"src{i % 10}") for i in range(40)]                                # copied everywhere
    own = KEY[::-1]
    rows += [(100 + i, f"é {own} and https://me:pa55word!x@host/", "src1") for i in range(3)]         # one owner
    rows += [(200, None, None), (None, "", "src1"), (None, f"token: {KEY}", None), (201, "zzzzzzzzzzzzzzzzzzzzzzzzzA1b2", "s"), (202, f"{own}-{own}", "src7"), (100, rows[-1][1], "src1")]
    frame = spark.createDataFrame([(*r, "v", "s") for r in rows], SECRET_DOC)
    out = secret_scan.find_secrets(frame).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, *_ in rows)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append([(s["kind"], s["start"], s["end"], s["verdict"], s["repos"], s["owners"]) for s in r.spans])
    assert by[3] == [[]] and by[200] == [[]] and by[201] == [[]]
    live = [("opaque", 2, 26, "live", 3, 1), ("login", 31, 54, "live", 3, 1)]
    assert by[100] == [live, live] and by[101] == [live]
    assert sorted(by[None], key=len) == [[], [("assign", 0, 31, "example", 41, 11)]]
    assert by[202] == [[("opaque", 0, 49, "live", 1, 1)]]
    assert secret_scan.find_secrets(frame.limit(0)).count() == 0


# ---------------------------------------------------------------------- joins with hot keys

def test_join_facts_keeps_every_row(spark):
    rows = spark.createDataFrame([(k, v) for v, k in enumerate(["hot"] * 500 + [None] * 3 + [f"k{i}" for i in range(2000)])], "k string, v long")
    base = stage_path(spark, "test-facts")
    rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("least")).write.parquet(base)
    got = lookup.join_facts(rows, spark.read.parquet(base), ["k"], "n")
    assert got.count() == rows.count() and got.where("k IS NOT NULL AND least > v").count() == 0 and got.where("k IS NULL AND n IS NULL").count() == 3
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
