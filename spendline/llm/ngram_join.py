"""Near-duplicate documents: a prefix-tree join of n-gram sets under a Jaccard threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.llm.components import components
from spendline.llm.words import drop_others, mix, portions, shingles
from spendline.session import stage_path

HOT_BLOCK, HOT_MOST = 4_000_000, 1_000_000     # shingles that a task counts together; shingles that are ranked by frequency (16 MB)
SKETCHES = 8        # min-hashes by which copies find a leader
NEAR = 16           # how far apart the neighbours are that are compared before whole groups are
PAIRS_HELD = 500_000    # candidate pairs that a task holds before it hands them on
GROUP = 256         # members that are compared with one hub at a time
FEW_IDS = 1_000_000  # as many ids at most are broadcast (16 MB)
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


def _needed(a: int, b: int, percent: int) -> int:
    """Smallest overlap of sets of sizes a and b that reaches the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def tree_overlaps(hub: np.ndarray, members: list[np.ndarray], percent: int) -> list[bool]:
    """Which of `members` reach the threshold with `hub`; all are sets of hashes in ascending order.

    The members form a prefix tree, walked in order: what two neighbours share at their start is intersected with the hub only once. A subtree is
    left as soon as its overlap so far and what remains on either side can no longer reach the needed overlap.
    """
    passed = [False] * len(members)
    keys = [m.astype(">u8").tobytes() for m in members]
    path, known, overlap = np.zeros(0, np.uint64), 0, np.zeros(1, np.int64)    # current branch; its first `known` nodes have their overlap
    for k in sorted(range(len(members)), key=keys.__getitem__):
        member = members[k]
        n = min(len(path), len(member))
        differ = np.flatnonzero(path[:n] != member[:n])
        shared = min(int(differ[0]) if len(differ) else n, known)
        need, so_far = _needed(len(hub), len(member), percent), int(overlap[shared])
        before = int(np.searchsorted(hub, member[shared - 1], "right")) if shared else 0
        path, overlap, known = member, overlap[:shared + 1], shared
        if so_far + min(len(member) - shared, len(hub) - before) < need:
            continue
        rest = member[shared:]
        at = np.minimum(np.searchsorted(hub, rest), len(hub) - 1)
        overlap = np.concatenate([overlap, so_far + np.cumsum(hub[at] == rest)])
        known = len(member)
        passed[k] = bool(overlap[-1] >= need)
    return passed


def set_hashes(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    return int(mix(s).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(s * _SEEDS[0])).view(np.int64)) if len(s) else 0


def min_hashes(s: np.ndarray) -> list[int]:
    """`SKETCHES` min-hashes of a set; none of an empty one."""
    return [int(x) for x in mix(s[None, :] * _SEEDS[:, None]).min(1).view(np.int64)] if len(s) else []


def parities(s: np.ndarray) -> bytes:
    """For each residue of a power of two (at least twice the set size) whether an odd number of shingles has it, as bits."""
    bits = max(256, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 256
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def most_overlap(a: bytes, b: bytes, sizes: int) -> int:
    """Upper bound of the overlap of two sets whose sizes add up to `sizes`: every differing bit is an element that only one of them has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))     # of the longer one, residues modulo the smaller power
    differ = np.bitwise_xor.reduce(x.reshape(-1, n), 0) ^ np.bitwise_xor.reduce(y.reshape(-1, n), 0)
    return (sizes - int(np.bitwise_count(differ).sum())) // 2


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose parities do not rule out the threshold; a few bytes a shingle travel instead of texts."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))      # noqa: E731

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            keep = [most_overlap(x, y, i + j) >= _needed(i, j, percent) for i, j, x, y in zip(na, nb, batch.column("pa").to_pylist(), batch.column("pb").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long").distinct()


def hot_shingles(docs: DataFrame, width: int, path: str) -> np.ndarray:
    """Frequent shingles, the most frequent last: at most `HOT_MOST`, by counts over all documents.

    A task reports what it meets twice or more in a block; Spark adds the reports up. They only set the global order of shingles (rare ones first);
    any order gives the same links, so the bound costs nothing but time.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others()
        held, size = [], 0
        for batch in batches:
            for part in portions(batch):
                sets = shingles(part.column("text"), width)
                held += sets
                size += sum(map(len, sets))
                if size >= HOT_BLOCK:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(sets), return_counts=True)
        often = n > 1
        return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often])], names=["shingle", "n"])

    docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).write.parquet(path)
    counts = spark.read.parquet(path).withColumn("step", F.floor(F.log2("n") * 8))
    least, total = None, 0
    for r in counts.groupBy("step").count().orderBy(F.desc("step")).collect():     # a few hundred steps at most
        total += r["count"]
        if total > HOT_MOST:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.uint64)
    top = counts.where(F.col("step") >= least).select("shingle", "n").toArrow()
    shingle, n = top.column("shingle").to_numpy(), top.column("n").to_numpy()
    return shingle[np.lexsort((shingle, n))].view(np.uint64)


def document_sets(docs: DataFrame, width: int, percent: int, hot: np.ndarray) -> DataFrame:
    """Per document: `n` (set size), `s1`, `s2` (hash of the set), `sketch` (min-hashes), `parity` (see `parities`) and `prefix`, the first
    shingles of its set in the global order, of which every partner shares at least one."""
    spark = docs.sparkSession
    by_value = np.argsort(hot)
    ranks = spark.sparkContext.broadcast((hot[by_value], by_value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, rank = ranks.value
        for batch in batches:
            for part in portions(batch):
                yield described(part, shingles(part.column("text"), width), values, rank)

    def described(part: pa.RecordBatch, sets: list[np.ndarray], values: np.ndarray, rank: np.ndarray) -> pa.RecordBatch:
        s1, s2, sketches, parity, prefixes = [], [], [], [], []
        for s in sets:
            both = set_hashes(s)
            s1.append(both[0])
            s2.append(both[1])
            if len(values) and len(s):
                at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                known = values[at] == s
            else:
                known = np.zeros(len(s), bool)
            rare = s[~known]
            sketches.append(min_hashes(s))
            parity.append(parities(s))
            length = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
            prefix = rare[:length]
            if len(prefix) < length:
                prefix = np.concatenate([rare, s[known][np.argsort(rank[at[known]])]])[:length]
            prefixes.append(prefix.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("version"), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
             pa.array(sketches, pa.list_(pa.int64())), pa.array(parity, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
            names=["id", "version", "n", "s1", "s2", "sketch", "parity", "prefix"])

    return docs.mapInArrow(run, "id long, version long, n long, s1 long, s2 long, sketch array<long>, parity binary, prefix array<long>")


_PREFIX = ["token", "id", "component", "n", "at"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Columns of `_PREFIX`, sorted by token, in portions that hold all rows of their tokens."""
    carry = None
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in _PREFIX])
        if carry is not None:
            rows = np.concatenate([carry, rows], 1)
        if not rows.shape[1]:
            continue
        last = int(np.searchsorted(rows[0], rows[0, -1]))
        carry = rows[:, last:]
        if last:
            yield rows[:, :last]
    if carry is not None:
        yield carry


def _mixed(rows: np.ndarray) -> np.ndarray:
    """The rows of tokens that stand in several components."""
    starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
    mixed = np.minimum.reduceat(rows[2], starts) != np.maximum.reduceat(rows[2], starts)
    return rows[:, np.repeat(mixed, np.diff(np.r_[starts, rows.shape[1]]))]


def _can_link(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of prefix rows of one token can reach the threshold, by size and by the place of the token; `small` has the smaller sets."""
    (_, _, c1, n1, at1), (_, _, c2, n2, at2) = small, large
    near = (c1 != c2) & (100 * n1 >= percent * n2) & (at1 <= n1 - -(-2 * percent * n1 // (100 + percent)) + 1)
    return near & (np.minimum(n1 - at1, n2 - at2) + 1 >= -(-percent * (n1 + n2) // (100 + percent)))


def neighbours(prefixes: DataFrame, percent: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Pairs (`a`, `b`) of rows that stand at most `NEAR` apart in a shuffled order of a token's rows, and the rows of all tokens in several components.

    The order is another one for each token, and the pairs grow with the rows; in a group of
    edited copies they already form one component, and the pairs of the whole group never arise.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            rows = _mixed(rows)
            if not rows.shape[1]:
                continue
            order = np.lexsort((mix(rows[1].view(np.uint64) ^ mix(rows[0].view(np.uint64))), rows[0]))
            found = []
            for apart in range(1, NEAR + 1):
                one, two = rows[:, order[:-apart]], rows[:, order[apart:]]
                swap = one[3] > two[3]
                good = (one[0] == two[0]) & _can_link(np.where(swap, two, one), np.where(swap, one, two), percent)
                found.append(np.sort(np.stack([one[1][good], two[1][good]]), 0))
            pairs = np.unique(np.concatenate(found, 1), axis=1)
            size, none = rows.shape[1], pairs.shape[1]
            columns = {"kind": np.r_[np.zeros(size, np.int32), np.ones(none, np.int32)], "token": np.r_[rows[0], pairs[0]], "id": np.r_[rows[1], pairs[1]],
                       "n": np.r_[rows[3], np.zeros(none, np.int64)], "at": np.r_[rows[4], np.zeros(none, np.int64)]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    spark = prefixes.sparkSession
    dealt = prefixes.select(*_PREFIX).repartition("token").sortWithinPartitions("token")
    dealt.mapInArrow(run, "kind int, token long, id long, n long, at long").write.partitionBy("kind").parquet(path)
    out = spark.read.schema("token long, id long, n long, at long, kind int").parquet(path)
    pairs = out.where("kind = 1").select(F.col("token").alias("a"), F.col("id").alias("b")).where("a != b").distinct()
    return pairs, out.where("kind = 0").drop("kind")


def candidates(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (`a`, `b`) of different components that share a prefix shingle and can reach the threshold by size and position.

    `prefixes` has a row per document and prefix shingle: `token`, `id`, `component`, `n`, `at`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            yield from paired(_mixed(rows))

    def paired(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]]) if rows.shape[1] else []
        found, size = [], 0
        for start, stop in zip(starts, [*starts[1:], rows.shape[1]]):
            group = rows[:, start:stop]     # sorted by n
            low = np.searchsorted(group[3], -(-percent * group[3] // 100))
            for x in range(1, stop - start):
                y = np.arange(low[x], x)
                y = y[_can_link(group[:, y], group[:, x:x + 1], percent)]
                if len(y):
                    pair = np.stack([group[1][y], np.broadcast_to(group[1][x], y.shape)])
                    found.append(np.sort(pair, 0))
                    size += len(y)
                if size >= PAIRS_HELD:
                    yield emitted(found)
                    found, size = [], 0
        if found:
            yield emitted(found)

    def emitted(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found, 1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    dealt = prefixes.select(*_PREFIX).repartition("token").sortWithinPartitions("token", "n", "id")
    return dealt.mapInArrow(run, "a long, b long").where("a != b").distinct()


def linked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose sets reach the threshold. `pairs` is a written table; `texts` has a row (`id`, `text`) for each id in it.

    Texts travel, as they are smaller than their sets. A hub with many partners is dealt out in groups of about `GROUP`.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    members = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), "groups").cast("int").alias("part"), F.col("b").alias("id"), F.lit(1).alias("member"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.col("a").alias("id"), F.lit(0).alias("member"))
    rows = members.unionByName(hubs).join(texts, "id").select(F.xxhash64("a", "part").alias("block"), "a", "part", "member", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set, held, held_sets = None, None, [], []
        for batch in batches:
            for part in portions(batch):
                sets = shingles(part.column("text"), width)
                for a, p, member, key, s in zip(part.column("a").to_pylist(), part.column("part").to_pylist(), part.column("member").to_pylist(),
                                                part.column("id").to_pylist(), sets):
                    if (a, p) != hub:
                        yield from compared(hub, hub_set, held, held_sets)
                        hub, hub_set, held, held_sets = (a, p), None, [], []
                    if member:
                        held.append(key)
                        held_sets.append(s)
                        if len(held) >= 4 * GROUP:
                            yield from compared(hub, hub_set, held, held_sets)
                            held, held_sets = [], []
                    else:
                        hub_set = s
        yield from compared(hub, hub_set, held, held_sets)

    def compared(hub: tuple | None, hub_set: np.ndarray | None, ids: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if hub is None or hub_set is None or not ids or not len(hub_set):
            return
        good = [i for i, ok in zip(ids, tree_overlaps(hub_set, sets, percent)) if ok]
        if good:
            yield pa.RecordBatch.from_arrays([pa.array([hub[0]] * len(good), pa.int64()), pa.array(good, pa.int64())], names=["a", "b"])

    return rows.repartition("block").sortWithinPartitions("block", "a", "part", "member").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of `docs`: the id, `n_shingles` (set size) and `component_id`, the smallest id reachable by links.

    Two documents link when 100 * intersection >= `percent` * union of their sets of `width`-word shingles (A-Z lower-cased; with fewer
    words, the whole sequence is the one shingle).

    1. Equal sets are one. 2. Min-hashes name each set a leader; those that truly link with it join it, so that a group
    of copies is one component before any pairs are made. 3. Prefix shingles in a global order (frequent ones last) bring together the sets that can link; first only
    neighbours in a shuffled order are compared, which joins groups of edited copies. 4. Then all pairs of different
    components that can link; parities rule out most of the others, and a prefix tree of the partners of a hub decides. 5. Components of all links found. Steps 1, 4 and 5 are exact; steps 2 and 3 only save work.

    Null or empty texts, or those without words: no shingles, linked with nothing. A null id has no component, and links nothing. Rows that share an
    id are one document: a link of either is a link of the id. An empty table gives no rows. No other column is read.
    """
    spark = docs.sparkSession
    base = stage_path(spark, "ngrams")
    text = F.coalesce(F.col(text_col), F.lit(""))
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))
    hot = hot_shingles(chosen, width, f"{base}/hot")
    document_sets(chosen, width, percent, hot).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    usable = sets.where("n > 0 AND id IS NOT NULL")
    usable.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep")).write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")
    usable.select("id", "version", "s1", "s2", "n").join(groups, ["s1", "s2", "n"]).where("id <> rep").select("id", "version", "rep").write.parquet(f"{base}/copies")
    copies = spark.read.parquet(f"{base}/copies")
    known = copies.select("id", "version").distinct()
    reps = usable.join(F.broadcast(known) if copies.count() <= FEW_IDS else known, ["id", "version"], "left_anti")

    def texts_of(pairs: DataFrame, name: str) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct().join(reps.select("id", "version").distinct(), "id")
        ids.write.parquet(f"{base}/{name}")
        ids = spark.read.parquet(f"{base}/{name}")
        few = ids.count() <= FEW_IDS
        return chosen.join(F.broadcast(ids) if few else ids, ["id", "version"], "left_semi").select("id", "text")

    # 2. leaders
    buckets = reps.select("id", F.posexplode("sketch").alias("k", "value"))
    buckets.groupBy("k", "value").agg(F.min("id").alias("a"), F.count("*").alias("m")).where("m > 1").select("k", "value", "a").write.parquet(f"{base}/leaders")
    agreed = (buckets.join(spark.read.parquet(f"{base}/leaders"), ["k", "value"]).where("a != id").groupBy("id", "a").agg(F.count("*").alias("m"))
              .where(F.col("m") >= 2).groupBy("id").agg(F.max(F.struct("m", (-F.col("a")).alias("less"))).alias("best")))
    possible(agreed.select((-F.col("best.less")).alias("a"), F.col("id").alias("b")), reps, percent).write.parquet(f"{base}/led")
    led = spark.read.parquet(f"{base}/led")
    linked(led, texts_of(led, "led-ids"), width, percent).write.parquet(f"{base}/links-1")
    links = spark.read.parquet(f"{base}/links-1")
    components(links).write.parquet(f"{base}/merged")
    merged = spark.read.parquet(f"{base}/merged").withColumnRenamed("node", "id")

    # 3. neighbours among those that share a prefix shingle
    inside = lambda df, parts: df.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))      # noqa: E731
    prefixes = inside(reps.select("id", "n", "prefix"), merged).select(F.posexplode("prefix").alias("at", "token"), "id", "component", "n").withColumn("at", (F.col("at") + 1).cast("long"))
    near, shared = neighbours(prefixes, percent, f"{base}/neighbours")
    near.write.parquet(f"{base}/near")
    possible(spark.read.parquet(f"{base}/near"), reps, percent).write.parquet(f"{base}/near-pairs")
    near = spark.read.parquet(f"{base}/near-pairs")
    linked(near, texts_of(near, "near-ids"), width, percent).write.parquet(f"{base}/links-2")
    links = links.unionByName(spark.read.parquet(f"{base}/links-2"))
    components(links).write.parquet(f"{base}/merged-2")

    # 4. everything else
    merged = spark.read.parquet(f"{base}/merged-2").withColumnRenamed("node", "id")
    candidates(inside(shared, merged), percent).write.parquet(f"{base}/candidates")
    possible(spark.read.parquet(f"{base}/candidates"), reps, percent).write.parquet(f"{base}/pairs")
    pairs = spark.read.parquet(f"{base}/pairs")
    linked(pairs, texts_of(pairs, "pair-ids"), width, percent).write.parquet(f"{base}/links-3")
    more = spark.read.parquet(f"{base}/links-3")
    # copies, and so sets that share an id, belong together
    twice = copies.select(F.col("rep").alias("a"), F.col("id").alias("b"))
    components(links.unionByName(more).unionByName(twice)).write.parquet(f"{base}/final")
    final = spark.read.parquet(f"{base}/final").withColumnRenamed("node", "id")
    return (sets.select("id", "n").join(final, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))
