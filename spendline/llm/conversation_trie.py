"""The prefix trie of conversations: a count-min sketch proves which prefixes are unique, only the others are grouped."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendline.llm.lookup import join_facts
from spendline.llm.words import mix
from spendline.session import stage_path

PIECE = 256             # turns that stand in one row; a conversation of any length is a chain of pieces
SKETCH_ROWS = 3
CELLS_PER_PREFIX = 8    # cells of the sketch for each prefix, rounded up to a power of two
MOST_CELLS = 1 << 29    # so the bitmap that is broadcast has 64 MB at most; a fuller sketch proves less, results stay the same
SKETCH_BLOCK = 1 << 16  # cells that one row of the sketch table covers
IDS_A_CHUNK = 512       # ids that are joined to one string before the digest of a node's ends
BLANK = " \t\n\x0b\x0c\r"
_KEY = ["depth", "d1", "d2"]
_TURN = pa.struct([("tie", pa.binary()), ("words", pa.int64())])
_NOTHING = hashlib.sha256(b"").hexdigest()


def turn_pieces(turns: DataFrame, base: str, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """`conv`, `at` (grows along the conversation) and `turns`, at most `PIECE` of them: content hash and number of words.

    Range partitions over conversation, turn and hash, so that even one conversation with a third of all turns lies in many tasks.
    """
    spark = turns.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    trimmed = F.trim(text, F.lit(BLANK))
    words = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")) - (trimmed == "").cast("int")
    turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.unhex(F.md5(F.concat(F.md5(role), F.md5(text)))).alias("tie"),
        words.cast("long").alias("words"), F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("salt")).write.parquet(f"{base}/turns")
    order = ["conv", "turn", "tie", "salt"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        open_conv, open_turns = None, []
        for batch in batches:
            done = []
            for conv, tie, n in zip(*(batch.column(c).to_pylist() for c in ("conv", "tie", "words"))):
                if open_turns and (conv != open_conv or len(open_turns) == PIECE):
                    done.append((open_conv, at, open_turns))
                    at, open_turns = at + 1, []
                open_conv = conv
                open_turns.append({"tie": tie, "words": n})
            if done:
                yield rows(done)
        if open_turns:
            yield rows([(open_conv, at, open_turns)])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        conv, at, lists = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(at, pa.int64()), pa.array(lists, pa.list_(_TURN))], ["conv", "at", "turns"])

    (spark.read.parquet(f"{base}/turns").repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "tie", "words")
     .mapInArrow(cut, "conv long, at long, turns array<struct<tie:binary,words:bigint>>").write.parquet(f"{base}/pieces"))
    return spark.read.parquet(f"{base}/pieces")


def rebuild(pieces: DataFrame, base: str, group: int = 20, heads: int = 4) -> DataFrame:
    """Rebuilt conversations in pieces: `conv`, `at`, `start` (turns before the piece), `length` (turns of the conversation), `turns`, `t1`, `t2` (the piece's part of the digest).

    A conversation c takes the first h turns of conversation c - c % `group` (h: crc32 of its number modulo `heads`) in place of its own first h.
    The first piece always stays, even without turns.
    """
    spark = pieces.sparkSession
    before = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.select("conv", "at", F.size("turns").alias("n"))
    (sizes.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("conv", "at", "n", "first").write.parquet(f"{base}/sizes"))
    sizes = spark.read.parquet(f"{base}/sizes")
    placed = pieces.join(sizes.select("at", "first"), "at")
    lead = (placed.where((F.col("conv") % group == 0) & (F.col("first") < heads - 1))
            .select(F.col("conv").alias("origin"), "first", F.posexplode(F.slice("turns", 1, heads - 1)).alias("k", "turn"))
            .groupBy("origin").agg(F.sort_array(F.collect_list(F.struct((F.col("first") + F.col("k")).alias("nth"), "turn"))).alias("lead")))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    own = F.col("conv") == F.col("origin")
    convs = sizes.groupBy("conv").agg(F.sum("n").alias("total")).withColumn("origin", F.col("conv") - F.col("conv") % group)
    empty = F.array().cast("array<struct<tie:binary,words:bigint>>")
    meta = convs.join(lead, "origin", "left").select(
        "conv", "total", F.when(own, 0).otherwise(h).cast("int").alias("drop"),
        F.when(own | F.col("lead").isNull(), empty).otherwise(F.slice(F.col("lead.turn"), F.lit(1), h.cast("int"))).alias("lead"))
    joined = placed.join(meta, "conv")
    skipped = F.greatest(F.col("drop") - F.col("first"), F.lit(0)).cast("int")
    kept = F.slice("turns", skipped + 1, F.size("turns"))
    first = F.col("first") == 0
    rebuilt = joined.select(
        "conv", "at", F.when(first, 0).otherwise(F.size("lead") + F.greatest(F.col("first") - F.col("drop"), F.lit(0))).cast("long").alias("start"),
        (F.size("lead") + F.greatest(F.col("total") - F.col("drop"), F.lit(0))).cast("long").alias("length"),
        F.when(first, F.concat("lead", kept)).otherwise(kept).alias("turns")).where((F.size("turns") > 0) | first)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_steps(ties, start) for ties, start in zip(_ties(batch), batch.column("start").to_pylist())]
            sums = [[int(np.bitwise_xor.reduce(p[k]).astype(np.int64)) if len(p[k]) else 0 for p in parts] for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(s, pa.int64()) for s in sums]], [*batch.schema.names, "t1", "t2"])

    rebuilt.mapInArrow(totals, "conv long, at long, start long, length long, turns array<struct<tie:binary,words:bigint>>, t1 long, t2 long").write.parquet(f"{base}/rebuilt")
    rebuilt = spark.read.parquet(f"{base}/rebuilt")
    chain = rebuilt.select("at", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(f"{t}_before") for t in ("t1", "t2")])
    rebuilt.join(chain, "at").drop("t1", "t2").withColumnsRenamed({"t1_before": "t1", "t2_before": "t2"}).write.parquet(f"{base}/chained")
    return spark.read.parquet(f"{base}/chained")


def _ties(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The content hashes of each piece as pairs of 64-bit numbers."""
    lists = batch.column("turns")
    flat = np.frombuffer(b"".join(lists.flatten().field("tie").to_pylist()), np.uint64).reshape(-1, 2)
    ends = np.cumsum([0, *[n or 0 for n in lists.value_lengths().to_pylist()]])
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def _steps(ties: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """What each turn adds (exclusive or) to the two digests: hashes of its content and its place."""
    place = np.arange(start + 1, start + 1 + len(ties), dtype=np.uint64)
    return mix(ties[:, 0] + mix(place)), mix(ties[:, 1] + mix(place + np.uint64(1 << 62)))


def _digests(ties: np.ndarray, start: int, t1: int, t2: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the prefixes that end at the turn before the piece and at each of its turns."""
    out = []
    for steps, before in zip(_steps(ties, start), (t1, t2)):
        out.append(np.bitwise_xor.accumulate(np.concatenate([np.array([before], np.int64).view(np.uint64), steps])))
    return tuple(out)


def _cells(d1: np.ndarray, d2: np.ndarray, width: int) -> np.ndarray:
    """The cell of each prefix in each row of the sketch; rows have ranges of their own."""
    each = np.uint64(width // SKETCH_ROWS)
    return np.stack([mix(d1 + np.uint64(k) * (d2 | np.uint64(1))) % each + np.uint64(k) * each for k in range(SKETCH_ROWS)])


def sketch_width(prefixes: int) -> int:
    return min(MOST_CELLS, max(SKETCH_BLOCK, 1 << (CELLS_PER_PREFIX * max(1, prefixes) - 1).bit_length()))


def met_twice(chained: DataFrame, width: int) -> np.ndarray:
    """The count-min sketch of all prefixes as a bitmap: which cells were counted twice or more. A prefix with a cell that was not has an estimate of one.

    Tasks send the cells they count, once each for a million prefixes, by block of cells; counters end at two. The bitmap has `width` bits.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for ties, start, t1, t2 in zip(_ties(batch), *(batch.column(c).to_pylist() for c in ("start", "t1", "t2"))):
                d1, d2 = _digests(ties, start, t1, t2)
                waiting.append(_cells(d1[1:], d2[1:], width).ravel())
                size += waiting[-1].size
            if size >= 3_000_000:
                yield blocks(waiting)
                waiting, size = [], 0
        if size:
            yield blocks(waiting)

    def blocks(waiting: list[np.ndarray]) -> pa.RecordBatch:
        cells, counts = np.unique(np.concatenate(waiting), return_counts=True)
        number = cells // np.uint64(SKETCH_BLOCK)
        places, many = (cells % np.uint64(SKETCH_BLOCK)).astype("<u2"), counts > 1
        starts = np.flatnonzero(np.diff(number, prepend=np.uint64(1 << 63)))
        ranges = list(zip(starts, [*starts[1:], len(cells)]))
        return pa.RecordBatch.from_arrays([pa.array(number[starts].astype(np.int64)), pa.array([places[a:b].tobytes() for a, b in ranges], pa.binary()),
                                           pa.array([np.packbits(many[a:b]).tobytes() for a, b in ranges], pa.binary())], ["block", "places", "many"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counts = None, np.zeros(SKETCH_BLOCK, np.uint8)
        for batch in batches:
            for block, places, many in zip(*(batch.column(c).to_pylist() for c in ("block", "places", "many"))):
                if block != number:
                    if number is not None:
                        yield bitmap(number, counts)
                    number, counts = block, np.zeros(SKETCH_BLOCK, np.uint8)
                at = np.frombuffer(places, "<u2")
                counts[at] = np.minimum(2, counts[at] + 1 + np.unpackbits(np.frombuffer(many, np.uint8))[:len(at)])
        if number is not None:
            yield bitmap(number, counts)

    def bitmap(number: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([np.packbits(counts == 2).tobytes()], pa.binary())], ["block", "bits"])

    counted = chained.where(F.size("turns") > 0).select("turns", "start", "t1", "t2").mapInArrow(count, "block long, places binary, many binary")
    found = counted.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, bits binary").toArrow()
    bits = np.zeros((width // SKETCH_BLOCK, SKETCH_BLOCK // 8), np.uint8)
    for block, part in zip(found.column("block").to_pylist(), found.column("bits").to_pylist()):
        bits[block] = np.frombuffer(part, np.uint8)
    return bits.ravel()


SHARED, BORDER, TAIL = 0, 1, 2      # kinds of prefixes: perhaps shared; proven unique after one that may be shared; proven unique after such a one


def screen(spark: SparkSession, chained: DataFrame, bitmap: np.ndarray, base: str) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: `kind`, `conv`, `at`, `depth`, `d1`, `d2` (digest), `q1`, `q2` (the parent's), `words`, `last`.

    A prefix whose estimate is one is unique, and so are all longer ones: they are complete where they stand.
    """
    sent = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        width = len(bits) * 8
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(10)]
            words = batch.column("turns").flatten().field("words").to_numpy(zero_copy_only=False)
            used = 0
            for ties, conv, at, start, length, t1, t2 in zip(_ties(batch), *(batch.column(c).to_pylist() for c in ("conv", "at", "start", "length", "t1", "t2"))):
                d1, d2 = _digests(ties, start, t1, t2)
                cells = _cells(d1[1:], d2[1:], width)
                often = (bits[cells >> np.uint64(3)] >> (np.uint64(7) - (cells & np.uint64(7))).astype(np.uint8) & 1).all(0)
                kind = np.full(len(ties), TAIL, np.int32)
                shared = len(ties) if often.all() else int(np.argmin(often))
                kind[:shared] = SHARED
                kind[shared:shared + 1] = BORDER
                depth = np.arange(start + 1, start + 1 + len(ties), dtype=np.int64)
                rows = [kind, np.full(len(ties), conv, np.int64), np.full(len(ties), at, np.int64), depth, d1[1:].view(np.int64), d2[1:].view(np.int64),
                        d1[:-1].view(np.int64), d2[:-1].view(np.int64), words[used:used + len(ties)], depth == length]
                used += len(ties)
                if start == 0:      # the root
                    rows = [np.concatenate([[x], r]).astype(r.dtype) for x, r in zip((SHARED, conv, at, 0, 0, 0, 0, 0, 0, length == 0), rows)]
                for column, r in zip(out, rows):
                    column.append(r)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["kind", "conv", "at", "depth", "d1", "d2", "q1", "q2", "words", "last"])

    (chained.mapInArrow(run, "kind int, conv long, at long, depth long, d1 long, d2 long, q1 long, q2 long, words long, last boolean")
     .write.partitionBy("kind").parquet(f"{base}/prefixes"))
    sent.destroy()
    return spark.read.schema("conv long, at long, depth long, d1 long, d2 long, q1 long, q2 long, words long, last boolean, kind int").parquet(f"{base}/prefixes")


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined `conv` of each node (`depth`, `d1`, `d2`): `ends_sha256`.

    Ids are range-partitioned by node and id, so that those of one node lie in many tasks, and joined there to strings of `IDS_A_CHUNK`. A digest has to be
    computed in sequence: one task per node reads these strings in order and holds one batch of them at a time.
    """
    order = [*_KEY, "conv"]

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            done = []
            for *own, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if ids and (own != key or len(ids) == IDS_A_CHUNK):
                    done.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = own
                ids.append(conv)
            if done:
                yield rows(done)
        if ids:
            yield rows([(*key, ids[0], ",".join(map(str, ids)))])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        *numbers, texts = zip(*done)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in numbers], pa.array(texts, pa.string())], [*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "ids"])):
                if own != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield digests(done)
        if key is not None:
            yield digests([(*key, state.hexdigest())])

    def digests(done: list[tuple]) -> pa.RecordBatch:
        *numbers, texts = zip(*done)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in numbers], pa.array(texts, pa.string())], [*_KEY, "ends_sha256"])

    numbers = "depth long, d1 long, d2 long"
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunk, f"{numbers}, conv long, ids string")
    return chunks.repartition(*_KEY).sortWithinPartitions(*order).select(*_KEY, "ids").mapInArrow(digest, f"{numbers}, ends_sha256 string")


def _towards_root(rows: DataFrame) -> DataFrame:
    """`rows` with `saved` and `leaves` summed from each row to the end of its conversation: within pieces, plus what later pieces hold."""
    within = Window.partitionBy("at").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    names = ("saved", "leaves")
    after = (rows.groupBy("conv", "at").agg(*[F.sum(c).alias(c) for c in names])
             .select("at", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after") for c in names]).where("saved_after > 0 OR leaves_after > 0"))
    summed = rows.withColumns({c: F.sum(c).over(within) for c in names}).join(after, "at", "left")
    return summed.withColumns({c: F.col(c) + F.coalesce(f"{c}_after", F.lit(0)) for c in names})


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", group: int = 20, heads: int = 4) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see `rebuild`): `conv_id` (the smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens`, `ends_sha256`.

    A node is a distinct sequence of turns (role, text). Conversations are cut into pieces and every prefix gets a rolling digest. A count-min sketch of all prefixes proves
    most of them unique; the tail of a conversation behind such a prefix is complete where it stands. Only prefixes that may be shared are shuffled and
    grouped exactly. Sums over a subtree are sums over the members of what each contributes from the node on: a conversation speaks for
    the nodes of which it is the smallest member.

    Turns are ordered by number (null first), equal numbers by the hash of role and text; repeated turns are turns. Null role or text is empty.
    Turns without conversation id belong to none and are left out. Conversation ids are integers. An empty table gives no rows. Other
    columns are not read.
    """
    spark = turns.sparkSession
    base = stage_path(spark, "trie")
    chained = rebuild(turn_pieces(turns, base, conv_col, turn_col, role_col, text_col), base, group, heads)
    prefixes = chained.where("start = 0").agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    rows = screen(spark, chained, met_twice(chained, sketch_width(prefixes)), base)
    shared, border, tail = (rows.where(F.col("kind") == k).drop("kind") for k in (SHARED, BORDER, TAIL))
    shared.groupBy(*_KEY, "q1", "q2").agg(F.count("*").alias("n_convs"), F.min("conv").alias("owner"), F.sum(F.col("last").cast("long")).alias("n_ends")).write.parquet(f"{base}/nodes")
    nodes = spark.read.parquet(f"{base}/nodes")

    known = join_facts(shared, nodes.select(*_KEY, "n_convs", "owner", "n_ends"), _KEY, "n_convs")
    own = F.col("owner") == F.col("conv")
    worth = known.select("conv", "at", *_KEY, "q1", "q2", own.alias("own"), F.when(own, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("saved"),
                         (own & F.col("last") & (F.col("n_convs") == F.col("n_ends"))).cast("long").alias("leaves"))
    alone = border.unionByName(tail).where("last").select("conv", "at", *_KEY, "q1", "q2", F.lit(False).alias("own"), F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"))
    zero = F.lit(0).cast("long")
    up = F.struct((F.col("depth") - 1).alias("depth"), F.col("q1").alias("d1"), F.col("q2").alias("d2"), zero.alias("saved"), zero.alias("leaves"), F.lit(1).cast("long").alias("children"))
    here = F.struct(*_KEY, "saved", "leaves", zero.alias("children"))
    told = (_towards_root(worth.unionByName(alone)).select(F.explode(F.when(F.col("own") & (F.col("depth") > 0), F.array(here, up)).otherwise(F.array(here))).alias("x"))
            .unionByName(border.select(up.alias("x"))).select("x.*")
            .groupBy(*_KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children")))
    parent = lambda df, conv: df.select(*df.columns, (F.col("depth") - 1).alias("p"), F.col(conv).alias("self"))      # noqa: E731
    facts = nodes.select(F.col("depth").alias("p"), F.col("d1").alias("q1"), F.col("d2").alias("q2"), F.col("owner").alias("parent"), F.col("n_convs").alias("size"))
    above = lambda df, conv: join_facts(parent(df, conv), facts, ["p", "q1", "q2"], "size").withColumn(     # noqa: E731
        "parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent", "self")))
    inner = (above(nodes, "owner").join(told, _KEY, "left").join(ends_digests(shared.where("last")), _KEY, "left")
             .select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256")))
    single = lambda df, above_id: df.select(        # noqa: E731
        F.col("conv").alias("conv_id"), "depth", above_id.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("last"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(_NOTHING).alias("ends_sha256"))
    return inner.unionByName(single(above(border, "conv"), F.col("parent_conv_id"))).unionByName(single(tail, F.col("conv")))
