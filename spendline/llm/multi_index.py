"""Near-duplicate embeddings through an inverted multi-index: a grid of two codebooks, walked from the nearest cell outwards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.llm.components import components
from spendline.session import stage_path

SAMPLE = 20_000     # vectors from which the codebooks are fitted
CHUNK = 2048        # vectors of a cell that meet at a time; larger cells are dealt out in such chunks
_KEY = ["label", "h1", "h2"]


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = _squares(x, centres).argmin(1)
        centres = np.stack([x[nearest == c].mean(0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
    return centres


class Grid:
    """Two codebooks, one for each half of a unit vector, and the reach to which cells are visited.

    A vector lives in the cell of its two nearest codewords. The gap to another cell is how far the vector must move to leave its own cell towards
    it: (d_other^2 - d_own^2) / (2 |other - own|) in each half. Cells are visited by growing gap until `reach`.
    """

    def __init__(self, unit: np.ndarray, codewords: int, threshold: float, target_recall: float):
        rng = np.random.default_rng(17)
        self.cut = unit.shape[1] // 2
        self.books = [_kmeans(half, codewords, rng) for half in self._halves(unit)]
        self.between = [np.sqrt(_squares(book, book)) for book in self.books]
        # the reach: on vectors moved by just the allowed angle in any direction, the share `target_recall` stays within it
        noise = rng.normal(size=unit.shape)
        noise -= (noise * unit).sum(1, keepdims=True) * unit
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
        moved = threshold * unit + np.sqrt(max(0.0, 1 - threshold ** 2)) * noise
        i, j = self.home(moved)
        gaps = self.gaps(unit)
        rows = np.arange(len(unit))
        self.reach = float(np.quantile(gaps[0][rows, i] + gaps[1][rows, j], target_recall))

    def _halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, :self.cut], unit[:, self.cut:]

    def home(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_squares(half, book).argmin(1) for half, book in zip(self._halves(unit), self.books))

    def gaps(self, unit: np.ndarray) -> list[np.ndarray]:
        """Squared gaps of every vector to every codeword of each half."""
        out = []
        for half, book, between in zip(self._halves(unit), self.books, self.between):
            d = _squares(half, book)
            own = d.argmin(1)
            apart = between[own]
            gap = np.where(apart > 0, (d - d[np.arange(len(d)), own][:, None]) / (2 * np.where(apart > 0, apart, 1)), 0)
            out.append(np.maximum(gap, 0) ** 2)
        return out

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(vector, i, j) of all visited cells. In both halves codewords come by growing gap, so each walk ends where the sum exceeds the reach."""
        g1, g2 = self.gaps(unit)
        o1, o2 = np.argsort(g1, 1), np.argsort(g2, 1)
        s1, s2 = np.take_along_axis(g1, o1, 1), np.take_along_axis(g2, o2, 1)
        found = []
        for a in range(s1.shape[1]):
            open_rows = np.flatnonzero(s1[:, a] <= self.reach)
            if not len(open_rows):
                break
            for b in range(s2.shape[1]):
                open_rows = open_rows[s1[open_rows, a] + s2[open_rows, b] <= self.reach]
                if not len(open_rows):
                    break
                found.append((open_rows, o1[open_rows, a], o2[open_rows, b]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _distinct(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Usable vectors with the hash of label and vector; `rep` is the smallest id of equal ones and `copies` their number."""
    v = F.col("vec")
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return chosen.where(F.coalesce(good, F.lit(False))).select("id", "label", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(7), "vec").alias("h2"))


def fit_grids(spark, reps: DataFrame, codewords: int, threshold: float, target_recall: float) -> dict[int, Grid]:
    """A grid for each vector length in a sample of `SAMPLE` distinct vectors (those with the smallest hashes)."""
    sample = reps.orderBy("h1", "h2").limit(SAMPLE).select("vec").toArrow().column("vec").to_pylist()
    by_dim: dict[int, list] = {}
    for vec in sample:
        by_dim.setdefault(len(vec), []).append(vec)
    return {dim: Grid(_unit(np.array(rows)), codewords, threshold, target_recall) for dim, rows in by_dim.items() if dim > 1}


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98,
                    codewords: int = 64, target_recall: float = 0.995) -> DataFrame:
    """One row per row of `vectors`: the id, `n_links` (other vectors of the same label with cosine >= `threshold`), `component_id`
    (smallest id reachable by links) and `kept` (it is the smallest).

    Equal vectors are collapsed first, so that copies cost nothing. Each distinct vector is stored in its home cell and looks
    into all cells within the grid's reach; every vector is indexed, only the codebooks come from a sample. In a cell the
    cosine is computed in double precision. A pair is found if either looks into the other's cell, and counts for both. Cells
    beyond `CHUNK` vectors are dealt out by chunk; counts and a spanning set of links leave a chunk, never all pairs.

    Rows with null id or label, or whose vector is null, empty, zero, or holds null or non-finite components, link with
    nothing. Vectors of different length link with nothing. Rows that share id, label and vector are one vector. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    base = stage_path(spark, "multi-index")
    good = _distinct(vectors, id_col, vec_col, label_col)
    good.groupBy(*_KEY).agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies")).write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")
    first = good.join(groups.withColumnRenamed("rep", "id"), [*_KEY, "id"]).dropDuplicates(["id", "h1", "h2"])
    first.write.parquet(f"{base}/reps")
    reps = spark.read.parquet(f"{base}/reps")
    grids = fit_grids(spark, reps, codewords, threshold, target_recall)
    label_type = reps.schema["label"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch], probes: bool) -> Iterator[pa.RecordBatch]:
        """The home cell of each vector, or with `probes` all cells that it visits."""
        for batch in batches:
            dims = np.array([len(v) for v in batch.column("vec")], np.int64)
            for dim in np.unique(dims):
                for at in range(0, int((dims == dim).sum()), 1000):
                    part = batch.take(pa.array(np.flatnonzero(dims == dim)[at:at + 1000]))
                    raw = np.array(part.column("vec").to_pylist(), np.float64)
                    grid, unit = grids.get(int(dim)), _unit(raw)
                    home = grid.home(unit) if grid else (np.zeros(len(raw), int),) * 2
                    if probes:
                        row, i, j = grid.visits(unit) if grid else (np.arange(len(raw)), *home)
                    else:
                        row, i, j = np.arange(len(raw)), *home
                    values = [x.astype("<f8").tobytes() for x in raw]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("label").take(pa.array(row)), pa.array(np.full(len(row), dim)), pa.array(i), pa.array(j), pa.array(np.full(len(row), int(probes))),
                         part.column("id").take(pa.array(row)), part.column("copies").take(pa.array(row)), pa.array(home[0][row]), pa.array(home[1][row]),
                         pa.array([values[k] for k in row], pa.binary())],
                        names=["label", "dim", "i", "j", "probe", "id", "copies", "hi", "hj", "vec"])

    cell = ["label", "dim", "i", "j"]
    schema = f"label {label_type}, dim long, i long, j long, probe long, id long, copies long, hi long, hj long, vec binary"
    stored = reps.select("label", "id", "copies", "vec").mapInArrow(lambda b: look(b, False), schema)
    probes = reps.select("label", "id", "copies", "vec").mapInArrow(lambda b: look(b, True), schema)
    stored.select(*cell).groupBy(*cell).count().where(F.col("count") > CHUNK).select(*cell, F.ceil(F.col("count") / CHUNK).alias("chunks")).write.parquet(f"{base}/large")
    large = spark.read.parquet(f"{base}/large")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Each row goes to one chunk of its own kind and to all chunks of the other kind."""
        n = F.coalesce("chunks", F.lit(1)).cast("int")
        return (df.join(large, cell, "left").withColumn(own, F.pmod(F.xxhash64("id"), n).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), n - 1))).drop("chunks"))

    rows = dealt(stored, "dc", "pc").unionByName(dealt(probes, "pc", "dc")).withColumn("block", F.xxhash64(*cell, "dc", "pc"))
    meeting = rows.repartition("block").sortWithinPartitions("block", "probe").select("block", *schema_names(schema))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None       # the stored rows of the current block
        counts: list = []
        for batch in batches:
            keys, kinds = batch.column("block").to_numpy(), batch.column("probe").to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])]) if len(keys) else []
            for start, stop in zip(starts, [*starts[1:], len(keys)]):
                if keys[start] != block:
                    held, block = [], keys[start]
                part = batch.slice(start, stop - start)
                if not kinds[start]:
                    held.append(part)
                elif held:
                    for at in range(0, part.num_rows, CHUNK):
                        counts += linked(part.slice(at, CHUNK), held)
            if len(counts) > 10_000:
                yield out(counts)
                counts = []
        if counts:
            yield out(counts)

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["id", "links", "peer"])

    def linked(part: pa.RecordBatch, held: list[pa.RecordBatch]) -> list[tuple[int, int, int]]:
        found = []
        dim = part.column("dim")[0].as_py()
        p = _unit(_matrix(part.column("vec"), dim))
        p_id, p_label, p_copies = part.column("id").to_numpy(), part.column("label").to_pylist(), part.column("copies").to_numpy()
        for stored in held:
            if stored.column("dim")[0].as_py() != dim:
                continue
            d = _unit(_matrix(stored.column("vec"), dim))
            d_id, d_label = stored.column("id").to_numpy(), stored.column("label").to_pylist()
            a, b = np.nonzero(p @ d.T >= threshold)
            same = (p_id[a] != d_id[b]) & np.fromiter((p_label[x] == d_label[y] for x, y in zip(a, b)), bool, len(a))
            a, b = a[same], b[same]
            if not len(a):
                continue
            d_copies, grid = stored.column("copies").to_numpy(), grids.get(dim)
            if grid:    # does the stored vector look into the prober's cell as well? If not, this is where its link is counted
                used, at = np.unique(b, return_inverse=True)
                g1, g2 = grid.gaps(d[used])
                blind = g1[at, part.column("hi").to_numpy()[a]] + g2[at, part.column("hj").to_numpy()[a]] > grid.reach
            else:
                blind = np.zeros(len(a), bool)
            n_p, n_d = np.zeros(len(p), np.int64), np.zeros(len(d), np.int64)
            np.add.at(n_p, a, d_copies[b])
            np.add.at(n_d, b[blind], p_copies[a[blind]])
            low_p, low_d = p_id.copy(), d_id.copy()
            while True:     # smallest id that each vector reaches inside this block
                before = low_p.sum() + low_d.sum()
                np.minimum.at(low_p, a, low_d[b])
                np.minimum.at(low_d, b, low_p[a])
                if low_p.sum() + low_d.sum() == before:
                    break
            found += [(int(p_id[k]), int(n_p[k]), int(low_p[k])) for k in np.unique(a)]
            found += [(int(d_id[k]), int(n_d[k]), int(low_d[k])) for k in np.unique(b)]
        return found

    meeting.mapInArrow(meet, "id long, links long, peer long").groupBy("id", "peer").agg(F.sum("links").alias("links")).write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    totals = links.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("id").alias("a"), F.col("peer").alias("b"))).withColumnRenamed("node", "id")
    state = groups.withColumnRenamed("rep", "id").join(totals, "id", "left").join(roots, "id", "left").select(
        *_KEY, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    state.write.parquet(f"{base}/state")
    state = spark.read.parquet(f"{base}/state")
    plain = vectors.select(F.col(id_col).alias("__id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    hashed = plain.select("__id", "label", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(7), "vec").alias("h2"))
    result = hashed.join(state, _KEY, "left")
    component = F.when(F.col("__id").isNotNull(), F.coalesce("component_id", F.col("__id").cast("long")))
    return result.select(F.col("__id").alias(id_col), F.when(F.col("__id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                         component.alias("component_id"), component.eqNullSafe(F.col("__id").cast("long")).alias("kept"))


def schema_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]
