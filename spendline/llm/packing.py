"""Packing: documents are cut into pieces and placed in sequences under three limits at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendline.llm.tokens import _ENCODERS, encoder
from spendline.llm.words import drop_others, portions

POOL = 2048         # remainders that a task weighs against each other at a time
WAITING = 1_000_000 # ids of placed pieces that a task holds before it hands them on
LEAST_CUT = 8       # a gap below this is padded rather than filled with a cut-off piece


class Packer:
    """Dot-product vector packing of one task's pieces; holds at most `POOL` documents' remainders.

    A piece is the vector (tokens, segments, loss-bearing tokens). An open sequence takes, as long as any fits, the piece with
    the largest dot product between the piece and what is left of each limit, both as shares of the limits. When none fits,
    the gap is filled with a cut from the longest remaining piece. Full windows of long documents need no choice.
    """

    def __init__(self, capacity: int, max_segments: int, max_loss: int, first_sequence: int):
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.sequence = first_sequence
        self.waiting: list[tuple] = []      # (document, ids, start, end, first loss-bearing id)
        self.out: list[tuple] = []          # (document, ids, start, length, sequence, offset)
        self.placed = 0                     # ids in `out`

    def add(self, document: tuple, ids: np.ndarray, loss_from: int) -> None:
        start = 0
        while len(ids) - start >= self.capacity and self._loss(start, start + self.capacity, loss_from) <= self.max_loss:
            self._emit(document, ids, start, self.capacity, 0)
            self.sequence += 1
            start += self.capacity
        while start < len(ids):     # one turn, unless the loss limit forbids a whole window
            end = min(len(ids), start + self.capacity, max(loss_from, start) + self.max_loss)
            self.waiting.append((document, ids, start, end, loss_from))
            start = end
        if len(self.waiting) >= POOL:
            self._pack(final=False)

    def finish(self) -> None:
        self._pack(final=True)

    @staticmethod
    def _loss(start: int, end: int, loss_from: int) -> int:
        return max(0, end - max(start, loss_from))

    def _emit(self, document: tuple, ids: np.ndarray, start: int, length: int, offset: int) -> None:
        self.out.append((document, ids, start, length, self.sequence, offset))
        self.placed += length

    def _pack(self, final: bool) -> None:
        items, self.waiting = self.waiting, []
        limits = np.array([self.capacity, self.max_segments, self.max_loss], float)
        vectors = np.array([[e - s, 1, self._loss(s, e, f)] for _, _, s, e, f in items], float).reshape(-1, 3)
        free = np.ones(len(items), bool)
        while free.any():
            if not final and free.sum() < POOL // 4:    # these meet the next documents
                self.waiting = [items[k] for k in np.flatnonzero(free)]
                return
            left, chosen = limits.copy(), []
            while True:
                fits = free & (vectors <= left).all(1)
                if fits.any():
                    k = int(np.argmax(np.where(fits, (vectors / limits) @ (left / limits), -1.0)))
                    chosen.append(items[k])
                    left -= vectors[k]
                    free[k] = False
                    continue
                if left[0] >= LEAST_CUT and left[1] >= 1 and free.any():
                    k = int(np.argmax(np.where(free, vectors[:, 0], -1.0)))
                    document, ids, start, end, loss_from = items[k]
                    cut = int(min(left[0], max(loss_from - start, 0) + left[2]))
                    if cut > 0:
                        chosen.append((document, ids, start, start + cut, loss_from))
                        left -= [cut, 1, self._loss(start, start + cut, loss_from)]
                        items[k] = (document, ids, start + cut, end, loss_from)
                        vectors[k] = [end - start - cut, 1, self._loss(start + cut, end, loss_from)]
                        continue
                break
            if free.any():
                self._place(chosen)
            else:
                self._place_last(chosen)

    def _place(self, chosen: list[tuple]) -> None:
        offset = 0
        for document, ids, start, end, _ in chosen:
            self._emit(document, ids, start, end - start, offset)
            offset += end - start
        self.sequence += 1

    def _place_last(self, chosen: list[tuple]) -> None:
        """The task's last sequence is cut at powers of two, which need no padding."""
        pieces, left = list(reversed(chosen)), sum(end - start for _, _, start, end, _ in chosen)
        while left:
            size = min(self.capacity, 1 << (left.bit_length() - 1))
            left -= size
            part: list[tuple] = []
            while size:
                document, ids, start, end, loss_from = pieces.pop()
                taken = min(size, end - start)
                part.append((document, ids, start, start + taken, loss_from))
                if start + taken < end:
                    pieces.append((document, ids, start + taken, end, loss_from))
                size -= taken
            self._place(part)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loss_from_col: str | None = None, capacity: int = 1024,
                   max_segments: int = 128, max_loss: int | None = None, end_id: int = 0, with_ids: bool = True,
                   ranks_file: str | None = None) -> DataFrame:
    """One row per piece: the document's id, `start`, `length`, `ids` (only `with_ids`), `ids_crc32`, `doc_tokens`,
    `sequence_id`, `offset`, `loss_tokens`.

    Each document's ids are followed by `end_id`; each id lies in exactly one piece. A sequence holds at most `capacity` ids,
    `max_segments` pieces and `max_loss` loss-bearing ids (default: `capacity`). `loss_from_col` names the column with the
    position of the first loss-bearing id (null or absent: 0), as for a prompt that is not trained on.

    Every task packs its own rows as they stream by, with a bounded pool, so nothing is shuffled and a lost task is simply
    run again. Sequence ids are the partition's number times 2^40 plus a counter.

    Null texts count as empty: one piece with `end_id` alone. Null ids and repeated rows are carried through, each row by
    itself. An empty table gives no rows. Other columns are not read, so their names cannot clash.
    """
    max_loss = capacity if max_loss is None else max_loss
    if min(capacity, max_segments, max_loss) < 1:
        raise ValueError("capacity, max_segments and max_loss must be positive")
    id_type = docs.schema[id_col].dataType
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                         (F.coalesce(F.col(loss_from_col).cast("long"), F.lit(0)) if loss_from_col else F.lit(0).cast("long")).alias("loss_from"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(_ENCODERS)
        codec = encoder(ranks_file)
        packer = Packer(capacity, max_segments, max_loss, TaskContext.get().partitionId() << 40)
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in portions(batch):
                flat, sizes = codec.encode(part.column("text"))
                stop = np.cumsum(sizes)
                for key, size, end, loss_from in zip(part.column("id").to_pylist(), sizes, stop, part.column("loss_from").to_pylist(), strict=True):
                    ids = np.empty(size + 1, "<u4")
                    ids[:size] = flat[end - size:end]
                    ids[size] = end_id
                    packer.add((key, size + 1, max(0, loss_from)), ids, max(0, loss_from))
                if packer.placed >= WAITING or len(packer.out) >= 5000:
                    yield rows(packer, kind)
        packer.finish()
        if packer.out:
            yield rows(packer, kind)

    def rows(packer: Packer, kind: pa.DataType) -> pa.RecordBatch:
        out, packer.out, packer.placed = packer.out, [], 0
        columns = {
            "id": pa.array([d[0] for d, *_ in out], kind),
            "start": pa.array([s for _, _, s, *_ in out], pa.int64()),
            "length": pa.array([n for _, _, _, n, *_ in out], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(ids[s:s + n]) for _, ids, s, n, *_ in out], pa.int64()),
            "doc_tokens": pa.array([int(d[1]) for d, *_ in out], pa.int64()),
            "sequence_id": pa.array([q for *_, q, _ in out], pa.int64()),
            "offset": pa.array([o for *_, o in out], pa.int64()),
            "loss_tokens": pa.array([Packer._loss(s, s + n, d[2]) for d, _, s, n, *_ in out], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([ids[s:s + n].astype(np.int32) for _, ids, s, n, *_ in out], pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(columns)

    schema = (f"id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
              + (", ids array<int>" if with_ids else ""))
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)
