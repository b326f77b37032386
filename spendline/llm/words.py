"""Words of a batch of texts as numbers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

KEPT: list[dict] = []   # what operators keep in a worker between tasks
PORTION = 1 << 20       # bytes of text that are worked on together; a longer text is worked on alone


def kept(store: dict) -> dict:
    """Registers what an operator keeps in its worker from task to task, so that others can drop it (`drop_others`)."""
    KEPT.append(store)
    return store


def drop_others(own: dict | None = None) -> None:
    """At the start of a task: a worker forgets what other operators kept in it, and hands freed memory back.

    Spark gives the workers of one stage to the next. Only time depends on what is kept.
    """
    for store in KEPT:
        if store is not own:
            store.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # not the GNU library
        pass


def portions(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch in order, with at most `PORTION` bytes of text or one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    reached, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        limit = (reached[start - 1] if start else 0) + PORTION
        stop = max(start + 1, int(np.searchsorted(reached, limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the number of each word in its place, and the number of words of each text (null: none).

    Words are runs without ASCII white space; `lower` changes A-Z only.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    texts = pc.ascii_trim_whitespace(texts)
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    words = lists.flatten()
    if empty.any():     # an empty text splits into one empty word
        words = words.filter(pa.array(~np.repeat(empty, counts)))
        counts[empty] = 0
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes, the same in every task."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words.to_pylist(), object), categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` values (len - width + 1 of them)."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(out)]
    return mix(out)


def shingles(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one."""
    words, at, counts = split_words(texts)
    hashes = hash_words(words)[at]
    runs = rolling(hashes, width) if len(hashes) >= width else np.zeros(0, np.uint64)
    out, start = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(runs[start:start + n - width + 1]))
        elif n:
            out.append(rolling(mix(hashes[start:start + n] + np.uint64(n)), n))
        else:
            out.append(np.zeros(0, np.uint64))
        start += n
    return out
