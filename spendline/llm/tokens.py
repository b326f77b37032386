"""Ids of a public byte-level BPE, computed once for each distinct word of a batch."""

from __future__ import annotations

import base64
import json
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spendline.llm.words import kept

#: Texts with white space before a space, or at their end, are encoded whole: there a cut before a space could change the ids.
_WIDE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]( |\z)"


class WordEncoder:
    """`encode(texts)` gives the flat ids of all texts and the number of ids of each.

    The pre-tokeniser of the vocabulary never joins a space to what stands before it, so a text can be cut before every
    single space without changing its ids. The distinct words of a batch are encoded in one call, and the lengths of the
    tokens tell where each word ends. The ids equal those that `tokenizers` gives with the JSON file of the same vocabulary
    and `add_special_tokens=False` (tested): a text is first cut at the `added` tokens, which have ids of their own.
    """

    def __init__(self, ranks_file: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        self._ids = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._added = added or {}
        self._cut = "|".join(re.escape(t) for t in sorted(self._added, key=len, reverse=True))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word with a space before it: flat, and where each word's ids start (one more entry than words)."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        flat = np.array(self._ids(" " + joined) if len(words) else [], np.uint32)
        ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = np.cumsum(self._bytes[flat])
        starts = np.searchsorted(at, ends) + 1
        if len(ends) and not np.array_equal(at[starts - 1], ends):
            raise ValueError("a token crosses the border of a word")
        return flat, np.concatenate([[0], starts])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        marked = np.zeros(len(texts), bool)
        for token in self._added:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._plain(texts)
        # what lies between added tokens is a text of its own; an added token is an empty one until its id is put in
        cut, parts, fixed, owner = re.compile(f"({self._cut})"), [], [], []
        for k, text in enumerate(texts.to_pylist()):
            for n, part in enumerate(cut.split(text) if marked[k] else [text]):
                parts.append("" if n % 2 else part)
                fixed.append(self._added[part] if n % 2 else -1)
                owner.append(k)
        flat, sizes = self._plain(pa.array(parts, pa.string()))
        fixed, starts = np.array(fixed, np.int64), np.cumsum(sizes) - sizes
        at = np.flatnonzero(fixed >= 0)
        flat = np.insert(flat, starts[at], fixed[at])
        sizes[at] = 1
        ends = np.searchsorted(owner, np.arange(len(texts)), "right")
        return flat, np.diff(np.concatenate([[0], np.cumsum(sizes)[ends - 1]]))

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in which no added token counts."""
        wide = pc.match_substring_regex(texts, _WIDE)
        pieces = pc.split_pattern(pc.if_else(wide, "", texts), " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        words = pieces.flatten()
        coded = words.dictionary_encode()
        flat, starts = self._words(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # the first word of a text has no space before it, and a wide text is one unit
        first = np.cumsum(counts) - counts
        firsts = pc.if_else(wide, texts, words.take(pa.array(first))).dictionary_encode()
        own = [self._ids(w) for w in firsts.dictionary.to_pylist()]
        sizes = np.array([len(x) for x in own], np.int64)
        starts = np.concatenate([starts, len(flat) + np.cumsum(sizes)])
        at[first] = len(coded.dictionary) + firsts.indices.to_numpy(zero_copy_only=False)
        flat = np.concatenate([flat, np.array([i for x in own for i in x], np.uint32)])
        lengths = np.diff(starts)[at]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        gathered = flat[np.arange(sums[-1]) + np.repeat(starts[at] - sums[:-1], lengths)]
        return gathered, sums[first + counts] - sums[first]


def added_tokens(json_file: Path) -> dict[str, int]:
    """The added tokens that a tokenizer file lists, and their ids; none if there is no such file."""
    if not json_file.exists():
        return {}
    listed = json.loads(json_file.read_text(encoding="utf-8"))["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in listed):
        raise ValueError("added tokens that depend on what stands beside them")
    return {t["content"]: t["id"] for t in listed}


_ENCODERS: dict[str, WordEncoder] = kept({})


def encoder(ranks_file: str | None = None) -> WordEncoder:
    """The worker's encoder for a rank file (added tokens: from the JSON file beside it); by default the public 50k byte-level vocabulary."""
    import public_tokenizers as public
    key = ranks_file or public.path("byte_bpe_50k.tiktoken")
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(key, public.PATTERN, added_tokens(Path(key).with_suffix(".json")))
    return _ENCODERS[key]
