"""Texts in Arrow batches: bounded slices, words, hashes.

Words are the maximal runs without the six ASCII white-space characters. Everything here is
vectorised over a slice of a batch and holds no more than that slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def slices(batches, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of a slice have ``max_bytes`` in all or are one text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """Words of a slice: text k has ``codes[offsets[k]:offsets[k + 1]]``, codes into ``dictionary``."""

    offsets: np.ndarray
    codes: np.ndarray
    dictionary: pa.Array

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a value of each dictionary entry."""
        run = np.concatenate(([0], np.cumsum(values[self.codes])))
        return run[self.offsets[1:]] - run[self.offsets[:-1]]

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each dictionary entry."""
        raw = self.dictionary.cast(pa.binary()).to_pylist()
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in raw), np.uint64, len(raw))


def split_lists(lists: pa.Array) -> Words:
    coded = lists.values.dictionary_encode()
    return Words(lists.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy(), coded.dictionary)


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text (null: none); ``lower`` maps A-Z to a-z first."""
    texts = pc.fill_null(texts, "")
    found = split_lists(pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts))
    empty = pc.index(found.dictionary, "").as_py()
    if empty >= 0:
        real = found.codes != empty
        found = Words(np.concatenate(([0], np.cumsum(real)))[found.offsets], found.codes[real], found.dictionary)
    return found


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each window of ``width`` values, over the whole array."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for k in range(1, width):
        out = scramble(out) * _MUL + values[k:k + n]
    return scramble(out)
