"""Quality rules: compression bands.

zstandard ratios (compressed over raw bytes) of the whole text and of its chunks, which cover every byte
of it. Text that repeats itself compresses too well, encoded or random text too badly. What is usual
depends on the length, as short texts carry the frame's overhead and give the matcher little to find, so
each length class has its own limits; whole chunks have one pair, a shorter one that of its length.

The base measures (words, symbols, repeated lines, repeated 8-word windows) are columns beside the
verdict. Each row is judged by itself, in slices of bounded size: no shuffle, no state.

Defined results: a null or empty text has no words and fails the base rules; texts under the first
class have no band of their own; equal rows get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provdata.llm.arrays import Words, slices, split_lists, window_hashes, words


@dataclass(frozen=True)
class Bands:
    """Limits of the ratios: from each class's least length in bytes on, the least and the greatest ratio."""

    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.42, 0.98), (192, 0.41, 0.89), (256, 0.40, 0.82), (384, 0.39, 0.78), (512, 0.38, 0.73), (768, 0.37, 0.68),
        (1024, 0.36, 0.64), (2048, 0.34, 0.58), (4096, 0.33, 0.55), (8192, 0.32, 0.55), (16384, 0.31, 0.55),
        (32768, 0.30, 0.55))
    #: A rest of less than half a chunk belongs to the chunk before it.
    chunk_bytes: int = 512
    chunk: tuple[float, float] = (0.25, 0.73)
    #: More than this share of the chunks out of their limits rejects the text.
    bad_chunks: float = 0.03
    level: int = 3


_WINDOW = 8
_SYMBOLS = r"[#*$%&|<>]"  # fixed values
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                     ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("ratio", pa.float64()),
                     ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()), ("in_band", pa.bool_())])


def repeated_words(found: Words) -> np.ndarray:
    """Of each text, the words that lie in an 8-word window which occurs twice or more in it."""
    n_texts, n = len(found.offsets) - 1, len(found.codes)
    marked = np.zeros(n + 1, np.int64)
    hashes = window_hashes(found.codes.astype(np.uint64), _WINDOW)
    if len(hashes):
        owner = found.owners()
        inside = owner[: len(hashes)] == owner[_WINDOW - 1:]
        at = np.flatnonzero(inside)
        # The text is part of the key, so windows of different texts never meet.
        keys = window_hashes(np.column_stack([hashes[at], owner[at].astype(np.uint64)]).ravel(), 2)[::2]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = at[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
        np.add.at(marked, twice, 1)
        np.add.at(marked, twice + _WINDOW, -1)
    run = np.concatenate(([0], np.cumsum(np.cumsum(marked)[:n] > 0)))
    return run[found.offsets[1:]] - run[found.offsets[:-1]] if n_texts else np.zeros(0, np.int64)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Of each text, the lines with a word that equal an earlier line."""
    lines = split_lists(pc.split_pattern(texts, "\n"))
    real = pc.match_substring_regex(lines.dictionary, r"[^ \t\n\x0b\x0c\r]").to_numpy(zero_copy_only=False)
    keep = real[lines.codes]
    owner = lines.owners()[keep]
    first = np.unique(owner * max(1, len(lines.dictionary)) + lines.codes[keep]) // max(1, len(lines.dictionary))
    n = len(texts)
    return np.bincount(owner, minlength=n) - np.bincount(first, minlength=n)


def _limits(n_bytes: int, bands: Bands) -> tuple[float, float]:
    return next(((low, high) for least, low, high in reversed(bands.whole) if n_bytes >= least), (0.0, float("inf")))


def _ratios(raw: bytes, compress, bands: Bands) -> tuple[float, int, int, bool]:
    if not raw:
        return 0.0, 0, 0, True
    ratio = len(compress(raw)) / len(raw)
    size = bands.chunk_bytes
    cuts = [*range(0, max(1, len(raw) - size // 2 + 1), size), len(raw)]
    bad = 0
    for start, end in zip(cuts, cuts[1:]):
        low, high = bands.chunk if end - start >= size else _limits(end - start, bands)
        bad += not low <= len(compress(raw[start:end])) / (end - start) <= high
    low, high = _limits(len(raw), bands)
    return ratio, len(cuts) - 1, bad, low <= ratio <= high and bad <= bands.bad_chunks * (len(cuts) - 1)


def _measure(bands: Bands):
    def run(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch["text"], "")
            found = words(texts)
            chars = pc.utf8_length(found.dictionary).to_numpy().astype(np.int64)
            symbols = pc.count_substring_regex(found.dictionary, _SYMBOLS).to_numpy().astype(np.int64)
            ratios = [_ratios(raw, compress, bands) for raw in texts.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(np.diff(found.offsets)), pa.array(found.per_text(chars)),
                pa.array(found.per_text(symbols)), pa.array(repeated_lines(texts)), pa.array(repeated_words(found)),
                *[pa.array(c, t) for c, t in zip(zip(*ratios), _SCHEMA.types[6:])]], schema=_SCHEMA)
    return run


def judge_quality(df: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base measures, ratio, chunks, base_failed, kept."""
    fields = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "ratio double, n_chunks long, n_bad_chunks long, in_band boolean")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_measure(bands), fields)
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
            .drop("in_band"))
