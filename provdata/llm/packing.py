"""Best-fit packing of token sequences: bounded-space online best-fit.

Each task tokenizes its documents and packs their pieces as they come. A fixed number of bins is
open; a bitset keyed by free space finds the open bin with the least space that still fits. If
none fits, a bin is opened, and if too many are, the fullest closes first. Bins still open
when a task ends are items of the next round, where ``fan_in`` tasks' bins meet in one, until one
group is left; a round moves at most ``fan_in * open_bins`` small rows to a task.

Only the places of the pieces are rows; the ids themselves are checked by a CRC and never stored.

Defined results: a null or empty text is one piece of its end token; equal rows are packed as often
as they occur; an empty table packs nothing; a text longer than ``size`` is cut, its first piece
taking what the division leaves; any other piece is a whole document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provdata.llm.arrays import slices, split_lists
from provdata.llm.tables import materialize

#: A space beside other white space, or at an end: such texts are encoded whole. (Fixed values: white space.)
_ODD_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\pZ] | [\s\x0b\x1c-\x1f\x{85}\pZ]|^ | $"
_CACHE_ENTRIES = 400_000


class Encoder:
    """Token ids of texts, each distinct blank-separated part encoded once.

    The vocabulary's patterns attach one blank to what follows it and never reach over a blank behind
    a visible character, so a text is the sequence of its parts " word". Parts that are new are
    joined and encoded in one call, by the same merges in tiktoken, which is several times faster;
    the lengths of the tokens' bytes then show where each part ends. Texts in which a blank meets
    other white space, or that hold the content of an added token (it has an id of its own), are encoded whole by the
    tokenizers library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD_SPACE, *added])
        self.fast, self.n_bytes = _byte_bpe(path)
        self._clear()

    def _clear(self) -> None:
        self.after: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> int:
        """Store more parts; the slot of the first."""
        slot = len(self.lengths)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
        return slot

    def _slots_after(self, parts: list[str]) -> np.ndarray:
        """Slots of the distinct ``parts``, each behind a blank."""
        slots = list(map(self.after.get, parts))
        new = [p for p, slot in zip(parts, slots) if slot is None]
        if new:
            ids = self.fast.encode_to_numpy(" " + " ".join(new), allowed_special=set(), disallowed_special=())
            ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in new), np.int64, len(new)))
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, side="right")
            slot = self._add(np.diff(cuts, prepend=0), ids.astype(np.uint32))
            self.after.update(zip(new, range(slot, slot + len(new))))
            slots = map(self.after.__getitem__, parts)
        return np.fromiter(slots, np.int64, len(parts))

    def _slots_first(self, parts: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(p for p in parts if p not in self.first))
        if new:
            found = [self.fast.encode_ordinary(p) for p in new]
            slot = self._add(np.array([len(x) for x in found], np.int64), np.array(sum(found, []), np.uint32))
            self.first.update(zip(new, range(slot, slot + len(new))))
        return np.fromiter(map(self.first.__getitem__, parts), np.int64, len(parts))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        if self.fast is None:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        parts = split_lists(pc.split_pattern(pc.replace_with_mask(
            texts, pa.array(np.isin(np.arange(len(texts)), odd)), pa.scalar("")), " "))
        if len(self.after) + len(self.first) > _CACHE_ENTRIES:
            self._clear()
        plain = parts.dictionary.to_pylist()
        firsts = parts.offsets[:-1]
        later = np.ones(len(parts.codes), bool)
        later[firsts] = False
        slots = np.zeros(len(parts.codes), np.int64)
        used = np.unique(parts.codes[later])
        by_code = np.zeros(len(plain), np.int64)
        by_code[used] = self._slots_after([plain[c] for c in used])
        slots[later] = by_code[parts.codes[later]]
        slots[firsts] = self._slots_first([plain[c] for c in parts.codes[firsts]])
        lengths = self.lengths[slots]
        ends = np.cumsum(lengths)
        flat = self.ids[np.repeat(self.starts[slots] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[parts.offsets]
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for k in odd:
            out[k] = np.array(self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, np.uint32)
        return out


def _byte_bpe(path: str):
    """The vocabulary in tiktoken, and the number of bytes of each id; None if it isn't a byte-level BPE in rank order."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        return None, None
    # Byte-level vocabularies write printable Latin-1 bytes as themselves, the others as U+0100 onwards.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    as_byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(as_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if spec.get("normalizer") or merged != sorted(merged):
        return None, None
    n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        n_bytes[i] = len(token)
    # The pattern that the ByteLevel pre-tokenizer splits by (fixed value).
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), n_bytes


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class BestFit:
    """Open bins of ``size``, at most ``most`` of them; numbers of new bins count up from ``first``."""

    def __init__(self, size: int, most: int, first: int):
        self.size, self.most, self.next = size, most, first
        self.mask, self.by_free, self.open = 0, {}, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the place in it that the next ``length`` tokens get."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            if self.open == self.most:  # only a new bin finds all open: the fullest closes
                fullest = (self.mask & -self.mask).bit_length() - 1
                if fullest <= left:
                    self._take(fullest)
                else:
                    return number, self.size - free
            self.by_free.setdefault(left, []).append(number)
            self.mask |= 1 << left
            self.open += 1
        return number, self.size - free

    def rest(self) -> list[tuple[int, int]]:
        """Bins still open, with their used sizes, fullest first."""
        return [(b, self.size - free) for free in sorted(self.by_free) for b in self.by_free[free]]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, part int"


def _pieces(path: str, size: int, end_id: int, open_bins: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("part", pa.int32())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode, bins, part = encoder(path), None, 0
        for batch in slices(batches, "text"):
            if bins is None:
                part = batch["part"][0].as_py()
                bins = BestFit(size, open_bins, part << 36)
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cut = len(ids) - (len(ids) - 1) // size * size
                for k, (a, b) in enumerate(zip([0, *range(cut, len(ids), size)], range(cut, len(ids) + 1, size))):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), *bins.place(b - a), part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if bins is not None and bins.open:
            rows = [(None, None, None, used, None, number, None, part) for number, used in bins.rest()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def _merge(size: int, open_bins: int):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        bins, rows, first = BestFit(size, open_bins, 0), [], {}
        for used, number in sorted(zip(items["used"], items["bin"]), key=lambda x: (-x[0], x[1])):
            place, shift = bins.place(int(used))
            rows.append((number, first.setdefault(place, number), shift))
        rest = {first[place]: used for place, used in bins.rest()}
        return pd.DataFrame([(b, to, shift, rest.get(to) if to == b else None, items["group"].iloc[0])
                             for b, to, shift in rows], columns=["bin", "to", "shift", "used", "group"]).astype(
            {"used": "Int64"})
    return run


def pack(df: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, open_bins: int = 32, fan_in: int = 8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a vocabulary for the tokenizers library, the same on all machines.
    """
    rows = materialize(
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                  F.spark_partition_id().alias("part"))
        .mapInArrow(_pieces(tokenizer, size, end_id, open_bins), _PIECES))
    pieces = rows.where("piece is not null").drop("part")
    left = rows.where("piece is null").select("bin", F.col("length").alias("used"), F.col("part").alias("group"))
    moved = left.select("bin", F.col("bin").alias("sequence"), F.lit(0).cast("long").alias("shift"))
    groups = (left.agg(F.max("group")).first()[0] or 0) + 1
    while groups > 1:
        groups = -(-groups // fan_in)
        merged = materialize(left.withColumn("group", F.floor(F.col("group") / fan_in).cast("int")).groupBy("group")
                             .applyInPandas(_merge(size, open_bins), "bin long, to long, shift long, used long, group int"))
        step = merged.select(F.col("bin").alias("sequence"), "to", F.col("shift").alias("more"))
        moved = materialize(moved.join(step, "sequence", "left").select(
            "bin", F.coalesce("to", "sequence").alias("sequence"),
            (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")))
        left = merged.where("used is not null").select("bin", "used", "group")
    return (pieces.join(moved, "bin", "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence", "bin").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))
