"""Byte-level BPE as a transducer: encoding by a lazily determinised machine, decoding by a UTF-8 machine.

Merging pairs by rank gives, for the bytes of one match of the split pattern, the one sequence of tokens in
which every two neighbours are *compatible*: merging their joint bytes gives back these two. So the tokens of a
prefix end in the only vocabulary entry that is a suffix of it and compatible with the last token before it.
``Transducer`` reads bytes from left to right. A state holds every earlier position from which a token may still be under
way (and could follow what is before it): its place in the trie of the vocabulary, the last token before it, and the tokens to it that
are not out yet. Tokens that all these positions share are put out, so none is held back further than the
longest vocabulary entry; and as the tokens behind a certain boundary are those of the remaining bytes alone, a state is
determined by the bytes read since that boundary. States and arcs are made when first met, and the table is dropped and begun anew when it
is full, so a worker's memory is bounded by ``MAX_STATES`` and ``MAX_PIECES``.

``Utf8Stream`` decodes: tokens go in, the bytes of whole characters come out, and what may still become a
character is held, three bytes at most; malformed bytes are passed on as they are.

Defined results: null and empty texts have no tokens, and no tokens decode to no bytes (null: none). Rows are
independent, so equal rows, ties, null or repeated ids and the order of rows change nothing; an empty table stays
empty. Texts are read whole however long: a batch is worked on in slices of 4 MB or one text. All columns stay as
they are; the new one takes the place of a column of its own name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provdata.llm.arrays import slices, split_lists

MAX_STATES = 200_000
MAX_PIECES = 250_000
MAX_CHAINS = 10_000
FEW = 16
SLICE_BYTES = 4 << 20

#: Code points that are letters or numbers for the `regex` package alone, whose tables are newer than
#: the Unicode 16 of the tokenizer that results are to equal. There they are neither.
NEWER_THAN_UNICODE_16 = "".join("-".join(chr(int(end, 16)) for end in span.split("-")) for span in (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
).split())


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
    """The tokens of ``piece`` by repeated merging of the pair of least rank (the leftmost of ties), and the last pair merged."""
    parts, last = [piece[k:k + 1] for k in range(len(piece))], None
    while len(parts) > 1:
        rank, k = min((ranks.get(a + b, len(ranks) + 256), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if parts[k] + parts[k + 1] not in ranks:
            break
        last = (parts[k], parts[k + 1])
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return parts, last


class Transducer:
    """Bytes in, token ids out, equal to merging by rank.

    A state is a number; ``alive`` holds for it (trie node, last token or -1 if it is out, tokens not yet out) of each position, oldest
    first, the present one last. ``arcs`` leads from ``state << 8 | byte`` to ``next state << 24 | number of an output``.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds all 256 single bytes")
        self.ranks, self.max_states = ranks, max_states
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        #: The two tokens that the last merge of a token joins, and the token's own bytes.
        self.halves: dict[int, tuple[int, int]] = {}
        self.bytes_of: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.behind: dict[int, tuple] = {}
        self.chains: tuple[dict, dict] = ({}, {})
        for token, rank in ranks.items():
            if len(token) > 1:
                parts, last = merge_by_rank(token, ranks)
                if len(parts) > 1:  # no merges lead to it: it only ever stands for a whole piece
                    continue
                self.halves[rank] = (ranks[last[0]], ranks[last[1]])
            self._insert(token, rank)
        self._clear()

    def _insert(self, token: bytes, rank: int) -> None:
        node = 0
        for b in token:
            if b not in self.children[node]:
                self.children[node][b] = len(self.children)
                self.children.append({})
                self.token_at.append(-1)
            node = self.children[node][b]
        self.token_at[node] = rank

    def _clear(self) -> None:
        start = ((0, -1, ()),)
        self.alive, self.states = [start], {start: 0}
        self.arcs: dict[int, int] = {}
        self.outputs, self.output_ids = [()], {(): 0}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joint bytes of two tokens leaves their boundary.

        Merges proceed on both sides of the boundary by rank: at its left stands a token of the chain of right halves of
        ``left``, at its right one of the chain of left halves of ``right``. The boundary goes if the two that meet
        make a token before either of them is used up within its own side.
        """
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is not None:
            return known
        ups, downs = self._chain(left, 1), self._chain(right, 0)
        never, ranks = 1 << 60, self.ranks
        i, j, top, end = 0, 0, len(ups) - 1, len(downs) - 1
        while True:
            joined = ranks.get(ups[i][0] + downs[j][0], never)
            next_a, next_b = ups[i][1], downs[j][1]
            if joined < next_a and joined <= next_b:
                ok = False
                break
            if i == top and j == end:
                ok = True
                break
            if next_a <= next_b:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= 3 * self.max_states:
            self.pairs = {}
        self.pairs[pair] = ok
        return ok

    def _leads_on(self, node: int, last: int) -> bool:
        """Whether a token behind ``node`` can follow ``last``; taken for granted where more than ``FEW`` tokens lie behind."""
        few = self.behind.get(node)
        if few is None:
            few, todo = [], list(self.children[node].values())
            while todo and len(few) <= FEW:
                child = todo.pop()
                if self.token_at[child] >= 0:
                    few.append(self.token_at[child])
                todo += self.children[child].values()
            if len(self.behind) >= self.max_states:
                self.behind = {}
            self.behind[node] = few = () if len(few) > FEW else tuple(few)
        return not few or any(self.compatible(last, token) for token in few)

    def _chain(self, token: int, side: int) -> tuple:
        """(bytes, rank of the merge that uses it up) of the single byte at that side of ``token`` up to ``token`` itself."""
        chain = self.chains[side].get(token)
        if chain is None:
            if token in self.halves:
                lower = self._chain(self.halves[token][side], side)
                chain = (*lower[:-1], (lower[-1][0], token), (self.bytes_of[token], 1 << 60))
            else:
                chain = ((self.bytes_of[token], 1 << 60),)
            if len(self.chains[side]) >= MAX_CHAINS:
                self.chains[side].clear()
            self.chains[side][token] = chain
        return chain

    def _step(self, state: int, byte: int) -> int:
        """Make the arc of ``state`` under ``byte``: the next state and the tokens that are now certain."""
        alive, present = [], None
        children, token_at, pairs = self.children, self.token_at, self.pairs
        for node, last, held in self.alive[state]:
            child = children[node].get(byte)
            if child is None:
                continue
            token = token_at[child]
            if token >= 0 and present is None:
                fits = last < 0 or pairs.get(last << 32 | token)
                if self.compatible(last, token) if fits is None else fits:
                    present = (0, token, (*held, token))
            if children[child] and (last < 0 or self._leads_on(child, last)):
                alive.append((child, last, held))
        alive.append(present)
        out, first = 0, alive[0][2]
        if first:  # tokens in front that all positions share
            out = len(first)
            for _, _, held in alive:
                while held[:out] != first[:out]:
                    out -= 1
        # What follows a certain boundary is tokenised by itself, so the token before it is forgotten.
        key = tuple([(node, last if len(held) > out else -1, held[out:]) for node, last, held in alive] if out else alive)
        if len(self.alive) >= self.max_states:
            self._clear()
            state = None
        to = self.states.setdefault(key, len(self.alive))
        if to == len(self.alive):
            self.alive.append(key)
        put = first[:out]
        number = self.output_ids.setdefault(put, len(self.outputs))
        if number == len(self.outputs):
            self.outputs.append(put)
        if state is not None:
            self.arcs[state << 8 | byte] = to << 24 | number
        return to << 24 | number

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one match of the split pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ids = 0, []
        arc_of = self.arcs.get
        for byte in piece:
            arc = arc_of(state << 8 | byte)
            if arc is None:
                arc = self._step(state, byte)
                arc_of = self.arcs.get
            state = arc >> 24
            if arc & 0xFFFFFF:
                ids += self.outputs[arc & 0xFFFFFF]
        ids += self.alive[state][-1][2]
        return ids


def _class_of(pattern: str, newer: bool):
    """The split pattern; ``newer`` for texts with characters that only newer tables call letters or numbers."""
    if newer:
        old = f"[{NEWER_THAN_UNICODE_16}]"
        pattern = (pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{old})")
                   .replace(r"?\p{L}+", rf"?[\p{{L}}--{old}]+").replace(r"?\p{N}+", rf"?[\p{{N}}--{old}]+"))
    return regex.compile(pattern, regex.V1 if newer else regex.V0)


#: A blank beside other white space, or at an end of the text.
_ODD_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\pZ] | [\s\x0b\x1c-\x1f\x{85}\pZ]|^ | $"


class Encoder:
    """Token ids of texts: split by the pattern, each distinct match sent through the transducer once.

    The pattern attaches a blank to what follows it and never reaches over a blank between two visible characters, so such a
    text is the sequence of its parts " word", and each distinct part of a slice is split once. Texts in which a
    blank meets other white space, or with characters that newer tables class otherwise, are split whole.
    """

    def __init__(self, path: str, pattern: str):
        self.machine = Transducer(read_ranks(path))
        self.split, self.split_newer = _class_of(pattern, False).findall, _class_of(pattern, True).findall
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _slots_of(self, pieces: list[str]) -> np.ndarray:
        """The slot of each match, where its ids lie."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.slots))
        if new:
            found = [self.machine.encode(p.encode()) for p in new]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for one in found for i in one), np.int32, int(lengths.sum()))
            self.slots.update(zip(new, range(len(self.lengths), len(self.lengths) + len(new))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
        return np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens of each text, all ids one text after the other); texts without nulls."""
        if len(self.slots) > MAX_PIECES:
            self._clear()
        newer = pc.match_substring_regex(texts, f"[{NEWER_THAN_UNICODE_16}]").to_numpy(zero_copy_only=False)
        odd = newer | pc.match_substring_regex(texts, _ODD_BLANK).to_numpy(zero_copy_only=False)
        parts = split_lists(pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " "))
        # A text's first part has no blank before it; an odd text is its own only part.
        words, firsts = parts.dictionary.to_pylist(), parts.offsets[:-1]
        later = np.ones(len(parts.codes), bool)
        later[firsts] = False
        used = np.unique(parts.codes[later])
        number = np.empty(len(parts.codes), np.int64)
        number[later] = np.searchsorted(used, parts.codes[later])
        number[firsts] = len(used) + np.arange(len(texts))
        pieces: list[str] = []
        counts = np.empty(len(used) + len(texts), np.int64)
        for k, code in enumerate(used.tolist()):
            found = self.split(" " + words[code])
            pieces += found
            counts[k] = len(found)
        for k, code in enumerate(parts.codes[firsts].tolist()):
            found = (self.split_newer if newer[k] else self.split)(texts[k].as_py() if odd[k] else words[code])
            pieces += found
            counts[len(used) + k] = len(found)
        slots, _ = _gather(self._slots_of(pieces), np.cumsum(counts) - counts, counts, number)
        ids, upto = _gather(self.ids, self.starts, self.lengths, slots)
        per_part = np.concatenate(([0], np.cumsum(counts[number])))
        return np.diff(upto[per_part[parts.offsets]]), ids


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``which`` of ``values`` one after the other, and where each of them begins (and the last ends)."""
    n = lengths[which]
    upto = np.concatenate(([0], np.cumsum(n)))
    return values[np.repeat(starts[which] - upto[:-1], n) + np.arange(upto[-1])], upto


#: A state of the UTF-8 machine is (continuation bytes to come, least and greatest next byte); this one is between characters.
BETWEEN = (0, 0x00, 0x7F)


def utf8_step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """The next state under ``byte``; None if it cannot follow."""
    left, low, high = state
    if left:
        return ((left - 1, 0x80, 0xBF) if left > 1 else BETWEEN) if low <= byte <= high else None
    if byte < 0x80:
        return BETWEEN
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:  # neither overlong forms nor surrogates
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:  # neither overlong forms nor beyond U+10FFFF
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return None


class Utf8Stream:
    """Bytes of any cut in; whole characters out, and malformed bytes as they are as soon as they are known to be."""

    def __init__(self):
        self.state, self.held = BETWEEN, bytearray()

    def feed(self, data: bytes) -> bytes:
        out = bytearray()
        for byte in data:
            to = utf8_step(self.state, byte)
            if to is None and self.held:  # what was held is malformed; the byte may begin a character
                out += self.held
                self.held.clear()
                to = utf8_step(BETWEEN, byte)
            self.held.append(byte)
            if to is None or to == BETWEEN:
                out += self.held
                self.held.clear()
            self.state = to or BETWEEN
        return bytes(out)

    def finish(self) -> bytes:
        out, self.held, self.state = bytes(self.held), bytearray(), BETWEEN
        return out


class Decoder:
    """Bytes of token ids; ids that are no token are refused."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.bytes_of: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        self.whole = np.zeros(len(self.bytes_of), bool)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            stream = Utf8Stream()
            self.whole[rank] = stream.feed(token) == token and _well_formed(token)

    def chunks(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of ``ids`` in pieces that end between characters; runs of whole characters go by at once."""
        at, n = 0, len(ids)
        for k in np.flatnonzero(~self.whole[ids]).tolist():
            if k < at:
                continue
            yield b"".join(map(self.bytes_of.__getitem__, ids[at:k].tolist()))
            stream, at = Utf8Stream(), k
            while at < n:
                yield stream.feed(self.bytes_of[ids[at]])
                at += 1
                if not stream.held:
                    break
            yield stream.finish()
        yield b"".join(map(self.bytes_of.__getitem__, ids[at:].tolist()))

    def __call__(self, ids: np.ndarray) -> bytes:
        return b"".join(self.chunks(ids))


def _well_formed(data: bytes) -> bool:
    state = BETWEEN
    for byte in data:
        state = utf8_step(state, byte)
        if state is None:
            return False
    return state == BETWEEN


_MACHINES: dict[tuple, object] = {}


def _machine(kind, *key):
    """One encoder or decoder for each Python worker and vocabulary."""
    if (kind, *key) not in _MACHINES:
        _MACHINES[kind, *key] = kind(*key)
    return _MACHINES[kind, *key]


def _cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of ``most`` in all, or of one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text`` as column ``into`` (array of int)."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _machine(Encoder, path, pattern)
        for texts in batches:
            texts = pc.fill_null(texts, "")
            lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for a, b in _cuts(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), SLICE_BYTES):
                n, found = encoder(texts.slice(a, b - a))
                lengths.append(n)
                ids.append(found)
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))

    return df.withColumn(into, encode(F.col(f"`{text}`")))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the token ids of column ``ids`` stand for as column ``into`` (binary)."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _machine(Decoder, path)
        for lists in batches:
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            valid = lists.is_valid().to_pylist()
            yield pa.array([decoder(values[a:b]) if ok else b"" for a, b, ok in zip(offsets[:-1], offsets[1:], valid)],
                           pa.binary())

    return df.withColumn(into, decode(F.col(f"`{ids}`")))


def encode_and_decode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id, the token ids of column ``text`` (``ids``) and the bytes decoded from them (``decoded``), in one pass of small batches."""
    from pyspark.sql.pandas.types import to_arrow_type

    doc_id = df.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", doc_id), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])
    id_type = to_arrow_type(doc_id)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _machine(Encoder, path, pattern), _machine(Decoder, path)
        for part in slices(batches, "text", SLICE_BYTES):
            lengths, ids = encoder(pc.fill_null(part["text"], ""))
            ends = np.concatenate(([0], np.cumsum(lengths)))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].cast(id_type), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                 pa.array([decoder(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())], ["doc_id", "ids", "decoded"])

    return df.select("doc_id", F.col(f"`{text}`").alias("text")).mapInArrow(code, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Digests of ids and of the bytes decoded from them: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_and_decode(df, path, pattern, text).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
