"""Ranked lexical search by bags: documents that no query can tell apart are scored once.

Terms are the maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A
query set (``items``) is taken in blocks of bounded size; for a block

1. each document is cut down to the block's vocabulary: the codes of the terms it holds, ascending, how often each occurs, and
   its number of terms ``n``, which enters the score through an integer ``m`` alone;
2. documents of equal codes, frequencies and ``m`` form a class: they are brought together by a 64-bit hash and told apart by
   the vectors themselves; a class keeps its ``top`` least doc_ids, as no result can name more of it;
3. each class is scored once against the items that share a term with it; each task keeps the ``top`` documents
   of every item, expanding classes by ascending doc_id;
4. a window over these candidates, ``top`` for each item and task, ranks them.

``max_block_bytes`` bounds the item texts (and so the vocabulary and the postings) that tasks receive; an item larger than
that is a block of its own. More items take more blocks, each a scan of the documents, never a larger block.

Defined results: a null text has no terms, like one without any; an item without terms has no results. A repeated
row is a document, or an item, of its own; null ids come before all others among equal scores. Documents of score 0
are never ranked. An empty table on either side gives no rows. Texts are read whole however long, in slices of 4 MB or
one text. Extra columns of either table are never read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provdata.llm.arrays import Words, slices, split_lists
from provdata.llm.tables import materialize, prefix_sums

#: Entries of (class, item, term) that are added up at a time.
_ENTRIES = 1 << 20

_TERM_BYTE = np.full(256, ord(" "), np.uint8)
_TERM_BYTE[0x80:] = np.arange(0x80, 0x100)
for _first, _last in (b"09", b"az"):
    _TERM_BYTE[_first:_last + 1] = np.arange(_first, _last + 1)
_TERM_BYTE[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def terms(texts: pa.Array) -> Words:
    """Terms of each text (null: none)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    blanked = pa.py_buffer(_TERM_BYTE[data])
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, blanked], offset=texts.offset)
    found = split_lists(pc.ascii_split_whitespace(plain))
    empty = pc.index(found.dictionary, pa.scalar("", found.dictionary.type)).as_py()
    if empty >= 0:
        real = found.codes != empty
        found = Words(np.concatenate(([0], np.cumsum(real)))[found.offsets - found.offsets[0]], found.codes[real],
                      found.dictionary)
    return found


@dataclass
class Block:
    """Some items: their ids, the sorted vocabulary, and the items of each term (``postings[starts[t]:starts[t + 1]]``)."""

    item_ids: list
    vocabulary: pa.Array
    starts: np.ndarray
    postings: np.ndarray

    @classmethod
    def of(cls, item_ids: list, texts: pa.Array) -> Block:
        found = terms(texts)
        order = pc.sort_indices(found.dictionary)
        code = np.empty(len(order), np.int64)
        code[order.to_numpy()] = np.arange(len(order))
        pairs = np.unique(code[found.codes] * max(len(texts), 1) + found.owners())
        term, item = np.divmod(pairs, max(len(texts), 1))
        starts = np.searchsorted(term, np.arange(len(order) + 1))
        return cls(item_ids, found.dictionary.take(order), starts, item)


def _blocks(items: DataFrame, max_bytes: int) -> Iterator[Block]:
    """The items in blocks; the driver holds one block at a time."""
    sized = materialize(items.select(F.col("item_id").alias("id"), F.coalesce("text", F.lit("")).alias("body"),
                                     F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
                                     F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_digest")))
    placed = prefix_sums(sized, [F.col("id"), F.col("text_digest")], {"start": F.col("size"), "nr": F.lit(1).cast("long")})
    # A block is begun at each multiple of the limit, so it holds that much and the item across its end; and 65,536 items at most.
    placed = materialize(placed.withColumn("block", F.floor(F.col("start") / max_bytes) + F.floor(F.col("nr") / 65536)))
    for row in placed.groupBy("block").count().orderBy("block").toLocalIterator():
        found = placed.where(F.col("block") == row["block"]).orderBy("nr").select("id", "body").toArrow()
        if found.num_rows:
            yield Block.of(found["id"].to_pylist(), found["body"].combine_chunks())


def document_vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """doc_id, n (terms of the document), codes (into the vocabulary, ascending) and how often each occurs (``tfs``)."""
    doc_id = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("doc_id", doc_id.dataType), T.StructField("n", T.LongType()),
                           T.StructField("codes", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.IntegerType()))])

    def cut_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = terms(part["text"])
            code = pc.index_in(found.dictionary.cast(vocabulary.type), vocabulary)
            code = pc.fill_null(code, -1).to_numpy(zero_copy_only=False).astype(np.int64)[found.codes]
            own, rows = found.owners(), part.num_rows
            keep = code >= 0
            pairs, tfs = np.unique(own[keep] * max(len(vocabulary), 1) + code[keep], return_counts=True)
            row, term = np.divmod(pairs, max(len(vocabulary), 1))
            offsets = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], pa.array(np.diff(found.offsets)),
                pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32)))], ["doc_id", "n", "codes", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(cut_down, schema)


def bag_classes(vectors: DataFrame, total: int, length: int, top: int) -> DataFrame:
    """Classes of equal m, codes and tfs, each with its ``top`` least doc_ids in order; documents without codes are in none.

    ``total`` is the number of documents with a term and ``length`` that of all their terms.
    """
    bags = (vectors.where(F.size("codes") > 0)
            .withColumn("m", F.lit(10).cast("long") + F.expr(f"(90L * n * {total}L) div {max(length, 1)}L"))
            .select("doc_id", "m", "codes", "tfs", F.xxhash64("m", "codes", "tfs").alias("bag")))
    same = ["bag", "m", "codes", "tfs"]
    least = bags.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy("doc_id"))).where(F.col("nth") <= top)
    return least.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("doc_id"))).alias("members"))


def _weights(vectors: DataFrame, n_terms: int, total: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term of the block."""
    out = np.zeros(n_terms, np.int64)
    held = vectors.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df"))
    for code, df in held.toLocalIterator():
        out[code] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
    return out


class TopDocuments:
    """The ``top`` best of each item so far: highest score, then least doc_id (nulls first)."""

    def __init__(self, n_items: int, top: int):
        self.top, self.best = top, [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, np.int64)  # a score below this cannot enter

    def offer(self, item: int, score: int, members: list) -> None:
        best = self.best[item]
        best += [(-score, d is not None, d) if d is not None else (-score, False, 0) for d in members]
        best.sort()
        del best[self.top:]
        if len(best) == self.top:
            self.least[item] = -best[-1][0]


def _score(classes: DataFrame, block: Block, weights: np.ndarray, top: int, id_type: T.DataType) -> DataFrame:
    """(item number, doc_id, score): what each task's classes offer to each item."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", id_type),
                           T.StructField("score", T.LongType())])
    starts, postings, n_items = block.starts, block.postings, len(block.item_ids)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = TopDocuments(n_items, top)
        for batch in batches:
            codes, tfs = batch["codes"], batch["tfs"]
            term, tf = codes.values.to_numpy().astype(np.int64), tfs.values.to_numpy().astype(np.int64)
            ends = codes.offsets.to_numpy().astype(np.int64)
            m = np.repeat(batch["m"].to_numpy(), np.diff(ends))
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            width = starts[term + 1] - starts[term]
            run = np.concatenate(([0], np.cumsum(width)))
            a = 0
            while a < batch.num_rows:  # whole classes, so many that their entries stay within the limit
                b = max(a + 1, int(np.searchsorted(run[ends], run[ends[a]] + _ENTRIES, side="right")) - 1)
                lo, hi = ends[a], ends[b]
                count = width[lo:hi]
                at = np.repeat(starts[term[lo:hi]] - (run[lo:hi] - run[lo]), count) + np.arange(run[hi] - run[lo])
                owner = np.repeat(np.repeat(np.arange(b - a), np.diff(ends[a:b + 1])), count)
                cell, inverse = np.unique(owner * n_items + postings[at], return_inverse=True)
                points = np.zeros(len(cell), np.int64)
                np.add.at(points, inverse, np.repeat(value[lo:hi], count))
                rows, items = np.divmod(cell, n_items)
                good = np.flatnonzero((points > 0) & (points >= found.least[items]))
                good = good[np.argsort(-points[good], kind="stable")]
                for k in good.tolist():
                    if points[k] >= found.least[items[k]]:
                        members = batch["members"][a + int(rows[k])].as_py()
                        found.offer(int(items[k]), int(points[k]), [d["doc_id"] for d in members])
                a = b
        rows = [(i, d if known else None, -s) for i, best in enumerate(found.best) for s, known, d in best]
        yield pa.RecordBatch.from_pylist([dict(zip(("item", "doc_id", "score"), r)) for r in rows],
                                         schema=pa.schema([("item", pa.int32()), ("doc_id", arrow_id), ("score", pa.int64())]))

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    return classes.select("m", "codes", "tfs", "members").mapInArrow(score, schema)


def search(docs: DataFrame, items: DataFrame, top: int = 10, max_block_bytes: int = 4 << 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of each item with a score above 0."""
    id_type = docs.schema["doc_id"].dataType
    item_type = items.schema["item_id"].dataType
    out = None
    for block in _blocks(items, max_block_bytes):
        vectors = materialize(document_vectors(docs, block.vocabulary))
        total, length = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = _weights(vectors, len(block.vocabulary), total)
        offers = _score(bag_classes(vectors, total, length, top), block, weights, top, id_type)
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = offers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = docs.sparkSession.createDataFrame(
            list(enumerate(block.item_ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))
        found = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", id_type), T.StructField("score", T.LongType())]))
    return out
