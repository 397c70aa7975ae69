"""N-gram Jaccard join by multiple-global-order filtering.

A document's set holds the hashes (64 bit) of its distinct 5-word shingles; documents of one set are one
class, and only classes are compared. Sets with a Jaccard similarity of ``percent`` or more
must meet in a short prefix under *every* global order of the tokens, so the filters of several orders
are intersected before any pair is verified:

1. By hash. Of its ``n`` tokens a set shows the ``n - need + l`` lowest, where ``need`` is the least possible
   overlap; two similar sets have ``l`` of those in common. A class lives on only if that many of its shown
   tokens occur in other classes too. Most of a corpus ends here, after one exchange of short tokens.
2. By rarity among the classes that live on. Tokens of a single class come first in this order and
   use up the prefix, so a class needs ``need`` shared tokens, and only the rarest of them are indexed.
3. By hash ascending and descending, for each pair that shares an indexed token: both prefixes must
   share a token too. Then the whole sets are intersected.

Nothing enumerates the pairs of a large group. Each indexed token first ties its classes to one pivot;
verified links are merged into components, and only classes of different components meet again:
pairwise under small tokens, and under large ones in blocks of bounded size, whose sets are compared inside
a task that returns no more than a spanning forest. Blocks of one component skip each other.

A token that many rows share is merged map-side, and each map task sends it on once.

Defined results: a document without words (null, empty or blank text) has no shingles and is linked with
nothing; with one to four words the whole sequence is its one shingle; copies are linked; a null id is
never the name of a component, and a component without other ids has a null name; rows of one id with
different texts are different documents, in what stays too; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provdata.llm.arrays import scramble, slices, window_hashes, words
from provdata.llm.graph import components
from provdata.llm.tables import materialize, prefix_sums, reducers


@dataclass(frozen=True)
class Params:
    width: int = 5
    percent: int = 75
    #: Tokens shown beyond the shortest prefix in the first order, in percent of the set.
    look: int = 20
    #: Tokens of more classes than this are compared in blocks, of so many tokens at most (or one set).
    pairwise: int = 32
    block_tokens: int = 250_000
    #: Tokens that a map task gathers before it sends them on.
    buffer_tokens: int = 4_000_000
    #: Bits of the sieve that spares most documents the shuffle of their texts: 4 MB, however large the corpus.
    sieve_bits: int = 1 << 25

    def need(self, n):
        """Least overlap of a set of ``n`` tokens with any similar set."""
        return -(-n * self.percent // 100)

    def shown(self, n):
        return np.minimum(n, n - self.need(n) + -(-n * self.look // 100))

    def shared(self, n):
        """Least number of the shown tokens that a similar set shows too."""
        return -(-self.need(n) * self.look // 100)


def _need(n: Column, p: Params) -> Column:
    return F.ceil(n * p.percent / 100)


def _similar_sizes(a: str, b: str, p: Params) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * p.percent


def token_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct hashes of its ``width``-word shingles."""
    found = words(texts, lower=True)
    values = found.hashes()[found.codes] if len(found.codes) else np.zeros(0, np.uint64)
    hashes = window_hashes(values, width)
    for a, b in zip(found.offsets[:-1], found.offsets[1:]):
        if b - a >= width:
            own = np.sort(hashes[a:b - width + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:  # the whole sequence, its length in the hash
            yield scramble(window_hashes(values[a:b], int(b - a)) ^ np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _class_of(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def _short(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token, six bytes each."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _longer(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _u64(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _i64(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _frame(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _sketch(p: Params):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("class", pa.binary()),
                        ("shown", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = list(token_sets(batch["text"], p.width))
            yield _frame(schema, [batch["doc_id"], batch["digest"], [len(s) for s in sets], [_class_of(s) for s in sets],
                                  [_short(s[:p.shown(len(s))]) for s in sets]])
    return run


def _slots(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Cuts of the sorted tokens into ``parts`` even ranges of their values."""
    return np.searchsorted(tokens, np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)) if parts > 1 else \
        np.zeros(0, np.int64)


def _route_shown(p: Params, parts: int):
    """To each part a range of tokens: those of one class here with that class, those of more marked as shared."""
    schema = pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in ("tokens", "ids", "marks", "done", "times")])

    def send(ids: list, sets: list):
        tokens = np.concatenate(sets)
        owner = np.repeat(np.array(ids, np.int64), [len(s) for s in sets])
        order = np.lexsort((owner, tokens))
        tokens, owner = tokens[order], owner[order]
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])))
        tokens, owner = tokens[new], owner[new]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        many = np.repeat(np.diff(np.append(first, len(tokens))), np.diff(np.append(first, len(tokens)))) > 1
        done, times = np.unique(owner[many], return_counts=True)
        marks, tokens, owner = np.unique(tokens[many]), tokens[~many], owner[~many]
        spread = [np.array_split(x, parts) for x in (done.astype("<i8"), times.astype("<i8"))]
        cut, cut_marks = _slots(tokens, parts), _slots(marks, parts)
        columns = [[_short(x) for x in np.split(tokens, cut)], [x.astype("<i8").tobytes() for x in np.split(owner, cut)],
                   [_short(x) for x in np.split(marks, cut_marks)], *[[x.tobytes() for x in s] for s in spread]]
        return _frame(schema, [list(range(parts)), *columns])

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids, sets, size = [], [], 0
        for batch in batches:
            for cid, raw in zip(batch["cid"].to_pylist(), batch["shown"].to_pylist()):
                ids.append(cid)
                sets.append(_longer(raw))
                size += len(sets[-1])
                if size >= p.buffer_tokens:
                    yield send(ids, sets)
                    ids, sets, size = [], [], 0
        if ids:
            yield send(ids, sets)
    return run


def _count_shared(parts: int):
    """How many tokens of this range each class shares with another, to the part that has the class's range."""
    schema = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("times", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        got = [list(map(lambda f, b: f(b), (_longer, _u64, _longer, _u64, _i64), row)) for batch in batches
               for row in zip(*[batch[c].to_pylist() for c in ("tokens", "ids", "marks", "done", "times")])]
        if not got:
            return
        tokens, ids, marks, done, times = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((ids, tokens))
        tokens, ids = tokens[order], ids[order]
        if len(tokens):
            new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])))
            tokens, ids = tokens[new], ids[new]
            same = tokens[1:] == tokens[:-1]
            shared = np.concatenate((same, [False])) | np.concatenate(([False], same)) | np.isin(tokens, marks)
            own, n = np.unique(ids[shared], return_counts=True)
            done, times = np.concatenate([done, own]), np.concatenate([times, n])
        if len(done):
            ids, place = np.unique(done, return_inverse=True)
            cut = _slots(ids, parts)
            yield _frame(schema, [list(range(parts)), [x.tobytes() for x in np.split(ids, cut)],
                                  [x.tobytes() for x in np.split(np.bincount(place, times).astype("<i8"), cut)]])
    return run


def _sum_shared(batches) -> Iterator[pa.RecordBatch]:
    """The sums of the classes of this range."""
    schema = pa.schema([("cid", pa.int64()), ("times", pa.int64())])
    got = [(_u64(i), _i64(t)) for batch in batches for i, t in zip(batch["ids"].to_pylist(), batch["times"].to_pylist())]
    ids, times = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if len(ids):
        ids, place = np.unique(ids, return_inverse=True)
        yield _frame(schema, [ids.view(np.int64), np.bincount(place, times).astype(np.int64)])


def _full_sets(p: Params):
    schema = pa.schema([("class", pa.binary()), ("n", pa.int64()), ("tokens", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [(c, len(s), s.astype("<u8").tobytes()) for c, s in zip(
                batch["class"].to_pylist(), token_sets(batch["text"], p.width)) if _class_of(s) == c]
            if rows:
                yield _frame(schema, list(zip(*rows)))
    return run


def _route_counts(parts: int):
    """How many sets of this partition hold each token, to the part that has the token's range."""
    schema = pa.schema([("part", pa.int32()), ("home", pa.int32()), ("tokens", pa.binary()), ("times", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        home, sets = 0, []
        for batch in batches:
            for home, raw in zip(batch["home"].to_pylist(), batch["tokens"].to_pylist()):
                sets.append(_u64(raw))
        if sets:
            tokens, times = np.unique(np.concatenate(sets), return_counts=True)
            cut = _slots(tokens, parts)
            yield _frame(schema, [list(range(parts)), [home] * parts, [x.tobytes() for x in np.split(tokens, cut)],
                                  [x.astype("<i8").tobytes() for x in np.split(times, cut)]])
    return run


def _sum_counts(batches) -> Iterator[pa.RecordBatch]:
    """Back to each home partition: its tokens that two or more sets hold, with their numbers of sets."""
    schema = pa.schema([("home", pa.int32()), ("tokens", pa.binary()), ("times", pa.binary())])
    got = [(home, _u64(t), _i64(n)) for batch in batches for home, t, n in zip(
        *[batch[c].to_pylist() for c in ("home", "tokens", "times")])]
    if not got:
        return
    tokens, place = np.unique(np.concatenate([t for _, t, _ in got]), return_inverse=True)
    total = np.bincount(place, np.concatenate([n for _, _, n in got])).astype(np.int64) if len(place) else np.zeros(0, np.int64)
    at = 0
    for home, t, _ in got:
        own = total[place[at:at + len(t)]]
        at += len(t)
        keep = own > 1
        if keep.any():
            yield _frame(schema, [[home], [t[keep].tobytes()], [own[keep].tobytes()]])


def _index(p: Params):
    """Of each set with enough shared tokens, the rarest of them: its prefix in the order of rarity."""
    def run(sets: pa.Table, counts: pa.Table) -> pa.Table:
        rows = []
        if len(counts) and len(sets):
            tokens = np.concatenate([_u64(x) for x in counts["tokens"].to_pylist()])
            times = np.concatenate([_i64(x) for x in counts["times"].to_pylist()])
            order = np.argsort(tokens)
            tokens, times = tokens[order], times[order]
            for node, n, raw in zip(*[sets[c].to_pylist() for c in ("node", "n", "tokens")]):
                own = _u64(raw)
                at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                hit = tokens[at] == own
                if hit.sum() >= p.need(n):
                    shared, rare = own[hit], times[at[hit]]
                    first = n - p.need(n) + 1 - (n - len(shared))
                    pick = np.lexsort((shared, rare))[:first]
                    rows.append((np.full(len(pick), node), np.full(len(pick), n), shared[pick].view(np.int64)))
        columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("node", "n", "token"), map(pa.array, columns))))
    return run


def _overlap(x: np.ndarray, index: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Tokens that ``x`` shares with each of the ``n`` sets in the index."""
    tokens, starts, owners = index
    if not len(tokens) or not len(x):
        return np.zeros(n, np.int64)
    at = np.minimum(np.searchsorted(tokens, x), len(tokens) - 1)
    at = at[tokens[at] == x]
    lengths = starts[at + 1] - starts[at]
    ends = np.cumsum(lengths)
    pick = np.repeat(starts[at] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    return np.bincount(owners[pick], minlength=n)


def _inverted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    tokens, starts = np.unique(flat[order], return_index=True)
    return tokens, np.append(starts, len(flat)), owners[order]


def _linked(a: np.ndarray, b: np.ndarray, p: Params) -> bool:
    """Prefixes under both hash orders, then the whole sets."""
    i, j = len(a) - p.need(len(a)) + 1, len(b) - p.need(len(b)) + 1
    if not len(np.intersect1d(a[:i], b[:j], True)) or not len(np.intersect1d(a[-i:], b[-j:], True)):
        return False
    both = len(np.intersect1d(a, b, True))
    return 100 * both >= p.percent * (len(a) + len(b) - both)


def _verify(p: Params):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b) for a, b, x, y in zip(*[batch[c].to_pylist() for c in ("a", "b", "x", "y")])
                    if _linked(_u64(x), _u64(y), p)]
            if rows:
                yield _frame(schema, list(zip(*rows)))
    return run


def _block_links(p: Params):
    """Links that join components, between the sets of two blocks (or within one)."""
    def run(rows: pa.Table) -> pa.Table:
        node, side, comp = (rows[c].to_numpy() for c in ("node", "side", "comp"))
        sets = [_u64(x) for x in rows["tokens"].to_pylist()]
        left, right = np.flatnonzero(side <= 1), np.flatnonzero((side == 0) | (side == 2))
        names, place = np.unique(comp, return_inverse=True)
        root = np.arange(len(names))

        def find(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        links = []
        if len(left) and len(right):
            n = np.array([len(s) for s in sets])
            short = n - p.need(n) + 1
            whole = _inverted([sets[k] for k in right])
            low, high = _inverted([sets[k][:short[k]] for k in right]), _inverted([sets[k][-short[k]:] for k in right])
            for k in left:
                roots = np.array([find(r) for r in range(len(names))])
                sizes = n[right]
                may = (roots[place[right]] != roots[place[k]]) & (
                    100 * np.minimum(sizes, n[k]) >= p.percent * np.maximum(sizes, n[k]))
                for prefix, index in ((sets[k][:short[k]], low), (sets[k][-short[k]:], high)):
                    if may.any():
                        may &= _overlap(prefix, index, len(right)) > 0
                if may.any():
                    both = _overlap(sets[k], whole, len(right))
                    for j in np.flatnonzero(may & (100 * both >= p.percent * (n[k] + sizes - both))):
                        a, b = find(place[k]), find(place[right[j]])
                        if a != b:
                            root[max(a, b)] = min(a, b)
                            links.append((node[k], node[right[j]]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _verified(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(p), "a long, b long")


def _sieved(docs: DataFrame, ids: DataFrame, p: Params) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be among the ``first_id`` of ``ids``: a bitmap of hashes, of fixed size, is broadcast.

    It lets through all that are, and by chance some others, which the join that follows drops.
    """
    def bit(c):
        return F.pmod(F.coalesce(F.xxhash64(c), F.lit(0)), F.lit(p.sieve_bits))

    bitmap = (ids.select(bit("first_id").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    place = F.bitmap_bit_position("bit")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (docs.withColumn("bit", bit("doc_id")).withColumn("bucket", F.bitmap_bucket_number("bit"))
            .join(F.broadcast(bitmap), "bucket")  # at most sieve_bits / 8 bytes in all
            .where(F.get(F.array(*[byte.bitwiseAND(1 << k) > 0 for k in range(8)]), (place % 8).cast("int")))
            .select("doc_id", "text"))


def _with_first_text(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of each of ``classes`` (class, first_id, first_digest) the text of its first row, as often as that is repeated."""
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (_text_digest(F.col("text")) == F.col("first_digest"))
    return docs.join(classes, same).select("class", "text")


def _links_of_large(index: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Links between components under tokens of more than ``pairwise`` classes, found in pairs of blocks.

    Classes are laid out by their commonest token, so that a large group fills blocks of its own, and by
    component, so that most blocks have one. A pair of blocks is a task if they share a token.
    """
    nodes = (index.groupBy("node", "n", "comp").agg(F.max(F.struct("classes", "token")).alias("home"))
             .select("node", "n", "comp", F.col("home.token").alias("home")))
    placed = prefix_sums(nodes, [F.col("home"), F.col("comp"), F.col("n"), F.col("node")], {"before": F.col("n")})
    placed = materialize(placed.withColumn("block", F.floor(F.col("before") / p.block_tokens).cast("long")))
    limits = placed.groupBy("block").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                         F.min("n").alias("n0"), F.max("n").alias("n1"))
    held = (index.join(placed.select("node", "block"), "node").select("token", "block").distinct()
            .join(limits, "block"))
    l, r = held.alias("l"), held.alias("r")
    pairs = materialize(
        l.join(r, F.col("l.token") == F.col("r.token")).where("l.block <= r.block")
        .where("not (l.c0 = l.c1 and r.c0 = r.c1 and l.c0 = r.c0)")
        .where((F.col("l.n1") * 100 >= F.col("r.n0") * p.percent) & (F.col("r.n1") * 100 >= F.col("l.n0") * p.percent))
        .select(F.col("l.block").alias("b1"), F.col("r.block").alias("b2")).distinct())
    sides = (pairs.where("b1 = b2").select("b1", "b2", F.col("b1").alias("block"), F.lit(0).alias("side"))
             .union(pairs.where("b1 < b2").select("b1", "b2", "b1", F.lit(1)))
             .union(pairs.where("b1 < b2").select("b1", "b2", "b2", F.lit(2))))
    return (sides.join(placed, "block").join(sets.select("node", "tokens"), "node")
            .select("b1", "b2", "node", "side", "comp", "tokens")
            .groupBy("b1", "b2").applyInArrow(_block_links(p), "a long, b long"))


def _text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _linked_rows(df: DataFrame, p: Params, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: doc_id, digest (of the text), n, class, component, component_id.

    ``component`` is the node that names the component among all, null for a class that no other is linked with.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialize(docs.withColumn("digest", _text_digest(F.col("text")))
                       .mapInArrow(_sketch(p), "doc_id long, digest binary, n long, class binary, shown binary")
                       .withColumn("cid", F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("long")))
    parts = reducers(rows)
    shared = (rows.where("n > 0").select("cid", "shown")
              .mapInArrow(_route_shown(p, parts), "part int, tokens binary, ids binary, marks binary, done binary, times binary")
              .repartitionById(parts, F.col("part")).mapInArrow(_count_shared(parts), "part int, ids binary, times binary")
              .repartitionById(parts, F.col("part")).mapInArrow(_sum_shared, "cid long, times long"))
    classes = materialize(rows.where("n > 0").groupBy("class", "cid", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first"),
        F.count(F.lit(1)).alias("copies"))
        .select("class", "cid", "n", "copies", F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("first_digest")))
    wanted = F.ceil(_need(F.col("n"), p) * p.look / 100)
    alive = materialize(classes.join(shared, "cid").where(F.col("times") >= wanted)
                        .select("class", "first_id", "first_digest"))
    # By id and text: an id of many rows with different texts would meet all living classes of that id.
    sets = materialize(
        _with_first_text(_sieved(docs, alive, p), alive)
        .mapInArrow(_full_sets(p), "class binary, n long, tokens binary")
        .groupBy("class").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        .withColumns({"node": F.monotonically_increasing_id(), "home": F.spark_partition_id()}))
    counts = (sets.select("home", "tokens").mapInArrow(_route_counts(parts), "part int, home int, tokens binary, times binary")
              .repartitionById(parts, F.col("part")).mapInArrow(_sum_counts, "home int, tokens binary, times binary"))
    index = materialize(sets.select("home", "node", "n", "tokens").groupBy("home").cogroup(counts.groupBy("home"))
                        .applyInArrow(_index(p), "node long, n long, token long"))
    groups = (index.groupBy("token").agg(F.count(F.lit(1)).alias("classes"), F.min(F.struct("node", "n")).alias("pivot"))
              .where("classes > 1").select("token", "classes", F.col("pivot.node").alias("b"), F.col("pivot.n").alias("b_n")))
    index = materialize(index.join(groups, "token"))
    to_pivot = (index.where("node <> b").where(_similar_sizes("n", "b_n", p))
                .select(F.col("node").alias("a"), "b").distinct())
    found = components(_verified(to_pivot, sets, p)).select("node", F.col("component").alias("comp"))
    index = materialize(index.select("token", "node", "n", "classes").join(found, "node", "left")
                        .withColumn("comp", F.coalesce("comp", "node")))
    apart = index.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("token")
    open_ = materialize(index.join(apart, "token", "left_semi"))
    small = open_.where(F.col("classes") <= p.pairwise)
    pairs = (small.alias("l").join(small.alias("r"), F.col("l.token") == F.col("r.token")).where("l.comp < r.comp")
             .where(_similar_sizes("l.n", "r.n", p))
             .select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct())
    links = found.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(_verified(pairs, sets, p)).union(
        _links_of_large(open_.where(F.col("classes") > p.pairwise), sets, p))
    joined = components(links)
    named = (sets.select("node", "class").join(joined, "node").join(classes.select("class", "first_id"), "class")
             .select("class", "component", "first_id"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = named.join(names, "component").select(F.col("class").alias("m_class"), "component", "component_id")
    copied = (classes.where("copies > 1").join(linked, F.col("class") == F.col("m_class"), "left_anti")
              .select(F.col("class").alias("m_class"), F.lit(None).cast("long").alias("component"),
                      F.col("first_id").alias("component_id")))
    members = linked.union(copied)
    return (rows.select("doc_id", "digest", "n", "class").join(members, F.col("class") == F.col("m_class"), "left")
            .select("doc_id", "digest", "n", "class", "component", F.coalesce("component_id", "doc_id").alias("component_id")))


def link_components(df: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    return _linked_rows(df, p, id_col, text_col).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                                                        "component_id")


def drop_near_duplicates(df: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text",
                         spare_unnamed: bool = True) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: one of each component, and all rows without shingles.

    Rows are judged by their text: of a component the row with the smallest id stays, then the least digest of its
    text, then of the whole row. Rows without an id all stay, unless ``spare_unnamed`` is off: then they are
    members like any other, and one stays where its component has no row with an id.
    """
    found = _linked_rows(df, p, id_col, text_col)
    if spare_unnamed:
        found = found.where("doc_id is not null")
    found = materialize(found.select("doc_id", "digest", "n", "class", "component"))
    alone = F.when(F.col("component").isNull(), F.col("class"))  # a class that no other is linked with names itself
    best = (found.where("n > 0").groupBy("component", alone.alias("alone"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("best"))
            .select("best.doc_id", "best.digest"))
    same = F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("digest") == F.col("b_digest"))
    best = (found.join(best.select(F.col("doc_id").alias("b_id"), F.col("digest").alias("b_digest")), same, "left_semi")
            .groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("times")))
    blank = found.where("n = 0").select("doc_id", "digest").distinct().withColumn("times", F.lit(1).cast("long"))
    stay = materialize(best.union(blank).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "times"))

    def rows_of(keys: DataFrame) -> DataFrame:
        return df.join(keys, F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
                       & (_text_digest(F.col(text_col)) == F.col("__digest")), "left_semi")

    kept = rows_of(stay.where("times = 1"))
    again = stay.where("times > 1")
    if not again.isEmpty():
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        one = (rows_of(again).select(F.col(id_col).cast("long").alias("__id"), _text_digest(F.col(text_col)).alias("__digest"),
                                     whole.alias("__row"))
               .groupBy("__id", "__digest").agg(F.min_by("__row", F.sha2(F.to_json("__row"), 256)).alias("__row")))
        kept = kept.unionByName(one.select("__row.*"))
    return kept.unionByName(df.where(F.col(id_col).isNull())) if spare_unnamed else kept
