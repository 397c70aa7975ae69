"""Cheapest repair of conversations by the auction algorithm for shortest paths.

A repaired conversation's role initials read ``(s?(ua)+)?``. Four automaton states (start, after system, after user, after
assistant) and the places between rows make a lattice whose arcs are edits with integer costs. ``auction`` keeps a
price for each node and one path from the origin: if an arc from the path's end is tight (its cost is the difference of
the prices), the path is extended along it; else the end's price rises to the least that some arc allows, and the path
contracts. When the path reaches the destination, the prices are an optimal dual solution: every
cheapest path consists of tight arcs, so the audit is traced through the tight arcs that lead to the destination,
least letter first.

Nothing holds a whole conversation but the row it ends in: rows are numbered by distributed prefix sums and solved in segments
of ``SEGMENT`` rows. A segment behind the first is priced from each entry state to each exit state; one
backward pass over these small tables gives each segment the prices at its end, with which it is traced from every
entry state; the last step streams each conversation once, in order.

Rows: null role or text is one space. Rows of one turn are taken by role, then text; null turns come first. Identical
rows (equal turn, role and text) are adjacent, and counted before any shuffle; but the first they are duplicates.
A null conv_id is a conversation of its own. An empty table has no conversations. Whole texts are read, however
long. Extra columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provdata.llm.arrays import slices
from provdata.llm.tables import materialize, prefix_sums

SEGMENT = 64
#: Costs of the edits, and of leaving a truncated row in.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role's initial, and the one role that may be inserted or assigned in a state.
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Prices at the end of a conversation: it may be empty or end with the assistant.
DONE = (0, None, None, 0)
LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"


def _arcs(symbols: str, terminal: tuple) -> list[list[tuple[str, int, int]]]:
    """(letter, to, cost) from each node ``4 * place + state``; the last node is the destination.

    A symbol is a row: ``x`` must be deleted, else its role's initial (``o``: any other), upper case if truncated.
    ``terminal`` holds the price of ending in each state (None: not allowed).
    """
    n = len(symbols)
    out: list[list[tuple[str, int, int]]] = []
    for place in range(n + 1):
        for state in range(4):
            arcs = []
            after = FOLLOWS[state, WANTED[state][0]]
            if place < n:
                row, here = symbols[place], 4 * (place + 1)
                arcs.append(("D", here + state, DELETE))
                if row != "x":
                    fault = TRUNCATED if row.isupper() else 0
                    kept = FOLLOWS.get((state, row.lower()))
                    if kept is not None:
                        arcs.append(("K", here + kept, KEEP + fault))
                    arcs.append(("R", here + after, REROLE + fault))
            elif terminal[state] is not None:
                arcs.append(("", 4 * (n + 1), terminal[state]))
            arcs.append(("I", 4 * place + after, INSERT))
            out.append(arcs)
    out.append([])
    return out


def _leading_to(destination: int, arcs: list, use) -> set[int]:
    """Nodes with a path to ``destination`` along arcs that ``use(node, to, cost)`` accepts."""
    into: dict[int, list[int]] = {}
    for node, some in enumerate(arcs):
        for _, to, cost in some:
            if use(node, to, cost):
                into.setdefault(to, []).append(node)
    found, todo = {destination}, [destination]
    while todo:
        for node in into.get(todo.pop(), ()):
            if node not in found:
                found.add(node)
                todo.append(node)
    return found


def auction(arcs: list, origin: int) -> list[int] | None:
    """Prices of all nodes when the path from ``origin`` has reached the last node; None if it can't be reached.

    ``prices[i] <= cost + prices[j]`` holds for every arc throughout, with equality along the path.
    """
    destination = len(arcs) - 1
    alive = _leading_to(destination, arcs, lambda *_: True)
    if origin not in alive:
        return None
    ways = [[(to, cost) for _, to, cost in some if to in alive] for some in arcs]
    prices, path = [0] * len(arcs), [origin]
    while path[-1] != destination:
        end = path[-1]
        best, to = min((cost + prices[to], to) for to, cost in ways[end])
        if prices[end] < best:  # contraction
            prices[end] = best
            if len(path) > 1:
                path.pop()
        else:  # extension along a tight arc
            path.append(to)
    return prices


@lru_cache(100_000)
def audit(symbols: str, entry: int, terminal: tuple) -> str | None:
    """Letters of the cheapest edits of a segment from ``entry`` on, least in ASCII order; None if there are none."""
    arcs = _arcs(symbols, terminal)
    prices = auction(arcs, entry)
    if prices is None:
        return None
    def tight(node, to, cost):
        return prices[node] == cost + prices[to]
    good = _leading_to(len(arcs) - 1, arcs, tight)
    node, letters = entry, []
    while node != len(arcs) - 1:
        letter, node, _ = min(a for a in arcs[node] if a[1] in good and tight(node, a[1], a[2]))
        letters.append(letter)
    return "".join(letters)


@lru_cache(100_000)
def crossing(symbols: str) -> tuple:
    """Cheapest cost of a segment from each state to each state, None where there is no way."""
    rows = []
    for entry in range(4):
        row = []
        for leave in range(4):
            prices = auction(_arcs(symbols, tuple(0 if s == leave else None for s in range(4))), entry)
            row.append(None if prices is None else prices[entry])
        rows.append(tuple(row))
    return tuple(rows)


def _backward(costs: list[list], terminal: list) -> list:
    """Prices before a segment from those after it."""
    ways = [[c + t for c, t in zip(row, terminal) if c is not None and t is not None] for row in costs]
    return [min(w) if w else None for w in ways]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by crc32(conv_id:turn) % 20, nulls as one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, question and exclamation marks, 3 repeats it, 4 makes
    it the user's.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    return (rows.where("kind <> 0")
            .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
            .select("conv_id", "turn", "role", "text"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and their place in the conversation."""
    runs = (rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")))
    placed = prefix_sums(runs, [F.col("turn"), F.col("role"), F.col("text")], {"place": F.lit(1).cast("long")}, by="conv_id")
    return materialize(placed.withColumn("segment", F.floor(F.col("place") / SEGMENT)))


def _segments(numbered: DataFrame) -> DataFrame:
    """One row per segment: ``faults`` of its rows (b, d, t or -) and the ``symbols`` of the lattice."""
    seen = F.expr(f"trim(TRAILING '{_BLANKS}' FROM text)")
    initial = F.substring("role", 1, 1)
    rows = numbered.select("conv_id", "segment", "place", "copies", "role", F.sha2("text", 256).alias("digest"),
                           F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
                           (seen == "").alias("blank"), (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("cut"))
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select(
        F.col("conv_id").alias("f_conv"), F.col("place").alias("f_place"))
    flagged = rows.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("place") == F.col("f_place")), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("f_place").isNull(), "d").when(F.col("cut"), "t").otherwise("-")
    symbol = (F.when(F.col("fault").isin("b", "d"), "x")
              .otherwise(F.concat(F.when(F.col("fault") == "t", F.upper("initial")).otherwise(F.col("initial")),
                                  F.when(F.col("copies") > 1, "x").otherwise(""))))
    in_order = F.array_sort(F.collect_list(F.struct("place", "fault", "symbol")))
    return materialize(
        flagged.withColumn("fault", fault).withColumn("symbol", symbol)
        .groupBy("conv_id", "segment").agg(in_order.alias("rows"))
        .select("conv_id", "segment", F.array_join("rows.fault", "").alias("faults"), F.array_join("rows.symbol", "").alias("symbols")))


def _end_prices(segments: DataFrame) -> DataFrame:
    """(e_conv, e_segment, prices): the cost from each state at the end of a segment on, for all but the last of each conversation."""
    conv = segments.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("e_conv", conv), T.StructField("e_segment", T.LongType()),
                           T.StructField("prices", T.ArrayType(T.LongType()))])
    costs = T.StructType([T.StructField("e_conv", conv), T.StructField("e_segment", T.LongType()),
                          T.StructField("costs", T.ArrayType(T.ArrayType(T.LongType())))])

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [crossing(s) for s in batch["symbols"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["segment"], pa.array(found, pa.list_(pa.list_(pa.int64())))],
                                             ["e_conv", "e_segment", "costs"])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, prices = ("none yet",), list(DONE)
        for batch in batches:
            out = []
            for conv_id, matrix in zip(batch["e_conv"].to_pylist(), batch["costs"].to_pylist()):
                prices = _backward(matrix, list(DONE) if (conv_id,) != last else prices)
                last = (conv_id,)
                out.append(prices)
            before = pa.array([s - 1 for s in batch["e_segment"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["e_conv"], before, pa.array(out, pa.list_(pa.int64()))],
                                             ["e_conv", "e_segment", "prices"])

    return (segments.where("segment > 0").select("conv_id", "segment", "symbols").mapInArrow(price, costs)
            .repartition("e_conv").sortWithinPartitions("e_conv", F.desc("e_segment")).mapInArrow(carry, schema))


def _traced(segments: DataFrame) -> DataFrame:
    """Each segment's audit from every state it may be entered in (the first: the start)."""
    schema = T.StructType([segments.schema["conv_id"], T.StructField("segment", T.LongType()),
                           T.StructField("faults", T.StringType()), T.StructField("letters", T.ArrayType(T.StringType()))])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["segment"].to_pylist(), batch["symbols"].to_pylist(), batch["prices"].to_pylist())
            letters = [[audit(symbols, entry, tuple(prices or DONE)) for entry in range(4 if segment else 1)]
                       for segment, symbols, prices in rows]
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["segment"], batch["faults"],
                                              pa.array(letters, pa.list_(pa.string()))], ["conv_id", "segment", "faults", "letters"])

    ends = _end_prices(segments)
    on = F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("segment") == F.col("e_segment"))
    return (segments.join(ends, on, "left").select("conv_id", "segment", "faults", "symbols", "prices")
            .mapInArrow(trace, schema))


class _Walk:
    """Goes along one conversation's rows and edits; gives the edits as rows."""

    def __init__(self):
        self.state, self.step, self.letters, self.faults, self.at, self.row = START, 0, "", "", 0, 0

    def _edit(self, edits: str, turn, was, role, text, fault: str, cost: int) -> tuple:
        self.step += 1
        return (self.step - 1, edits, turn, was, role, text, fault, cost)

    def _inserted(self) -> Iterator[tuple]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            role = WANTED[self.state]
            self.state = FOLLOWS[self.state, role[0]]
            self.at += 1
            yield self._edit("I", None, None, role, "", "-", INSERT)

    def segment(self, letters: list[str], faults: str) -> None:
        self.letters, self.faults, self.at, self.row = letters[self.state], faults, 0, 0

    def read(self, turn, role: str, text: str, copies: int) -> Iterator[tuple]:
        fault = self.faults[self.row]
        self.row += 1
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "D":
            n = copies if fault in "bd" else 1
            yield self._edit("D" * n, turn, role, role, text, fault, DELETE * n)
        else:
            new = WANTED[self.state] if letter == "R" else role
            self.state = FOLLOWS[self.state, new[0]]
            yield self._edit(letter, turn, role, new, text, fault,
                             (REROLE if letter == "R" else KEEP) + (TRUNCATED if fault == "t" else 0))
        if copies > 1 and fault not in "bd":
            yield from self._inserted()
            self.at += 1
            yield self._edit("D" * (copies - 1), turn, role, role, text, "d", DELETE * (copies - 1))
        if self.row == len(self.faults):
            yield from self._inserted()


_EDIT_FIELDS = [("place", T.LongType(), pa.int64()), ("edits", T.StringType(), pa.string()),
                ("turn", None, None), ("was", T.StringType(), pa.string()), ("role", T.StringType(), pa.string()),
                ("text", T.StringType(), pa.string()), ("fault", T.StringType(), pa.string()), ("cost", T.LongType(), pa.int64())]


def repair(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """The cheapest edits, in order within each conversation and partition.

    conv_id, place, edits (``K``, ``R``, ``I``, or ``D`` as often as equal rows were deleted), turn, was (the role before), role and
    text (after), fault (``b`` blank, ``d`` duplicate, ``t`` truncated, ``-`` none) and cost. The repaired conversation
    is the rows whose edit isn't a deletion. Conversations in ``conv_ids`` without rows have one row with no edits.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    numbered = _numbered(rows)
    conv, turn = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    traced = _traced(_segments(numbered))
    none = F.lit(None)
    parts = [
        traced.select("conv_id", "segment", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("place"), none.cast(turn).alias("turn"),
                      none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
                      "faults", "letters"),
        numbered.select("conv_id", "segment", F.lit(2).alias("kind"), "place", "turn", "role", "text", "copies",
                        none.cast("string").alias("faults"), none.cast("array<string>").alias("letters"))]
    ids = rows.select("conv_id") if conv_ids is None else conv_ids.select("conv_id")
    parts.append(ids.distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("segment"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("place"),
        none.cast(turn).alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("text"),
        F.lit(0).cast("long").alias("copies"), none.cast("string").alias("faults"), none.cast("array<string>").alias("letters")))
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    schema = T.StructType([T.StructField("conv_id", conv), *[T.StructField(n, t or turn) for n, t, _ in _EDIT_FIELDS]])
    arrow = pa.schema([("conv_id", to_arrow_type(conv)), *[(n, a or to_arrow_type(turn)) for n, _, a in _EDIT_FIELDS]])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = _Walk()
        for batch in slices(batches, "text"):
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    here = _Walk()
                    out.append((r["conv_id"], -1, "", None, None, None, None, "-", 0))
                elif r["kind"] == 1:
                    here.segment(r["letters"] + [None] * (4 - len(r["letters"])), r["faults"])
                else:
                    out += [(r["conv_id"], *e) for e in here.read(r["turn"], r["role"], r["text"], r["copies"])]
            columns = zip(*out) if out else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return (together.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "kind", "place")
            .mapInArrow(walk, schema))


class _Report:
    """Counts and digests of one conversation, read edit by edit."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.least, self.turn = conv_id, 0, None, None
        self.counts, self.illegal, self.cost, self.before = {"b": 0, "d": 0, "t": 0, "-": 0}, 0, 0, None
        self.audit, self.digest, self.empty = [], hashlib.sha256(), True

    def read(self, edits: str, turn, was, role, text, fault, cost) -> None:
        if not edits:
            return
        self.audit.append(edits)
        self.cost += cost
        if edits != "I":
            n = len(edits)
            self.counts[fault] += n
            initial = was[:1]
            self.illegal += (self.before is not None and self.before + initial not in LEGAL) + (n - 1)
            self.before = initial
            if turn is not None and turn != self.turn:
                self.least = turn if self.least is None else self.least
                self.turns, self.turn = self.turns + 1, turn
        if edits[0] != "D":
            self.digest.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
            self.empty = False

    def row(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def report(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s rows, which stay in their order: faults, cost, audit and a digest of the result."""
    from pyspark.sql.pandas.types import to_arrow_type

    conv = edits.schema["conv_id"].dataType
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([T.StructField("conv_id", conv), *[T.StructField(n, T.LongType()) for n in counts],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = pa.schema([("conv_id", to_arrow_type(conv)), *[(n, pa.int64()) for n in counts],
                       ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def table(done: list) -> pa.RecordBatch:
        columns = zip(*done) if done else [[] for _ in arrow]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in slices(batches, "text"):
            done = []
            for r in batch.to_pylist():
                if r["place"] < 0:  # every conversation begins with such a row
                    if now is not None:
                        done.append(now.row())
                    now = _Report(r["conv_id"])
                else:
                    now.read(*(r[n] for n in ("edits", "turn", "was", "role", "text", "fault", "cost")))
            yield table(done)
        yield table([now.row()] if now is not None else [])

    return edits.mapInArrow(count, schema)
