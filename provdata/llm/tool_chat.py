"""Chat formatting: tool-call linking.

Calls and results meet in a hash join by conversation and call id. The calls of a message run side by side and
may refer to one another by ``"$<call id>"`` strings in their arguments, so each message's calls
are put in topological order; calls of later messages come later anyway. Arguments are validated
against their tool's schema, and call and result are serialised as canonical JSON: keys in code-point
order, no blanks, integral numbers as integers and others in their shortest form.

A conversation is never gathered: a message's calls are one group, which its own text bounds, however many
messages a conversation has. Results are reduced to one per id before the join.

Defined results: of calls with one id in a conversation the first (turn, position) is taken and the others have
the status ``duplicate``; of results with one id the first by turn and text; a call without a result has a
null one, and a result without a call is dropped; a null call id is never linked; null or broken
arguments are ``invalid`` and serialised as the string they are; a reference to a call that is not there or
comes in a later message is ``invalid``; calls of a cycle, and those behind one, come last by
position, with the status ``cyclic``; an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import heapq
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _plain(value):
    """The value with every integral number as an integer (so no negative zero either): equal numbers are written alike."""
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def canonical(value) -> str:
    """Canonical JSON of a value; NaN and infinities have none, and lone surrogates stay escaped."""
    text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def _unique_pairs(pairs):
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("a key occurs twice")
    return dict(pairs)


def _finite(text: str):
    raise ValueError(f"{text} is no JSON number")


def read_json(text: str):
    return json.loads(text, object_pairs_hook=_unique_pairs, parse_constant=_finite)


def _is(kind: str, value) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value)
    return isinstance(value, {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}[kind])


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks ``schema``: type, enum, bounds, lengths, items, properties, required, extra keys."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(k, value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the allowed values")
    if _is("number", value):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            found.append(f"{at}: out of bounds")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        found.append(f"{at}: bad length")
    if isinstance(value, list) and "items" in schema:
        found += [e for k, item in enumerate(value) for e in schema_errors(item, schema["items"], f"{at}[{k}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}: no {k}" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                found += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}: unknown {k}")
    return found


def references(value) -> set[str]:
    """Call ids that a value refers to: its strings ``"$<id>"``, at any depth."""
    todo, found = [value], set()
    while todo:
        v = todo.pop()
        if isinstance(v, str) and len(v) > 1 and v[0] == "$":
            found.add(v[1:])
        todo.extend(v.values() if isinstance(v, dict) else v if isinstance(v, list) else ())
    return found


def topological(needs: list[set[int]]) -> tuple[list[int], set[int]]:
    """Order of the items, each behind those it needs, lowest first; and the items that a cycle holds back, last."""
    waiting, dependents = [len(n) for n in needs], [[] for _ in needs]
    for k, n in enumerate(needs):
        for other in n:
            dependents[other].append(k)
    ready = [k for k, n in enumerate(waiting) if not n]
    order = []
    while ready:
        k = heapq.heappop(ready)
        order.append(k)
        for other in dependents[k]:
            waiting[other] -= 1
            if not waiting[other]:
                heapq.heappush(ready, other)
    stuck = set(range(len(needs))) - set(order)
    return order + sorted(stuck), stuck


_OUT = ("conv_id long, turn long, place int, call_id string, name string, status string, errors array<string>, "
        "linked boolean, json string")


def _format(schemas: dict[str, dict]):
    out = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int32()), ("call_id", pa.string()),
                     ("name", pa.string()), ("status", pa.string()), ("errors", pa.list_(pa.string())),
                     ("linked", pa.bool_()), ("json", pa.string())])

    def message(conv_id, turn, calls: list[dict]) -> Iterator[tuple]:
        values, errors, places = [], [], {c["call_id"]: k for k, c in enumerate(calls) if not c["again"]}
        needs: list[set[int]] = []
        for k, call in enumerate(calls):
            try:
                value = read_json(call["arguments"] or "")
                canonical([[value]])  # raises where it is nested too deeply, as part of a message too
                errors.append(schema_errors(value, schemas[call["name"]]) if call["name"] in schemas else ["$: unknown tool"])
            except (ValueError, RecursionError):
                value = call["arguments"]
                errors.append(["$: not JSON"])
            values.append(value)
            wanted = references(value) if not isinstance(value, str) else set()
            needs.append({places[r] for r in wanted if r in places})
            earlier = set(call["earlier"] or [])
            errors[-1] += [f"$: no call {r}" for r in sorted(wanted) if r not in places and r not in earlier]
        order, stuck = topological(needs)
        for place, k in enumerate(order):
            call = calls[k]
            status = ("duplicate" if call["again"] else "cyclic" if k in stuck else "invalid" if errors[k] else "ok")
            body = {"id": call["call_id"], "name": call["name"], "arguments": values[k], "result": call["content"]}
            yield conv_id, turn, place, call["call_id"], call["name"], status, errors[k], call["linked"], canonical(body)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                rows = [row for c, t, calls in zip(*[some[x].to_pylist() for x in ("conv_id", "turn", "calls")])
                        for row in message(c, t, calls)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
    return run


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: conv_id, turn, place in its message's order, call_id, name, status, errors, linked, json.

    ``calls``: conv_id, turn, position, call_id, name, arguments (JSON). ``results``: conv_id, turn, call_id,
    content. ``schemas``: of each tool's arguments.
    """
    calls = calls.select("conv_id", "turn", "position", "call_id", "name", "arguments")
    first = (results.where("call_id is not null").groupBy(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"))
             .agg(F.min(F.struct("turn", "content")).alias("first")))
    # Rows with one id are few, but a null id may stand for many: those are no group.
    same_id = Window.partitionBy("conv_id", "call_id").orderBy("turn", "position", "name", "arguments")
    named = calls.where("call_id is not null").withColumn("again", F.row_number().over(same_id) > 1)
    marked = named.unionByName(calls.where("call_id is null").withColumn("again", F.lit(False)))
    linked = (marked.join(first, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call")), "left")
              .withColumn("linked", F.col("first").isNotNull() & ~F.col("again"))
              .withColumn("content", F.when(F.col("linked"), F.col("first.content"))))
    # References into earlier messages: the ids that arguments name and that an earlier call has.
    wanted = (calls.where("arguments like '%\"$%'")
              .select("conv_id", "turn", F.explode(F.array_distinct(F.regexp_extract_all(
                  F.col("arguments"), F.lit('"\\$([^"\\\\]+)"')))).alias("wanted")))
    known = named.where("not again").select(F.col("conv_id").alias("k_conv"), F.col("turn").alias("k_turn"),
                                            F.col("call_id").alias("k_call"))
    earlier = (wanted.distinct().join(known, F.col("conv_id").eqNullSafe(F.col("k_conv")) & (F.col("wanted") == F.col("k_call"))
                                      & (F.col("k_turn") < F.col("turn")))
               .groupBy(F.col("conv_id").alias("e_conv"), F.col("turn").alias("e_turn"))
               .agg(F.collect_set("wanted").alias("earlier")))
    messages = (linked.join(earlier, F.col("conv_id").eqNullSafe(F.col("e_conv")) & F.col("turn").eqNullSafe(F.col("e_turn")), "left")
                .groupBy("conv_id", "turn")
                .agg(F.sort_array(F.collect_list(F.struct("position", "call_id", "name", "arguments", "content", "again",
                                                          "linked", "earlier"))).alias("calls")))
    return messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           "calls").mapInArrow(_format(schemas), _OUT)


def calls_of_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read out of plain conversations, which hold no tool traffic of their own.

    Every line of an assistant's message is a call; the lines of the next message answer them in turn. A line
    with an odd number of words needs the next line's call, one whose number divides by four the line's before,
    one that divides by six the first call of the assistant's previous message.
    """
    lines = conversations.select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    an_id = lambda turn, position: F.concat_ws("-", F.col("conv_id"), turn, position)
    n = F.size(F.split(F.trim("line"), " +"))
    turn, position = F.col("turn"), F.col("position")
    needs = F.filter(F.array(
        F.when(n % 2 == 1, F.concat(F.lit("$"), an_id(turn, position + 1))),
        F.when((n % 4 == 0) & (position > 0), F.concat(F.lit("$"), an_id(turn, position - 1))),
        F.when(n % 6 == 0, F.concat(F.lit("$"), an_id(turn - 2, F.lit(0))))), lambda x: x.isNotNull())
    calls = (lines.where("role = 'assistant'")
             .select("conv_id", "turn", "position", an_id(turn, position).alias("call_id"),
                     F.element_at(F.array(F.lit("search"), F.lit("note")), (position % 2 + 1).cast("int")).alias("name"),
                     F.to_json(F.struct(F.col("line").alias("query"), n.alias("limit"), needs.alias("after"))).alias("arguments")))
    results = (lines.where("role = 'user'")
               .select("conv_id", "turn", an_id(turn - 1, position).alias("call_id"), F.col("line").alias("content")))
    return calls, results
