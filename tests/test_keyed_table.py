"""The merge-on-read table: rows as a dictionary would hold them, bytes that follow the change, races, compaction."""

import os
import random

import pytest

from provdata.sources.io import ConcurrentWrite, write_version, read_current, current_version
from provdata.sources.keyed import ConcurrentUpdate, KeyedTable

SCHEMA = "k long, part string, v string"


def rows_of(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def test_changes_equal_a_dictionary(spark, tmp_path):
    rnd, table, want = random.Random(4), KeyedTable(spark, str(tmp_path), ["k", "part"], buckets=4, compact_after=5), {}
    assert table.read() is None and table.version() == 0
    for step in range(9):
        change = {(rnd.choice([None, *range(40)]), rnd.choice(["a", None])): f"s{step}" for _ in range(rnd.choice([1, 15]))}
        df = spark.createDataFrame([(*k, v) for k, v in change.items()], SCHEMA)
        kind = ("replace", "insert_only", "delete")[step % 3]
        if kind == "delete":
            table.delete(df)
            want = {k: v for k, v in want.items() if k not in change}
        else:
            table.upsert(df, kind)
            want = want | change if kind == "replace" else change | want
        assert rows_of(table) == sorted(((*k, v) for k, v in want.items()), key=str)
    table.compact()
    assert rows_of(table) == sorted(((*k, v) for k, v in want.items()), key=str)
    state = table.state()
    assert state["delta"] == [] and len({b for _, own in state["base"] for b in own}) == sum(len(own) for _, own in state["base"])


def test_repeated_keys_new_columns_and_types(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"])
    table.upsert(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string"))
    table.upsert(spark.createDataFrame([(2, "d", 5)], "k long, v string, w int"))
    assert [tuple(r) for r in table.read().orderBy("k").collect()] == [(1, "b", None), (2, "d", 5)]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(2, 7)], "k long, v int"))
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(2, True)], "k long, _deleted boolean"))
    version = table.version()
    assert table.upsert(spark.createDataFrame([], "k long, v string")) == version
    empty = KeyedTable(spark, str(tmp_path / "e"), ["k"])
    empty.upsert(spark.createDataFrame([], "k long, v string"))
    assert empty.read().collect() == [] and empty.delete(table.read()) == 2 and empty.read().collect() == []


def test_bytes_written_follow_the_change(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=8, compact_after=0)
    table.upsert(spark.range(200_000).selectExpr("id as k", "md5(cast(id as string)) as v"))
    table.compact()
    table.vacuum(1)
    before = size_of(tmp_path)
    table.upsert(spark.createDataFrame([(7, "x"), (8, "y")], "k long, v string"))
    assert size_of(tmp_path) - before < before / 100
    state = table.state()
    untouched = set(range(8)) - {b for _, own in state["delta"] for b in own}
    assert len(untouched) >= 6
    # A read of an untouched bucket opens base files alone, without a join.
    plan = table.read(buckets=sorted(untouched))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert table.read().count() == 200_000 and table.read().where("k = 7").first().v == "x"
    old_base = {c for c, _ in state["base"]}
    table.compact()  # rewrites the touched buckets and keeps the files of the others
    kept = {b for c, own in table.state()["base"] if c in old_base for b in own}
    assert kept == untouched and table.read().count() == 200_000


def test_the_loser_of_a_race_leaves_the_winners_rows(spark, tmp_path):
    first = KeyedTable(spark, str(tmp_path), ["k"], buckets=4)
    first.upsert(spark.createDataFrame([(k, "old") for k in range(40)], "k long, v string"))
    stale = first.state()
    loser = KeyedTable(spark, str(tmp_path), ["k"], buckets=4)
    first.upsert(spark.createDataFrame([(1, "winner")], "k long, v string"))
    real = loser.state
    answers = iter([stale])
    loser.state = lambda: next(answers, None) or real()
    with pytest.raises(ConcurrentUpdate):
        loser.upsert(spark.createDataFrame([(1, "loser")], "k long, v string"))
    assert first.read().where("k = 1").first().v == "winner" and first.read().count() == 40
    # A writer of another bucket takes the next number instead.
    bucket = lambda k: spark.createDataFrame([(k,)], "k long").select(first._bucket(4)).first()[0]
    other = next(k for k in range(2, 40) if bucket(k) != bucket(1))
    answers = iter([stale])
    version = loser.upsert(spark.createDataFrame([(other, "beside")], "k long, v string"))
    assert version == 3 and {r.v for r in first.read().where(f"k in (1, {other})").collect()} == {"winner", "beside"}
    # A compaction that began before a change keeps the change.
    answers = iter([stale])
    loser.compact()
    assert {r.v for r in first.read().where(f"k in (1, {other})").collect()} == {"winner", "beside"}


def test_a_commit_number_is_taken_once(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=1)
    table.upsert(spark.createDataFrame([(1, "a")], "k long, v string"))
    (tmp_path / "_log" / "000000000002.json").write_text("")  # a writer that died between creating and writing
    monkeypatch.setattr(KeyedTable, "_entry", lambda self, v, wait_s=0.1, real=KeyedTable._entry: real(self, v, 0.1))
    with pytest.raises(RuntimeError, match="left empty"):
        table.upsert(spark.createDataFrame([(1, "b")], "k long, v string"))


def test_vacuum_keeps_what_the_last_commits_name(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=2, compact_after=3)
    for k in range(7):
        table.upsert(spark.createDataFrame([(k, "a")], "k long, v string"))
    table.vacuum(1)
    assert table.read().count() == 7
    named = {c for kind in ("base", "delta") for c, _ in table.state()[kind]}
    assert {p.name.removeprefix("_commit=") for p in (tmp_path / "data").iterdir()} == named


def test_write_version_leaves_the_winners_rows(spark, tmp_path, monkeypatch):
    """Two writers at the same version: the second raises and the first one's rows stay."""
    from provdata.sources import io as IO

    base = str(tmp_path / "t")
    write_version(spark, spark.range(3), base)
    write_version(spark, spark.range(10), base)
    with monkeypatch.context() as m:
        m.setattr(IO, "_last_marker", lambda *_: 1)
        with pytest.raises(ConcurrentWrite):
            write_version(spark, spark.range(5), base)
    assert current_version(spark, base) == 2 and read_current(spark, base).count() == 10
