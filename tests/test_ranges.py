"""Snapshots by key range: unchanged ranges are not scanned, and the history is that of the full run."""

import re

from pyspark.sql import functions as F

from provdata.operators import history as H
from provdata.plans import q_staging
from provdata.sources.ranges import RangedSnapshots


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "valid_from", "valid_to").collect()), key=str)


def _snapshot(spark, change):
    rows = [(f"{k:05d}", change.get(k, f"v{k}"), k) for k in range(4000) if change.get(k, "") is not None]
    return spark.createDataFrame(rows, "k string, v string, other long")


def test_unchanged_ranges_are_not_scanned(spark, tmp_path):
    ranged = RangedSnapshots(spark, str(tmp_path), ["k"], ["v"], fanout=6)
    # One stretch of keys changes: new values, a key that goes, one that comes.
    before, after = _snapshot(spark, {7: None}), _snapshot(spark, {k: "new" for k in range(100, 160)} | {155: None})
    ranged.write("d0", before)
    ranged.write("d1", after)
    changed = ranged.changed("d0", "d1")
    total = len({r._range for r in spark.read.parquet(f"{tmp_path}/day=d1").select("_range").distinct().collect()})
    assert total == 36 and 1 <= len(changed) <= total / 10, (total, changed)
    part = ranged.read("d1", changed)
    scanned = {int(re.search(r"_range=(\d+)", f)[1]) for f in part.inputFiles()}
    assert scanned == set(changed)
    first = H.scd2_apply(None, ranged.read("d0"), "k", ["v"], "2025-01-01")
    got = H.scd2_apply_ranges(first, part, ranged.inside(changed), "k", ["v"], "2025-01-02")
    assert _rows(got) == _rows(H.scd2_apply(first, after, "k", ["v"], "2025-01-02"))
    assert ranged.changed("d0", "d0") == [] and ranged.read("d1", []).count() == 0


def test_columns_outside_the_content_change_nothing(spark, tmp_path):
    ranged = RangedSnapshots(spark, str(tmp_path), ["k"], ["v"], fanout=2)
    df = spark.createDataFrame([("a", "1", 1), ("b", None, 2), (None, "3", 3)], "k string, v string, other long")
    ranged.write("d0", df)
    ranged.write("d1", df.withColumn("other", df.other + 1).repartition(3))
    assert ranged.changed("d0", "d1") == []
    ranged.write("d2", df.fillna("", ["v"]))  # NULL and '' differ
    assert len(ranged.changed("d1", "d2")) == 1
    empty = RangedSnapshots(spark, str(tmp_path / "e"), ["k"], ["v"], fanout=2)
    empty.write("d0", df.limit(0))
    empty.write("d1", df)
    assert empty.changed("d0", "d1") == [0] and empty.read("d1", [0]).count() == 3


def test_history_ranges_makes_each_snapshot_once(spark, tmp_path, monkeypatch):
    spark.range(300).selectExpr("id as c_custkey", "'C' || id as c_name", "cast(id % 25 as int) as c_nationkey") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    real, seen = q_staging.staged(spark, str(tmp_path)), spark.sparkContext.accumulator(0)

    def counted(city):
        seen.add(1)
        return city

    monkeypatch.setattr(q_staging, "staged", lambda s, d: real.withColumn("city", F.udf(counted)("city")))
    got = q_staging.q_history_ranges(spark, str(tmp_path))
    assert got.count() > 300
    assert seen.value == real.count()  # whole rows of both days; the day whose keys set the boundaries came twice


def test_all_ranges_changed_reads_each_snapshot_once(spark, tmp_path):
    ranged = RangedSnapshots(spark, str(tmp_path), ["k"], ["v"], fanout=3)
    before, after = _snapshot(spark, {}), _snapshot(spark, {k: "new" for k in range(0, 4000, 3)} | {8: None})
    ranged.write("d0", before)
    ranged.write("d1", after)
    changed = ranged.changed("d0", "d1")
    assert changed == list(range(9))
    first = H.scd2_apply(None, ranged.read("d0"), "k", ["v"], "2025-01-01")
    got = H.scd2_apply_ranges(first, ranged.read("d1", changed), ranged.inside(changed), "k", ["v"], "2025-01-02")
    assert _rows(got) == _rows(H.scd2_apply(first, after, "k", ["v"], "2025-01-02"))
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_inside_and_number_of_a_range(spark, tmp_path):
    ranged = RangedSnapshots(spark, str(tmp_path), ["k"], ["v"], fanout=3)
    df = _snapshot(spark, {}).unionByName(spark.createDataFrame([(None, "x", 1), ("", "x", 2), ("\u00e9", "x", 3)], "k string, v string, other long"))
    ranged._set_bounds(df)
    lows = ranged.bounds()
    assert len(lows) == 8
    for some in ([], [0], [8], [0, 1, 4, 6, 7], [2, 3, 8], list(range(9)), [5, 5, 40]):
        rows = df.select("k", ranged.range_of().alias("n"), ranged.inside(some).alias("is_in")).collect()
        for r in rows:
            n = sum((r.k or "") >= x for x in lows)
            assert (r.n, r.is_in) == (n, n in some), (r, some)
