"""Range carries and heavy values against plain windows and counting."""

import statistics
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from provdata.operators import heavy
from provdata.operators import history as H
from provdata.operators.carry import RANGE, Ranges
from provdata.operators.metrics import budget_cut
from provdata.operators.windows import session_starts


def log(spark, n=6000):
    """One key holds a third of the rows, all of them within one hour; keys may be null."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 5).select(
        F.when(hot, F.lit(1)).when(F.col("id") % 50 != 1, F.col("id") % 37).alias("k"),
        F.timestamp_add("SECOND", F.when(hot, F.col("id") * 7919 % 3600).otherwise(F.col("id") * 7919 % 900_000).cast("int"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("t"),
        F.col("id").alias("i"), F.when(F.col("id") * 13 % 5 < 2, "a").when(F.col("id") * 13 % 5 < 4, "b").alias("v"))


def bag(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_neighbours_equal_the_plain_window(spark):
    df = log(spark)
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = df.withColumns({"p": F.lag("v").over(w), "n": F.lead("i").over(w)})
    r = Ranges(df, ["k"], ["t", "i"]).previous(F.col("v"), "p").following(F.col("i"), "n")
    assert bag(r.plain(), "k", "t", "i", "v", "p", "n") == bag(plain, "k", "t", "i", "v", "p", "n")
    assert Ranges(df.limit(0), ["k"], ["t", "i"]).previous(F.col("v"), "p").plain().count() == 0


def test_history_of_a_log_equals_the_plain_window(spark):
    df = log(spark).unionByName(log(spark).where("i % 11 = 0"))  # repeated rows change nothing
    w = Window.partitionBy("k").orderBy("t", "i")
    starts = (df.distinct().withColumn("s", F.struct("v")).withColumn("p", F.lag("s").over(w))
              .where("p is null or not (s <=> p)"))
    want = starts.select("k", "v", F.col("t").alias("valid_from"), F.lead("t").over(w).alias("valid_to"))
    got = H.scd2_from_changes(df, "k", ["v"], ["t", "i"])
    assert bag(got, "k", "v", "valid_from", "valid_to") == bag(want, "k", "v", "valid_from", "valid_to")


def test_sessions_equal_the_plain_window(spark):
    df = log(spark).select("k", "t")
    prev = F.lag("t").over(Window.partitionBy("k").orderBy("t"))
    want = df.withColumn("p", prev).where("p is null or timestampdiff(SECOND, p, t) >= 600")
    assert bag(session_starts(df, "k", "t", 600), "k", "t") == bag(want, "k", "t")


@pytest.mark.parametrize("limit", [0, 1, 700, 10**6])
def test_budget_over_ranges_equals_the_running_sum(spark, limit):
    df = spark.range(0, 3000, 1, 4).select((F.col("id") * 7 % 3001).alias("k"), (F.col("id") % 3 != 0).alias("m"))
    run, want = 0, {}
    for k, m in sorted((r.k, r.m) for r in df.collect()):
        if run < limit:
            want[k] = run
        run += m
    assert {r.k: r.credits_before for r in budget_cut(df, ["k"], "m", limit).collect()} == want


def test_a_hot_key_is_cut_into_ranges_without_another_hash(spark):
    r = Ranges(log(spark, 60_000), ["k"], ["t", "i"])
    sizes = [row["count"] for row in r.rows.groupBy(RANGE).count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 3 * statistics.median(sizes)
    plan = r.previous(F.col("v"), "p").plain()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and "CartesianProduct" not in plan


VALUES = {
    "few": [(("x", "y", "", None, "z")[k % 5],) for k in range(400)],
    "heavy and unique": [("hot" if k % 3 else f"u{k}",) for k in range(3000)] + [("warm",)] * 40,
    "unique": [(f"u{k:05d}",) for k in range(3000)],
    "ties": [(f"t{k % 60:02d}",) for k in range(1200)],
    "none": [],
}


@pytest.mark.parametrize("case", VALUES)
@pytest.mark.parametrize("tracked,buckets", [(40, 8), (heavy.TRACKED, heavy.BUCKETS)])
def test_heavy_and_lowest_values_equal_counting(spark, case, tracked, buckets):
    df = spark.createDataFrame(VALUES[case], "s string").repartition(3)
    counts = Counter(v for v, in VALUES[case] if v is not None)
    top = [tuple(r) for r in heavy.top_values(df, F.col("s"), 10, tracked, buckets).collect()]
    assert top == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
    low = [tuple(r) for r in heavy.lowest_values(df, F.col("s"), 5, buckets).collect()]
    assert low == sorted(counts.items())[:5]


def test_what_is_shuffled_of_a_near_unique_column_is_bounded(spark):
    """With one heavy value the buckets of the others stay below it, so none of them is grouped by value."""
    df = spark.range(0, 50_000, 1, 4).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("s"))
    values = df.select(F.col("s").alias("value"))
    most = values.where("value <> 'hot'").groupBy(heavy._bucket(64)).count().agg(F.max("count")).first()[0]
    assert most < 12_500  # no bucket reaches the heavy value
    assert [tuple(r) for r in heavy.top_values(df, F.col("s"), 1, 40, 64).collect()] == [("hot", 12_500)]
