"""Steps whose cost per task must not grow with the table: dealing out, clustered files, keyed reads."""

import pandas as pd
from pyspark.sql import functions as F

from provdata.sources import io as IO
from provdata.sources.bindings import spread
from provdata.sources.keyed import KeyedTable
from provdata.streaming.engagement import LeadState


def test_rows_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    spark.range(5000).withColumn("x", F.md5(F.col("id").cast("string"))).coalesce(1).write.parquet(f"{tmp_path}/a b.parquet")
    one = spark.read.parquet(f"{tmp_path}/a b.parquet")
    dealt = spread(one, 20_000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 2000 and sum(sizes) == 5000
    assert sorted(dealt.collect()) == sorted(one.collect())
    assert spread(one, 1 << 30) is one


def test_clustered_files_grow_in_number_not_in_size(spark, tmp_path):
    df = spark.range(6000).select(F.lit("TX").alias("state"), "id")
    IO.write_clustered(df, str(tmp_path), ["state"], num_files=2, rows_per_file=500)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path)).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1000 and sum(sizes) == 6000


def test_keyed_read_of_some_columns_and_single_deltas(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=2)
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, w long")
    table.upsert(rows(("a", "1", 1), ("b", "2", 2), (None, "3", 3)), one_per_key=True)
    assert "Aggregate" not in table.read()._jdf.queryExecution().toString()  # one delta is not grouped
    table.compact()
    table.upsert(rows(("a", "4", 4), ("c", None, 5)))
    table.delete(rows((None, "", 0)))
    want = [("a", "4", 4), ("b", "2", 2), ("c", None, 5)]
    assert sorted(tuple(r) for r in table.read().collect()) == want
    assert sorted(tuple(r) for r in table.read(only=["w"]).collect()) == [(2,), (4,), (5,)]
    assert sorted(tuple(r) for r in table.read(only=["k"]).collect()) == [(k,) for k, *_ in want]
    table.upsert(rows(("c", "6", 6), ("b", "7", 7)))
    assert sorted(tuple(r) for r in table.read(only=["v", "k"]).collect()) == [("a", "4"), ("b", "7"), ("c", "6")]


def test_lead_state_of_mixed_touches():
    lead, hour = LeadState(), 3_600_000_000
    touches = pd.DataFrame({"at": [0, hour, hour, 60_000_000], "hour": [0, 1, 1, 0], "day": [0, 0, 0, 0], "dow": [5, 5, 5, 5],
                            "channel": ["x", None, "x", float("nan")]})
    lead.add(touches, 1_800_000_000)
    assert lead.stored() == (4, 0, 0, hour, [0, 0, 0, 0, 4, 0, 0], [2, 2] + [0] * 22, [("x", 2), (None, 2)], [0],
                             [(0, 60_000_000), (hour, hour)])
