"""Readers, versioned writes and snapshot helpers."""

import os
import tempfile

from pyspark.sql import functions as F

from provdata.sources import io as IO
from provdata.sources.bindings import binding
from tests.conftest import SF_SMALL


def test_license_csv_round_trip_with_bad_rows(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    path = os.path.join(d, "tx.csv")
    with open(path, "w") as f:
        f.write("lic_id,lic_nbr,city\n1, L1 ,Austin\n2,L2,NULL\n3,L3\n4,\"L4,x\",Dallas\n5,L5,\"unterminated\n")
    good, bad = IO.read_license_csv(spark, path, ["lic_id", "lic_nbr", "city"])
    rows = sorted((r.lic_id, r.lic_nbr, r.city) for r in good.collect())
    assert ("1", "L1", "Austin") in rows and ("2", "L2", None) in rows and ("3", "L3", None) in rows
    assert good.count() + bad.count() == 5


def test_versioned_upsert_and_pointer(spark):
    base = tempfile.mkdtemp(prefix="tbl-")
    a = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    assert IO.upsert(spark, base, a, ["k"]) == 1
    b = spark.createDataFrame([("k2", 20), ("k3", 3)], "k string, v int")
    assert IO.upsert(spark, base, b, ["k"], mode="replace") == 2
    cur = sorted(tuple(r) for r in IO.read_current(spark, base).collect())
    assert cur == [("k1", 1), ("k2", 20), ("k3", 3)]
    c = spark.createDataFrame([("k1", 100), ("k4", 4)], "k string, v int")
    IO.upsert(spark, base, c, ["k"], mode="insert_only")
    cur = sorted(tuple(r) for r in IO.read_current(spark, base).collect())
    assert cur == [("k1", 1), ("k2", 20), ("k3", 3), ("k4", 4)]
    # Version 1 is untouched.
    assert spark.read.parquet(IO._folder(spark, base, 1)).count() == 2


def test_clustered_and_by_type_writes(spark):
    df = binding(spark, SF_SMALL, "tx_license_raw")
    out = tempfile.mkdtemp(prefix="cl-")
    IO.write_clustered(df, out + "/c", ["state", "professional_type"], num_files=4)
    assert spark.read.parquet(out + "/c").count() == df.count()
    IO.write_by_type(df, out + "/t")
    back = spark.read.parquet(out + "/t")
    assert sorted(r[0] for r in back.select("professional_type").distinct().collect()) == ["dentist", "hygienist"]


def test_fingerprint_detects_change(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    same = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    diff = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    fp = lambda x: IO.snapshot_fingerprint(x.withColumn("g", F.lit(1)), ["g"])
    assert fp(df).first().digest == fp(same).first().digest
    assert fp(df).first().digest != fp(diff).first().digest


def test_uncommitted_version_is_invisible_and_rewritten(spark):
    base = tempfile.mkdtemp(prefix="tbl-")
    IO.write_version(spark, spark.createDataFrame([("a", 1)], "k string, v int"), base)
    # A job that wrote v=2 but died before committing it.
    spark.createDataFrame([("junk", 9)], "k string, v int").write.parquet(f"{base}/v=2")
    assert IO.current_version(spark, base) == 1
    assert [tuple(r) for r in IO.read_current(spark, base).collect()] == [("a", 1)]
    assert IO.write_version(spark, spark.createDataFrame([("b", 2)], "k string, v int"), base) == 2
    assert [tuple(r) for r in IO.read_current(spark, base).collect()] == [("b", 2)]
