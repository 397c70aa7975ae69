"""Stress run of the NPI-licence match at the published raw volume.

Derives ~9.2 M registry rows and ~200 K licences from the driver's customer
table by key expansion (names repeat, so common surnames form huge blocks),
writes them once as parquet to a scratch folder, then times ``best_match``
and reports the pair work an all-pairs scorer would have done.

Usage: python tools/stress.py [SF_DIR] [NPI_FACTOR] [LIC_FACTOR] [SCRATCH]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from provdata.operators import match as M  # noqa: E402
from provdata.operators import staging as ST  # noqa: E402
from provdata.operators.providers import latest_per_key  # noqa: E402
from provdata.session import build_session  # noqa: E402
from provdata.sources.bindings import spark_text  # noqa: E402


def expanded(customer, factor):
    rep = customer.select("c_custkey", "c_name", "c_nationkey",
                          F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("_r"))
    return rep.select((F.col("c_custkey") * factor + F.col("_r")).alias("c_custkey"), "c_name", "c_nationkey")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    nf = int(sys.argv[2]) if len(sys.argv) > 2 else 560
    lf = int(sys.argv[3]) if len(sys.argv) > 3 else 28
    scratch = sys.argv[4] if len(sys.argv) > 4 else tempfile.mkdtemp(prefix="stress-")
    spark = build_session(shuffle_partitions=64, extra={"spark.driver.memory": "16g"})
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    t0 = time.perf_counter()
    # Many files, as a registry extract lands; a single file with one row group would be read by one task.
    (spark.sql(spark_text("npi_raw"), customer=expanded(cust, nf)).repartition(64)
     .write.mode("overwrite").parquet(f"{scratch}/npi"))
    raw = spark.sql(spark_text("tx_license_raw"), customer=expanded(cust, lf)).filter("snapshot_date = '2025-06-30'")
    ST.stage_tx(raw).repartition(16).write.mode("overwrite").parquet(f"{scratch}/lic")
    t1 = time.perf_counter()
    npi = spark.read.parquet(f"{scratch}/npi")
    lic = latest_per_key(spark.read.parquet(f"{scratch}/lic"), ["professional_id"], [F.col("source_license_id")])
    lic = ST.active_licenses(lic)
    t2 = time.perf_counter()
    M.best_match(lic, npi).write.format("noop").mode("overwrite").save()
    t3 = time.perf_counter()
    hist = M.block_histogram(lic, npi)
    stats = hist.agg(F.sum("pairs").alias("pairs"), F.max("pairs").alias("max_block_pairs"),
                     F.max("npi_rows").alias("max_block_npi")).first()
    print(json.dumps({"npi_rows": npi.count(), "licenses": lic.count(), "prepare_sec": round(t1 - t0, 1),
                      "match_sec": round(t3 - t2, 1), "all_pairs_would_be": int(stats.pairs or 0),
                      "largest_block_pairs": int(stats.max_block_pairs or 0),
                      "largest_block_npi_rows": int(stats.max_block_npi or 0)}))
    spark.stop()


if __name__ == "__main__":
    main()
