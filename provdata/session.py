"""Spark session helpers.

The library never creates a session inside an operator: every operator takes
DataFrames and returns DataFrames. These helpers are for tests, the bench and
command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at cluster scale as well as locally. AQE re-plans joins
# (broadcast conversion, skew-split) and coalesces small shuffle partitions at
# runtime, which is what keeps the blocking match join and the waterfall
# aggregate balanced when one surname or one provider holds a large share.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "provdata", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("PROVDATA_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at storage which the driver and every executor see, and it
    is used as is. Where it is unset, a scratch folder is made only for ``local[...]`` masters
    (one machine); any other master raises, because files that executors write to their own
    disks cannot be read back.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="provdata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
