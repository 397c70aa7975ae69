"""Per-query stage statistics from Spark's event log (shuffle bytes, skew).

Runs the named registered queries (or the stress match) with the event log
written to a scratch folder, each under its own job group, then reads the
log: per query the number of stages and tasks, shuffle bytes written, and
the worst stage skew (max task run time / median task run time).

Usage:
  python tools/eventlog_stats.py SF_DIR query [query ...]
  python tools/eventlog_stats.py --stress SCRATCH_WITH_npi_AND_lic
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from provdata.session import build_session  # noqa: E402


def run(jobs, shuffle_partitions=16):
    logdir = tempfile.mkdtemp(prefix="evlog-")
    spark = build_session(shuffle_partitions=shuffle_partitions, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false",
        "spark.driver.memory": "16g"})
    for name, build in jobs:
        spark.sparkContext.setJobGroup(name, name)
        build(spark).write.format("noop").mode("overwrite").save()
    spark.stop()
    return parse(glob.glob(os.path.join(logdir, "*"))[0])


def _lines(path):
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    for fp in files:
        if os.path.basename(fp).startswith("appstatus"):
            continue
        with open(fp) as f:
            yield from f


def parse(path):
    stage_group, tasks = {}, defaultdict(list)
    shuffle = defaultdict(int)
    if True:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                sid = e["Stage ID"]
                tasks[sid].append(m.get("Executor Run Time", 0))
                shuffle[sid] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    out = defaultdict(lambda: {"stages": 0, "tasks": 0, "shuffle_bytes": 0, "worst_skew": 1.0, "worst_stage_ms": 0})
    for sid, times in tasks.items():
        g = stage_group.get(sid)
        if g is None:
            continue
        o = out[g]
        o["stages"] += 1
        o["tasks"] += len(times)
        o["shuffle_bytes"] += shuffle[sid]
        med = statistics.median(times) or 1
        if len(times) >= 4:
            o["worst_skew"] = round(max(o["worst_skew"], max(times) / med), 2)
        o["worst_stage_ms"] = max(o["worst_stage_ms"], max(times))
    return dict(out)


def main():
    if sys.argv[1] == "--stress":
        from pyspark.sql import functions as F
        from provdata.operators import match as M
        from provdata.operators import staging as ST
        from provdata.operators.providers import latest_per_key
        s = sys.argv[2]

        def build(spark):
            lic = latest_per_key(spark.read.parquet(f"{s}/lic"), ["professional_id"], [F.col("source_license_id")])
            return M.best_match(ST.active_licenses(lic), spark.read.parquet(f"{s}/npi"))
        print(json.dumps(run([("stress_best_match", build)], shuffle_partitions=64)))
        return
    from provdata.plans.registry import load_all
    sf, names = sys.argv[1], sys.argv[2:]
    reg = load_all()
    print(json.dumps(run([(n, lambda spark, n=n: reg[n].build(spark, sf)) for n in names]), indent=1))


if __name__ == "__main__":
    main()
