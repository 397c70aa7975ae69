"""The driver contract: entry / queries / oracle_sql, and bench.py's one JSON line."""

import importlib.util
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_queries_and_oracles(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.count() > 0 and "market_type" in df.columns
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
    assert all(isinstance(v, str) and v.strip() for v in o.values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="lead_rollup,clean_providers",
               BENCH_CPUS="2", BENCH_WARMUP_DIR="")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"lead_rollup", "clean_providers"} and d["value"] > 0
