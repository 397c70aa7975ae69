"""Run each registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [--sf DIR] [name ...]

Comparison (mirrors the driver's gate): same column-name set, same row count,
same multiset of rows after sorting columns by name and normalising values.
Also reports column type families that differ between the two engines.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from provdata.plans.registry import load_all  # noqa: E402
from provdata.session import build_session  # noqa: E402
from provdata.sources.bindings import DRIVER_TABLES  # noqa: E402


STRICT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def family(t: str) -> str:
    t = t.lower()
    for k, f in [("bigint", "int64"), ("long", "int64"), ("hugeint", "int128"), ("int", "int32"),
                 ("double", "double"), ("float", "float"), ("decimal", "decimal"), ("bool", "bool"),
                 ("timestamp", "ts"), ("date", "date"), ("string", "str"), ("varchar", "str"),
                 ("struct", "struct"), ("array", "array"), ("[]", "array"), ("map", "map")]:
        if k in t:
            return f
    return t


def duck(sf: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def compare(spark, con, q, sf: str) -> tuple[list[str], int]:
    """Messages describing differences (empty = match) and the Spark row count."""
    sdf = q.build(spark, sf)
    scols = sdf.columns
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    srows = [tuple(norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
    if q.oracle is None:
        return [], len(srows)
    rel = con.sql(q.oracle)
    ocols = rel.columns
    otypes = dict(zip(ocols, [str(x) for x in rel.types]))
    orows = [tuple(norm(r[ocols.index(c)]) for c in sorted(ocols)) for r in rel.fetchall()]
    msgs = []
    if sorted(scols) != sorted(ocols):
        msgs.append(f"columns differ: spark-only {sorted(set(scols) - set(ocols))} "
                    f"oracle-only {sorted(set(ocols) - set(scols))}")
    else:
        tdiff = {c: (stypes[c], otypes[c]) for c in scols if family(stypes[c]) != family(otypes[c])}
        if tdiff:
            msgs.append(f"types {tdiff}")
    if len(srows) != len(orows):
        msgs.append(f"rows spark={len(srows)} oracle={len(orows)}")
    if not msgs or all(m.startswith("types") for m in msgs):
        cs, co = Counter(srows), Counter(orows)
        if cs != co:
            only_s = list((cs - co).elements())[:3]
            only_o = list((co - cs).elements())[:3]
            msgs.append(f"values differ; cols={sorted(scols)}\n   spark-only {only_s}\n   oracle-only {only_o}")
    return msgs, len(srows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--strict", action="store_true", help="compare doubles bit for bit")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    global STRICT
    STRICT = args.strict
    spark = build_session()
    con = duck(args.sf)
    reg = load_all()
    names = args.names or list(reg)
    bad = 0
    for name in names:
        q = reg[name]
        t0 = time.time()
        try:
            msgs, n = compare(spark, con, q, args.sf)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"rows {name}: {n} rows (no oracle) {ts:.1f}s")
        elif msgs:
            bad += 1
            print(f"FAIL {name} ({n} rows, {ts:.1f}s): " + " | ".join(msgs))
        else:
            print(f"ok   {name}: {n} rows {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
