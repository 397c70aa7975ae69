"""Command line: list, run or explain the registered queries.

  python -m provdata list
  python -m provdata run NAME --data DIR [--out PATH] [--master local[8]]
  python -m provdata explain NAME --data DIR

``run`` writes the result as parquet to ``--out`` (or prints the first rows);
``explain`` prints the formatted physical plan.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="provdata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for c in ("run", "explain"):
        p = sub.add_parser(c)
        p.add_argument("name")
        p.add_argument("--data", required=True, help="directory with the input tables as <table>.parquet")
        p.add_argument("--master", default=None)
        p.add_argument("--shuffle-partitions", type=int, default=200)
        if c == "run":
            p.add_argument("--out", default=None, help="parquet output path (default: show 20 rows)")
    args = ap.parse_args(argv)
    from .plans.registry import load_all
    reg = load_all()
    if args.cmd == "list":
        for name, q in sorted(reg.items()):
            print(f"{name:34s} {q.operators}")
        return 0
    if args.name not in reg:
        print(f"unknown query {args.name}; see `python -m provdata list`", file=sys.stderr)
        return 2
    from .session import build_session
    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    df = reg[args.name].build(spark, args.data)
    if args.cmd == "explain":
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(f"wrote {args.out}")
    else:
        df.show(20, truncate=60)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
