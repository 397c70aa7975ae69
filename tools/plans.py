"""Write PLANS.md: the physical plan (operator tree) of each headline query at a given scale."""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def condense(tree: str) -> list[str]:
    out = []
    for line in tree.splitlines():
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?([A-Za-z]+)(.*)$", line)
        if not m:
            continue
        indent, _, node, rest = m.groups()
        detail = ""
        if node in ("Exchange",):
            k = re.match(r"\s*(\w+\([^)]*\))", rest)
            detail = " " + (k.group(1) if k else rest.strip()[:60])
        elif node in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin"):
            detail = " " + rest.strip()[:90]
        elif node in ("HashAggregate", "SortAggregate", "ObjectHashAggregate"):
            k = re.match(r"\(keys=\[([^\]]*)\]", rest)
            detail = f" keys=[{k.group(1)[:80]}]" if k else ""
        elif node == "FileScan":
            k = re.search(r"parquet ([^\[]*)\[", rest)
            detail = " parquet"
        elif node == "Window":
            detail = " " + rest.strip()[:80]
        out.append(f"{indent}{node}{detail}")
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import bench
    from provdata.plans.registry import load_all
    from provdata.session import build_session
    spark = build_session(shuffle_partitions=16)
    reg = load_all()
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plans.py` at `{sf}` (initial adaptive plan; AQE may coalesce partitions, switch",
             "joins to broadcast and split skewed partitions at runtime). Operator names with the keys of exchanges,",
             "joins and aggregates.", ""]
    for name in bench.HEADLINE:
        df = reg[name].build(spark, sf)
        tree = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + condense(tree) + ["```", ""]
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
