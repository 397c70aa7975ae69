"""Connected components of a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provdata.llm.tables import materialize


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _union_find(batches) -> Iterator[pa.RecordBatch]:
    pairs = [np.stack([b["hi"].to_numpy(), b["lo"].to_numpy()]) for b in batches]
    if not pairs:
        return
    nodes, place = np.unique(np.concatenate(pairs, axis=1), return_inverse=True)
    root = list(range(len(nodes)))
    for a, b in place.reshape(2, -1).T.tolist():
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        root[max(a, b)] = min(a, b)
    for k, r in enumerate(root):  # a root is never larger than what hangs on it
        root[k] = root[r]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "component"])


def components(edges: DataFrame, local_edges: int = 1_000_000) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (long a, long b); the component is its smallest node.

    Up to ``local_edges`` edges, 16 MB at the default, are joined by union-find in one task. More go through
    rounds of large-star and small-star: each node links its larger neighbours, then its smaller ones, to the
    least it knows, until nothing changes; a node with many neighbours meets its minimum by a
    pre-aggregated group and a join that adaptive execution can split. The result is materialised.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))
    if now.count() <= local_edges:
        return materialize(now.coalesce(1).mapInArrow(_union_find, "node long, component long"))
    now = materialize(now.distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("v"), F.col("lo").alias("u")).union(
            now.select(F.col("lo").alias("v"), F.col("hi").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = materialize(both.where("u > v").join(least, "v").select(F.col("u").alias("hi"), F.col("m").alias("lo"))
                            .where("hi <> lo").distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m").alias("lo"))))
        now = materialize(small.distinct())
        if mark == (mark := _mark(now)):
            break
    return materialize(now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        now.select("lo", "lo").distinct()))
