"""Snapshots by key range with a tree of digests (SRC5, HIS1): what has not changed is not read.

A snapshot is written in folders of key ranges, with the boundaries of the first one, so that equal keys lie in equal
ranges. Each range has a leaf (rows and an order-free digest of key and content), and ``fanout`` leaves
have a parent that sums them up. Two snapshots are compared from the root down: only the children of nodes that differ are looked at,
and only the ranges whose leaves differ are read, staged and joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import exists, row_digest

#: Keys looked at for each range when boundaries are set; which these are depends on their hashes alone.
KEYS_PER_RANGE = 32


class RangedSnapshots:
    """Snapshots under ``base``, ``fanout ** 2`` ranges of ``key`` columns; a change in ``content`` columns is a change."""

    def __init__(self, spark: SparkSession, base: str, key: Sequence[str], content: Sequence[str], fanout: int = 16):
        self.fanout = fanout
        self.spark, self.base, self.key, self.content = spark, base.rstrip("/"), list(key), list(content)
        self._bounds: list[str] | None = None

    def _key(self) -> Column:
        return F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in self.key])

    def bounds(self) -> list[str]:
        """The least key of each range but the first, ascending."""
        if self._bounds is None:
            self._bounds = [r[0] for r in self.spark.read.parquet(f"{self.base}/bounds").orderBy("low").collect()]
        return self._bounds

    def _set_bounds(self, df: DataFrame) -> None:
        ranges = self.fanout * self.fanout
        keys = df.select(self._key().alias("low")).distinct()
        some = sorted(r[0] for r in keys.orderBy(F.xxhash64("low"), "low").limit(KEYS_PER_RANGE * ranges).collect())
        lows = sorted({some[k * len(some) // ranges] for k in range(1, ranges)}) if some else []
        self.spark.createDataFrame([(x,) for x in lows], "low string").coalesce(1).write.mode("overwrite").parquet(f"{self.base}/bounds")

    def range_of(self) -> Column:
        """The number of a row's range, by halving: as many comparisons a row as ``fanout ** 2`` has bits."""
        lows, key = self.bounds(), self._key()

        def number(first: int, last: int) -> Column:
            if first == last:
                return F.lit(first)
            mid = (first + last + 1) // 2
            return F.when(key < F.lit(lows[mid - 1]), number(first, mid - 1)).otherwise(number(mid, last))

        return number(0, len(lows)).cast("int")

    def write(self, day: str, df: DataFrame, keys: DataFrame | None = None) -> None:
        """Write one snapshot and its tree; the tree comes last, so a snapshot without one is not there.

        ``keys`` has the key columns of the rows that ``df`` was made of: where boundaries are set, they are read there
        if given, so that a snapshot that costs an aggregate of whole rows is made once, not twice.
        """
        if not exists(self.spark, f"{self.base}/bounds/_SUCCESS"):
            self._set_bounds(df if keys is None else keys)
        spread = F.pmod(F.xxhash64(self._key()), F.lit(4))
        ranged = df.withColumn("_range", self.range_of())
        ranged.repartition("_range", spread).write.mode("overwrite").partitionBy("_range").parquet(f"{self.base}/day={day}")
        written = self.spark.read.schema(ranged.schema).parquet(f"{self.base}/day={day}")
        columns = [*self.key, *[c for c in self.content if c not in self.key]]
        leaves = written.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(columns)).alias("digest"))
        leaves = leaves.select(F.lit(0).alias("level"), F.col("_range").alias("node"), "rows", "digest")
        parents = leaves.groupBy(F.lit(1).alias("level"), F.floor(F.col("node") / self.fanout).cast("int").alias("node")).agg(
            F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest"))
        leaves.withColumn("digest", F.col("digest").cast("decimal(38,0)")).unionByName(parents).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.base}/tree/day={day}")

    def _nodes(self, day: str, level: int, parents: Sequence[int] | None = None) -> dict[int, tuple]:
        tree = self.spark.read.parquet(f"{self.base}/tree/day={day}").where(F.col("level") == level)
        if parents is not None:
            tree = tree.where(F.floor(F.col("node") / self.fanout).isin(list(parents)))
        return {r["node"]: (r["rows"], r["digest"]) for r in tree.collect()}  # fanout ** 2 rows at most

    def changed(self, before: str, day: str) -> list[int]:
        """The ranges in which two snapshots differ."""
        differ = lambda a, b: sorted(n for n in a.keys() | b.keys() if a.get(n) != b.get(n))
        tops = differ(self._nodes(before, 1), self._nodes(day, 1))
        return differ(self._nodes(before, 0, tops), self._nodes(day, 0, tops)) if tops else []

    def read(self, day: str, ranges: Sequence[int] | None = None) -> DataFrame:
        """A snapshot, whole or of some ranges: only their folders are listed and scanned."""
        folder = f"{self.base}/day={day}"
        if ranges is None:
            return self.spark.read.parquet(folder).drop("_range")
        there = [f"{folder}/_range={n}" for n in sorted(self._nodes(day, 0).keys() & set(ranges))]
        if not there:
            return self.spark.createDataFrame([], self.read(day).schema)
        return self.spark.read.option("basePath", folder).parquet(*there).drop("_range")

    def inside(self, ranges: Sequence[int]) -> Column:
        """Whether a row with the key columns lies in one of ``ranges``: two comparisons for each run of neighbours."""
        lows, key = self.bounds(), self._key()
        some, runs = set(ranges) & set(range(len(lows) + 1)), []
        for first in sorted(n for n in some if n - 1 not in some):
            last = next(n for n in range(first, len(lows) + 1) if n + 1 not in some)
            edges = [key >= F.lit(x) for x in lows[:first][-1:]] + [key < F.lit(x) for x in lows[last:last + 1]]
            runs.append(reduce(lambda a, b: a & b, edges, F.lit(True)))
        return reduce(lambda a, b: a | b, runs, F.lit(False))
