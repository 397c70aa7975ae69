"""Previous row, next row and running sum of an order, by ranges with a carry (HIS2, WIN8, sessionisation).

``Window.partitionBy(key)`` sorts all rows of a key in one task, and a window without a key sorts the whole
table in one. Here rows are range-partitioned by (key, order) and written, so that a hot key is cut into as many
ranges as it needs, within one hour or any other unit of time too. A window inside each range does all but its
edge, and the edge comes from a table with one row per range (the last row, first row or sum of each), whose own
window has no more rows than the table has partitions. Results equal the plain window's.

Rows that agree in key, order and ``ties`` meet in one range; callers whose result ignores repeats drop them first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

RANGE = "_range"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Ranges:
    """``df`` in ranges of (``key``, ``order``, a digest of ``ties``), written under ``spark.checkpoint.dir``."""

    def __init__(self, df: DataFrame, key: Sequence[str], order: Sequence[str], ties: Sequence[str] = (),
                 rows: DataFrame | None = None):
        self.key, self.order, self.ties = list(key), list(order), list(ties)
        if rows is None:
            ensure_checkpoint_dir(df.sparkSession)
            n = _partitions(df)
            rows = (df.repartitionByRange(n, *self._sorted()).withColumn(RANGE, F.spark_partition_id()).checkpoint()
                    .repartitionById(n, F.col(RANGE)))
        self.rows = rows

    def _sorted(self) -> list[Column]:
        tie = [F.xxhash64(*self.ties)] if self.ties else []
        return [F.col(c) for c in self.key + self.order] + tie

    def of(self, rows: DataFrame) -> Ranges:
        """The same ranges of rows derived from ``self.rows``, some of them dropped or widened."""
        return Ranges(rows, self.key, self.order, self.ties, rows)

    def _neighbour(self, value: Column, out: str, forward: bool) -> Ranges:
        own = F.struct(F.struct(*self.key).alias("k"), value.alias("v"))
        place = F.struct(*self._sorted())
        edge = (F.min_by if forward else F.max_by)(own, place)
        shift = F.lead if forward else F.lag
        edges = self.rows.groupBy(RANGE).agg(edge.alias("_edge"))  # one row per range
        carried = edges.select(RANGE, shift("_edge").over(Window.orderBy(RANGE)).alias("_carry"))
        inside = Window.partitionBy(RANGE).orderBy(*self._sorted())
        rows = self.rows.join(F.broadcast(carried), RANGE).withColumn("_near", F.coalesce(shift(own).over(inside), F.col("_carry")))
        same = F.col("_near.k").eqNullSafe(F.struct(*self.key))
        return self.of(rows.withColumn(out, F.when(same, F.col("_near.v"))).drop("_near", "_carry"))

    def previous(self, value: Column, out: str) -> Ranges:
        """Add ``out``: ``value`` of the previous row of the key, null for its first row."""
        return self._neighbour(value, out, forward=False)

    def following(self, value: Column, out: str) -> Ranges:
        """Add ``out``: ``value`` of the next row of the key, null for its last row."""
        return self._neighbour(value, out, forward=True)

    def before(self, value: Column, out: str, below: int | None = None) -> Ranges:
        """Add ``out``: sum of ``value`` over all earlier rows (no key); with ``below``, only rows where it is less.

        Ranges that start at ``below`` or more are left out before any row of theirs is sorted.
        """
        if self.key:
            raise ValueError("a running sum goes over the whole order")
        sums = self.rows.groupBy(RANGE).agg(F.sum(value).alias("_sum"))
        earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        starts = sums.select(RANGE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
        if below is not None:
            starts = starts.where(F.col("_start") < below)
        inside = Window.partitionBy(RANGE).orderBy(*self._sorted()).rowsBetween(Window.unboundedPreceding, -1)
        rows = self.rows.join(F.broadcast(starts), RANGE).withColumn(
            out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_start")
        return self.of(rows if below is None else rows.where(F.col(out) < below))

    def plain(self) -> DataFrame:
        return self.rows.drop(RANGE)
