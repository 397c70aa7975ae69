"""Skew-safe "previous / next row of the same key" (used by HIS2 and sessionisation).

``Window.partitionBy(key)`` sends every row of a key to one task; with a key
that holds a third of all rows that task sorts a third of the data. Here the
window runs per (key, bucket) — ``bucket`` must never decrease along the
order (e.g. the hour of a timestamp) — and the first row of each bucket gets
its predecessor from a per-bucket table (the last row of each (key, bucket),
shifted one bucket along the key). The per-bucket table has one row per
(key, bucket), so its own window is small. Results equal the plain window.

Without a bucket the rows are cut into ranges of (key, order) and the edges carried over (``carry.Ranges``),
which holds for a key whose rows all lie within one hour too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carry import Ranges


def with_previous(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], bucket: Column | None = None,
                  out: str = "_prev") -> DataFrame:
    """Add ``out`` = struct of ``cols`` of the previous row of the same key (NULL for the first row)."""
    vals = F.struct(*[F.col(c) for c in cols])
    if bucket is None:
        return Ranges(df, [key], order, [c for c in cols if c not in order]).previous(vals, out).plain()
    d = df.withColumn("_b", bucket)
    kb = [key, "_b"]
    last = d.groupBy(*kb).agg(F.max(F.struct(*[F.col(o) for o in order], vals.alias("v"))).alias("_last"))
    prevb = last.select(*kb, F.lag("_last.v").over(Window.partitionBy(key).orderBy("_b")).alias("_pv"))
    w = Window.partitionBy(*kb).orderBy(*order)
    return d.join(prevb, kb, "left").withColumn(out, F.coalesce(F.lag(vals).over(w), F.col("_pv"))) \
        .drop("_pv")


def with_next_start(starts: DataFrame, key: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """For rows that carry ``_b`` (from ``with_previous`` with a bucket): ``out`` = ``value`` of the next row
    of the same key, stitched across buckets the same way."""
    kb = [key, "_b"]
    firsts = starts.groupBy(*kb).agg(F.min(F.struct(*[F.col(o) for o in order])).alias("_f"))
    nextb = firsts.select(*kb, F.lead(F.col(f"_f.{value}")).over(Window.partitionBy(key).orderBy("_b")).alias("_nb"))
    w = Window.partitionBy(*kb).orderBy(*order)
    return starts.join(nextb, kb, "left").withColumn(out, F.coalesce(F.lead(F.col(value)).over(w), F.col("_nb"))) \
        .drop("_nb")


def session_starts(df: DataFrame, key: str, ts: str, gap_seconds: int, bucket: Column | None = None) -> DataFrame:
    """Rows that open a session: first row of the key, or at least ``gap_seconds`` after the previous row."""
    p = with_previous(df, key, [ts], [ts], bucket, out="_p")
    gap = F.timestamp_diff("SECOND", F.col(f"_p.{ts}"), F.col(ts))
    return p.filter(F.col("_p").isNull() | (gap >= gap_seconds)).drop("_p", "_b")
