"""Commonest and lowest values of a column without grouping all of it (VAL4, VAL7).

A near-unique column makes a plain group-by shuffle every value only to keep a few. Here each pass shuffles a
summary of fixed size; a full count is made only of what the summary could not rule out, so results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets that values are counted in: the rows a task sends on are at most as many.
BUCKETS = 1 << 14
#: Values the heavy-hitter summary of a task tracks.
TRACKED = 2048


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("value"), F.lit(buckets))


def top_values(df: DataFrame, value: Column, k: int, tracked: int = TRACKED, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` commonest non-null values as (value, rows), ties by lowest value.

    A mergeable frequent-items summary names candidates, a second pass counts them exactly and everything else by
    hash bucket. No value outnumbers its bucket, so only buckets that reach the k-th candidate's count are
    grouped by value.
    """
    values = df.select(value.cast("string").alias("value")).where("value is not null")
    found = values.agg(F.expr(f"approx_top_k(value, {min(tracked, 4 * k)}, {tracked})").alias("found"))
    candidates = found.select(F.explode("found.item").alias("value")).withColumn("_known", F.lit(True))
    marked = values.join(F.broadcast(candidates), "value", "left")  # at most 4 k rows
    bucket = F.when(F.col("_known").isNull(), _bucket(buckets))
    counts = (marked.groupBy(F.when(F.col("_known"), F.col("value")).alias("value"), bucket.alias("_bucket"))
              .agg(F.count(F.lit(1)).alias("rows")))
    known = counts.where("_bucket is null").select("value", "rows")
    first = known.orderBy(F.desc("rows")).limit(k).agg(F.when(F.count(F.lit(1)) == k, F.min("rows")).otherwise(0).alias("least"))
    open_ = counts.where((F.col("_bucket").isNotNull()) & (F.col("rows") >= first.select("least").scalar())).select("_bucket")
    rest = (marked.where("_known is null").withColumn("_bucket", _bucket(buckets))
            .join(F.broadcast(open_), "_bucket", "left_semi")  # at most ``buckets`` rows
            .groupBy("value").agg(F.count(F.lit(1)).alias("rows")))
    return known.unionByName(rest).orderBy(F.desc("rows"), "value").limit(k)


def lowest_values(df: DataFrame, value: Column, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` lowest distinct non-null values as (value, rows).

    The least values of ``k`` buckets are distinct, so the k-th of them is no lower than the k-th value; only
    values up to it are counted.
    """
    values = df.select(value.cast("string").alias("value")).where("value is not null")
    least = values.groupBy(_bucket(buckets).alias("_bucket")).agg(F.min("value").alias("value"))
    last = least.orderBy("value").limit(k).agg(F.when(F.count(F.lit(1)) == k, F.max("value")).alias("last"))
    bound = last.select("last").scalar()
    return (values.where(bound.isNull() | (F.col("value") <= bound))
            .groupBy("value").agg(F.count(F.lit(1)).alias("rows")).orderBy("value").limit(k))
