"""Shared helpers on DataFrames: materialising and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provdata.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into ``spark.checkpoint.dir``; later jobs read the files.

    The files outlive any executor, and Spark's context cleaner may remove them
    (``spark.cleaner.referenceTracking.cleanCheckpoints``) once nothing refers to them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def reducers(df: DataFrame) -> int:
    """Partitions for an exchange whose tasks hold what they get in memory: as many as ``df`` has, or more if so set.

    The input's partitions follow its size, so what reaches a task does not grow with the input.
    """
    last = df.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0]
    return max(shuffle_partitions(df), (last or 0) + 1)


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], by: str | None = None) -> DataFrame:
    """Add to each row the exclusive running sums ``sums`` in ``order`` (within each ``by``).

    The rows are range-partitioned by ``(by, order)`` and materialised, so that a partition is a
    range; one aggregate sums each range, a window over the ranges (one row per range and ``by``)
    gives each its offset, and a window inside the range does the rest. No task sees more than
    one range, however many rows one value of ``by`` has. Rows that tie in ``order`` must be
    identical in what the sums read, or the order among them is open.
    """
    key = [F.col(by)] if by else []
    ranged = materialize(df.repartitionByRange(shuffle_partitions(df), *key, *order)
                         .withColumn("__range", F.spark_partition_id()))
    per = ranged.groupBy(*([by] if by else []), "__range").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*([F.col(by).alias("__by")] if by else []), F.col("__range").alias("__at"),
                         *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums])
    on = F.col("__range") == F.col("__at")
    if by:
        on = on & F.col(by).eqNullSafe(F.col("__by"))
    inside = Window.partitionBy("__range", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(offsets, on, "left")
            .withColumns({n: F.col(f"__o_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
            .drop("__range", "__at", "__by", *[f"__o_{n}" for n in sums]))
