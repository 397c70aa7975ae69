"""Mixing sources to target weights.

Each source gets a target number of words; its rows get hash-random keys, are range-sorted within
the source, and the distributed prefix sum of their sizes decides which of them the last, broken
epoch takes. A target above the source's size repeats it: ``floor(target / source size)`` whole
epochs, then the cut. A source that holds most rows spans many ranges (see ``prefix_sums``).

Defined results: a null text has size 0; null is a source of its own, last in order; a table
without words gives targets of 0 and takes nothing; repeated rows count as often as they occur;
the row across the cut is taken if at least half of it lies before the cut, so a source misses
its target by at most half a row. Equal rows are cut one by one. Extra columns are kept by ``repeat_to_mix`` and not read
otherwise, whatever their names; texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provdata.llm.tables import materialize, prefix_sums

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], cap: int) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, size): source, source_size, target.

    Sources in code-point order, null last, take ``weights`` in turn and share all words by them. A
    target stops at ``cap`` times its source's size and the excess is shared again until none is
    above: with the sources sorted by size over weight, the capped ones come first, and the rest
    share what those leave. Ranks and running sums are distributed, so the number of sources may grow.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = prefix_sums(per, [F.col("source").isNull(), F.col("source")], {"place": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialize(ranked.withColumn("weight", weight))
    total, weight_sum = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    ratio = F.col("source_size") / F.col("weight")
    order = [ratio, F.col("source").isNull(), F.col("source")]
    run = prefix_sums(weighed, order, {"capped": F.col("source_size") * cap, "gone": F.col("weight")})
    share = (F.lit(total) - F.col("capped")).cast("double") / (F.lit(weight_sum) - F.col("gone"))
    level = (run.withColumn("share", share).where(F.col("share") * F.col("weight") <= F.col("source_size") * cap)
             .agg(F.min_by("share", F.struct(ratio, F.col("source").isNull(), F.col("source")))).first()[0])
    return weighed.select("source", "source_size", F.least(
        F.lit(level) * F.col("weight"), (F.col("source_size") * cap).cast("double")).alias("target"))


def _sized(seed: str, id_col: str, text_col: str, source_col: str) -> list[Column]:
    """id, source, size and the random key of a row."""
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), digest))
    return [F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"), key.alias("key")]


def _copies(rows: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """``rows`` (id, source, size, key and others) with their source's size and target, and how often the mix takes them."""
    targets = targets.withColumnRenamed("source", "t_source")
    run = prefix_sums(rows, [F.col("key"), F.col("id"), F.col("size")], {"start": F.col("size")}, by="source")
    joined = run.join(targets, F.col("source").eqNullSafe(F.col("t_source")), "left")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    broken = (F.col("start") + F.col("size") / 2 <= rest) & (F.col("source_size") > 0)
    return (joined.withColumn("epochs", epochs.cast("long"))
            .withColumn("copies", F.least(F.col("epochs") + broken.cast("long"), F.lit(cap).cast("long"))))


def mix_sources(df: DataFrame, weights: list[float] = (1, 2, 3), cap: int = 3, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies (times the mix takes it), taken (words).

    The key is the MD5 of seed, id and the text's digest, so reruns and other cluster sizes agree, and rows without an id
    or with a repeated one are drawn one by one like any others.
    """
    sizes = materialize(df.select(*_sized(seed, id_col, text_col, source_col)))
    found = _copies(sizes, source_targets(sizes, list(weights), cap), cap)
    return found.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat_to_mix(df: DataFrame, weights: list[float] = (1, 2, 3), cap: int = 3, seed: str = "mix",
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them (0 to ``cap`` times), with all their columns.

    Each row goes through the range sort with its key, so its count is its own: the cut may fall among equal rows.
    """
    rows = df.select(*_sized(seed, id_col, text_col, source_col), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("size")), list(weights), cap)
    found = _copies(rows, targets, cap).where("copies > 0")
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return found.withColumn("__time", F.explode(times)).select("__row.*")
