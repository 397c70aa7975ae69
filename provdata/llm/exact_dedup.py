"""Exact de-duplication: tree-merge of sorted digest runs.

Every input partition is one run of ``(digest, check, bytes) -> best row, rows``. In each round
the runs of ``fan_in`` neighbouring partitions are exchanged and merged into one run of their
parent, so after ``log(partitions, fan_in)`` rounds one run is left. A run is never one task:
the exchange hashes ``(parent run, digest)``, so each parent is cut into digest slices. The
best row is the maximum of a struct, which Spark computes by sort aggregation: it sorts the
partial runs map-side, and merges the sorted rows after each exchange. A group that holds a
third of the table is one row per run from the first exchange on.

Entries merge only if SHA-256, the 64-bit check hash and the byte length all agree, at every
level; texts of one digest that differed in the others would stay apart.

Defined results: a null text counts as empty; of equal texts the row with the largest id stays
(``keep="smallest"`` for the smallest), a null id only if the group has no other; of rows
repeated with the same id and text exactly one stays; an empty table gives an empty result.
Extra columns, whatever their names, do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provdata.llm.tables import materialize

_KEYS = ["digest", "check", "n_bytes"]


def _digest_columns(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    return {"digest": F.unhex(F.sha2(whole, 256)), "check": F.xxhash64(whole),
            "n_bytes": F.octet_length(whole).cast("long")}


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One small row per input row: id, digest columns, input partition (``run``) and a row number."""
    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    return slim.select("id", *[c.alias(n) for n, c in _digest_columns(F.col("body")).items()],
                       F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"))


def merge_runs(rows: DataFrame, keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """Merge the runs of ``rows`` (see ``digest_rows``) into one: digest columns, keep_id, keep_row, group_size.

    ``rows`` must be materialised: its runs and row numbers are read in more than one job.
    """
    if keep == "largest":
        best, pick = F.struct(F.col("id").isNotNull().alias("known"), "id", (-F.col("row")).alias("row")), F.max
    elif keep == "smallest":
        best, pick = F.struct(F.col("id").isNull().alias("known"), "id", "row"), F.min
    else:
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    level = rows.select("run", *_KEYS, best.alias("best"), F.lit(1).cast("long").alias("n"))
    while True:
        runs = -(-runs // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *_KEYS).agg(pick("best").alias("best"), F.sum("n").alias("n")))
        if runs == 1:
            return level.select(*_KEYS, F.col("best.id").alias("keep_id"), F.abs("best.row").alias("keep_row"),
                                F.col("n").alias("group_size"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                     fan_in: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Only groups of two or more are joined back. A large group makes one large key on the row side
    of that left join, which adaptive execution splits.
    """
    rows = materialize(digest_rows(df, id_col, text_col))
    groups = merge_runs(rows, keep, fan_in).where("group_size > 1")
    return (rows.join(groups, _KEYS, "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                          fan_in: int = 16) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Kept rows are found by id and digest, so only they need their texts moved. Rows repeated with
    the same id and text are all found by that; where there are such, one of each is taken.
    """
    rows = materialize(digest_rows(df, id_col, text_col))
    groups = materialize(merge_runs(rows, keep, fan_in).select(F.col("keep_id").alias("__k_id"), *[
        F.col(c).alias(f"__k_{c}") for c in _KEYS], F.col("group_size").alias("__k_size")))
    found = {f"__k_{n}": c for n, c in _digest_columns(F.col(text_col)).items()}
    on = F.col(id_col).eqNullSafe(F.col("__k_id"))
    for name, c in found.items():
        on = on & (c == F.col(name))
    stay = df.alias("d").join(groups.alias("g"), on, "left_semi")
    # A kept row is repeated only if its group has several rows; ids of such groups, counted per id.
    again = (rows.join(groups.where("__k_size > 1"), [F.col("id").eqNullSafe(F.col("__k_id"))] + [
        F.col(c) == F.col(f"__k_{c}") for c in _KEYS], "left_semi")
        .groupBy("id", *_KEYS).count().where("count > 1"))
    if again.isEmpty():
        return stay
    plain = list(df.columns)
    marked = stay.withColumns({f"__{n}": c for n, c in _digest_columns(F.col(text_col)).items()})
    return marked.dropDuplicates([id_col, *[f"__{n}" for n in _KEYS]]).select(*plain)
