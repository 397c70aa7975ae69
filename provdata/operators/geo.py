"""Geography lookups: ZIP -> county crosswalk, state names (JOIN15, JOIN19, AGG8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata


def zip_county_crosswalk(addresses: DataFrame, zip_col: str = "zip_code", county_col: str = "county",
                         state_col: str | None = None) -> DataFrame:
    """JOIN15 (reconstructed): one county per ZIP5 — the county with the highest share of addresses
    (ties: county name). Built with aggregates only; one row per ZIP."""
    a = addresses.select(C.zip5(zip_col).alias("zip5"), F.upper(F.trim(county_col)).alias("county"))
    a = a.filter(F.col("zip5").isNotNull() & F.col("county").isNotNull() & (F.col("county") != ""))
    g = a.groupBy("zip5", "county").agg(F.count(F.lit(1)).alias("n"))
    best = g.groupBy("zip5").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("county"))).alias("m"),
                                 F.sum("n").alias("total"))
    return best.select("zip5", F.col("m.county").alias("county"),
                       (-F.col("m.neg") / F.col("total")).alias("ratio"))


def with_county(df: DataFrame, crosswalk: DataFrame, zip_col: str = "practice_zip") -> DataFrame:
    """JOIN15: attach the county of the ZIP (left join; one crosswalk row per ZIP5).

    A national crosswalk has ~40k ZIPs, so AQE broadcasts it; nothing here
    forces a broadcast in case a larger key space is used.
    """
    return df.join(crosswalk.select(F.col("zip5").alias("_z"), "county"), C.zip5(zip_col) == F.col("_z"), "left") \
        .drop("_z")


def county_density(providers_with_county: DataFrame, limit: int = 500) -> DataFrame:
    """AGG8 (reconstructed): per state and county: providers, new practices, innovation score; top ``limit``."""
    new = F.col("practice_age_cohort").isin(*refdata.NEW_COHORTS)
    g = providers_with_county.filter(F.col("county").isNotNull()).groupBy(
        F.col("practice_state").alias("state"), "county").agg(
        F.count(F.lit(1)).alias("provider_count"), F.count_if(new).cast("bigint").alias("new_practice_count"),
        C.percent(F.count_if(new), F.count(F.lit(1))).alias("innovation_score"))
    return g.select("state", "county", F.concat_ws(", ", "county", "state").alias("state_county"),
                    "provider_count", "new_practice_count", "innovation_score") \
        .orderBy(F.desc("provider_count"), "state", "county").limit(limit)


def state_dim(spark) -> DataFrame:
    return spark.createDataFrame(refdata.STATE_NAMES, "state_name string, state_code string")


def normalize_state(df: DataFrame, dim: DataFrame, col: str) -> DataFrame:
    """JOIN19: accept a state given as a name or as a code; add ``state_code`` and ``state_name``.

    Spark broadcasts ``dim`` if its size allows.
    """
    # One dimension row per accepted spelling (name and code), so the lookup is one equi-join.
    keys = dim.select(F.explode(F.array(F.upper("state_name"), F.upper("state_code"))).alias("_k"),
                      F.col("state_code").alias("_c"), F.col("state_name").alias("_sn"))
    j = df.join(keys, F.upper(F.trim(col)) == F.col("_k"), "left")
    return j.select(*df.columns, F.col("_c").alias("state_code"), F.col("_sn").alias("state_name"))
