"""Market segments and dashboard aggregates (AGG1-AGG10, AGG23-24, SEG1).

Each is one ``groupBy().agg()`` with conditional counts, so Spark computes
partial aggregates map-side and shuffles one row per group per partition.
Percent-of-total uses a window over the already-aggregated rows (one row per
group), never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata
from .providers import us_states_only

def _new() -> F.Column:
    return F.col("practice_age_cohort").isin(*refdata.NEW_COHORTS)


def _female() -> F.Column:
    return F.col("gender") == "Female"


def _cnt(cond) -> F.Column:
    return F.count_if(cond).cast("bigint")


def state_insights(providers: DataFrame) -> DataFrame:
    """AGG1: per state totals, female share, cohort counts, innovation score, distinct zips/cities."""
    return us_states_only(providers).groupBy(F.col("practice_state").alias("state")).agg(
        F.count(F.lit(1)).alias("total_dentists"),
        _cnt(_female()).alias("female_dentists"),
        C.percent(F.count_if(_female()), F.count(F.lit(1))).alias("female_pct"),
        _cnt(_new()).alias("new_practices"),
        _cnt(F.col("practice_age_cohort") == "Established (5-10 yrs)").alias("growth_practices"),
        _cnt(F.col("practice_age_cohort") == "Mature (10-20 yrs)").alias("established_practices"),
        C.percent(F.count_if(_new()), F.count(F.lit(1))).alias("innovation_score"),
        F.count_distinct("practice_zip").alias("zip_count"),
        F.count_distinct("practice_city").alias("city_count"),
    )


def city_density(providers: DataFrame) -> DataFrame:
    """AGG2 (+ ``city_state`` the dashboard expects)."""
    return us_states_only(providers).groupBy(
        F.col("practice_city").alias("city"), F.col("practice_state").alias("state")).agg(
        F.count(F.lit(1)).alias("provider_count"),
        _cnt(_female()).alias("female_count"),
        C.percent(F.count_if(_female()), F.count(F.lit(1))).alias("female_pct"),
        _cnt(_new()).alias("new_practice_count"),
        _cnt(F.col("practice_age_cohort") == "Established (5-10 yrs)").alias("mid_practice_count"),
        _cnt(F.col("practice_age_cohort") == "Mature (10-20 yrs)").alias("established_count"),
        C.percent(F.count_if(_new()), F.count(F.lit(1))).alias("innovation_score"),
    ).withColumn("city_state", F.concat_ws(", ", "city", "state"))


def market_type(total: F.Column, new_pct: F.Column) -> F.Column:
    # FIXED VALUES: market thresholds (providers, new-practice %) in evaluation order.
    return (F.when((total >= 50) & (new_pct >= 15), "High Growth")
            .when((total >= 20) & (new_pct >= 10), "Growing")
            .when((total >= 10) & (new_pct >= 5), "Mid-Size")
            .when(total >= 5, "Established")
            .otherwise("Emerging"))


def market_opportunity(providers: DataFrame) -> DataFrame:
    """AGG3: city stats classified by size and rounded new-practice share."""
    stats = us_states_only(providers).groupBy(
        F.col("practice_city").alias("city"), F.col("practice_state").alias("state")).agg(
        F.count(F.lit(1)).alias("total_providers"),
        _cnt(_new()).alias("new_practices"),
        C.percent(F.count_if(_new()), F.count(F.lit(1))).alias("new_practice_pct"),
        C.percent(F.count_if(_female()), F.count(F.lit(1))).alias("female_pct"),
    )
    return stats.select(
        "city", "state", F.concat_ws(", ", "city", "state").alias("market"),
        "total_providers", "new_practices", "new_practice_pct", "female_pct",
        market_type(F.col("total_providers"), F.col("new_practice_pct")).alias("market_type"))


def cohort_rank(c: F.Column) -> F.Column:
    return C.case_map(c, [(label, i + 1) for i, label in enumerate(refdata.COHORT_ORDER)])


def practice_age_distribution(providers: DataFrame) -> DataFrame:
    """AGG4 + WIN7 + TOP2: count and percent of total per cohort, with the display rank."""
    g = us_states_only(providers).groupBy("practice_age_cohort").agg(
        F.count(F.lit(1)).alias("provider_count"))
    total = F.sum("provider_count").over(Window.partitionBy())  # one row per cohort: 5 rows
    return g.select("practice_age_cohort", "provider_count",
                    C.percent(F.col("provider_count"), total).alias("percentage"),
                    cohort_rank(F.col("practice_age_cohort")).alias("cohort_rank"))


def state_share(providers: DataFrame, limit: int = 10) -> DataFrame:
    """AGG5 + WIN7 + TOP1: providers per state, percent of all, top ``limit`` (ties by state)."""
    g = providers.groupBy("practice_state").agg(F.count(F.lit(1)).alias("provider_count"))
    total = g.select(F.sum("provider_count")).scalar()  # one row, whatever the states are
    return (g.select("practice_state", "provider_count",
                     C.percent(F.col("provider_count"), total, 2).alias("pct"))
            .orderBy(F.desc("provider_count"), F.asc_nulls_last("practice_state")).limit(limit))


def specialty_counts(providers_with_taxonomy: DataFrame) -> DataFrame:
    """AGG6: providers by taxonomy specialty name (NULL name = code not in the dimension)."""
    return providers_with_taxonomy.groupBy("specialty_name").agg(
        F.count(F.lit(1)).alias("provider_count"))


def specialty_by_state(providers_with_taxonomy: DataFrame) -> DataFrame:
    """AGG6 (reconstructed): individuals per state and specialty."""
    df = us_states_only(providers_with_taxonomy).filter(F.col("entity_type") == "Individual")
    return df.groupBy(F.col("practice_state").alias("state"),
                      F.coalesce("specialty_name", F.lit("Other")).alias("specialty")).agg(
        F.count(F.lit(1)).alias("provider_count"))


def top_state_specialties(providers_with_taxonomy: DataFrame, k: int = 10) -> DataFrame:
    """JOIN16: specialty-by-state rows for the ``k`` states with most dentists.

    The top-k list is a limited subquery (k rows), so the semi-join side is
    bounded by ``k`` whatever the data size.
    """
    top = (state_insights(providers_with_taxonomy)
           .orderBy(F.desc("total_dentists"), F.asc("state")).limit(k).select("state"))
    return specialty_by_state(providers_with_taxonomy).join(F.broadcast(top), "state", "left_semi")


def _org_aggs():
    return [F.count(F.lit(1)).alias("org_count"), _cnt(_new()).alias("new_orgs"),
            C.percent(F.count_if(_new()), F.count(F.lit(1))).alias("innovation_score")]


def org_by_state(orgs: DataFrame) -> DataFrame:
    """AGG7 on the organisation view."""
    return us_states_only(orgs, "state").groupBy("state").agg(*_org_aggs())


def org_by_city(orgs: DataFrame, min_count: int = 3, limit: int = 200) -> DataFrame:
    """AGG7: cities with at least ``min_count`` organisations, top ``limit``."""
    g = us_states_only(orgs, "state").groupBy("state", "city").agg(*_org_aggs())
    return (g.filter(F.col("org_count") >= min_count)
            .orderBy(F.desc("org_count"), F.asc("state"), F.asc_nulls_last("city")).limit(limit))


def provider_counts(providers: DataFrame) -> DataFrame:
    """AGG11: total / individuals / organisations as metric rows (one scan + ``stack``)."""
    one = providers.agg(
        F.count(F.lit(1)).alias("t"),
        F.count_if(F.col("entity_type") == "Individual").alias("i"),
        F.count_if(F.col("entity_type") == "Organization").alias("o"))
    return one.select(F.expr(
        "stack(3, 'Total Dental Providers', cast(t as bigint), 'Individual Dentists', cast(i as bigint),"
        " 'Organizations', cast(o as bigint)) as (metric, value)"))


def dentists_by_state_gender(individuals: DataFrame) -> DataFrame:
    """AGG10: the column holds Male/Female (the dashboard's 'M'/'F' test always gave 0)."""
    return individuals.filter(F.col("state").isNotNull()).groupBy("state").agg(
        F.count(F.lit(1)).alias("count"),
        _cnt(F.col("gender") == "Male").alias("male"),
        _cnt(F.col("gender") == "Female").alias("female"))


def age_cohorts(individuals: DataFrame) -> DataFrame:
    """AGG10."""
    return individuals.filter(F.col("practice_age_cohort").isNotNull()) \
        .groupBy(F.col("practice_age_cohort").alias("cohort")).agg(F.count(F.lit(1)).alias("count"))


def gender_counts(individuals: DataFrame) -> DataFrame:
    """AGG10."""
    return individuals.filter(F.col("gender").isNotNull()).groupBy("gender") \
        .agg(F.count(F.lit(1)).alias("count"))


# FIXED VALUES: dashboard specialty labels (code, label); anything else 'Other Specialty'.
SPECIALTY_LABELS = [
    ("1223G0001X", "General Dentist"),
    ("1223P0221X", "Pediatric"),
    ("1223S0112X", "Oral Surgery"),
    ("1223E0200X", "Endodontics"),
    ("1223P0300X", "Periodontics"),
    ("1223D0001X", "Orthodontics"),
    ("1223P0700X", "Prosthodontics"),
]


def specialty_labels(individuals: DataFrame) -> DataFrame:
    """AGG10: 8-way CASE key."""
    return individuals.groupBy(
        C.case_map("taxonomy_code", SPECIALTY_LABELS, "Other Specialty").alias("specialty")
    ).agg(F.count(F.lit(1)).alias("count"))


def kpis(individuals: DataFrame, orgs: DataFrame, decision_makers: DataFrame) -> DataFrame:
    """AGG9: the headline counts in one row (each input scanned once)."""
    i = individuals.agg(F.count(F.lit(1)).alias("dentists"),
                        F.count_distinct("city").alias("cities"))
    orgs_n = orgs.select(F.count(F.lit(1))).scalar()
    dm_n = decision_makers.select(F.count(F.lit(1))).scalar()
    return i.select("dentists", orgs_n.alias("orgs"), dm_n.alias("decision_makers"),
                    F.lit(len(refdata.US_STATES)).cast("bigint").alias("states"), "cities")


def cohort_pie(state_ins: DataFrame) -> DataFrame:
    """AGG23: new / growth / established sums over the state insights and the new share."""
    s = state_ins.agg(F.sum("new_practices").cast("bigint").alias("new"),
                      F.sum("growth_practices").cast("bigint").alias("growth"),
                      F.sum("established_practices").cast("bigint").alias("established"))
    return s.select("new", "growth", "established",
                    C.percent(F.col("new"), F.col("new") + F.col("growth") + F.col("established"))
                    .alias("new_pct"))


def market_type_counts(market: DataFrame) -> DataFrame:
    """AGG24."""
    return market.groupBy("market_type").agg(F.count(F.lit(1)).alias("market_count"))


def top_growth_markets(market: DataFrame, k: int = 25) -> DataFrame:
    """AGG24: High Growth / Growing cities, top ``k`` by new-practice share."""
    return (market.filter(F.col("market_type").isin("High Growth", "Growing"))
            .orderBy(F.desc("new_practice_pct"), F.desc("total_providers"), F.asc("state"),
                     F.asc_nulls_last("city")).limit(k))


def innovation_ready_targets(individuals: DataFrame) -> DataFrame:
    """SEG1 (reconstructed): individual dentists in the two newest cohorts."""
    return individuals.filter(F.col("practice_age_cohort").isin(*refdata.NEW_COHORTS))
