"""Provider table build and its views.

``clean_providers`` is the RAW -> CLEAN transform of the registry file:
filter (dental taxonomy prefix, active, US), one ``select`` of cleaning
expressions, then the latest row per NPI. The filter columns are raw input
columns, so Catalyst pushes them into the parquet scan (``StringStartsWith``,
``EqualTo``) and prunes every column the projection does not use.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata

# Canonical raw registry columns this transform understands. Columns absent
# from the input become typed NULLs, so a narrow extract and the full file
# run through the same code.
RAW_COLUMNS = [
    "npi", "entity_type_code", "first_name", "middle_name", "last_name", "name_prefix",
    "name_suffix", "credential", "organization_name", "dba_name", "practice_address_1",
    "practice_address_2", "practice_city", "practice_state", "practice_zip",
    "practice_country", "practice_phone", "practice_fax", "mailing_address_1",
    "mailing_address_2", "mailing_city", "mailing_state", "mailing_zip", "taxonomy_code",
    "taxonomy_code_2", "taxonomy_code_3", "sex_code", "auth_official_first_name",
    "auth_official_last_name", "auth_official_phone", "auth_official_credential",
    "enumeration_date", "last_update_date", "deactivation_date", "license_number",
    "license_state", "is_sole_proprietor",
]


def _with_raw_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def active_us(df: DataFrame) -> DataFrame:
    """FLT1: not deactivated (NULL or blank) and practice country US."""
    return df.filter(C.is_blank("deactivation_date") & (F.col("practice_country") == "US"))


def taxonomy_prefix(df: DataFrame, prefixes: Iterable[str], column: str = "taxonomy_code") -> DataFrame:
    """FLT2: primary taxonomy starts with any of ``prefixes``."""
    return df.filter(C.prefix_any(column, prefixes))


def us_states_only(df: DataFrame, column: str = "practice_state") -> DataFrame:
    """FLT4: 50 states + DC (territories excluded)."""
    return df.filter(F.col(column).isin(*refdata.US_STATES))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WIN1: the row with the largest ``order`` tuple per key (NULLs lose).

    Expressed as one ``max(struct(order..., row))`` aggregate instead of a
    ``row_number`` window: the aggregate combines map-side, so a key that
    holds a third of all rows collapses to one row per input partition
    before the shuffle, and the whole row as the last struct field makes the
    choice total (identical rows are interchangeable).
    """
    payload = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                          F.struct(*payload).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*")


def clean_providers(npi_raw: DataFrame, as_of: str, prefixes: Iterable[str] = refdata.DENTAL_PREFIXES,
                    null_cohort: str = refdata.COHORT_ELSE) -> DataFrame:
    """RAW registry rows -> one clean row per NPI (PRJ1-12, FLT1-2, WIN1)."""
    raw = _with_raw_columns(npi_raw)
    base = active_us(taxonomy_prefix(raw, prefixes))
    b = C.blank_to_null
    cleaned = base.select(
        F.col("npi").cast("string").alias("npi"),
        F.col("entity_type_code").cast("string").alias("entity_type_code"),
        C.decode_entity_type("entity_type_code").alias("entity_type"),
        b("first_name").alias("first_name"),
        b("middle_name").alias("middle_name"),
        b("last_name").alias("last_name"),
        b("name_prefix").alias("name_prefix"),
        b("name_suffix").alias("name_suffix"),
        b("credential").alias("credential"),
        b("organization_name").alias("organization_name"),
        b("dba_name").alias("dba_name"),
        b("practice_address_1").alias("practice_address_1"),
        b("practice_address_2").alias("practice_address_2"),
        b("practice_city").alias("practice_city"),
        b("practice_state").alias("practice_state"),
        b("practice_zip").alias("practice_zip_full"),
        b("practice_country").alias("practice_country"),
        b("practice_phone").alias("practice_phone_raw"),
        b("practice_fax").alias("practice_fax_raw"),
        b("mailing_address_1").alias("mailing_address_1"),
        b("mailing_address_2").alias("mailing_address_2"),
        b("mailing_city").alias("mailing_city"),
        b("mailing_state").alias("mailing_state"),
        b("mailing_zip").alias("mailing_zip_full"),
        b("taxonomy_code").alias("primary_taxonomy_code"),
        b("taxonomy_code_2").alias("secondary_taxonomy_code"),
        b("taxonomy_code_3").alias("tertiary_taxonomy_code"),
        b("sex_code").alias("gender_code"),
        b("auth_official_first_name").alias("auth_official_first_name"),
        b("auth_official_last_name").alias("auth_official_last_name"),
        b("auth_official_phone").alias("auth_official_phone"),
        b("auth_official_credential").alias("auth_official_credential"),
        C.safe_date("enumeration_date").alias("enumeration_date"),
        C.safe_date("last_update_date").alias("npi_last_update_date"),
        F.col("last_update_date").alias("_last_update_raw"),
        b("license_number").alias("license_number"),
        b("license_state").alias("license_state"),
        b("is_sole_proprietor").alias("is_sole_proprietor"),
    )
    latest = latest_per_key(cleaned, ["npi"], [F.col("npi_last_update_date"), F.col("_last_update_raw")])
    return latest.select(
        "npi", "entity_type_code", "entity_type", "first_name", "middle_name", "last_name",
        "name_prefix", "name_suffix", "credential",
        C.display_name("entity_type_code", "name_prefix", "first_name", "last_name", "credential",
                       "organization_name", "dba_name").alias("display_name"),
        C.full_name("name_prefix", "first_name", "middle_name", "last_name", "name_suffix").alias("provider_full_name"),
        "organization_name", "dba_name", "practice_address_1", "practice_address_2",
        C.address_full("practice_address_1", "practice_address_2").alias("practice_address_full"),
        "practice_city", "practice_state",
        C.zip5("practice_zip_full").alias("practice_zip"), "practice_zip_full", "practice_country",
        "practice_phone_raw", C.digits_only("practice_phone_raw").alias("practice_phone_clean"),
        "practice_fax_raw", "mailing_address_1", "mailing_address_2", "mailing_city", "mailing_state",
        C.zip5("mailing_zip_full").alias("mailing_zip"),
        "primary_taxonomy_code", "secondary_taxonomy_code", "tertiary_taxonomy_code",
        "gender_code", C.decode_gender("gender_code").alias("gender"),
        "auth_official_first_name", "auth_official_last_name",
        C.auth_official_name("auth_official_first_name", "auth_official_last_name").alias("auth_official_full_name"),
        "auth_official_phone", "auth_official_credential",
        "enumeration_date", "npi_last_update_date",
        C.practice_age_cohort("enumeration_date", as_of, null_cohort).alias("practice_age_cohort"),
        "license_number", "license_state", "is_sole_proprietor",
        C.yes_flag("is_sole_proprietor").alias("is_sole_proprietor_flag"),
        # PRJ12: validation and enrichment placeholders filled by later stages.
        F.lit(None).cast("boolean").alias("address_validated"),
        F.lit(None).cast("double").alias("address_confidence"),
        F.lit(None).cast("boolean").alias("phone_validated"),
        F.lit(None).cast("string").alias("phone_line_type"),
        F.lit(None).cast("string").alias("enriched_email"),
        F.lit(None).cast("string").alias("enriched_linkedin_url"),
        F.lit(None).cast("string").alias("enrichment_source"),
        F.lit(None).cast("timestamp_ntz").alias("enriched_at"),
    )


def taxonomy_dim(spark) -> DataFrame:
    return spark.createDataFrame(refdata.DENTAL_TAXONOMY, "taxonomy_code string, specialty_name string")


def with_taxonomy(providers: DataFrame, dim: DataFrame, code_col: str = "primary_taxonomy_code") -> DataFrame:
    """JOIN1: many-to-one lookup. Spark broadcasts ``dim`` if its size allows."""
    return providers.join(dim, providers[code_col] == dim["taxonomy_code"], "left") \
        .drop(dim["taxonomy_code"])


def v_individual_dentists(providers: DataFrame, us_only: bool = True) -> DataFrame:
    """VIEW1."""
    df = providers.filter(F.col("entity_type") == "Individual")
    if us_only:
        df = us_states_only(df)
    return df.select(
        F.col("npi"), "display_name", "first_name", "last_name", "credential",
        F.col("practice_city").alias("city"), F.col("practice_state").alias("state"),
        F.col("practice_zip").alias("zip"), F.col("practice_phone_clean").alias("phone"),
        F.col("primary_taxonomy_code").alias("taxonomy_code"), "gender", "practice_age_cohort",
        "enumeration_date", F.lit("Individual").alias("record_type"))


def v_organizations(providers: DataFrame, us_only: bool = True) -> DataFrame:
    """VIEW1."""
    df = providers.filter(F.col("entity_type") == "Organization")
    if us_only:
        df = us_states_only(df)
    return df.select(
        F.col("npi"), "organization_name", "dba_name",
        F.col("practice_address_full").alias("address"), F.col("practice_city").alias("city"),
        F.col("practice_state").alias("state"), F.col("practice_zip").alias("zip"),
        F.col("practice_phone_clean").alias("phone"),
        F.col("primary_taxonomy_code").alias("taxonomy_code"), "auth_official_full_name",
        "auth_official_credential", "auth_official_phone", "practice_age_cohort",
        F.lit("Organization").alias("record_type"))


def mental_health_taxonomy_dim(spark) -> DataFrame:
    return spark.createDataFrame(refdata.MENTAL_HEALTH_TAXONOMY,
                                 "taxonomy_code string, provider_category string, specialty_name string, "
                                 "is_facility boolean")


def mental_health_providers(npi_raw: DataFrame, dim: DataFrame, as_of: str) -> DataFrame:
    """Mental-health variant of the provider build (FLT2 with nine prefixes, JOIN1 with the
    30-row category dimension: provider_category, specialty_name, is_facility)."""
    base = clean_providers(npi_raw, as_of, prefixes=refdata.MENTAL_HEALTH_PREFIXES)
    return with_taxonomy(base, dim)
