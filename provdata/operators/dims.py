"""Professional dimension (DIM1): current versions plus derived attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from .history import current_view


PASSTHROUGH = ["entity_number", "status_description", "middle_name", "former_last_name", "gender", "birth_year", "graduation_year", "school_name", "address_line_1", "address_line_2", "country", "phone", "practice_description", "has_nitrous_oxide_permit", "has_anesthesia_level_1", "has_anesthesia_level_2", "has_anesthesia_level_3", "has_anesthesia_level_4", "has_portability", "has_sealant_certification", "has_nitrous_monitoring", "has_local_infiltration_anesthesia", "has_disciplinary_action", "has_remedial_plans"]


def dim_professionals(history: DataFrame, as_of: str) -> DataFrame:
    """DIM1: current version per professional with expiry status, sedation level, segment and priority.

    ``specialty_code IN ('GEN', '', NULL)`` of the source never matches NULL,
    so a dentist without a specialty code is a 'Specialist' (kept as is).
    """
    today = F.lit(as_of).cast("date")
    exp = F.col("license_expiration_date")
    ptype = F.col("professional_type")
    flag = lambda c: F.when(F.col(c), 1).otherwise(0)
    certs = ["has_nitrous_oxide_permit", "has_anesthesia_level_1", "has_anesthesia_level_2",
             "has_anesthesia_level_3", "has_anesthesia_level_4", "has_sealant_certification",
             "has_nitrous_monitoring", "has_local_infiltration_anesthesia"]
    cert_count = flag(certs[0])
    for c in certs[1:]:
        cert_count = cert_count + flag(c)
    return current_view(history).select(
        "professional_id", "state_code", "professional_type", "source_license_id", "license_number",
        "status_code", "status_category", "license_issue_date", "license_expiration_date",
        C.year_diff(today, "license_issue_date").cast("int").alias("years_licensed"),
        F.datediff(exp, today).cast("int").alias("days_until_expiration"),
        F.when(exp < today, "EXPIRED").when(exp < F.date_add(today, 30), "EXPIRING_30_DAYS")
        .when(exp < F.date_add(today, 90), "EXPIRING_90_DAYS").otherwise("VALID").alias("expiration_status"),
        "first_name", "last_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        (F.year(today) - F.col("birth_year").try_cast("int")).cast("int").alias("approximate_age"),
        (F.year(today) - F.col("graduation_year").try_cast("int")).cast("int").alias("years_since_graduation"),
        "city", "address_state", "zip_code", C.zip5("zip_code").alias("zip5"), "county",
        "specialty_code", "specialty_description",
        F.when(F.col("has_anesthesia_level_4"), "LEVEL_4").when(F.col("has_anesthesia_level_3"), "LEVEL_3")
        .when(F.col("has_anesthesia_level_2"), "LEVEL_2").when(F.col("has_anesthesia_level_1"), "LEVEL_1")
        .when(F.col("has_nitrous_oxide_permit"), "NITROUS_ONLY").otherwise("NONE").alias("sedation_level"),
        cert_count.cast("int").alias("certification_count"),
        F.when((ptype == "dentist") & F.col("specialty_code").isin("GEN", ""), "General Dentist")
        .when(ptype == "dentist", "Specialist").when(ptype == "hygienist", "Hygienist")
        .when(ptype == "dental_assistant", "Assistant").otherwise("Other").alias("professional_segment"),
        F.when(F.col("status_category") != "ACTIVE", 0).when(F.col("has_disciplinary_action"), 1)
        .when((ptype == "dentist") & F.col("has_anesthesia_level_4"), 5)
        .when((ptype == "dentist") & F.col("specialty_code").isin("OMS", "PERI", "ORTH"), 4)
        .when(ptype == "dentist", 3).when(ptype == "hygienist", 2).otherwise(1)
        .alias("marketing_priority_score"),
        F.col("valid_from").alias("record_valid_from"),
        # Licence attributes carried through unchanged.
        *PASSTHROUGH)
