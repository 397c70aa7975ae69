"""Licence staging (STG1-STG9) and unions (SET1-SET2).

Raw licence files arrive all-string (or with loosely typed codes); staging is
one ``select`` per source that trims, casts with ``try_*`` (ANSI mode never
raises on bad input), decodes status and specialty, and derives permit flags.
Per-type differences are expressed as ``CASE professional_type`` inside the
same projection, so a combined file of several types is staged in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata

# Raw Texas columns across the five file kinds; absent ones become NULL.
TX_RAW_COLUMNS = [
    "lic_id", "lic_nbr", "lic_sta_cde", "lic_sta_desc", "lic_orig_dte", "lic_expr_dte",
    "first_nme", "middle_nme", "last_nme", "last_mne", "former_last_nme", "gender", "address1",
    "address2", "city", "state", "zip", "county", "country", "phone", "nox_permit_dte",
    "level_1_dte", "level_2_dte", "level_3_dte", "level_4_dte", "portability", "disc_action",
    "prac_desc", "prac_types", "grad_yr", "school", "birth_year", "shrp_mod", "spp_mod",
    "erx_waiver", "level_exempt", "entity_nbr", "remedial_plns", "sealant", "nom_mod", "lia_mod",
    "lab_nme", "lab_type", "lab_owner", "lab_manager", "lab_cdt", "rank_efct_dte",
]

STAGED_COLUMNS = [
    "professional_id", "state_code", "professional_type", "source_license_id", "license_number",
    "entity_number", "status_code", "status_description", "status_category", "license_issue_date",
    "license_expiration_date", "first_name", "middle_name", "last_name", "former_last_name", "gender",
    "birth_year", "graduation_year", "school_name", "address_line_1", "address_line_2", "city",
    "address_state", "zip_code", "county", "country", "phone", "practice_description",
    "specialty_code", "specialty_description", "nitrous_oxide_permit_date",
    "has_nitrous_oxide_permit", "has_anesthesia_level_1", "has_anesthesia_level_2",
    "has_anesthesia_level_3", "has_anesthesia_level_4", "has_portability",
    "has_sealant_certification", "has_nitrous_monitoring", "has_local_infiltration_anesthesia",
    "has_disciplinary_action", "has_remedial_plans",
    "anesthesia_level_1_date", "anesthesia_level_2_date", "anesthesia_level_3_date", "anesthesia_level_4_date",
    "has_shrp_modifier", "has_spp_modifier", "has_erx_waiver", "is_level_exempt",
    "business_name", "owner_name", "manager_name", "certified_dental_technician", "lab_type",
]


def _with_columns(df: DataFrame, names) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing]) if missing else df


def permit_flag(c) -> F.Column:
    """``x NOT IN ('No Permit', '')``: NULL stays NULL (three-valued, as the source)."""
    return ~C.col_(c).isin("No Permit", "")


def permit_date(c) -> F.Column:
    return F.when(permit_flag(c), C.safe_date(c))


def not_no(c) -> F.Column:
    """Anything but 'NO' (NULL stays NULL)."""
    return F.upper(F.trim(C.col_(c))) != "NO"


def yes(c) -> F.Column:
    return F.upper(F.trim(C.col_(c))) == "YES"


def stage_tx(raw: DataFrame, professional_type: str | None = None, coalesce_flags: bool = False) -> DataFrame:
    """STG1-STG4: stage a Texas licence extract.

    ``professional_type`` names the file kind; when None the input carries a
    ``professional_type`` column (a combined extract) and each row is staged
    by its own type. Flags that do not apply to a type are ``false`` and
    text that does not apply is NULL, as the unified schema wants
    (SET1), so the result of several kinds is already union-compatible.
    Permit flags keep the source's three-valued result (a missing permit
    date gives NULL, not false) unless ``coalesce_flags`` is set.
    """
    df = _with_columns(raw, TX_RAW_COLUMNS)
    ptype = F.lit(professional_type) if professional_type else F.col("professional_type")
    is_dentist = ptype == "dentist"
    is_hyg = ptype == "hygienist"
    is_asst = ptype == "dental_assistant"
    is_person = ptype != "dental_lab"
    spec = F.trim("prac_types")
    false = F.lit(False)
    extra = [c for c in ("snapshot_date",) if c in raw.columns]
    staged = df.select(
        F.lit("TX").alias("state_code"),
        ptype.alias("professional_type"),
        F.col("lic_id").try_cast("int").alias("source_license_id"),
        F.trim(F.col("lic_nbr").cast("string")).alias("license_number"),
        F.col("entity_nbr").try_cast("int").alias("entity_number"),
        F.col("lic_sta_cde").try_cast("int").alias("status_code"),
        F.trim("lic_sta_desc").alias("status_description"),
        C.status_category(F.col("lic_sta_cde").try_cast("int"), ptype).alias("status_category"),
        C.safe_date("lic_orig_dte").alias("license_issue_date"),
        C.safe_date("lic_expr_dte").alias("license_expiration_date"),
        F.when(is_person, F.trim("first_nme")).alias("first_name"),
        F.when(is_person, F.trim("middle_nme")).alias("middle_name"),
        # Hygienist files spell the column LAST_MNE; resolve from whichever exists.
        F.when(is_person, F.trim(F.coalesce("last_nme", "last_mne"))).alias("last_name"),
        F.when(is_dentist | is_hyg, F.trim("former_last_nme")).alias("former_last_name"),
        F.trim("gender").alias("gender"),
        C.blank_to_null("birth_year").alias("birth_year"),
        F.when(is_dentist | is_hyg, C.blank_to_null("grad_yr")).alias("graduation_year"),
        F.when(is_dentist | is_hyg, F.trim("school")).alias("school_name"),
        F.trim("address1").alias("address_line_1"),
        F.trim("address2").alias("address_line_2"),
        F.trim("city").alias("city"),
        F.trim("state").alias("address_state"),
        F.trim("zip").alias("zip_code"),
        F.trim("county").alias("county"),
        F.trim("country").alias("country"),
        F.trim("phone").alias("phone"),
        F.when(is_dentist, F.trim("prac_desc")).alias("practice_description"),
        F.when(is_dentist, spec).alias("specialty_code"),
        F.when(is_dentist, C.case_map(spec, refdata.SPECIALTIES)).alias("specialty_description"),
        F.when(is_dentist, permit_date("nox_permit_dte")).alias("nitrous_oxide_permit_date"),
        F.when(is_dentist, permit_flag("nox_permit_dte")).otherwise(false).alias("has_nitrous_oxide_permit"),
        *[F.when(is_dentist, permit_flag(f"level_{k}_dte")).otherwise(false).alias(f"has_anesthesia_level_{k}")
          for k in (1, 2, 3, 4)],
        F.when(is_dentist, yes("portability")).otherwise(false).alias("has_portability"),
        F.when(is_hyg, yes("sealant")).otherwise(false).alias("has_sealant_certification"),
        F.when(is_hyg | is_asst, yes("nom_mod")).otherwise(false).alias("has_nitrous_monitoring"),
        F.when(is_hyg, yes("lia_mod")).otherwise(false).alias("has_local_infiltration_anesthesia"),
        yes("disc_action").alias("has_disciplinary_action"),
        yes("remedial_plns").alias("has_remedial_plans"),
        *[F.when(is_dentist, permit_date(f"level_{k}_dte")).alias(f"anesthesia_level_{k}_date") for k in (1, 2, 3, 4)],
        F.when(is_dentist, not_no("shrp_mod")).otherwise(false).alias("has_shrp_modifier"),
        F.when(is_dentist, not_no("spp_mod")).otherwise(false).alias("has_spp_modifier"),
        F.when(is_dentist, yes("erx_waiver")).otherwise(false).alias("has_erx_waiver"),
        F.when(is_dentist, yes("level_exempt")).otherwise(false).alias("is_level_exempt"),
        # Labs have a business, not a person.
        *[F.when(~is_person, F.trim(c)).alias(n) for c, n in (
            ("lab_nme", "business_name"), ("lab_owner", "owner_name"), ("lab_manager", "manager_name"),
            ("lab_cdt", "certified_dental_technician"), ("lab_type", "lab_type"))],
        *extra,
    )
    flag_cols = [c for c in STAGED_COLUMNS if c.startswith(("has_", "is_"))]
    return staged.select(
        C.surrogate_key("state_code", "professional_type", "license_number").alias("professional_id"),
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) if (coalesce_flags and c in flag_cols) else F.col(c)
          for c in STAGED_COLUMNS if c != "professional_id"], *extra)


def stage_tx_etn(raw: DataFrame) -> DataFrame:
    """STG5: ETN extract (declared source without a model): rank date and status."""
    df = _with_columns(raw, TX_RAW_COLUMNS)
    return df.select(
        F.trim(F.col("lic_nbr").cast("string")).alias("license_number"),
        F.col("lic_sta_cde").try_cast("int").alias("status_code"),
        F.trim("lic_sta_desc").alias("status_description"),
        C.safe_date("rank_efct_dte").alias("rank_effective_date"),
        yes("erx_waiver").alias("has_erx_waiver"))


def union_professionals(*staged: DataFrame) -> DataFrame:
    """SET1: stack staged kinds by name; a flag that a kind lacks is false, other missing columns are NULL."""
    names = list(dict.fromkeys(c for df in staged for c in df.columns))
    types = {f.name: f.dataType for df in staged for f in df.schema.fields}

    def whole(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns
                           else F.lit(False if c.startswith(("has_", "is_")) else None).cast(types[c]).alias(c) for c in names])

    out = whole(staged[0])
    for df in staged[1:]:
        out = out.unionByName(whole(df))
    return out


def active_licenses(df: DataFrame, codes=tuple(refdata.MATCH_ACTIVE_CODES)) -> DataFrame:
    """FLT5."""
    return df.filter(F.col("status_code").isin(*codes))


# FIXED VALUES: status codes the recent-licence finder treats as active, per type.
RECENT_ACTIVE_CODES = {"dentist": [20, 46, 70], "hygienist": [20, 46, 70], "dental_assistant": [20, 46]}


def recent_licenses(staged: DataFrame, days: int, as_of: str, types=None, counties=None) -> DataFrame:
    """FLT6: issued on/after ``as_of - days`` (future dates pass), status active for the file kind
    (per-type code lists; kinds without a list are not searched), optional type list and
    case-insensitive county list (a missing county never matches)."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days)
    active = None
    for ptype, codes in RECENT_ACTIVE_CODES.items():
        c = (F.col("professional_type") == ptype) & F.col("status_code").isin(*codes)
        active = c if active is None else active | c
    out = staged.filter((F.col("license_issue_date") >= cutoff) & active)
    if types:
        out = out.filter(F.col("professional_type").isin(*types))
    if counties:
        out = out.filter(F.upper("county").isin(*[c.upper() for c in counties]))
    return out


# --- Other states (STG6-STG9): JSON record transforms ---------------------
# Missing text fields become '' (the source writes empty strings, not NULLs).

# FIXED VALUES: Washington credential type -> professional type (others -> 'other').
WA_TYPES = [
    ("Dentist License", "dentist"),
    ("Dentist Resident Postdoctoral License", "dentist"),
    ("Dentist Resident Community License", "dentist"),
    ("Dentist Faculty License", "dentist"),
    ("Dentist Temporary Practice Permit", "dentist"),
    ("Dental Hygiene License", "hygienist"),
    ("Dental Hygiene Temporary Practice Permit", "hygienist"),
    ("Dental Hygiene Initial Temporary License", "hygienist"),
    ("Dental Hygiene Renewable Temporary License", "hygienist"),
    ("Dental Hygiene Initial Limited Temporary Practice Permit", "hygienist"),
    ("Dental Assistant Registration", "dental_assistant"),
    ("Dental Assistant Endorsement", "dental_assistant"),
    ("Dental Anesthesia Assistant Certification", "dental_assistant"),
    ("Expanded Function Dental Auxiliary", "dental_assistant"),
    ("Denturist License", "denturist"),
    ("Denturist Temporary Practice Permit", "denturist"),
    ("Denturist Alternate Location", "denturist"),
]

# FIXED VALUES: Colorado licence type code -> (professional type, description).
CO_TYPES = [
    ("DEN", "dentist", "Dentist"),
    ("T-DEN", "dentist", "Temporary Dentist"),
    ("MSDEN", "dentist", "Military Spouse Dentist"),
    ("DH", "hygienist", "Dental Hygienist"),
    ("T-DH", "hygienist", "Temporary Dental Hygienist"),
]

# FIXED VALUES: Florida profession code -> (name, professional type, board).
FL_PROFESSIONS = [
    ("DEN", "Dentist", "dentist", "Board of Dentistry"),
    ("DH", "Dental Hygienist", "hygienist", "Board of Dentistry"),
    ("DN", "Dental Laboratory", "dental_lab", "Board of Dentistry"),
]

# FIXED VALUES: Florida status text -> category (others -> 'UNKNOWN').
FL_STATUS = [
    ("Clear/Active", "ACTIVE"),
    ("Active", "ACTIVE"),
    ("Expired", "EXPIRED"),
    ("Null and Void", "VOID"),
    ("Revoked", "REVOKED"),
    ("Suspended", "SUSPENDED"),
    ("Voluntary Inactive", "INACTIVE"),
    ("Inactive", "INACTIVE"),
    ("Retired", "RETIRED"),
]


def _txt(df: DataFrame, c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")


def stage_wa(raw: DataFrame, active_only: bool = False) -> DataFrame:
    """STG6 + STG9: credential type map, YYYYMMDD -> ISO only when exactly 8 characters, action flag;
    ``active_only`` filters before anything is written."""
    def iso(c):
        s = _txt(raw, c)
        return F.when(F.length(s) == 8, F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2),
                                                    F.lit("-"), F.substring(s, 7, 2))).otherwise(F.lit(""))
    ctype = _txt(raw, "credentialtype")
    df = raw.select(
        F.lit("WA").alias("state_code"),
        C.case_map(ctype, WA_TYPES, "other").alias("professional_type"),
        ctype.alias("credential_type"),
        _txt(raw, "credentialnumber").alias("license_number"),
        _txt(raw, "status").alias("status"),
        _txt(raw, "firstname").alias("first_name"), _txt(raw, "middlename").alias("middle_name"),
        _txt(raw, "lastname").alias("last_name"), _txt(raw, "birthyear").alias("birth_year"),
        iso("firstissuedate").alias("first_issue_date"), iso("lastissuedate").alias("last_issue_date"),
        iso("expirationdate").alias("expiration_date"), iso("ceduedate").alias("ce_due_date"),
        ((F.coalesce(F.col("actiontaken"), F.lit("No")) if "actiontaken" in raw.columns else F.lit("No"))
         == "Yes").alias("has_enforcement_action"))
    return df.filter(F.upper("status") == "ACTIVE") if active_only else df


def stage_co(raw: DataFrame, active_only: bool = False) -> DataFrame:
    """STG7 + STG9: type code map, ISO timestamp prefix -> date text, nested URL or '' (``active_only``)."""
    code = _txt(raw, "licensetype")

    def url(c):
        return F.coalesce(F.col(f"{c}.url"), F.lit("")) if c in raw.columns else F.lit("")
    df = raw.select(
        F.lit("CO").alias("state_code"),
        C.case_map(code, [(k, t) for k, t, _ in CO_TYPES], "other").alias("professional_type"),
        code.alias("license_type_code"),
        F.coalesce(C.case_map(code, [(k, d) for k, _, d in CO_TYPES]), code).alias("license_type_description"),
        _txt(raw, "licensenumber").alias("license_number"),
        _txt(raw, "licensestatusdescription").alias("status"),
        _txt(raw, "firstname").alias("first_name"), _txt(raw, "middlename").alias("middle_name"),
        _txt(raw, "lastname").alias("last_name"), _txt(raw, "city").alias("city"),
        _txt(raw, "state").alias("state"), _txt(raw, "mailzipcode").alias("zip_code"),
        F.left(_txt(raw, "licensefirstissuedate"), F.lit(10)).alias("first_issue_date"),
        F.left(_txt(raw, "licenselastreneweddate"), F.lit(10)).alias("last_renewed_date"),
        F.left(_txt(raw, "licenseexpirationdate"), F.lit(10)).alias("expiration_date"),
        url("linktoverifylicense").alias("verification_url"),
        url("linktoviewhealthcareprofile").alias("healthcare_profile_url"))
    return df.filter(F.col("status") == "Active") if active_only else df


def stage_fl(raw: DataFrame, profession_code: str, active_only: bool = False) -> DataFrame:
    """STG8: 'LAST, FIRST MIDDLE' split on ', ' then on spaces; status map else UNKNOWN."""
    name, ptype, board = next((n, t, b) for k, n, t, b in FL_PROFESSIONS if k == profession_code)
    full = _txt(raw, "Name")
    parts = F.split(full, ", ")
    given = F.split(F.coalesce(F.get(parts, 1), F.lit("")), " ")
    has_given = F.size(parts) > 1
    status = _txt(raw, "Status")
    df = raw.select(
        F.lit("FL").alias("state_code"), F.lit(ptype).alias("professional_type"),
        F.lit(name).alias("license_type"), _txt(raw, "LicenseNumber").alias("license_number"),
        status.alias("status"), C.case_map(status, FL_STATUS, "UNKNOWN").alias("status_category"),
        F.when(has_given, F.get(given, 0)).otherwise(F.lit("")).alias("first_name"),
        F.when(has_given & (F.size(given) > 1), F.array_join(F.slice(given, 2, 1 << 20), " "))
        .otherwise(F.lit("")).alias("middle_name"),
        F.get(parts, 0).alias("last_name"), full.alias("full_name"),
        _txt(raw, "Address").alias("address"), _txt(raw, "City").alias("city"),
        _txt(raw, "State").alias("state"), _txt(raw, "ZipCode").alias("zip_code"),
        _txt(raw, "County").alias("county"), _txt(raw, "OriginalIssueDate").alias("original_issue_date"),
        _txt(raw, "ExpirationDate").alias("expiration_date"),
        _txt(raw, "LastRenewalDate").alias("last_renewal_date"), F.lit(board).alias("board"))
    return df.filter(F.col("status_category") == "ACTIVE") if active_only else df
