"""Fixed reference values.

FIXED VALUES — these must equal the source system's vocabularies for results
to agree: taxonomy codes and names, state lists, licence status code maps,
specialty codes, cohort labels, enrichment source priorities, export
destinations. They are stated plainly, in natural order. Every lookup here is
tiny (well under 200 rows) and is used either as a literal ``CASE``/``isin``
expression or as a broadcast dimension whose size is bounded by this file.
"""

from __future__ import annotations

# --- FIXED VALUES: dental taxonomy dimension (code, name) -------------------
DENTAL_TAXONOMY = [
    ("122300000X", "Dentist"),
    ("1223G0001X", "General Practice"),
    ("1223X0400X", "Orthodontics"),
    ("1223P0221X", "Pediatric Dentistry"),
    ("1223S0112X", "Oral & Maxillofacial Surgery"),
    ("1223E0200X", "Endodontics"),
    ("1223P0300X", "Periodontics"),
    ("1223P0700X", "Prosthodontics"),
    ("1223D0001X", "Dental Public Health"),
    ("1223P0106X", "Oral & Maxillofacial Pathology"),
    ("1223D0004X", "Dentist Anesthesiologist"),
    ("1223X0008X", "Oral & Maxillofacial Radiology"),
    ("1223X2210X", "Orofacial Pain"),
]

# --- FIXED VALUES: mental-health taxonomy dimension (code, category, specialty name, is facility)
MENTAL_HEALTH_TAXONOMY = [
    ("101Y00000X", "Counselor", "Counselor (General)", False),
    ("101YM0800X", "Counselor", "Mental Health Counselor", False),
    ("101YA0400X", "Counselor", "Addiction Counselor", False),
    ("101YP2500X", "Counselor", "Professional Counselor", False),
    ("101YP1600X", "Counselor", "Pastoral Counselor", False),
    ("101YS0200X", "Counselor", "School Counselor", False),
    ("1041C0700X", "Social Worker", "Clinical Social Worker", False),
    ("106H00000X", "Therapist", "Marriage & Family Therapist", False),
    ("103T00000X", "Psychologist", "Psychologist (General)", False),
    ("103TC0700X", "Psychologist", "Clinical Psychologist", False),
    ("103TC1900X", "Psychologist", "Counseling Psychologist", False),
    ("103TC2200X", "Psychologist", "Child Psychologist", False),
    ("103TS0200X", "Psychologist", "School Psychologist", False),
    ("103TB0200X", "Psychologist", "Behavioral Psychologist", False),
    ("103TA0400X", "Psychologist", "Addiction Psychologist", False),
    ("2084P0800X", "Psychiatrist", "Psychiatrist", False),
    ("2084P0804X", "Psychiatrist", "Addiction Psychiatrist", False),
    ("261QM0801X", "Facility", "Mental Health Clinic", True),
    ("261QM0850X", "Facility", "Adult Mental Health Clinic", True),
    ("261QM0855X", "Facility", "Child Mental Health Clinic", True),
    ("261QM1300X", "Facility", "Multi-Specialty Mental Health", True),
    ("261QM1200X", "Facility", "MHMR Center", True),
    ("261QM2500X", "Facility", "Medical Specialty Clinic", True),
    ("261QM2800X", "Facility", "Methadone Clinic", True),
    ("261QR0400X", "Facility", "Rehabilitation Clinic", True),
    ("261QR0405X", "Facility", "Substance Use Rehab", True),
    ("261QR1300X", "Facility", "Rural Health Clinic", True),
    ("261QR0200X", "Facility", "Physical Rehab Clinic", True),
    ("324500000X", "Facility", "Substance Abuse Facility", True),
    ("283Q00000X", "Facility", "Psychiatric Hospital", True),
]

# --- FIXED VALUES: taxonomy codes accepted by the NPI-licence match ---------
MATCH_TAXONOMY_CODES = [
    "1223G0001X", "122300000X", "1223D0001X", "1223E0200X", "1223P0106X",
    "1223D0008X", "1223S0112X", "1223X0400X", "1223P0221X", "1223P0300X",
    "1223P0700X", "124Q00000X", "126800000X",
]

# --- FIXED VALUES: taxonomy prefixes -----------------------------------------
DENTAL_PREFIXES = ["1223"]
MENTAL_HEALTH_PREFIXES = ["101Y", "1041C", "106H", "103T", "2084P", "261QM", "261QR",
                          "324500", "283Q"]

# --- FIXED VALUES: 50 states + DC -------------------------------------------
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
    "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT",
    "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]

# --- FIXED VALUES: state name -> abbreviation (50 states + DC) ---------------
STATE_NAMES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"), ("Idaho", "ID"),
    ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"), ("Kansas", "KS"),
    ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"), ("Maryland", "MD"),
    ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"), ("Mississippi", "MS"),
    ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"),
    ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"), ("New York", "NY"),
    ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"), ("Oklahoma", "OK"),
    ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"), ("South Carolina", "SC"),
    ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"), ("Utah", "UT"),
    ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"), ("West Virginia", "WV"),
    ("Wisconsin", "WI"), ("Wyoming", "WY"), ("District of Columbia", "DC"),
]

# --- FIXED VALUES: practice age cohorts (upper bound in years, label) -------
COHORTS = [
    (2, "Very New (0-2 yrs)"),
    (5, "New (2-5 yrs)"),
    (10, "Established (5-10 yrs)"),
    (20, "Mature (10-20 yrs)"),
]
COHORT_ELSE = "Legacy (20+ yrs)"
NEW_COHORTS = ["Very New (0-2 yrs)", "New (2-5 yrs)"]
COHORT_ORDER = [label for _, label in COHORTS] + [COHORT_ELSE]

# --- FIXED VALUES: Texas licence status code -> category, per type ----------
# (codes, category) in evaluation order; anything else is UNKNOWN.
STATUS_MAP = {
    "dentist": [((20, 46, 70), "ACTIVE"), ((45, 48, 60), "LAPSED"),
                ((61, 65, 71, 72), "INACTIVE"), ((80,), "DECEASED"), ((47,), "SUSPENDED")],
    "hygienist": [((20, 46), "ACTIVE"), ((45, 48, 60), "LAPSED"),
                  ((61, 65, 72), "INACTIVE"), ((80,), "DECEASED"), ((47,), "SUSPENDED")],
    "dental_assistant": [((20, 46), "ACTIVE"), ((45, 48, 60), "LAPSED"),
                         ((61, 65, 71, 27), "INACTIVE"), ((80,), "DECEASED"), ((47,), "SUSPENDED")],
    "dental_lab": [((20, 46), "ACTIVE"), ((45, 48, 60), "LAPSED"),
                   ((61, 65), "INACTIVE"), ((80,), "CLOSED")],
}
MATCH_ACTIVE_CODES = [20, 46, 70]

# --- FIXED VALUES: Texas specialty code -> description ----------------------
SPECIALTIES = [
    ("GEN", "General Dentistry"),
    ("ORTH", "Orthodontics"),
    ("OMS", "Oral & Maxillofacial Surgery"),
    ("PEDO", "Pediatric Dentistry"),
    ("PERI", "Periodontics"),
    ("PROS", "Prosthodontics"),
    ("END", "Endodontics"),
    ("DPH", "Dental Public Health"),
    ("OMP", "Oral Medicine/Pathology"),
    ("OFPN", "Orofacial Pain"),
    ("OMR", "Oral & Maxillofacial Radiology"),
    ("ANE", "Dental Anesthesiology"),
]

# --- FIXED VALUES: enrichment field priorities (source -> rank, 99 otherwise)
FIELD_PRIORITIES = {
    "email": {"apollo": 1, "wiza": 2, "scraped": 3, "npi": 4},
    "phone": {"npi": 1, "apollo": 2, "wiza": 3, "scraped": 4},
    "linkedin_url": {"wiza": 1, "apollo": 2},
    "website": {"scraped": 1, "apollo": 2, "wiza": 3},
    "company_name": {"apollo": 1, "wiza": 2, "scraped": 3, "npi": 4},
    "title": {"apollo": 1, "wiza": 2},
    "employee_count": {"apollo": 1},
}
OTHER_PRIORITY = 99

# Output column for each field's provenance.
FIELD_SOURCE_NAMES = {
    "email": "email_source",
    "phone": "phone_source",
    "linkedin_url": "linkedin_source",
    "website": "website_source",
    "company_name": "company_source",
}

# --- FIXED VALUES: enrichment score weights ---------------------------------
SCORE_WEIGHTS = [("email", 40), ("phone", 20), ("linkedin_url", 15), ("website", 15),
                 ("company_name", 10)]

# --- FIXED VALUES: export destinations --------------------------------------
# (destination, cost_per_record, is_reversible, auto_approve, min_confidence_for_auto,
#  delay_hours, rate_limit_per_day)
DESTINATIONS = [
    ("ghl", 0.0, True, True, 70, 0, None),
    ("instantly", 0.01, False, True, 85, 0, 500),
    ("lob_postcard", 0.50, True, False, 95, 24, None),
    ("lob_letter", 1.50, True, False, 95, 48, None),
    ("webhook", 0.0, False, True, 70, 0, None),
]

# --- FIXED VALUES: monthly enrichment credit budget -------------------------
MONTHLY_CREDIT_BUDGET = 2500

# --- FIXED VALUES: governance validation-rule seed --------------------------
# (rule_id, source_type, rule_name, rule_type, rule_config JSON, severity)
VALIDATION_RULES = [
    ("rule-001", "tx_license", "row_count_min", "row_count", '{"min": 1000}', "error"),
    ("rule-002", "tx_license", "row_count_delta", "row_count_delta", '{"max_delta_pct": 0.20}', "error"),
    ("rule-003", "tx_license", "row_count_delta_warning", "row_count_delta", '{"max_delta_pct": 0.05}', "warning"),
    ("rule-010", "tx_license", "license_number_required", "field_populated", '{"field": "LICENSE_NUMBER", "min_pct": 0.99}', "error"),
    ("rule-011", "tx_license", "last_name_required", "field_populated", '{"field": "LAST_NAME", "min_pct": 0.99}', "error"),
    ("rule-012", "tx_license", "city_populated", "field_populated", '{"field": "CITY", "min_pct": 0.90}', "warning"),
    ("rule-020", "tx_license", "active_ratio", "value_distribution", '{"field": "STATUS_CODE", "value": 20, "min_pct": 0.50}', "error"),
    ("rule-030", "tx_license", "no_future_dates", "date_range", '{"field": "LICENSE_ORIGINAL_DATE", "max": "CURRENT_DATE()"}', "error"),
    ("rule-031", "tx_license", "no_ancient_dates", "date_range", '{"field": "LICENSE_ORIGINAL_DATE", "min": "1900-01-01"}', "error"),
    ("rule-040", "npi", "row_count_min", "row_count", '{"min": 100000}', "error"),
    ("rule-041", "npi", "npi_format", "field_format", '{"field": "NPI", "pattern": "^[0-9]{10}$", "min_pct": 0.99}', "error"),
]
