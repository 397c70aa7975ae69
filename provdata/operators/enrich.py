"""Enrichment waterfall, golden record and enrichment rollups.

WIN3-WIN5, SET3, JOIN5, GLD1-GLD2, ENR3-ENR5, AGG12-AGG14.

The warehouse model computes 12 ``FIRST_VALUE ... IGNORE NULLS`` windows over
6 different source orderings (one Window + Sort per ordering). Here the whole
waterfall is ONE ``groupBy(provider_id)``: per field, ``min`` of a
``struct(priority, -enriched_at, value, source)`` restricted to rows where the
value is present. ``min`` keeps O(1) state per group and combines map-side,
so a provider with a huge number of enrichment rows never lands in one task
as raw rows, and the result does not depend on input order (total order:
priority, newest first, value, source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata

WATERFALL_FIELDS = ["email", "phone", "linkedin_url", "website", "company_name", "title", "employee_count"]
_NEWEST_LAST = 1 << 62  # ordering value for a NULL enriched_at (sorts after every real time)


def source_priority(field: str, source: Column) -> Column:
    pri = refdata.FIELD_PRIORITIES[field]
    return C.case_map(source, list(pri.items()), refdata.OTHER_PRIORITY)


def _recency(ts: Column) -> Column:
    """Smaller = newer; NULL last. Works for DATE and TIMESTAMP inputs."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.coalesce(F.timestamp_diff("MICROSECOND", ts.cast("timestamp_ntz"), epoch), F.lit(_NEWEST_LAST))


def waterfall(enrichments: DataFrame, key: str = "provider_id", ts_col: str = "enriched_at") -> DataFrame:
    """WIN3 + WIN4 + WIN5: per-field source waterfall with provenance, in one aggregate."""
    src = F.col("source")
    aggs = []
    for f in WATERFALL_FIELDS:
        cand = F.when(F.col(f).isNotNull(),
                      F.struct(source_priority(f, src).alias("p"), _recency(F.col(ts_col)).alias("r"),
                               F.col(f).alias("v"), src.alias("s")))
        aggs.append(F.min(cand).alias(f"_{f}"))
    aggs.append(F.max(ts_col).alias("last_enriched_at"))
    g = enrichments.groupBy(key).agg(*aggs)
    cols = [F.col(key)]
    for f in WATERFALL_FIELDS:
        cols.append(F.col(f"_{f}.v").alias(f))
        if f in refdata.FIELD_SOURCE_NAMES:
            cols.append(F.col(f"_{f}.s").alias(refdata.FIELD_SOURCE_NAMES[f]))
    out = g.select(*cols, "last_enriched_at")
    score = None
    for f, w in refdata.SCORE_WEIGHTS:
        term = F.when(F.col(f).isNotNull(), w).otherwise(0)
        score = term if score is None else score + term
    return out.select(
        "*", F.col("email").isNotNull().alias("has_email"), F.col("phone").isNotNull().alias("has_phone"),
        F.col("linkedin_url").isNotNull().alias("has_linkedin"), F.col("website").isNotNull().alias("has_website"),
        score.cast("int").alias("enrichment_score"))


def union_enrichment_sources(npi: DataFrame | None = None, apollo: DataFrame | None = None,
                             wiza: DataFrame | None = None, scraped: DataFrame | None = None) -> DataFrame:
    """SET3: four source tables to one 10-column shape (Apollo rows only when they carry an e-mail)."""
    shape = ["provider_id", "source", "phone", "email", "linkedin_url", "website", "company_name", "title",
             "employee_count", "enriched_at"]
    parts = []

    def pick(df, src, mapping):
        exprs = []
        for c in shape:
            if c == "source":
                exprs.append(F.lit(src).alias("source"))
            elif c in mapping:
                exprs.append(F.col(mapping[c]).alias(c))
            elif c in df.columns:
                exprs.append(F.col(c))
            else:
                exprs.append(F.lit(None).cast("int" if c == "employee_count" else "string").alias(c))
        return df.select(*exprs)

    if npi is not None:
        parts.append(pick(npi.filter(F.col("entity_type_code") == "1")
                          .withColumn("_updated", C.safe_date("last_update_date")), "npi",
                          {"provider_id": "npi", "phone": "practice_phone", "company_name": "organization_name",
                           "enriched_at": "_updated"}).withColumn("email", F.lit(None).cast("string")))
    if apollo is not None:
        parts.append(pick(apollo.filter(F.col("email").isNotNull()), "apollo", {"website": "website_url"}))
    if wiza is not None:
        parts.append(pick(wiza, "wiza", {"website": "company_website"}))
    if scraped is not None:
        parts.append(pick(scraped, "scraped", {"company_name": "practice_name", "enriched_at": "scraped_at"}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def first_success(df: DataFrame, providers: list[str]) -> DataFrame:
    """ENR3: ordered provider waterfall — first provider struct with a hit, and which one.

    ``df`` has one struct column per provider (NULL = no result); the first
    non-NULL in ``providers`` order wins.
    """
    hit = F.coalesce(*[F.when(F.col(p).isNotNull(), F.struct(F.lit(p).alias("provider"), F.col(p).alias("result")))
                       for p in providers])
    return df.select("*", hit.provider.alias("enriched_by"), hit.result.alias("enrichment_result"))


def npi_details(npi_raw: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Individual NPI rows, one per NPI (latest update; the raw file repeats NPIs).

    ``only`` (a column ``npi_number``) restricts the registry to those NPIs
    before the de-duplication, e.g. to the NPIs a match actually chose.
    """
    from .providers import latest_per_key
    ind = npi_raw.filter(F.col("entity_type_code") == "1")
    if only is not None:
        keep = only.select(F.col("npi_number").alias("_keep")).where(F.col("_keep").isNotNull()).distinct()
        ind = ind.join(keep, F.col("npi").cast("string") == F.col("_keep"), "left_semi")
    ind = ind.select(
        F.col("npi").cast("string").alias("npi_number"),
        F.col("first_name").alias("provider_first_name"), F.col("last_name").alias("provider_last_name"),
        *[F.col(c) if c in npi_raw.columns else F.lit(None).cast("string").alias(c)
          for c in ("practice_address_1", "practice_address_2", "practice_fax", "license_number", "license_state")],
        F.col("practice_city"), F.col("practice_state"), F.col("practice_zip"), F.col("practice_phone"),
        F.col("taxonomy_code"), F.col("organization_name"),
        C.safe_date("last_update_date").alias("npi_last_update_date"),
        F.col("last_update_date").alias("_raw_update"))
    return latest_per_key(ind, ["npi_number"], [F.col("npi_last_update_date"), F.col("_raw_update")]) \
        .drop("_raw_update")


def golden(matches: DataFrame, licenses: DataFrame, npi: DataFrame, enrichment: DataFrame, as_of: str,
           address_mode: str = "per_column") -> DataFrame:
    """JOIN5 + GLD1 + GLD2: one golden row per matched licence.

    Licence is authoritative for identity, NPI for practice address, the
    enrichment waterfall for contact fields. ``address_mode='per_column'``
    coalesces each address column independently (the source behaviour, which
    can pair NPI line 1 with licence line 2); ``'atomic'`` takes the whole NPI
    address when it has a first line, else the whole licence address.
    """
    today = F.lit(as_of).cast("date")
    m = matches.alias("m")
    lic = licenses.alias("lic")
    n = npi.alias("npi")
    e = enrichment.alias("enr")
    # Unmatched licences have no NPI: a key of their own each keeps them from meeting in one partition.
    npi_key = F.coalesce(F.col("m.npi_number"), F.concat(F.lit("none-"), F.col("m.professional_id")))
    pid = F.coalesce(F.col("m.npi_number"), F.concat(F.col("m.state_code"), F.lit("-"), F.col("m.license_number")))
    j = (m.join(lic, F.col("m.professional_id") == F.col("lic.professional_id"), "inner")
         .join(n, npi_key == F.col("npi.npi_number"), "left")
         .join(e, pid == F.col("enr.provider_id"), "left"))
    if address_mode == "atomic":
        use_npi = F.col("npi.practice_address_1").isNotNull()
        addr = {k: F.when(use_npi, F.col(f"npi.{a}")).otherwise(F.col(f"lic.{b}")) for k, a, b in [
            ("address1", "practice_address_1", "address_line_1"), ("address2", "practice_address_2", "address_line_2"),
            ("city", "practice_city", "city"), ("state", "practice_state", "address_state"),
            ("zip_code", "practice_zip", "zip_code")]}
    else:
        addr = {k: F.coalesce(F.col(f"npi.{a}"), F.col(f"lic.{b}")) for k, a, b in [
            ("address1", "practice_address_1", "address_line_1"), ("address2", "practice_address_2", "address_line_2"),
            ("city", "practice_city", "city"), ("state", "practice_state", "address_state"),
            ("zip_code", "practice_zip", "zip_code")]}
    phone = F.coalesce(F.col("enr.phone"), F.col("npi.practice_phone"), F.col("lic.phone"))
    conf = F.col("m.match_confidence")
    return j.select(
        pid.alias("provider_id"), F.col("m.npi_number").alias("npi_number"),
        F.col("m.state_code").alias("license_state"), F.col("m.license_number").alias("license_number"),
        F.col("lic.first_name").alias("first_name"), F.col("lic.middle_name").alias("middle_name"),
        F.col("lic.last_name").alias("last_name"),
        F.concat_ws(" ", F.col("lic.first_name"), F.nullif(F.col("lic.middle_name"), F.lit("")),
                    F.col("lic.last_name")).alias("full_name"),
        F.col("lic.gender").alias("gender"), F.col("lic.professional_type").alias("professional_type"),
        F.col("npi.taxonomy_code").alias("taxonomy_code"),
        F.col("enr.email").alias("email"), F.col("enr.email_source").alias("email_source"),
        phone.alias("phone"),
        F.coalesce(F.col("enr.phone_source"),
                   F.when(F.col("npi.practice_phone").isNotNull(), F.lit("npi"))
                   .when(F.col("lic.phone").isNotNull(), F.lit("license"))).alias("phone_source"),
        F.col("npi.practice_fax").alias("fax"),
        F.col("enr.linkedin_url").alias("linkedin_url"), F.col("enr.linkedin_source").alias("linkedin_source"),
        F.col("enr.website").alias("website"), F.col("enr.website_source").alias("website_source"),
        *[v.alias(k) for k, v in addr.items()],
        F.col("lic.address_line_1").alias("license_address1"), F.col("lic.address_line_2").alias("license_address2"),
        F.col("lic.city").alias("license_city"),
        F.col("lic.address_state").alias("license_state_addr"), F.col("lic.zip_code").alias("license_zip"),
        F.col("lic.county").alias("county"),
        F.col("lic.status_category").alias("license_status"), F.col("lic.status_code").alias("license_status_code"),
        F.col("lic.license_issue_date").alias("license_original_date"),
        F.col("lic.license_expiration_date").alias("license_expiration_date"),
        F.col("lic.practice_description").alias("practice_type"),
        F.col("lic.specialty_code").alias("specialty_codes"),
        F.col("lic.has_disciplinary_action").alias("disciplinary_action"),
        F.col("lic.school_name").alias("school"), F.col("lic.graduation_year").alias("graduation_year"),
        F.col("lic.birth_year").alias("birth_year"),
        F.coalesce(F.col("enr.company_name"), F.col("npi.organization_name")).alias("company_name"),
        # The source labels the company 'npi' even when there is none (kept).
        F.coalesce(F.col("enr.company_source"), F.lit("npi")).alias("company_source"),
        F.col("enr.title").alias("title"), F.col("enr.employee_count").alias("employee_count"),
        conf.alias("match_confidence"), F.col("m.match_type").alias("match_type"),
        F.col("m.needs_manual_review").alias("needs_manual_review"),
        F.col("m.auto_approve_for_email").alias("auto_approve_for_email"),
        F.col("m.auto_approve_for_mail").alias("auto_approve_for_mail"),
        F.coalesce(F.col("enr.enrichment_score"), F.lit(0)).alias("enrichment_score"),
        F.col("m.npi_number").isNull().alias("missing_npi"),
        F.col("enr.email").isNull().alias("missing_email"),
        phone.isNull().alias("missing_phone"),
        F.col("enr.linkedin_url").isNull().alias("missing_linkedin"),
        F.coalesce((F.col("lic.city") != F.col("npi.practice_city")) & F.col("m.npi_number").isNotNull(),
                   F.lit(False)).alias("address_mismatch"),
        F.coalesce(F.col("lic.license_issue_date") >= F.date_sub(today, 180), F.lit(False)).alias("is_new_licensee"),
        F.datediff(today, F.col("lic.license_issue_date")).alias("days_since_licensed"),
        F.when(F.col("enr.email").isNotNull() & (conf >= 85), "email_ready")
        .when(F.coalesce(F.col("enr.phone"), F.col("npi.practice_phone")).isNotNull(), "phone_only")
        .when(addr["address1"].isNotNull(), "mail_only").otherwise("no_contact").alias("outreach_readiness"),
        F.col("enr.last_enriched_at").alias("last_enriched_at"))


def needs_enrichment(golden_df: DataFrame) -> DataFrame:
    """ENR4: active providers without e-mail, with an enrichment priority (100/80/50/30)."""
    d = F.col("days_since_licensed")
    return golden_df.filter(F.col("email").isNull() & F.col("license_status_code").isin(20, 46, 70)).select(
        "provider_id", "npi_number", "license_state", "license_number", "first_name", "last_name",
        "company_name", "city", "state", "is_new_licensee", "days_since_licensed", "enrichment_score",
        F.when(F.col("is_new_licensee") & (d <= 30), 100).when(F.col("is_new_licensee"), 80)
        .when(d <= 365, 50).otherwise(30).alias("enrichment_priority"))


def enrichment_coverage(golden_df: DataFrame) -> DataFrame:
    """AGG12: coverage per licence state and type, active licences only."""
    g = golden_df.filter(F.col("license_status_code").isin(20, 46, 70))
    n = F.count(F.lit(1))
    has = lambda c: F.count_if(F.col(c).isNotNull()).cast("bigint")
    return g.groupBy("license_state", "professional_type").agg(
        n.alias("total_providers"), has("email").alias("has_email"), has("phone").alias("has_phone"),
        has("linkedin_url").alias("has_linkedin"), has("website").alias("has_website"),
        C.percent(F.count_if(F.col("email").isNotNull()), n).alias("email_pct"),
        C.percent(F.count_if(F.col("phone").isNotNull()), n).alias("phone_pct"),
        F.avg(F.col("enrichment_score").cast("double")).alias("avg_enrichment_score"))


def enrichment_daily(enrichments: DataFrame, ts_col: str = "enriched_at") -> DataFrame:
    """AGG13: per load day and source, records loaded and e-mails found (union first, one groupBy)."""
    return enrichments.filter(F.col("source") != "npi").groupBy(
        F.to_date(ts_col).alias("load_date"), "source").agg(
        F.count(F.lit(1)).alias("records_loaded"),
        F.count_if(F.col("email").isNotNull()).cast("bigint").alias("emails_found"))


def enrichment_cost_rollup(results: DataFrame, cost_per_credit: dict[str, float],
                           ts_col: str = "enriched_at") -> DataFrame:
    """AGG14: per day and source: credits, records, found, success rate, cost, found percentages.

    A request that returns an e-mail or phone is 'found' and costs one credit.
    """
    found = F.col("email").isNotNull() | F.col("phone").isNotNull()
    price = C.case_map("source", list(cost_per_credit.items()), 0.0)
    g = results.filter(F.col("source") != "npi").groupBy(F.to_date(ts_col).alias("date"), "source").agg(
        F.count_if(found).cast("bigint").alias("credits_used"),
        F.count(F.lit(1)).alias("records_enriched"),
        F.count_if(found).cast("bigint").alias("records_found"),
        C.money(F.sum(F.when(found, price).otherwise(0.0))).alias("total_cost_usd"),
        F.count_if(F.col("email").isNotNull()).alias("_emails"),
        F.count_if(F.col("phone").isNotNull()).alias("_phones"))
    return g.select(
        "date", "source", "credits_used", "records_enriched", "records_found",
        (F.col("records_found").cast("double") / F.col("records_enriched")).alias("success_rate"),
        "total_cost_usd",
        C.money(F.col("total_cost_usd") / F.nullif(F.col("records_found"), F.lit(0))).alias("cost_per_enriched_record"),
        C.percent(F.col("_emails"), F.col("records_enriched")).alias("email_found_pct"),
        C.percent(F.col("_phones"), F.col("records_enriched")).alias("phone_found_pct"))


def quality_flags_summary(golden_df: DataFrame) -> DataFrame:
    """GLD1/GLD2 rollup: providers per readiness class and missing-field flags."""
    return golden_df.groupBy("outreach_readiness").agg(
        F.count(F.lit(1)).alias("providers"),
        *[F.count_if(c).cast("bigint").alias(c) for c in
          ("missing_npi", "missing_email", "missing_phone", "missing_linkedin", "address_mismatch", "is_new_licensee")])
