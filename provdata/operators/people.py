"""Decision makers, authorised officials and roles (JOIN13, JOIN14, VIEW2, ROLE1, AGG10).

An organisation's authorised official is matched to an individual provider
with the same first and last name in the same state: HIGH when the city is
the same too, MEDIUM otherwise, one individual per organisation (HIGH first,
then lowest NPI). As in the NPI-licence match, each tier joins the
organisations against the individuals *pre-aggregated by the tier key*
(``min(struct(npi, ...))``), so a common name never produces all
organisation x individual pairs. (The individual side is the de-duplicated
provider table — hundreds of thousands of rows at the published volume — so
one struct aggregate is cheaper here than the hash-aggregate + attribute
lookup used for the 9 M-row registry in the licence match.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C


def infer_role(title: str | Column) -> Column:
    """ROLE1: title -> DECISION_MAKER / INFLUENCER / BUDGET_HOLDER (NULL when nothing applies)."""
    t = F.upper(F.coalesce(C.col_(title), F.lit("")))
    # FIXED VALUES: title patterns per role, in evaluation order.
    return (F.when(t.rlike(r"\b(OWNER|CEO|PRESIDENT|PARTNER|CO-?FOUNDER)\b"), "DECISION_MAKER")
            .when(t.rlike(r"\bOFFICE MANAGER\b"), "INFLUENCER")
            .when(t.rlike(r"\b(CFO|CONTROLLER)\b"), "BUDGET_HOLDER"))


def _people_side(individuals: DataFrame, keys: list[str], i: int) -> DataFrame:
    best = F.min(F.struct("npi", "display_name", "first_name", "last_name", "credential", "gender",
                          "practice_phone_clean", "primary_taxonomy_code"))
    return individuals.groupBy(*[F.col(k).alias(f"_k{i}_{k}") for k in keys]).agg(best.alias(f"_m{i}"))


def decision_makers(providers: DataFrame) -> DataFrame:
    """JOIN13 (reconstructed): one owner per organisation whose authorised official is a listed dentist."""
    ind = providers.filter(F.col("entity_type") == "Individual").select(
        "*", F.upper(F.trim("first_name")).alias("fn"), F.upper(F.trim("last_name")).alias("ln"),
        F.upper(F.trim("practice_state")).alias("st"), F.upper(F.trim("practice_city")).alias("ct"))
    ind = ind.filter(F.col("fn").isNotNull() & F.col("ln").isNotNull())
    org = providers.filter((F.col("entity_type") == "Organization")
                           & F.col("auth_official_first_name").isNotNull()
                           & F.col("auth_official_last_name").isNotNull()).select(
        "*", F.upper(F.trim("auth_official_first_name")).alias("fn"),
        F.upper(F.trim("auth_official_last_name")).alias("ln"),
        F.upper(F.trim("practice_state")).alias("st"), F.upper(F.trim("practice_city")).alias("ct"))
    tiers = [("HIGH", ["fn", "ln", "st", "ct"]), ("MEDIUM", ["fn", "ln", "st"])]
    out = org
    for i, (_, keys) in enumerate(tiers):
        t = _people_side(ind, keys, i)
        cond = None
        for k in keys:
            c = F.col(k) == F.col(f"_k{i}_{k}")
            cond = c if cond is None else cond & c
        out = out.join(t, cond, "left").drop(*[f"_k{i}_{k}" for k in keys])
    m = F.coalesce(F.col("_m0"), F.col("_m1"))
    return out.filter(m.isNotNull()).select(
        F.col("npi").alias("organization_npi"), "organization_name", "dba_name",
        F.col("practice_address_full").alias("org_address"), F.col("practice_city").alias("org_city"),
        F.col("practice_state").alias("org_state"), F.col("practice_zip").alias("org_zip"),
        F.col("practice_phone_clean").alias("org_phone"),
        m.npi.alias("owner_npi"), m.display_name.alias("owner_name"), m.first_name.alias("owner_first_name"),
        m.last_name.alias("owner_last_name"), m.credential.alias("owner_credential"),
        m.gender.alias("owner_gender"), m.practice_phone_clean.alias("owner_phone"),
        m.primary_taxonomy_code.alias("owner_taxonomy"),
        F.when(F.col("_m0").isNotNull(), "HIGH").otherwise("MEDIUM").alias("match_confidence"),
        "practice_age_cohort")


def credential_category(cred: str | Column) -> Column:
    """JOIN14 (reconstructed): credential text -> category."""
    c = F.regexp_replace(F.upper(F.trim(C.col_(cred))), r"[.\s]", "")
    # FIXED VALUES: credential groups.
    return (F.when(c.isNull() | (c == ""), "unknown")
            .when(c.isin("DDS", "DMD"), "dentist_no_npi_match")
            .when(c.isin("MBA", "CPA", "CEO", "CFO", "COO", "PRESIDENT", "OWNER"), "business_professional")
            .when(c.isin("RDH", "RDA", "CDA", "EFDA"), "dental_staff")
            .otherwise("other"))


def auth_officials_to_enrich(providers: DataFrame, dm: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """JOIN14 + VIEW2: organisations without a matched owner, their official, category, priority, status."""
    orgs = providers.filter(F.col("entity_type") == "Organization")
    un = orgs.join(dm.select(F.col("organization_npi").alias("npi")), "npi", "left_anti")
    cat = credential_category("auth_official_credential")
    pri = F.when(cat == "dentist_no_npi_match", 1).when(cat == "business_professional", 2) \
        .when(cat == "unknown", 3).otherwise(4)
    out = un.select(
        F.col("npi").alias("organization_npi"), "organization_name", "dba_name",
        F.col("practice_address_1").alias("address"), F.col("practice_city").alias("city"),
        F.col("practice_state").alias("state"), F.col("practice_zip").alias("zip"),
        "auth_official_full_name", "auth_official_first_name", "auth_official_last_name",
        "auth_official_credential", "auth_official_phone", cat.alias("credential_category"),
        pri.alias("enrichment_priority"))
    if enrichment is None:
        enr = [F.lit(None).cast("string").alias(c) for c in ("enriched_email", "enriched_linkedin_url",
                                                              "enriched_title", "enrichment_source")] + \
              [F.lit(None).cast("date").alias("enriched_at")]
        out = out.select("*", *enr)
    else:
        e = enrichment.select(F.col("provider_id").alias("organization_npi"), F.col("email").alias("enriched_email"),
                              F.col("linkedin_url").alias("enriched_linkedin_url"),
                              F.col("title").alias("enriched_title"),
                              F.col("email_source").alias("enrichment_source"),
                              F.col("last_enriched_at").alias("enriched_at"))
        out = out.join(e, "organization_npi", "left")
    return out.select("*", infer_role("enriched_title").alias("inferred_role"),
                      F.when(F.col("enriched_email").isNotNull(), "Enriched").otherwise("Pending")
                      .alias("enrichment_status"))


def decision_makers_by_state(dm: DataFrame) -> DataFrame:
    """AGG10."""
    return dm.filter(F.col("org_state").isNotNull()).groupBy(F.col("org_state").alias("state")) \
        .agg(F.count(F.lit(1)).alias("count"))


def overview_stats(individuals: DataFrame, orgs: DataFrame, dm: DataFrame, officials: DataFrame) -> DataFrame:
    """AGG9 (overview): dentists, organisations, decision makers, officials, enriched, enrichment rate."""
    o = orgs.select(F.count(F.lit(1))).scalar()
    d = dm.select(F.count(F.lit(1))).scalar()
    a = officials.agg(F.count(F.lit(1)).alias("auth_officials"),
                      F.count("enriched_email").alias("enriched"))
    a = a.select("auth_officials", "enriched", C.percent(F.col("enriched"), F.col("auth_officials")).alias("enrichment_rate"))
    return individuals.agg(F.count(F.lit(1)).alias("dentists")).select(
        "dentists", o.alias("orgs"), d.alias("decision_makers"),
        a.select("auth_officials").scalar().alias("auth_officials"), a.select("enriched").scalar().alias("enriched"),
        a.select("enrichment_rate").scalar().alias("enrichment_rate"))


def match_import(contacts: DataFrame, providers: DataFrame) -> DataFrame:
    """JOIN20 (reconstructed): imported contacts matched to individual providers by name + state.

    One provider per contact (lowest NPI) through an equi-join against the
    providers pre-aggregated by (first, last, state); keeps e-mail type
    (work / personal), phone, profile and title of the import.
    """
    from .metrics import PERSONAL_DOMAINS
    ind = providers.filter(F.col("entity_type") == "Individual").select(
        F.upper(F.trim("first_name")).alias("_fn"), F.upper(F.trim("last_name")).alias("_ln"),
        F.upper(F.trim("practice_state")).alias("_st"), "npi", "display_name")
    side = ind.filter(F.col("_fn").isNotNull() & F.col("_ln").isNotNull()).groupBy("_fn", "_ln", "_st").agg(
        F.min(F.struct("npi", "display_name")).alias("_m"))
    c = contacts.select("*", F.upper(F.trim("first_name")).alias("_cfn"), F.upper(F.trim("last_name")).alias("_cln"),
                        F.upper(F.trim("state")).alias("_cst"))
    j = c.join(side, (F.col("_cfn") == F.col("_fn")) & (F.col("_cln") == F.col("_ln")) & (F.col("_cst") == F.col("_st")),
               "left")
    domain = F.lower(F.substring_index(F.col("email"), "@", -1))
    return j.select(*contacts.columns, F.col("_m.npi").alias("matched_npi"), F.col("_m.display_name").alias("matched_name"),
                    F.when(F.col("email").isNull(), F.lit(None).cast("string"))
                    .when(domain.isin(*PERSONAL_DOMAINS), "personal").otherwise("work").alias("email_type"),
                    F.col("_m").isNotNull().alias("is_matched"))
