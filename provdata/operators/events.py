"""Licence change events (EVT0-EVT12, JOIN6-JOIN8, JOIN17).

``license_events`` evaluates every rule over one scan of the history: the
previous version comes from ``lag(struct)`` over the key (no self-join) and
the rules are an array of structs that is filtered and ``inline``d, instead
of a ten-branch UNION ALL that would rescan and re-sort the history per rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C

PREV_FIELDS = [
    ("status_category", "status_category"), ("license_expiration_date", "expiration_date"),
    ("address_line_1", "address_1"), ("city", "city"), ("address_state", "state"),
    ("zip_code", "zip"), ("county", "county"), ("specialty_code", "specialty"),
    ("has_nitrous_oxide_permit", "nitrous"), ("has_anesthesia_level_4", "anes_4"),
    ("has_sealant_certification", "sealant"),
]

EVENT_COLUMNS = ["event_id", "professional_id", "state_code", "professional_type", "license_number",
                 "first_name", "last_name", "event_timestamp", "event_type", "event_description",
                 "previous_value", "current_value", "priority", "marketing_action"]


def previous_version(history: DataFrame, key: str = "professional_id", order: str = "valid_from") -> DataFrame:
    """JOIN6 / WIN6: each version with its predecessor's tracked fields as ``prev`` struct."""
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(F.struct(*[F.col(c).alias(n) for c, n in PREV_FIELDS])).over(w)
    return history.select("*", prev.alias("prev"))


def since_watermark(df: DataFrame, ts_col: str, target: DataFrame | None, target_col: str = "event_timestamp") -> DataFrame:
    """JOIN17: rows later than ``coalesce(max(target.ts), '1900-01-01')`` (scalar, one row)."""
    if target is None:
        return df.filter(F.col(ts_col) > F.lit("1900-01-01").cast("timestamp_ntz"))
    mark = target.select(F.coalesce(F.max(target_col), F.lit("1900-01-01").cast("timestamp_ntz"))).scalar()
    return df.filter(F.col(ts_col) > mark)  # scalar subquery, evaluated once


def _rule(fires: Column, rule_key: str, event_type: str, desc: str, prev_v: Column | None,
          cur_v: Column | None, priority: str, action: str) -> Column:
    return F.struct(
        F.coalesce(fires, F.lit(False)).alias("fires"), F.lit(rule_key).alias("rule_key"),
        F.lit(event_type).alias("event_type"), F.lit(desc).alias("event_description"),
        (prev_v if prev_v is not None else F.lit(None)).cast("string").alias("previous_value"),
        (cur_v if cur_v is not None else F.lit(None)).cast("string").alias("current_value"),
        F.lit(priority).alias("priority"), F.lit(action).alias("marketing_action"))


def license_events(history: DataFrame, as_of: str, previous_events: DataFrame | None = None) -> DataFrame:
    """EVT0: every rule (EVT1-EVT10) in one pass over the history.

    After a first run only the keys with a version newer than its events are windowed.
    """
    if previous_events is not None:
        touched = since_watermark(history, "valid_from", previous_events).select("professional_id").distinct()
        history = history.join(touched, "professional_id", "left_semi")
    return version_events(since_watermark(previous_version(history), "valid_from", previous_events), as_of)


def version_events(v: DataFrame, as_of: str) -> DataFrame:
    """EVT1-EVT10 of versions that carry their predecessor's tracked fields as ``prev`` (NULL: none)."""
    p = lambda n: F.col(f"prev.{n}")
    is_new = F.col("prev").isNull()
    old = ~is_new
    e = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    pe = lambda n: F.coalesce(p(n).cast("string"), F.lit(""))
    today = F.lit(as_of).cast("date")
    cat, pcat = F.col("status_category"), p("status_category")
    rules = F.array(
        # FIXED VALUES: rule vocabulary (type, description, priority, action).
        _rule(is_new, "NEW_LICENSE", "NEW_LICENSE", "New licensee detected", None, cat,
              "HIGH", "onboarding"),
        _rule(old & (pcat == "ACTIVE") & (cat == "LAPSED"), "STATUS_LAPSED", "STATUS_LAPSED",
              "License cancelled or expired", pcat, cat, "MEDIUM", "winback_or_suppress"),
        _rule(old & pcat.isin("LAPSED", "SUSPENDED") & (cat == "ACTIVE"), "STATUS_REINSTATED",
              "STATUS_REINSTATED", "License reinstated", pcat, cat, "HIGH", "reengagement"),
        _rule(old & (pcat != "DECEASED") & (cat == "DECEASED"), "STATUS_DECEASED", "STATUS_DECEASED",
              "Licensee deceased - remove from all lists", pcat, cat, "CRITICAL", "suppress_all"),
        _rule(old & ((pe("address_1") != e("address_line_1")) | (pe("city") != e("city"))
                     | (pe("zip") != e("zip_code"))), "ADDRESS_CHANGE", "ADDRESS_CHANGE",
              "Practice address changed", F.concat(pe("city"), F.lit(", "), pe("state")),
              F.concat(e("city"), F.lit(", "), e("address_state")), "LOW", "update_crm_territory"),
        _rule(old & (pe("county") != e("county")) & F.col("county").isNotNull(), "TERRITORY_CHANGE",
              "TERRITORY_CHANGE", "County/territory changed", p("county"), F.col("county"),
              "MEDIUM", "territory_reassignment"),
        _rule(old & (p("nitrous") == F.lit(False)) & (F.col("has_nitrous_oxide_permit") == F.lit(True)),
              "NEW_CERT_NITROUS", "NEW_CERTIFICATION", "Obtained nitrous oxide permit",
              F.lit("No permit"), F.lit("Nitrous oxide permit"), "HIGH", "upsell_sedation_products"),
        _rule(old & (p("anes_4") == F.lit(False)) & (F.col("has_anesthesia_level_4") == F.lit(True)),
              "NEW_CERT_ANES_4", "NEW_CERTIFICATION", "Obtained anesthesia level 4 permit",
              F.lit("No level 4 permit"), F.lit("Anesthesia level 4 permit"), "HIGH",
              "upsell_advanced_sedation"),
        _rule(old & (F.col("professional_type") == "hygienist") & (p("sealant") == F.lit(False))
              & (F.col("has_sealant_certification") == F.lit(True)), "NEW_CERT_SEALANT",
              "NEW_CERTIFICATION", "Obtained sealant certification", F.lit("No certification"),
              F.lit("Sealant certification"), "MEDIUM", "upsell_preventive_products"),
        _rule((cat == "ACTIVE") & F.col("license_expiration_date").between(today, F.date_add(today, 90))
              & (F.coalesce(p("expiration_date"), F.lit("1900-01-01").cast("date"))
                 != F.col("license_expiration_date")),
              "EXPIRATION_APPROACHING", "EXPIRATION_APPROACHING", "License expiring within 90 days",
              p("expiration_date"), F.col("license_expiration_date"), "MEDIUM", "renewal_reminder"),
    )
    fired = v.select("professional_id", "state_code", "professional_type", "license_number",
                     "first_name", "last_name", F.col("valid_from").alias("event_timestamp"),
                     F.inline(F.filter(rules, lambda r: r["fires"])))
    return fired.select(
        C.surrogate_key("professional_id", "event_timestamp", F.col("rule_key")).alias("event_id"),
        *EVENT_COLUMNS[1:])


# --- Two-snapshot differ (EVT11, JOIN7, JOIN8) ------------------------------

DIFF_ACTIVE = [20, 46, 70]
DIFF_LAPSED = [45, 48, 60]


def _dedupe_license(snap: DataFrame) -> DataFrame:
    """One row per (professional_type, lic_nbr): the highest lic_id (licence numbers can be reused)."""
    from .providers import latest_per_key
    s = snap.withColumn("lic_nbr", F.trim(F.col("lic_nbr").cast("string")))
    return latest_per_key(s, ["professional_type", "lic_nbr"], [F.col("lic_id")])


def _person(df: DataFrame) -> list[Column]:
    last = F.coalesce(*[F.col(c) for c in ("last_nme", "last_mne") if c in df.columns], F.lit(""))
    desc = F.col("lic_sta_desc") if "lic_sta_desc" in df.columns else F.lit(None).cast("string")
    return [F.trim(F.coalesce(F.col("first_nme"), F.lit(""))).alias("first_name"),
            F.trim(last).alias("last_name"),
            F.nullif(F.trim(F.col("city")), F.lit("")).alias("city"),
            F.nullif(F.trim(F.col("county")), F.lit("")).alias("county"),
            F.nullif(F.left(F.trim(F.col("zip")), F.lit(5)), F.lit("")).alias("zip_code"),
            F.coalesce(desc, F.lit("")).alias("status_desc")]


def new_keys(cur: DataFrame, prev: DataFrame, deduped: bool = False) -> DataFrame:
    """JOIN7 / SET5: licence numbers in ``cur`` but not ``prev`` (per type), active only."""
    c = cur if deduped else _dedupe_license(cur)
    p = (prev if deduped else _dedupe_license(prev)).select("professional_type", "lic_nbr")
    return c.join(p, ["professional_type", "lic_nbr"], "left_anti") \
        .filter(F.col("lic_sta_cde").try_cast("int").isin(*DIFF_ACTIVE))


def status_changes(cur: DataFrame, prev: DataFrame, deduped: bool = False) -> DataFrame:
    """JOIN8: inner join on licence number (per type), status code differs."""
    c = cur if deduped else _dedupe_license(cur)
    p = (prev if deduped else _dedupe_license(prev)).select("professional_type", "lic_nbr",
                                     F.col("lic_sta_cde").try_cast("int").alias("prev_code"),
                                     (F.col("lic_sta_desc") if "lic_sta_desc" in prev.columns
                                      else F.lit(None).cast("string")).alias("prev_desc"))
    return c.join(p, ["professional_type", "lic_nbr"], "inner") \
        .withColumn("cur_code", F.col("lic_sta_cde").try_cast("int")) \
        .filter(~F.col("cur_code").eqNullSafe(F.col("prev_code")))


def snapshot_diff(cur: DataFrame, prev: DataFrame, as_of: str, state_code: str = "TX") -> DataFrame:
    """EVT11: NEW_LICENSE / LAPSED / REINSTATED between two snapshots of the same files.

    A professional type without a file in the previous snapshot cannot be compared and is skipped,
    so its licences do not all come out as new.
    """
    day = as_of[:10]
    desc = lambda df: F.col("lic_sta_desc") if "lic_sta_desc" in df.columns else F.lit(None).cast("string")
    # Both snapshots in one aggregate: the newest row of each licence number on either side, without a join.
    names = [c for c in ("lic_id", "lic_sta_cde", "lic_sta_desc", "first_nme", "last_nme", "last_mne", "city", "county", "zip")
             if c in cur.columns]
    number = F.trim(F.col("lic_nbr").cast("string")).alias("lic_nbr")
    c = cur.select("professional_type", number, F.struct(*names).alias("c"))
    p = prev.select("professional_type", number, F.struct(
        "lic_id", F.col("lic_sta_cde").try_cast("int").alias("code"), desc(prev).alias("desc")).alias("p"))
    sides = c.select("*", F.lit(None).cast(p.schema["p"].dataType).alias("p")).unionByName(
        p.select("*", F.lit(None).cast(c.schema["c"].dataType).alias("c")))
    both = (sides.where("lic_nbr is not null and professional_type is not null").groupBy("professional_type", "lic_nbr")
            .agg(F.max("c").alias("c"), F.max("p").alias("p")).where("c is not null"))
    # Types of which the previous snapshot has a file (a handful of rows).
    both = both.join(prev.select("professional_type").distinct(), "professional_type", "left_semi")
    v = both.select("professional_type", "lic_nbr", "c.*", F.col("p").isNotNull().alias("known"), F.col("p.code").alias("prev_code"),
                    F.coalesce(F.col("p.desc"), F.lit("")).alias("prev_desc"), F.col("c.lic_sta_cde").try_cast("int").alias("cur_code"))
    now = F.coalesce(desc(v), F.lit(""))
    active, lapsed = F.col("cur_code").isin(*DIFF_ACTIVE), F.col("cur_code").isin(*DIFF_LAPSED)
    was_active, was_lapsed = F.col("prev_code").isin(*DIFF_ACTIVE), F.col("prev_code").isin(*DIFF_LAPSED)

    def rule(fires, etype, prefix, prev_v, priority, action):
        return F.when(fires, F.struct(F.lit(etype).alias("event_type"), F.lit(prefix).alias("prefix"),
                                      prev_v.cast("string").alias("previous_value"), F.lit(priority).alias("priority"),
                                      F.lit(action).alias("marketing_action")))

    # FIXED VALUES: differ vocabulary. A licence fires one rule at most.
    fired = F.coalesce(
        rule(~F.col("known") & active, "NEW_LICENSE", "NEW", F.lit(None), "HIGH", "onboarding_sequence"),
        rule(F.col("known") & was_active & lapsed, "LAPSED", "LAPSED", F.col("prev_desc"), "MEDIUM", "suppress_or_winback"),
        rule(F.col("known") & was_lapsed & active, "REINSTATED", "REINSTATED", F.col("prev_desc"), "HIGH", "reengagement_sequence"))
    e = v.withColumn("e", fired).where("e is not null")
    return e.select(
        F.concat(F.col("e.prefix"), F.lit("_"), F.col("lic_nbr"), F.lit("_" + day)).alias("event_id"),
        F.concat_ws("_", F.col("e.prefix"), F.col("professional_type"), F.col("lic_nbr"), F.lit(day)).alias("event_key"),
        F.col("e.event_type").alias("event_type"), F.lit(as_of).alias("timestamp"),
        F.lit(state_code).alias("state_code"), "professional_type", F.col("lic_nbr").alias("license_number"), *_person(e),
        F.col("e.previous_value").alias("previous_value"), now.cast("string").alias("current_value"),
        F.col("e.priority").alias("priority"), F.col("e.marketing_action").alias("marketing_action")).drop("status_desc")


def recent_to_events(recent: DataFrame) -> DataFrame:
    """EVT12: recent-licence rows as NEW_LICENSE events (id = first 12 hex of md5(state-licence-type))."""
    t = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    return recent.select(
        C.short_id("state_code", "license_number", F.lit("NEW_LICENSE")).alias("event_id"),
        F.lit("NEW_LICENSE").alias("event_type"),
        F.date_format(F.col("license_issue_date").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "state_code", "professional_type", "license_number",
        t("first_name").alias("first_name"), t("last_name").alias("last_name"), t("city").alias("city"),
        t("county").alias("county"), t("zip_code").alias("zip_code"),
        F.coalesce(F.trim(F.col("address_state")), F.col("state_code")).alias("state"),
        F.lit("HIGH").alias("priority"), F.lit("new_licensee_campaign").alias("marketing_action"))


def filter_events(events: DataFrame, event_type: str | None = None, types=None, counties=None) -> DataFrame:
    """FLT7: event type, professional type, county (NULL county compares as '')."""
    out = events
    if event_type:
        out = out.filter(F.col("event_type") == event_type)
    if types:
        out = out.filter(F.col("professional_type").isin(*types))
    if counties:
        out = out.filter(F.upper(F.coalesce("county", F.lit(""))).isin(*[c.upper() for c in counties]))
    return out
