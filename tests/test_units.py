"""Edge-row unit tables (the cases listed for each operator family)."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from provdata.functions import clean as C
from provdata.operators import enrich as N
from provdata.operators import export as X
from provdata.operators import history as H
from provdata.operators import match as M
from provdata.operators import providers as P
from provdata.operators import staging as ST
from provdata.operators import validate as V


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_soundex_key_trims_and_nulls_blank(spark):
    df = spark.createDataFrame([(" Robert",), ("ROBERT",), ("",), ("  ",), (None,), ("123",)], "n string")
    out = [r[0] for r in df.select(C.soundex_key("n")).collect()]
    assert out == ["R163", "R163", None, None, None, "123"]


def test_safe_date_accepts_padded_and_unpadded(spark):
    df = spark.createDataFrame([("1/5/2020",), ("01/05/2020",), ("unknown",), ("13/40/2020",)], "d string")
    out = [r[0] for r in df.select(C.safe_date("d")).collect()]
    assert out == [dt.date(2020, 1, 5), dt.date(2020, 1, 5), None, None]


def test_cohort_counts_year_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2022, 12, 31),), (dt.date(2023, 1, 1),), (None,)], "d date")
    out = [r[0] for r in df.select(C.practice_age_cohort("d", "2025-01-01")).collect()]
    # 2025 - 2022 = 3 boundaries -> New; 2025 - 2023 = 2 -> Very New; unknown -> Legacy.
    assert out == ["New (2-5 yrs)", "Very New (0-2 yrs)", "Legacy (20+ yrs)"]


def test_latest_per_key_orders_by_parsed_date_not_text(spark):
    schema = ("npi string, entity_type_code string, first_name string, last_name string, taxonomy_code string, "
              "practice_country string, practice_state string, deactivation_date string, last_update_date string")
    npi = spark.createDataFrame([
        ("1", "1", "A", "B", "1223G0001X", "US", "TX", None, "12/01/2010"),
        ("1", "1", "A2", "B", "1223G0001X", "US", "TX", " ", "01/01/2024"),
        ("2", "1", "C", "D", "1223G0001X", "US", "TX", "01/02/2020", "01/01/2024"),   # deactivated
        ("3", "1", "E", "F", "1223G0001X", "CA", "TX", None, "01/01/2024")], schema)  # not US
    out = P.clean_providers(npi, "2025-06-30").select("npi", "first_name").collect()
    assert [(r.npi, r.first_name) for r in out] == [("1", "A2")]


def test_permit_flags_keep_null(spark):
    raw = spark.createDataFrame([("L1", "dentist", None), ("L2", "dentist", ""), ("L3", "dentist", "No Permit"),
                                 ("L4", "dentist", "03/01/2019"), ("L5", "hygienist", "03/01/2019")],
                                "lic_nbr string, professional_type string, nox_permit_dte string")
    out = rows(ST.stage_tx(raw), "license_number", "has_nitrous_oxide_permit")
    assert out == [("L1", None), ("L2", False), ("L3", False), ("L4", True), ("L5", False)]


def test_status_category_per_type(spark):
    raw = spark.createDataFrame([("D", "dentist", "71"), ("A", "dental_assistant", "71"), ("H", "hygienist", "71"),
                                 ("B", "dental_lab", "80"), ("X", "dentist", "abc")],
                                "lic_nbr string, professional_type string, lic_sta_cde string")
    out = dict(rows(ST.stage_tx(raw), "license_number", "status_category"))
    assert out == {"D": "INACTIVE", "A": "INACTIVE", "H": "UNKNOWN", "B": "CLOSED", "X": "UNKNOWN"}


def _snap(spark, data):
    return spark.createDataFrame(data, "k string, status string, phone string")


def test_scd2_properties(spark):
    s1 = _snap(spark, [("a", "ACTIVE", "1"), ("b", "ACTIVE", "1"), ("c", "ACTIVE", "1")])
    h1 = H.scd2_apply(None, s1, "k", ["status"], "2025-01-01")
    # Applying the same snapshot again changes nothing.
    h1b = H.scd2_apply(h1, s1, "k", ["status"], "2025-01-02")
    assert rows(h1b, "k", "status", "valid_from", "valid_to") == rows(h1, "k", "status", "valid_from", "valid_to")
    # a changes tracked column, b changes untracked phone, c disappears, d appears.
    s2 = _snap(spark, [("a", "LAPSED", "1"), ("b", "ACTIVE", "2"), ("d", "ACTIVE", "1")])
    h2 = H.scd2_apply(h1, s2, "k", ["status"], "2025-01-02")
    # c comes back.
    s3 = _snap(spark, [("a", "LAPSED", "1"), ("b", "ACTIVE", "2"), ("c", "ACTIVE", "1"), ("d", "ACTIVE", "1")])
    h3 = H.scd2_apply(h2, s3, "k", ["status"], "2025-01-03").cache()
    got = rows(h3, "k", "status", "valid_from", "valid_to")
    t = lambda d: dt.datetime(2025, 1, d)
    assert got == sorted([
        ("a", "ACTIVE", t(1), t(2)), ("a", "LAPSED", t(2), None),
        ("b", "ACTIVE", t(1), None),
        ("c", "ACTIVE", t(1), t(2)), ("c", "ACTIVE", t(3), None),
        ("d", "ACTIVE", t(2), None)])
    # At most one open version per key; intervals never overlap.
    assert h3.filter("valid_to is null").groupBy("k").count().filter("count > 1").count() == 0


def test_waterfall_is_order_independent_and_prioritised(spark):
    data = [("p1", "npi", None, "111", None, "2025-01-01"), ("p1", "apollo", "a@x", None, None, "2025-01-02"),
            ("p1", "wiza", "w@x", "222", "li", "2025-01-03"), ("p1", "apollo", "b@x", None, None, "2025-01-05"),
            ("p2", "scraped", None, None, None, None)]
    schema = "provider_id string, source string, email string, phone string, linkedin_url string, enriched_at string"
    df = spark.createDataFrame(data, schema).withColumn("enriched_at", F.col("enriched_at").cast("date"))
    for c in ("website", "company_name", "title"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("employee_count", F.lit(None).cast("int"))
    a = N.waterfall(df).collect()
    b = N.waterfall(df.orderBy(F.desc("source")).repartition(3)).collect()
    key = lambda r: r.provider_id
    assert sorted(a, key=key) == sorted(b, key=key)
    p1 = [r for r in a if r.provider_id == "p1"][0]
    # Newest apollo e-mail wins among apollo rows; phone from npi; linkedin from wiza.
    assert (p1.email, p1.email_source, p1.phone, p1.phone_source, p1.linkedin_source) == ("b@x", "apollo", "111", "npi", "wiza")
    assert p1.enrichment_score == 40 + 20 + 15
    p2 = [r for r in a if r.provider_id == "p2"][0]
    assert p2.email is None and p2.enrichment_score == 0


def test_suppression_case_expiry_scope(spark):
    recs = spark.createDataFrame([("1", "ghl", "A@X.COM", None), ("2", "ghl", "b@x.com", None),
                                  ("3", "instantly", "c@x.com", None), ("4", "ghl", "d@x.com", "L9")],
                                 "rid string, destination string, email string, license_number string")
    supp = spark.createDataFrame([
        ("a@x.com", None, None, None, True, None),            # global, case-insensitive hit on 1
        ("b@x.com", None, None, None, True, dt.date(2020, 1, 1)),  # expired
        ("c@x.com", None, None, "ghl", True, None),           # other destination
        (None, "L9", None, "ghl", False, None)],              # inactive
        "email string, license_number string, npi string, destination string, is_active boolean, expires_at date")
    kept = rows(X.suppress(recs, supp, "2025-06-30", "rid"), "rid")
    assert kept == [("2",), ("3",), ("4",)]


def test_enqueue_outcomes_and_counts(spark):
    queue = spark.createDataFrame([("e1", "p1", "ghl", "queued"), ("e2", "p2", "ghl", "sent")],
                                  "export_id string, provider_id string, destination string, status string")
    recs = spark.createDataFrame([
        (1, None, "ghl", None, None, 90), (2, "p1", "ghl", None, None, 90),   # no id; active in queue
        (3, "p2", "ghl", None, None, 90), (4, "p2", "ghl", None, None, 90),   # sent before -> ok; dup in batch
        (5, "p3", "ghl", "x@y", None, 60), (6, "p4", "lob_letter", None, None, 99)],
        "seq int, provider_id string, destination string, email string, license_number string, match_confidence int")
    supp = spark.createDataFrame([("X@Y", None, None, None, True, None)],
                                 "email string, license_number string, npi string, destination string, is_active boolean, expires_at date")
    from provdata.operators.governance import destination_config
    out = X.enqueue(recs, queue, supp, destination_config(spark), "L1", "2025-06-30", "seq")
    got = rows(out, "seq", "outcome", "new_status")
    assert got == [(1, "skipped", None), (2, "skipped", None), (3, "queued", "approved"), (4, "skipped", None),
                   (5, "suppressed", None), (6, "queued", "queued")]
    c = X.enqueue_counts(out).first()
    assert c.queued + c.suppressed + c.skipped == 6


def test_capped_rank_matches_full_window_under_skew(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select(F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
                                     (F.col("id") * 7919 % 5003).alias("t"), F.col("id"))
    got = rows(X.capped_rank(df, ["g"], [F.col("t"), F.col("id")], 25, salts=8), "g", "id", "rank_in_group")
    w = Window.partitionBy("g").orderBy("t", "id")
    exp = rows(df.withColumn("rank_in_group", F.row_number().over(w)).filter("rank_in_group <= 25"), "g", "id", "rank_in_group")
    assert got == exp


def test_validator_edges(spark):
    empty = spark.createDataFrame([], "lic_id int, lic_nbr string, city string")
    res = V.validate_load(empty, [("row_count_min", {"min_rows": 1}), ("field_populated", {"field": "city", "min_pct": 0.5}),
                                  ("field_populated", {"field": "missing", "min_pct": 0.5}),
                                  ("no_duplicates", {"key_fields": ["lic_id"]}), ("bogus", {})])
    got = rows(res, "rule_index", "passed", "severity")
    assert got == [(0, False, "error"), (1, False, "error"), (2, False, "error"), (3, True, "error"), (4, False, "warning")]
    dup = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k int")
    r = V.validate_load(dup, [("no_duplicates", {"key_fields": ["k"]})]).first()
    assert (r.passed, r.observed) == (False, 4.0)


def test_match_blank_names_never_match_and_ties_take_lower_npi(spark):
    npi = spark.createDataFrame([
        ("2", "1", "Ann", "Smith", "TX", "City1", "75001", "1223G0001X", None, "p2"),
        ("1", "1", "Ann", "Smith", "TX", "City1", "75001", "1223G0001X", None, "p1"),
        ("3", "1", "", "", "TX", "City1", "75001", "1223G0001X", None, "p3")],
        "npi string, entity_type_code string, first_name string, last_name string, practice_state string, "
        "practice_city string, practice_zip string, taxonomy_code string, deactivation_date string, practice_phone string")
    lic = spark.createDataFrame([("k1", "TX", "L1", "dentist", " ANN", "SMITH", "City1", "TX", "75001", None),
                                 ("k2", "TX", "L2", "dentist", "", "", "City1", "TX", "75001", None)],
                                "professional_id string, state_code string, license_number string, professional_type string, "
                                "first_name string, last_name string, city string, address_state string, zip_code string, county string")
    got = rows(M.best_match(lic, npi), "license_number", "npi_number", "match_confidence")
    assert got == [("L1", "1", 95), ("L2", None, 0)]


def test_state_transforms(spark):
    fl = spark.createDataFrame([("SMITH, ANN MARIE LEE",), ("SMITH",), ("",)], "Name string")
    got = [(r.last_name, r.first_name, r.middle_name) for r in ST.stage_fl(fl, "DEN").collect()]
    assert got == [("SMITH", "ANN", "MARIE LEE"), ("SMITH", "", ""), ("", "", "")]
    wa = spark.createDataFrame([("20200105", "Dental Hygiene License"), ("2020015", "X"), ("", None)],
                               "firstissuedate string, credentialtype string")
    got = [(r.first_issue_date, r.professional_type) for r in ST.stage_wa(wa).collect()]
    assert got == [("2020-01-05", "hygienist"), ("", "other"), ("", "other")]
    co = spark.createDataFrame([("DEN", Row(url="u1")), ("XX", None)],
                               "licensetype string, linktoverifylicense struct<url:string>")
    got = [(r.professional_type, r.license_type_description, r.verification_url) for r in ST.stage_co(co).collect()]
    assert got == [("dentist", "Dentist", "u1"), ("other", "XX", "")]


def test_change_log_history_bucketed_equals_plain_under_skew(spark):
    # One hot key with most rows, values flipping; buckets split it.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 7).alias("k"),
        (F.col("id") * 37 % 3001).alias("t"), F.col("id").alias("i"),
        F.when((F.col("id") * 13) % 5 < 2, F.lit("a")).otherwise(F.lit("b")).alias("v"))
    plain = H.scd2_from_changes(df, "k", ["v"], ["t", "i"])
    bucketed = H.scd2_from_changes(df, "k", ["v"], ["t", "i"], bucket=F.floor(F.col("t") / 97))
    assert rows(plain, "k", "v", "valid_from", "valid_to") == rows(bucketed, "k", "v", "valid_from", "valid_to")


def test_session_starts_bucketed_equals_plain(spark):
    from provdata.operators.windows import session_starts
    df = spark.range(0, 2000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("lead"),
        F.timestamp_add("MINUTE", (F.col("id") * 7919 % 20011).cast("int"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    plain = session_starts(df, "lead", "ts", 1800)
    bucketed = session_starts(df, "lead", "ts", 1800, bucket=F.date_trunc("hour", "ts"))
    assert rows(plain, "lead", "ts") == rows(bucketed, "lead", "ts")


def test_promote_and_quarantine_transitions(spark):
    from provdata.operators import governance as G
    loads = spark.createDataFrame([("a", "validated", True), ("b", "validated", False), ("c", "pending", None)],
                                  "load_id string, status string, validation_passed boolean")
    targets = spark.createDataFrame([("a",), ("b",), ("c",)], "load_id string")
    got = rows(G.promote_loads(loads, targets, "ops", "2025-06-30"), "load_id", "status", "promotion_result")
    assert got == [("a", "promoted", "promoted"), ("b", "validated", "error: Load did not pass validation"),
                   ("c", "pending", "error: Load must be in validated status to promote")]
    queue = spark.createDataFrame([("e1", "a", "queued"), ("e2", "a", "sent"), ("e3", "z", "approved"), ("e4", "c", "queued")],
                                  "export_id string, data_load_id string, status string")
    new_loads, new_queue = G.quarantine_loads(loads, queue, spark.createDataFrame([("a",), ("z",)], "load_id string"),
                                              "bad", "ops", "2025-06-30")
    assert rows(new_queue, "export_id", "status") == [("e1", "cancelled"), ("e2", "sent"), ("e3", "cancelled"), ("e4", "queued")]
    got = rows(new_loads, "load_id", "status", "exports_cancelled")
    # 'z' was not registered: it is created, quarantined.
    assert got == [("a", "quarantined", 1), ("b", "validated", None), ("c", "pending", None), ("z", "quarantined", 1)]


def test_budget_cut_two_level_equals_running_sum(spark):
    from pyspark.sql import Window
    from provdata.operators.metrics import budget_cut
    df = spark.range(0, 3000).select(F.col("id").alias("k"), ((F.col("id") * 7) % 3 != 0).alias("matched"))
    got = rows(budget_cut(df, ["k"], "matched", 700, F.floor(F.col("k") / 250)), "k", "credits_before")
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("credits_before", F.coalesce(F.sum(F.col("matched").cast("int")).over(w), F.lit(0)).cast("long")) \
        .filter("credits_before < 700")
    assert got == rows(exp, "k", "credits_before")


def test_every_licence_appears_once_in_match_output(spark):
    from provdata.plans import q_match
    from tests.conftest import SF_SMALL
    lic = q_match.licenses(spark, SF_SMALL)
    out = q_match.matches(spark, SF_SMALL)
    assert out.count() == lic.count() == out.select("professional_id").distinct().count()


def test_replaying_a_snapshot_changes_nothing(spark, tmp_path):
    from provdata.sources.bindings import binding
    from provdata.streaming.changes import apply_snapshot, read_events, read_history
    from tests.conftest import SF_SMALL
    raw = binding(spark, SF_SMALL, "tx_license_raw")
    base = str(tmp_path / "t")
    for day in ("2025-06-29", "2025-06-30"):
        apply_snapshot(spark, raw.filter(F.col("snapshot_date") == day).drop("snapshot_date"), day, base,
                       as_of="2025-06-30")
    h1 = rows(read_history(spark, base), "professional_id", "valid_from", "valid_to")
    e1 = rows(read_events(spark, base), "event_id")
    # Replay the last snapshot (a retried micro-batch).
    apply_snapshot(spark, raw.filter(F.col("snapshot_date") == "2025-06-30").drop("snapshot_date"), "2025-06-30",
                   base, as_of="2025-06-30")
    assert rows(read_history(spark, base), "professional_id", "valid_from", "valid_to") == h1
    assert rows(read_events(spark, base), "event_id") == e1


def test_optional_exact_npi_tier_and_flag_coalescing(spark):
    npi = spark.createDataFrame([("1000000001", "1", "Ann", "Smith", "TX", "City1", "75001", "1223G0001X", None, "p1"),
                                 ("1000000002", "1", "Bob", "Jones", "CA", "City9", "90001", "1223G0001X", None, "p2")],
                                "npi string, entity_type_code string, first_name string, last_name string, practice_state string, "
                                "practice_city string, practice_zip string, taxonomy_code string, deactivation_date string, practice_phone string")
    lic = spark.createDataFrame([("k1", "TX", "L1", "dentist", "ANN", "SMITH", "City1", "TX", "75001", None, "1000000002")],
                                "professional_id string, state_code string, license_number string, professional_type string, "
                                "first_name string, last_name string, city string, address_state string, zip_code string, county string, npi string")
    assert rows(M.best_match(lic, npi), "npi_number", "match_confidence") == [("1000000001", 95)]
    assert rows(M.best_match(lic, npi, npi_on_license_col="npi"), "npi_number", "match_confidence", "match_type") == \
        [("1000000002", 100, "exact_npi")]
    raw = spark.createDataFrame([("L1", "dentist", None)], "lic_nbr string, professional_type string, nox_permit_dte string")
    assert ST.stage_tx(raw).first().has_nitrous_oxide_permit is None
    assert ST.stage_tx(raw, coalesce_flags=True).first().has_nitrous_oxide_permit is False


def test_partial_snapshot_is_refused(spark, tmp_path):
    from provdata.sources.bindings import binding
    from provdata.streaming.changes import apply_snapshot, latest_table
    from tests.conftest import SF_SMALL
    raw = binding(spark, SF_SMALL, "tx_license_raw")
    base = str(tmp_path / "t")
    day0 = raw.filter(F.col("snapshot_date") == "2025-06-29").drop("snapshot_date")
    assert apply_snapshot(spark, day0, "2025-06-29", base)["status"] == "applied"
    before = latest_table(spark, base).version()
    partial = raw.filter((F.col("snapshot_date") == "2025-06-30") & (F.col("lic_id") % 2 == 0)).drop("snapshot_date")
    assert apply_snapshot(spark, partial, "2025-06-30", base)["status"] == "quarantined"
    assert latest_table(spark, base).version() == before


def test_build_history_with_checkpoints_equals_stepwise(spark):
    from provdata.plans.q_staging import history, snapshots
    from tests.conftest import SF_SMALL
    got = H.build_history(snapshots(spark, SF_SMALL), "professional_id", H.LICENSE_CHECK_COLS,
                          ["2025-06-30", "2025-06-29"], checkpoint_every=1)
    cols = ["professional_id", "status_category", "valid_from", "valid_to"]
    assert rows(got, *cols) == rows(history(spark, SF_SMALL), *cols)


def test_enqueue_threshold_and_delay_edges(spark):
    from provdata.operators.governance import destination_config
    queue = spark.createDataFrame([], "export_id string, provider_id string, destination string, status string")
    recs = spark.createDataFrame([(1, "p1", "ghl", 70), (2, "p2", "ghl", 69), (3, "p3", "lob_postcard", 99)],
                                 "seq int, provider_id string, destination string, match_confidence int")
    supp = spark.createDataFrame([], "email string, license_number string, npi string, destination string, "
                                     "is_active boolean, expires_at date")
    out = X.enqueue(recs, queue, supp, destination_config(spark), "L", "2025-06-30 00:00:00", "seq")
    got = rows(out, "seq", "new_status", "scheduled_send_at")
    # ghl: auto-approve at >= 70, no delay; lob_postcard: never auto, 24 h delay.
    assert got == [(1, "approved", None), (2, "queued", None), (3, "queued", dt.datetime(2025, 7, 1, 0, 0))]


def test_validation_share_exactly_at_threshold_passes(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "city string")
    r = V.validate_load(df, [("field_populated", {"field": "city", "min_pct": 0.75})]).first()
    assert (r.passed, r.observed) == (True, 0.75)


def test_waterfall_value_only_in_lowest_source(spark):
    df = spark.createDataFrame([("p", "apollo", None, "2025-01-01"), ("p", "npi", "x@y", "2025-01-02")],
                               "provider_id string, source string, email string, enriched_at string") \
        .withColumn("enriched_at", F.col("enriched_at").cast("date"))
    for c in ("phone", "linkedin_url", "website", "company_name", "title"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("employee_count", F.lit(None).cast("int"))
    r = N.waterfall(df).first()
    assert (r.email, r.email_source, r.enrichment_score) == ("x@y", "npi", 40)


def test_expiration_window_edges(spark):
    from provdata.operators import events as E
    cols = ("professional_id string, state_code string, professional_type string, license_number string, "
            "first_name string, last_name string, status_category string, license_expiration_date date, "
            "address_line_1 string, city string, address_state string, zip_code string, county string, "
            "specialty_code string, has_nitrous_oxide_permit boolean, has_anesthesia_level_4 boolean, "
            "has_sealant_certification boolean")
    d = dt.date
    snap = spark.createDataFrame([
        (k, "TX", "dentist", k, "A", "B", "ACTIVE", e, "1 Main", "X", "TX", "75001", "C1", "GEN", False, False, False)
        for k, e in [("d0", d(2025, 6, 30)), ("d90", d(2025, 9, 28)), ("d91", d(2025, 9, 29)), ("past", d(2025, 6, 29))]],
        cols)
    h = H.scd2_apply(None, snap, "professional_id", ["license_expiration_date"], "2025-06-30")
    ev = E.license_events(h, "2025-06-30").filter(F.col("event_type") == "EXPIRATION_APPROACHING")
    assert rows(ev, "professional_id") == [("d0",), ("d90",)]


def test_organisation_display_names(spark):
    schema = ("npi string, entity_type_code string, organization_name string, dba_name string, taxonomy_code string, "
              "practice_country string, practice_state string, deactivation_date string, last_update_date string")
    npi = spark.createDataFrame([("1", "2", None, "Smile Co", "1223G0001X", "US", "TX", None, "01/01/2024"),
                                 ("2", "2", " ", None, "1223G0001X", "US", "TX", None, "01/01/2024")], schema)
    got = rows(P.clean_providers(npi, "2025-06-30"), "npi", "display_name")
    assert got == [("1", "Smile Co"), ("2", "Unknown Organization")]


def test_null_transitions_emit_no_events_but_open_versions(spark):
    from provdata.operators import events as E
    cols = ("professional_id string, state_code string, professional_type string, license_number string, "
            "first_name string, last_name string, status_category string, license_expiration_date date, "
            "address_line_1 string, city string, address_state string, zip_code string, county string, "
            "specialty_code string, has_nitrous_oxide_permit boolean, has_anesthesia_level_4 boolean, "
            "has_sealant_certification boolean")
    e = dt.date(2027, 1, 1)
    base = ("TX", "dentist", "L", "A", "B")
    s1 = spark.createDataFrame([("k",) + base + (None, e, "1 Main", "X", "TX", "75001", "C1", "GEN", None, False, False)], cols)
    s2 = spark.createDataFrame([("k",) + base + ("DECEASED", e, "1 Main", "X", "TX", "75001", None, "GEN", True, False, False)], cols)
    track = ["status_category", "county", "has_nitrous_oxide_permit"]
    h = H.scd2_apply(H.scd2_apply(None, s1, "professional_id", track, "2025-06-29"), s2, "professional_id", track, "2025-06-30")
    assert h.count() == 2  # NULL -> value changes open a new version (NULL-safe comparison)
    kinds = rows(E.license_events(h, "2025-06-30"), "event_type", "event_timestamp")
    # Only the first version's NEW_LICENSE: NULL -> DECEASED, county -> NULL, flag NULL -> true emit nothing.
    assert [k for k, _ in kinds] == ["NEW_LICENSE"]


def test_other_state_never_matches_and_all_null_format_fails(spark):
    npi = spark.createDataFrame([("1000000001", "1", "Ann", "Smith", "CA", "City1", "75001", "1223G0001X", None, "p")],
                                "npi string, entity_type_code string, first_name string, last_name string, practice_state string, "
                                "practice_city string, practice_zip string, taxonomy_code string, deactivation_date string, practice_phone string")
    lic = spark.createDataFrame([("k1", "TX", "L1", "dentist", "ANN", "SMITH", "City1", "TX", "75001", None)],
                                "professional_id string, state_code string, license_number string, professional_type string, "
                                "first_name string, last_name string, city string, address_state string, zip_code string, county string")
    assert rows(M.best_match(lic, npi), "npi_number", "match_type") == [(None, "no_match")]
    df = spark.createDataFrame([(None,), (None,)], "npi string")
    r = V.validate_load(df, [("field_format", {"field": "npi", "pattern": r"^\d{10}$", "min_pct": 0.99})]).first()
    assert (r.passed, r.detail) == (False, "no non-null values")
