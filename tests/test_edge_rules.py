"""Rules that the bound tables cannot break: audit records, caps, keys, headers, dates, timeouts."""

import pytest
from pyspark.sql import functions as F

from provdata.operators import events as E
from provdata.operators import export as X
from provdata.operators import governance as G
from provdata.operators import match as M
from provdata.operators import validate as V
from provdata.sources import io as IO

AS_OF = "2025-06-30 10:30:00"


def test_quarantine_keeps_earlier_records(spark):
    loads = spark.createDataFrame([("a", "pending"), ("b", "pending")], "load_id string, status string")
    queue = spark.createDataFrame([("1", "a", "queued"), ("2", "b", "sent")], "export_id string, data_load_id string, status string")
    pick = lambda x: spark.createDataFrame([(x,)], "load_id string")
    one, queue = G.quarantine_loads(loads, queue, pick("a"), "first", "ann", "2025-06-01")
    two, _ = G.quarantine_loads(one, queue, pick("b"), "second", "bob", "2025-06-02")
    got = {r.load_id: (r.quarantined_by, r.quarantine_reason, str(r.quarantined_at)[:10], r.exports_cancelled) for r in two.collect()}
    assert got == {"a": ("ann", "first", "2025-06-01", 1), "b": ("bob", "second", "2025-06-02", 0)}


def test_send_results_count_once_per_export(spark):
    queue = spark.createDataFrame([("1", "p", "ghl", "approved"), ("2", "p", "ghl", "approved"), ("3", "p", "ghl", "approved")],
                                  "export_id string, provider_id string, destination string, status string")
    res = spark.createDataFrame([("1", None, "late"), ("1", "x", None), ("1", "a", None), ("2", None, "e2"), ("2", None, "e1"),
                                 (None, "z", None)], "export_id string, external_id string, error string")
    q, h = X.apply_send_results(queue, res, G.destination_config(spark), AS_OF)
    assert {(r.export_id, r.status, r.external_id, r.error_message) for r in q.collect()} == {
        ("1", "sent", "a", None), ("2", "failed", None, "e1"), ("3", "approved", None, None)}
    assert [r.export_id for r in h.collect()] == ["1"]


@pytest.mark.parametrize("sent_hour,sent_earlier,left", [(0, 0, 5), (3, 0, 2), (0, 97, 3), (5, 60, 0)])
def test_caps_hold_for_the_send_day_and_hour(spark, sent_hour, sent_earlier, left):
    rows = [(f"{k:03}", "d", "approved", f"2025-06-{1 + k % 20:02} 00:00:00") for k in range(40)] + [("900", "free", "approved", "2025-06-01 00:00:00")]
    queue = spark.createDataFrame(rows, "export_id string, destination string, status string, queued_at string") \
        .withColumn("queued_at", F.col("queued_at").cast("timestamp_ntz"))
    sent = [("d", "2025-06-30 10:05:00")] * sent_hour + [("d", "2025-06-30 08:00:00")] * sent_earlier + [("d", "2025-06-29 10:00:00")] * 50
    history = spark.createDataFrame(sent, "destination string, sent_at string").withColumn("sent_at", F.col("sent_at").cast("timestamp_ntz"))
    caps = spark.createDataFrame([("d", 5, 100), ("free", None, None)], "destination string, rate_limit_per_hour int, rate_limit_per_day int")
    got = X.rate_limited(queue, caps, AS_OF, history).collect()
    fifo = sorted((r[3], r[0]) for r in rows if r[1] == "d")[:left]
    assert {r.export_id for r in got} == {i for _, i in fifo} | {"900"}


def test_differ_skips_types_without_a_previous_file(spark):
    cols = "professional_type string, lic_nbr string, lic_id int, lic_sta_cde int, first_nme string, last_nme string, city string, county string, zip string"
    row = lambda t, n, s: (t, n, 1, s, "A", "B", "c", "d", "7")
    prev = spark.createDataFrame([row("dentist", "1", 20), row("dentist", "2", 60)], cols)
    cur = spark.createDataFrame([row("dentist", "1", 45), row("dentist", "2", 20), row("dentist", "3", 46), row("hygienist", "1", 20)], cols)
    got = {(r.event_type, r.professional_type, r.license_number) for r in E.snapshot_diff(cur, prev, "2025-06-30").collect()}
    assert got == {("LAPSED", "dentist", "1"), ("REINSTATED", "dentist", "2"), ("NEW_LICENSE", "dentist", "3")}


def test_digest_tells_shifted_values_apart(spark):
    rows = [(1, "a|b", "c"), (2, "a", "b|c"), (3, "3:a|b", None), (4, None, "3:a|b"), (5, "\\N", ""), (6, None, "")]
    df = spark.createDataFrame(rows, "k int, x string, y string")
    assert IO.snapshot_fingerprint(df, ["k"]).select("digest").distinct().count() == len(rows)


def test_upsert_counts_a_key_once_and_matches_nulls(spark):
    target = spark.createDataFrame([(1, "old"), (None, "old"), (3, "old")], "k int, v string")
    updates = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "c"), (2, "c")], "k int, v string")
    rows = lambda mode: sorted(((r.k, r.v) for r in IO.merge_upsert(target, updates, ["k"], mode).collect()), key=str)
    assert rows("replace") == sorted([(1, "b"), (None, "n"), (3, "old"), (2, "c")], key=str)
    assert rows("insert_only") == sorted([(1, "old"), (None, "old"), (3, "old"), (2, "c")], key=str)


def test_two_writers_of_one_version_conflict(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    df = spark.range(2)
    IO.write_version(spark, df, base)
    monkeypatch.setattr(IO, "_last_marker", lambda *_: 0)  # a writer that read the table before the first commit
    with pytest.raises(IO.ConcurrentWrite):
        IO.write_version(spark, df, base)


def test_registry_columns_are_found_by_header(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('Last Name,npi,first_name,extra\n"Smi\nth",1000000001,Ann,x\nDoe,1000000002\n')
    rows = IO.read_npi(spark, str(path), columns=["npi", "first_name", "last_name", "city"], names={"Last Name": "last_name"}).collect()
    assert [(r.npi, r.first_name, r.last_name, r.city) for r in rows] == [
        ("1000000001", "Ann", "Smi\nth", None), ("1000000002", None, "Doe", None)]


def test_date_rule_needs_the_date(spark):
    df = spark.createDataFrame([("01/01/2999",)], "d string")
    rule = [("date_range", {"field": "d", "max_date": "CURRENT_DATE()"})]
    with pytest.raises(ValueError, match="as_of"):
        V.validate_load(df, rule)
    assert not V.validate_load(df, rule, as_of="2025-06-30").first()["passed"]


def test_a_stream_that_does_not_finish_raises():
    from provdata.streaming import leads as L

    class Query:
        stopped = False

        def awaitTermination(self, timeout):
            return False

        def stop(self):
            self.stopped = True
    q = Query()
    with pytest.raises(TimeoutError):
        L._finish(q, 1)
    assert q.stopped


def test_match_returns_the_row_that_matched_and_counts_unusable_npis(spark):
    npi = spark.createDataFrame(
        [("1000000001", "1", "ANN", "BADEL", "AAA", "TX", "70000", "1"), ("1000000001", "1", "ANN", "BADEL", "AUSTIN", "TX", "75001", "2"),
         ("N-7", "1", "ANN", "BADEL", "AUSTIN", "TX", "75001", "3"), ("12345678901", "1", "ANN", "BADEL", "AUSTIN", "TX", "75001", "4"),
         (None, "1", "ANN", "BADEL", "AUSTIN", "TX", "75001", "5")],
        "npi string, entity_type_code string, first_name string, last_name string, practice_city string, practice_state string, practice_zip string, practice_phone string") \
        .withColumns({"taxonomy_code": F.lit("1223G0001X"), "deactivation_date": F.lit(None).cast("string")})
    lic = spark.createDataFrame([("p", "TX", "L1", "dentist", "Ann", "Badel", "Austin", "TX", "75001", "C"),
                                 ("q", "TX", "L2", "dentist", "Zoe", "Quux", "Austin", "TX", "75001", "C")],
                                "professional_id string, state_code string, license_number string, professional_type string, first_name string, "
                                "last_name string, city string, address_state string, zip_code string, county string")
    got = {r.professional_id: r for r in M.best_match(lic, npi).collect()}
    assert (got["p"].match_type, got["p"].npi_number, got["p"].npi_city, got["p"].npi_phone) == (
        "exact_name_city_state", "1000000001", "AUSTIN", "2")
    assert got["q"].match_type == "no_match" and got["q"].npi_number is None
    assert {r.npi: r.rows for r in M.unusable_npis(npi).collect()} == {"N-7": 1, "12345678901": 1, None: 1}
    by_npi = M.best_match(lic.withColumn("n", F.lit("1000000001")), npi, npi_on_license_col="n")
    assert {(r.professional_id, r.match_type) for r in by_npi.collect()} == {("p", "exact_npi"), ("q", "exact_npi")}


def test_checkpoint_folder_must_be_set_outside_local_masters(monkeypatch):
    from provdata import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Context:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, **conf):
            self.sparkContext, self.conf = Context(master), Conf(conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session("spark://host:7077"))
    cluster = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///ck"})
    assert session.ensure_checkpoint_dir(cluster) == "hdfs:///ck" == cluster.sparkContext.folder
    local = Session("local[4]")
    assert session.ensure_checkpoint_dir(local) == local.conf["spark.checkpoint.dir"] == local.sparkContext.folder


def test_every_event_rule_fires_on_the_bound_tables(spark):
    from provdata.plans.registry import load_all
    rows = load_all()["license_event_rules"].build(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 10 and all(r.events > 0 for r in rows)
    levels = {r.sedation_level for r in load_all()["dim_professionals"].build(spark, "/root/testdata/sf0.01").collect()}
    assert levels == {"NONE", "NITROUS_ONLY", "LEVEL_1", "LEVEL_2", "LEVEL_3", "LEVEL_4"}


def test_union_fills_missing_flags_with_false(spark):
    from provdata.operators import staging as ST
    a = spark.createDataFrame([(1, None)], "k int, has_x boolean")
    b = spark.createDataFrame([(2, True, "t")], "k int, is_y boolean, z string")
    got = {r.k: (r.has_x, r.is_y, r.z) for r in ST.union_professionals(a, b).collect()}
    assert got == {1: (None, False, None), 2: (False, True, "t")}


def test_load_fields_that_are_new_are_kept(spark):
    loads = spark.createDataFrame([("a", "x"), ("b", "y")], "load_id string, status string")
    got = G.update_load(loads, spark.createDataFrame([("a", "z", "n")], "load_id string, status string, note string"), "2025-06-30")
    assert {(r.load_id, r.status, r.note, r.updated_at is None) for r in got.collect()} == {("a", "z", "n", False), ("b", "y", None, True)}


def test_budget_cut_over_many_buckets(spark):
    from provdata.operators import metrics as MET
    rows = [(k, k % 3 == 0) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, m boolean").repartition(5)
    got = {r.k: r.credits_before for r in MET.budget_cut(df, ["k"], "m", 50, F.floor(F.col("k") / 7), fan=4).collect()}
    run, want = 0, {}
    for k, m in rows:
        if run < 50:
            want[k] = run
        run += m
    assert got == want


def test_files_of_a_folder_are_bound_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('npi,last_name,city\n1,"Smith\nJones",Austin\n2,"O""Neil",Waco\n')
    (tmp_path / "b.csv").write_text("last_name,npi\nJones,3\n")
    (tmp_path / "c.csv").write_text("npi,last_name,city\n4,Kay,Paris\n")
    (tmp_path / "d.csv").write_text("\ufeffNPI,extra\n5,x\n")
    got = IO.read_npi(spark, str(tmp_path), columns=["npi", "last_name", "city"], names={"NPI": "npi"}).collect()
    assert sorted((r.npi, r.last_name, r.city, r._corrupt_record) for r in got) == [
        ("1", "Smith\nJones", "Austin", None), ("2", 'O"Neil', "Waco", None), ("3", "Jones", None, None),
        ("4", "Kay", "Paris", None), ("5", None, None, None)]


def test_a_load_updated_twice_stays_one_row(spark):
    from provdata.operators import governance as G

    loads = spark.createDataFrame([("a", "pending", None), ("b", "pending", None)], "load_id string, status string, updated_at timestamp_ntz")
    updates = spark.createDataFrame([("a", "promoted"), ("a", "quarantined")], "load_id string, status string")
    got = G.update_load(loads, updates, "2025-06-30").collect()
    assert sorted((r.load_id, r.status) for r in got) == [("a", "quarantined"), ("b", "pending")]


def test_records_of_one_order_key_are_queued_once(spark):
    from provdata.operators import export as X, governance as G

    records = spark.createDataFrame(
        [(1, "p1", "email", 95, "L1", "a@x"), (1, "p1", "email", 96, "L1", "b@x"), (1, "p2", "email", 90, "L2", None),
         (2, "p1", "email", 95, "L1", "a@x")],
        "rec_id long, provider_id string, destination string, match_confidence int, license_number string, email string")
    records = records.union(records.where("provider_id = 'p2'"))  # an equal row
    queue = spark.createDataFrame([], "provider_id string, destination string, status string")
    suppression = spark.createDataFrame([], "email string, npi string, license_number string, destination string, "
                                            "is_active boolean, expires_at timestamp_ntz")
    out = X.enqueue(records, queue, suppression, G.destination_config(spark), "load", "2025-06-30", "rec_id").collect()
    queued = [r for r in out if r.outcome == "queued"]
    assert len(out) == 5 and sorted(r.provider_id for r in queued) == ["p1", "p2"]
    assert len({r.new_export_id for r in queued}) == 2
    assert sum(r.outcome == "skipped" for r in out) == 3


def test_rate_limit_counts_minutes_before_it_ranks(spark):
    import datetime as dt

    from provdata.operators import export as X

    start = dt.datetime(2025, 6, 1)
    rows = [("email", k, start + dt.timedelta(minutes=k // 7)) for k in range(500)]
    rows += [("email", 900 + k, None) for k in range(3)] + [("mail", k, start) for k in range(50)] + [("off", k, start) for k in range(5)]
    df = spark.createDataFrame(rows, "destination string, export_id int, queued_at timestamp_ntz").withColumn(
        "allowed", F.expr("case destination when 'email' then 20 when 'mail' then 8 else 0 end"))
    kept = X.first_of_each(df, "destination", "queued_at", F.col("allowed"))
    assert {r.destination: r["count"] for r in kept.groupBy("destination").count().collect()} == {"email": 24, "mail": 50}
    ranked = X.capped_rank(kept, ["destination"], [F.col("queued_at"), F.col("export_id")], F.col("allowed")).collect()
    assert sorted(r.rank_in_group for r in ranked if r.destination == "email") == list(range(1, 21))
    assert sorted(r.export_id for r in ranked if r.destination == "email") == [*range(17), 900, 901, 902]
    assert sorted(r.export_id for r in ranked if r.destination == "mail") == list(range(8))
