"""Each stream operator run with availableNow equals its batch twin."""

import tempfile

from pyspark.sql import functions as F

from provdata.sources.bindings import binding
from provdata.streaming import leads as L
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lead_rollup_stream_equals_batch(spark):
    batch = L.lead_rollup(binding(spark, SF_SMALL, "touchpoints"))
    stream = L.lead_rollup(L.touchpoint_stream(spark, SF_SMALL))
    out = L.run_available_now(stream, tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-") + "/lead_rollup_t", "complete")
    out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_at") else F.col(c)
                       for c in out.columns])
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_lead_stage_stream_equals_batch(spark):
    batch = L.lead_stage(binding(spark, SF_SMALL, "touchpoints"))
    stream = L.lead_stage(L.touchpoint_stream(spark, SF_SMALL))
    out = L.run_available_now(stream, tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-") + "/lead_stage_t", "complete")
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_dedupe_stream_keeps_one_row_per_event(spark):
    stream = L.dedupe_events(L.touchpoint_stream(spark, SF_SMALL), streaming=True)
    out = L.run_available_now(stream, tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-") + "/dedupe_t", "append")
    n = binding(spark, SF_SMALL, "touchpoints").select("event_id").distinct().count()
    assert out.count() == n


def _snapshot_files(spark, root, raw, parts=3):
    """Every date and type as ``parts`` files of their own, and the manifest; returns the schema."""
    import os

    for day, kind in sorted((r[0], r[1]) for r in raw.select("snapshot_date", "professional_type").distinct().collect()):
        raw.where((F.col("snapshot_date") == day) & (F.col("professional_type") == kind)).repartition(parts) \
            .write.mode("append").parquet(os.path.join(root, "in"))
    raw.groupBy("snapshot_date", "professional_type").agg(F.count(F.lit(1)).alias("rows")) \
        .write.mode("overwrite").parquet(os.path.join(root, "manifest"))
    return spark.read.parquet(os.path.join(root, "in")).schema


def _history_rows(df):
    return _rows(df.select("professional_id", "status_category", "valid_from", "valid_to"))


def test_change_stream_over_many_files_equals_the_batch(spark, tmp_path):
    from provdata.operators import events as E
    from provdata.plans.q_staging import history
    from provdata.streaming import changes as CH

    root, base = str(tmp_path), str(tmp_path / "t")
    schema = _snapshot_files(spark, root, binding(spark, SF_SMALL, "tx_license_raw"))
    CH.run_change_events(spark, f"{root}/in", schema, f"{root}/manifest", base, f"{root}/ck", as_of="2025-06-30", max_files=2)
    assert _history_rows(CH.read_history(spark, base)) == _history_rows(history(spark, SF_SMALL))
    assert _rows(CH.read_events(spark, base)) == _rows(E.license_events(history(spark, SF_SMALL), "2025-06-30"))
    assert [(r.snapshot_date, r.status) for r in CH.read_loads(spark, base).orderBy("snapshot_date").collect()] == [
        ("2025-06-29", "applied"), ("2025-06-30", "applied")]
    # Applied again, as after a failure before the loads row was written: nothing changes.
    before = _history_rows(CH.read_history(spark, base)), CH.read_events(spark, base).count()
    CH.apply_snapshot(spark, CH.landed(spark, base, schema, "2025-06-30"), "2025-06-30", base, as_of="2025-06-30")
    assert before == (_history_rows(CH.read_history(spark, base)), CH.read_events(spark, base).count())


def test_change_stream_waits_for_a_whole_date_and_quarantines(spark, tmp_path):
    from provdata.streaming import changes as CH

    root, base = str(tmp_path), str(tmp_path / "t")
    raw = binding(spark, SF_SMALL, "tx_license_raw")
    half = raw.where("snapshot_date = '2025-06-30' and lic_id % 2 = 0").withColumn("snapshot_date", F.lit("2025-07-01"))
    schema = _snapshot_files(spark, root, raw.where("snapshot_date = '2025-06-29'").union(half), parts=2)
    first = raw.where("snapshot_date = '2025-06-29'").count()
    run = lambda: CH.run_change_events(spark, f"{root}/in", schema, f"{root}/manifest", base, f"{root}/ck", as_of="2025-06-30")
    # The manifest names a date of which nothing has landed yet: the later one waits, though it is there whole.
    manifest = spark.read.parquet(f"{root}/manifest").collect()
    more = raw.where("snapshot_date = '2025-06-30'").groupBy("snapshot_date", "professional_type").agg(F.count(F.lit(1)).alias("rows")).collect()
    spark.createDataFrame(manifest + more, "snapshot_date string, professional_type string, rows long").write.mode("overwrite").parquet(f"{root}/manifest")
    run()
    assert [r.snapshot_date for r in CH.read_loads(spark, base).collect()] == ["2025-06-29"]
    assert CH.read_history(spark, base).where("valid_to is null").count() <= first
    raw.where("snapshot_date = '2025-06-30'").repartition(3).write.mode("append").parquet(f"{root}/in")
    run()
    got = {r.snapshot_date: (r.status, r.reason) for r in CH.read_loads(spark, base).collect()}
    assert got == {"2025-06-29": ("applied", None), "2025-06-30": ("applied", None),
                   "2025-07-01": ("quarantined", "key count moved by more than 20%")}
    open_before = CH.read_history(spark, base).where("valid_to is null").count()
    CH.release_snapshot(spark, base, schema, "2025-07-01", as_of="2025-07-01")
    assert CH.read_history(spark, base).where("valid_to is null").count() < 0.7 * open_before
    assert {r.status for r in CH.read_loads(spark, base).collect()} == {"applied"}
    assert CH.latest_table(spark, base).version() == 3 and CH.read_ledger(spark, base).count() == 0


def test_attribution_windows_stream_equals_batch(spark):
    batch = L.attribution_rollup(binding(spark, SF_SMALL, "touchpoints"))
    stream = L.attribution_rollup(L.touchpoint_stream(spark, SF_SMALL).withWatermark("event_timestamp", "1 day"))
    out = L.run_available_now(stream, tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-") + "/attr_t", "complete")
    out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("window_") else F.col(c)
                       for c in out.columns])
    assert _rows(out.select(*batch.columns)) == _rows(batch)


def test_lead_rollup_update_stream_into_versioned_table(spark):
    import os
    from provdata.sources.keyed import KeyedTable
    root = tempfile.mkdtemp(prefix="upd-")
    src = os.path.join(root, "events")
    # The events arrive as several files, so the stream runs several micro-batches.
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i in range(3):
        ev.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    from provdata.sources.bindings import TOUCHPOINTS
    tp = spark.sql(TOUCHPOINTS, events=raw).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    L.run_upsert_stream(L.lead_rollup(tp), ["lead_id"], os.path.join(root, "rollup"), os.path.join(root, "ck"))
    got = KeyedTable(spark, os.path.join(root, "rollup"), ["lead_id"]).read()
    got = got.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_at") else F.col(c) for c in got.columns])
    batch = L.lead_rollup(binding(spark, SF_SMALL, "touchpoints"))
    assert _rows(got.select(*batch.columns)) == _rows(batch)
    assert KeyedTable(spark, os.path.join(root, "rollup"), ["lead_id"]).version() >= 3


def test_attribution_windows_are_emitted_once_they_close(spark, tmp_path):
    """Append mode: a window appears when the watermark passes it, with its final count, and its state is dropped."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # Files in event-time order, so that the watermark moves between micro-batches.
    ordered = ev.withColumn("_t", F.unix_timestamp(F.col("ts").cast("timestamp")))
    cuts = ordered.approxQuantile("_t", [0.25, 0.5, 0.75], 0.0)
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = ordered
        if lo is not None:
            part = part.where(F.col("_t") > lo)
        if hi is not None:
            part = part.where(F.col("_t") <= hi)
        part.drop("_t").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    from provdata.sources.bindings import TOUCHPOINTS
    raw = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tp = spark.sql(TOUCHPOINTS, events=raw).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    out = L.run_available_now(L.attribution_rollup(tp.withWatermark("event_timestamp", "1 hour")), str(tmp_path / "ck"), str(tmp_path / "out"), "append")
    out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("window_") else F.col(c) for c in out.columns])
    batch = L.attribution_rollup(binding(spark, SF_SMALL, "touchpoints"))
    got, want = set(_rows(out.select(*batch.columns))), set(_rows(batch))
    assert got and got < want
    last = max(r[1] for r in want)
    assert {r for r in want if r[1] < last} >= got >= {r for r in want if (last - r[1]).days >= 2}


def _closed(spark, exact):
    """Result of a stream over three files in event-time order, and its progress reports."""
    from provdata.plans.q_streaming import _in_three_files

    root = tempfile.mkdtemp(prefix="leads-")
    df = L.lead_windows(_in_three_files(spark, SF_SMALL, root), exact=exact)
    out = L.run_available_now(df, root + "/progress", root + "/out", "append")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def test_distinct_leads_of_a_stream_equal_the_batch_where_windows_are_closed(spark):
    tp = binding(spark, SF_SMALL, "touchpoints")
    last = tp.agg(F.max("event_timestamp") - F.expr("interval 1 hour")).first()[0]
    want = L.lead_windows(tp).where(F.col("window_end") <= F.lit(last))
    got = _closed(spark, exact=True)
    assert want.count() > 10 and _rows(got.select(*want.columns)) == _rows(want)  # each window once: none is late


def test_sketches_of_a_stream_stay_within_their_error_and_merge(spark):
    tp = binding(spark, SF_SMALL, "touchpoints")
    exact = {tuple(r)[:5]: r.leads for r in L.lead_windows(tp).collect()}
    got = _closed(spark, exact=False)
    for r in got.collect():
        assert abs(r.leads - exact[tuple(r)[:5]]) <= max(1, 0.05 * exact[tuple(r)[:5]])
    last = got.agg(F.max("window_end")).first()[0]
    whole = {r.channel: r.n for r in tp.where(F.col("event_timestamp") < F.lit(last)).groupBy("channel").agg(
        F.count_distinct("lead_id").alias("n")).collect()}
    merged = {r.channel: r.leads for r in L.merged_leads(got, ["channel"]).collect()}
    assert merged.keys() == whole.keys() and all(abs(merged[c] - n) <= max(1, 0.05 * n) for c, n in whole.items())


def test_windows_that_the_watermark_passed_leave_the_state(spark, tmp_path):
    from provdata.plans.q_streaming import _in_three_files

    df = L.lead_windows(_in_three_files(spark, SF_SMALL, str(tmp_path)))
    q = (df.writeStream.outputMode("append").format("noop").option("checkpointLocation", str(tmp_path / "progress"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    states = q.lastProgress["stateOperators"]
    assert len(states) == 2 and sum(s["numRowsTotal"] for s in states) < L.lead_windows(binding(spark, SF_SMALL, "touchpoints")).count()
