"""STR5 on a stream equals its batch twin, evicts what the watermark has passed, and survives a restart."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from provdata.sources.bindings import TOUCHPOINTS, binding
from provdata.streaming import engagement as G
from provdata.streaming import leads as L
from tests.conftest import SF_SMALL


def _files(spark, folder, parts=3):
    """The events as files in event-time order, so that the watermark moves between micro-batches."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("_t", F.unix_timestamp(F.col("ts").cast("timestamp")))
    cuts = [float("-inf"), *ev.approxQuantile("_t", [k / parts for k in range(1, parts)], 0.0), float("inf")]
    for lo, hi in zip(cuts, cuts[1:]):
        yield ev.where((F.col("_t") > lo) & (F.col("_t") <= hi)).drop("_t").coalesce(1)


def _stream(spark, folder, schema):
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return spark.sql(TOUCHPOINTS, events=raw).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def _rows(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_stream_over_files_with_a_restart_equals_the_batch(spark, tmp_path):
    folder, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    batch = L.engagement_features(binding(spark, SF_SMALL, "touchpoints"))
    for k, part in enumerate(_files(spark, folder)):
        part.write.mode("append").parquet(folder)
        if k != 1:  # run after one file, then, as a new query from the checkpoint, over the other two
            table = G.run_engagement(spark, _stream(spark, folder, part.schema), out, ck, delay="1 hour")
    assert _rows(table.read(), batch.columns) == _rows(batch.withColumn("lead_id", F.col("lead_id").cast("string")), batch.columns)
    version = table.version()
    G.run_engagement(spark, _stream(spark, folder, part.schema), out, ck, delay="1 hour")  # nothing new: nothing changes
    assert table.version() in (version, version + 1) and _rows(table.read(), batch.columns) == _rows(
        batch.withColumn("lead_id", F.col("lead_id").cast("string")), batch.columns)


def test_silent_leads_expire(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "event_id long, lead_id string, channel string, event_timestamp timestamp"
    days = [[("a", 1), ("b", 1)], [("b", 20)], [("b", 40)], [("b", 60)]]
    for k, some in enumerate(days):
        spark.createDataFrame([(d, lead, "email", (pd.Timestamp("2025-01-01") + pd.Timedelta(days=d)).to_pydatetime()) for lead, d in some], schema) \
            .coalesce(1).write.mode("append").parquet(folder)
        os.utime(max((os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")), key=os.path.getmtime), (k + 1, k + 1))
    tp = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    table = G.run_engagement(spark, tp, str(tmp_path / "out"), str(tmp_path / "ck"), delay="1 hour", expire_after_s=30 * 86400)
    got = {r.lead_id: (r.events, r.active_days, r.sessions, r.expired) for r in table.read().collect()}
    assert got == {"a": (1, 1, 1, True), "b": (4, 4, 4, False)}


@pytest.mark.parametrize("seed", range(4))
def test_state_equals_sorting_and_stays_small(seed):
    """Batches within the watermark, in any order inside it: totals equal one sort, and closed parts are not kept."""
    rnd, gap = random.Random(seed), 1_800_000_000
    times = sorted(rnd.randrange(0, 40 * G.DAY) // 60_000_000 * 60_000_000 for _ in range(400))
    lead, biggest = G.LeadState(), 0
    for k in range(0, 400, 20):
        some = times[k:k + 20]
        rnd.shuffle(some)
        lead.add(pd.DataFrame({"at": some, "hour": [t // 3_600_000_000 % 24 for t in some], "day": [t // G.DAY for t in some],
                               "dow": [(t // G.DAY + 4) % 7 + 1 for t in some], "channel": [rnd.choice(["a", None]) for _ in some]}), gap)
        lead.fold(times[k + 20] if k + 20 < 400 else times[-1], gap)
        lead = G.LeadState(lead.stored())
        biggest = max(biggest, len(lead.sessions) + len(lead.days))
    row = lead.features("x", False).iloc[0]
    assert row.sessions == 1 + sum(b - a >= gap for a, b in zip(times, times[1:]))
    assert row.active_days == len({t // G.DAY for t in times}) and row.events == 400 and biggest <= 4
