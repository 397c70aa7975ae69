"""Touchpoint streams (STR1-STR6).

Every operator is a plain DataFrame function. ``lead_rollup``, ``lead_stage``,
``attribution_rollup`` and ``dedupe_events`` run over a batch DataFrame (the oracle
twin) and over a ``readStream`` DataFrame; the stream side only adds what
streaming needs: event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ), a
watermark, and an output mode. ``channel_attribution`` (exact distinct leads) and
``engagement_features`` (several aggregates, gaps between rows) are batch operators: a
stream lands its touchpoints first, and they run over the landed table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: lead stages in rank order and the touchpoint type that reaches each.
STAGES = [
    (1, "new", ["email_sent", "ad_impression"]),
    (2, "engaged", ["email_open", "email_click", "ad_click", "page_view"]),
    (3, "qualified", ["form_submit"]),
    (4, "opportunity", ["demo_booked"]),
    (5, "customer", ["deal_won"]),
]
PASSIVE = ["email_sent", "ad_impression"]


def _count(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def lead_rollup(tp: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """STR1: per lead: sends, opens, clicks, page views, first seen, last engaged (non-passive touch)."""
    et = F.col("event_type")
    return tp.groupBy("lead_id").agg(
        _count(et == "email_sent").alias("total_emails_sent"),
        _count(et == "email_open").alias("total_opens"),
        _count(et.isin("email_click", "ad_click")).alias("total_clicks"),
        _count(et == "page_view").alias("total_page_views"),
        F.count(F.lit(1)).alias("total_touchpoints"),
        F.min(ts).alias("first_seen_at"),
        F.max(F.when(~et.isin(*PASSIVE), F.col(ts))).alias("last_engaged_at"))


def stage_rank(et: Column) -> Column:
    expr = None
    for rank, _, types in STAGES:
        expr = F.when(et.isin(*types), rank) if expr is None else expr.when(et.isin(*types), rank)
    return expr.otherwise(1)


def lead_stage(tp: DataFrame) -> DataFrame:
    """STR6: current stage = highest stage any touchpoint reached (a monotone max, stream-safe)."""
    g = tp.groupBy("lead_id").agg(F.max(stage_rank(F.col("event_type"))).alias("stage_rank"))
    name = None
    for rank, label, _ in STAGES:
        name = F.when(F.col("stage_rank") == rank, label) if name is None else name.when(F.col("stage_rank") == rank, label)
    return g.select("lead_id", "stage_rank", name.alias("current_stage"))


def attribution_rollup(tp: DataFrame, ts: str = "event_timestamp", window: str = "1 day",
                       slide: str | None = None) -> DataFrame:
    """STR2: touchpoints per tumbling (or, with ``slide``, sliding) window, channel, campaign and event type."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return tp.groupBy(w.alias("w"), "channel", "campaign_id", "event_type").agg(
        F.count(F.lit(1)).alias("touchpoints")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "channel", "campaign_id", "event_type", "touchpoints")


def channel_attribution(tp: DataFrame) -> DataFrame:
    """STR2 (batch twin, exact): touchpoints and distinct leads per channel, campaign, event type."""
    return tp.groupBy("channel", "campaign_id", "event_type").agg(
        F.count(F.lit(1)).alias("touchpoints"), F.count_distinct("lead_id").alias("leads"))


def lead_windows(tp: DataFrame, ts: str = "event_timestamp", window: str = "1 day", delay: str = "1 hour",
                 exact: bool = True, lg_k: int = 12) -> DataFrame:
    """STR2: touchpoints and distinct leads per tumbling window, channel, campaign and event type, on a batch or a stream.

    On a stream a window comes out once the watermark has passed it, and its state goes (append mode). The exact form
    keeps a counter per lead of the open windows, aggregated twice, so a hot window is many small groups rather
    than one set. The other keeps a mergeable sketch of 2^lg_k cells per group, whatever its leads number:
    ``leads`` is then an estimate with a relative standard error of about 1.04 / sqrt(2^lg_k), 1.6 % for 12, and
    ``leads_sketch`` merges over windows and keys (``merged_leads``).
    """
    if tp.isStreaming:
        tp = tp.withWatermark(ts, delay)
    by = ["w", "channel", "campaign_id", "event_type"]
    rows = tp.select(F.window(ts, window).alias("w"), *by[1:], "lead_id")
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by[1:], "touchpoints", "leads"]
    if exact:
        per_lead = rows.groupBy(*by, "lead_id").agg(F.count(F.lit(1)).alias("n"))
        return per_lead.groupBy(*by).agg(F.sum("n").alias("touchpoints"), F.count("lead_id").alias("leads")).select(*bounds)
    sketch = F.hll_sketch_agg(F.col("lead_id").cast("string"), lg_k)
    return (rows.groupBy(*by).agg(F.count(F.lit(1)).alias("touchpoints"), sketch.alias("leads_sketch"))
            .withColumn("leads", F.hll_sketch_estimate("leads_sketch")).select(*bounds, "leads_sketch"))


def merged_leads(windows: DataFrame, by: list[str]) -> DataFrame:
    """Touchpoints and estimated distinct leads of coarser groups, from the sketches of ``lead_windows``."""
    return windows.groupBy(*by).agg(F.sum("touchpoints").alias("touchpoints"),
                                    F.hll_sketch_estimate(F.hll_union_agg("leads_sketch")).alias("leads"))


def dedupe_events(tp: DataFrame, streaming: bool = False, ts: str = "event_timestamp",
                  delay: str = "1 hour") -> DataFrame:
    """STR3: one row per event_id; in a stream, late duplicates beyond the watermark are dropped."""
    if streaming:
        return tp.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])
    return tp.dropDuplicates(["event_id"])


def engagement_features(tp: DataFrame, ts: str = "event_timestamp", session_gap_s: int = 1800,
                        bucket: Column | None = None) -> DataFrame:
    """STR5: per lead: activity by weekday, active days, velocity, top channel, peak hour, sessions.

    Top channel / peak hour are the argmax of per-(lead, value) counts with a
    deterministic tie-break (smaller value wins), computed as aggregates —
    no per-lead lists are collected. Sessions come from the previous-touch
    gap, carried over ranges of (lead, time), or over a ``bucket`` of the time, so a hot lead is not sorted by one task.
    (In a stream, ``session_window`` with a watermark is the stateful form.)
    """
    # One aggregate of the touchpoints; everything else rolls its cells up, without a distinct aggregate.
    cells = (tp.groupBy("lead_id", "channel", F.hour(ts).cast("int").alias("hour"), F.to_date(ts).alias("day"))
             .agg(F.count(F.lit(1)).alias("n")))
    days = cells.groupBy("lead_id", "day").agg(F.sum("n").alias("n"))
    base = days.groupBy("lead_id").agg(
        F.sum("n").alias("events"), F.count("day").alias("active_days"),
        *[F.coalesce(F.sum(F.when(F.dayofweek("day") == d, F.col("n"))), F.lit(0)).cast("bigint").alias(f"dow_{d}")
          for d in range(1, 8)])
    by_ch = cells.groupBy("lead_id", "channel").agg(F.sum("n").alias("n"))
    # Smaller channel wins ties: order by (count desc, channel asc) via min over (-count, channel).
    top_ch = by_ch.groupBy("lead_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("channel"))).alias("m")) \
        .select("lead_id", F.col("m.channel").alias("top_channel"))
    by_hr = cells.groupBy("lead_id", "hour").agg(F.sum("n").alias("n"))
    peak = by_hr.groupBy("lead_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("hour"))).alias("m")) \
        .select("lead_id", F.col("m.hour").alias("peak_hour"))
    # Sessions = rows at least ``session_gap_s`` after the lead's previous touch; equal touches open none.
    from ..operators.windows import session_starts
    sess = session_starts(tp.select("lead_id", ts).distinct(), "lead_id", ts, session_gap_s, bucket) \
        .groupBy("lead_id").agg(F.count(F.lit(1)).alias("sessions"))
    out = base.join(top_ch, "lead_id").join(peak, "lead_id").join(sess, "lead_id")
    return out.select("*", (F.col("events").cast("double") / F.col("active_days")).alias("events_per_active_day"))


def metadata_fields(tp: DataFrame, meta_col: str = "event_metadata") -> DataFrame:
    """Event metadata JSON -> VARIANT, with a typed field pulled out (``k`` in the driver's events)."""
    v = F.try_parse_json(F.col(meta_col))
    return tp.select("*", v.alias("metadata_variant"),
                     F.try_variant_get(v, "$.k", "int").alias("meta_k"))


# --- stream plumbing ---------------------------------------------------------

def touchpoint_stream(spark: SparkSession, events_dir: str, file_glob: str = "events.parquet",
                      max_files: int = 1) -> DataFrame:
    """A file stream of the driver's events table shaped as touchpoints (event time as TIMESTAMP)."""
    from ..sources.bindings import TOUCHPOINTS
    schema = spark.read.parquet(f"{events_dir.rstrip('/')}/{file_glob}").schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
           .option("maxFilesPerTrigger", max_files).parquet(events_dir))
    tp = spark.sql(TOUCHPOINTS, events=raw)
    return tp.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def _finish(q, timeout_s: int) -> None:
    """Wait for an available-now query; one that is still running then is stopped and raises: its result is partial."""
    if not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream was still running after {timeout_s} s")
    if q.exception():
        raise q.exception()


def run_available_now(df: DataFrame, checkpoint_dir: str, table: str, mode: str = "complete",
                      timeout_s: int = 300) -> DataFrame:
    """Run a streaming DataFrame over everything available into the table at ``table`` and return it as batch.

    Tasks write the rows of each micro-batch to a folder of its own (a replay overwrites it). In complete mode
    the last micro-batch holds the result, in append mode all of them do.
    """
    from ..sources import io as IO

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id:09d}")

    spark = df.sparkSession
    _finish(df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start(), timeout_s)
    if not IO.exists(spark, table):
        return spark.createDataFrame([], df.schema)
    rows = spark.read.schema(df.schema.add("batch", "long")).parquet(table)
    return (rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()) if mode == "complete" else rows).drop("batch")


def run_upsert_stream(df: DataFrame, key: list[str], base: str, checkpoint_dir: str, available_now: bool = True,
                      timeout_s: int = 600):
    """Run an aggregating stream in update mode into the merge-on-read table (``sources.keyed``) at ``base``.

    Each micro-batch carries the keys whose aggregate changed and writes these rows alone; they replace
    their rows. A replayed micro-batch writes the same rows again, so the table ends up identical (exactly-once result).
    """
    from ..sources.keyed import KeyedTable

    def merge(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, base, key).upsert(batch)

    w = df.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        _finish(q, timeout_s)
    return q
