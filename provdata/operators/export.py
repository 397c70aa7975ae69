"""Export queue (EXP1-EXP10, JOIN11-JOIN12, TOP3-TOP4, AGG17, AGG19).

Queue transitions are set-based: a batch of records becomes outcome rows in
one plan (no per-record loop over a JSON file), and the new queue is the old
one plus the appended rows.

Suppression (JOIN11) is ``NOT EXISTS (... email = OR licence = OR npi = ...)``
in the source, which Spark can only run as a broadcast nested-loop join. Here
both sides are exploded to ``(key_type, key)`` rows, so the test is ONE
equi-join on (key_type, key) with the destination scope as a residual
predicate; the records that hit are then removed with an anti-join on the
record id. Same rows as the OR form, no nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from .governance import ACTIVE_EXPORT_STATES


def suppression_keys(suppression: DataFrame, as_of: str) -> DataFrame:
    """Active, unexpired suppressions as (key_type, key, destination) rows; e-mails lower-cased."""
    now = F.lit(as_of).cast("timestamp_ntz")
    s = suppression.filter(F.coalesce(F.col("is_active"), F.lit(True))
                           & (F.col("expires_at").isNull() | (F.col("expires_at").cast("timestamp_ntz") > now)))
    keys = F.array(
        F.struct(F.lit("email").alias("key_type"), F.lower("email").alias("key")),
        F.struct(F.lit("license").alias("key_type"), F.col("license_number").alias("key")),
        F.struct(F.lit("npi").alias("key_type"), F.col("npi").alias("key")))
    return s.select(F.col("destination").alias("s_destination"),
                    F.inline(F.filter(keys, lambda k: k["key"].isNotNull() & (k["key"] != ""))))


def _record_keys(records: DataFrame, id_col: str) -> DataFrame:
    npi = F.coalesce(*[F.col(c) for c in ("npi_number", "npi") if c in records.columns], F.lit(None).cast("string"))
    lic = F.col("license_number") if "license_number" in records.columns else F.lit(None).cast("string")
    email = F.lower(F.col("email")) if "email" in records.columns else F.lit(None).cast("string")
    keys = F.array(F.struct(F.lit("email").alias("key_type"), email.alias("key")),
                   F.struct(F.lit("license").alias("key_type"), lic.alias("key")),
                   F.struct(F.lit("npi").alias("key_type"), npi.alias("key")))
    return records.select(F.col(id_col).alias("_rid"), F.col("destination").alias("r_destination"),
                          F.inline(F.filter(keys, lambda k: k["key"].isNotNull() & (k["key"] != ""))))


def suppressed_ids(records: DataFrame, suppression: DataFrame, as_of: str, id_col: str) -> DataFrame:
    """Ids of records hit by a suppression that is global or scoped to the record's destination."""
    rk = _record_keys(records, id_col)
    sk = suppression_keys(suppression, as_of)
    hit = rk.join(sk, ["key_type", "key"], "inner") \
        .filter(F.col("s_destination").isNull() | (F.col("s_destination") == F.col("r_destination")))
    return hit.select("_rid").distinct()


def suppress(records: DataFrame, suppression: DataFrame, as_of: str, id_col: str) -> DataFrame:
    """JOIN11: records not suppressed for their destination."""
    ids = suppressed_ids(records, suppression, as_of, id_col)
    return records.join(ids, records[id_col] == ids["_rid"], "left_anti")


def exports_ready(queue: DataFrame, loads: DataFrame, config: DataFrame, suppression: DataFrame,
                  as_of: str) -> DataFrame:
    """JOIN12: approved, load promoted, destination active, schedule reached, not suppressed."""
    now = F.lit(as_of).cast("timestamp_ntz")
    promoted = loads.filter(F.col("status") == "promoted").select(F.col("load_id").alias("data_load_id"))
    active = config.filter("is_active").select("destination")
    sched = F.col("scheduled_send_at") if "scheduled_send_at" in queue.columns else F.lit(None).cast("timestamp_ntz")
    q = (queue.filter((F.col("status") == "approved") & (sched.isNull() | (sched <= now)))
         .join(promoted, "data_load_id", "left_semi")
         .join(active, "destination", "left_semi"))
    return suppress(q, suppression, as_of, "export_id")


def enqueue(records: DataFrame, queue: DataFrame, suppression: DataFrame, config: DataFrame, load_id: str,
            as_of: str, order_col: str) -> DataFrame:
    """EXP1: outcome per offered record (skipped / suppressed / queued), plus the new export row fields.

    Outcome order follows the source: no provider id -> skipped; suppressed
    -> suppressed; an active export for (provider, destination) already in
    the queue, or offered earlier in this batch -> skipped; else queued,
    auto-approved when the destination allows it and the confidence reaches
    its threshold, scheduled ``delay_hours`` after ``as_of``.

    One aggregate per (provider, destination) carries both whether the queue has an active
    export and the first record offered (``min(order)``), and is joined back, not a window: a provider
    offered a million times combines map-side instead of sorting in one task. Records without a provider
    get a key of their own each, so they do not meet in one partition.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    # Records of one order key are told apart by their rows; of equal rows the first copy alone can be queued.
    rec = records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_rid", F.struct(F.col(order_col).alias("o"), F.xxhash64(*records.columns).alias("h")))
    has_id = F.coalesce(F.col("provider_id"), F.lit("")) != ""
    sup = suppressed_ids(rec.filter(has_id), suppression, as_of, "_rid").withColumn("_sup", F.lit(True))
    r = rec.join(sup.withColumnRenamed("_rid", "_srid"), F.col("_rid") == F.col("_srid"), "left").drop("_srid")
    pair = lambda d, rid, active: d.select(F.col("provider_id").alias("_p"), F.col("destination").alias("_d"),
                                           rid.alias("_rid"), F.lit(active).alias("_active"))
    offered = pair(r.filter(has_id & F.col("_sup").isNull()), F.col("_rid"), False)
    queued_now = pair(queue.filter(F.col("status").isin(*ACTIVE_EXPORT_STATES)), F.lit(None).cast(dict(rec.dtypes)["_rid"]), True)
    pairs = (offered.union(queued_now).groupBy("_p", "_d")
             .agg(F.max("_active").alias("_active"), F.min("_rid").alias("_first")))
    own = F.when(has_id, F.col("provider_id")).otherwise(F.concat(F.lit("none-"), F.col("_rid").cast("string")))
    r = r.join(pairs, (own == F.col("_p")) & (F.col("destination") == F.col("_d")), "left")
    cfg = config.select("destination", "auto_approve", "min_confidence_for_auto", "delay_hours")
    r = r.join(cfg, "destination", "left")
    outcome = (F.when(~has_id, "skipped").when(F.col("_sup").isNotNull(), "suppressed")
               .when(F.coalesce("_active", F.lit(False)) | (F.col("_rid") != F.col("_first")) | (F.col("_copy") > 1), "skipped")
               .otherwise("queued"))
    r = r.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    conf = F.coalesce(F.col("match_confidence"), F.lit(0))
    auto = F.coalesce(F.col("auto_approve"), F.lit(False)) & (conf >= F.col("min_confidence_for_auto"))
    queued = outcome == "queued"
    return r.select(
        *records.columns, outcome.alias("outcome"),
        F.when(queued, C.short_id("provider_id", "destination", F.lit(as_of), F.col(order_col))).alias("new_export_id"),
        F.when(queued, F.when(auto, "approved").otherwise("queued")).alias("new_status"),
        F.when(queued, ~auto).alias("requires_approval"),
        F.when(queued & auto, now).alias("approved_at"),
        F.when(queued & auto, F.lit("auto")).alias("approved_by"),
        F.when(queued & (F.col("delay_hours") > 0),
               F.timestamp_add("HOUR", F.col("delay_hours"), now)).alias("scheduled_send_at"),
        F.when(queued, F.lit(load_id)).alias("new_data_load_id"))


def enqueue_counts(outcomes: DataFrame) -> DataFrame:
    """EXP1 counts: queued, auto_approved, suppressed, skipped (sum = records offered)."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == "queued").cast("bigint").alias("queued"),
        F.count_if(F.col("new_status") == "approved").cast("bigint").alias("auto_approved"),
        F.count_if(F.col("outcome") == "suppressed").cast("bigint").alias("suppressed"),
        F.count_if(F.col("outcome") == "skipped").cast("bigint").alias("skipped"))


def pending_approval(queue: DataFrame, destination: str | None = None) -> DataFrame:
    """EXP2."""
    q = queue.filter(F.col("status") == "queued")
    return q.filter(F.col("destination") == destination) if destination else q


def approve(queue: DataFrame, as_of: str, export_ids: DataFrame | None = None, destination: str | None = None,
            min_confidence: int = 0, approver: str = "manual") -> DataFrame:
    """EXP3: queued rows meeting the filters become approved (new queue version)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    q = queue
    sel = (F.col("status") == "queued") & (F.coalesce(F.col("match_confidence"), F.lit(0)) >= min_confidence)
    if destination:
        sel = sel & (F.col("destination") == destination)
    if export_ids is not None:
        ids = export_ids.select(F.col("export_id").alias("_eid")).distinct().withColumn("_pick", F.lit(True))
        q = q.join(ids, q["export_id"] == ids["_eid"], "left").drop("_eid")
        sel = sel & F.col("_pick").isNotNull()
    cols = [c for c in queue.columns if c not in ("status", "approved_at", "approved_by")]
    old = lambda c: F.col(c) if c in queue.columns else F.lit(None)
    return q.select(*cols, F.when(sel, F.lit("approved")).otherwise(F.col("status")).alias("status"),
                    F.when(sel, now).otherwise(old("approved_at").cast("timestamp_ntz")).alias("approved_at"),
                    F.when(sel, F.lit(approver)).otherwise(old("approved_by").cast("string")).alias("approved_by"))


def ready_to_send(queue: DataFrame, as_of: str, destination: str | None = None, limit: int = 100) -> DataFrame:
    """EXP4 / TOP3: approved, schedule reached, FIFO (queued_at, export_id), first ``limit``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    sched = F.col("scheduled_send_at") if "scheduled_send_at" in queue.columns else F.lit(None).cast("timestamp_ntz")
    q = queue.filter((F.col("status") == "approved") & (sched.isNull() | (sched <= now)))
    if destination:
        q = q.filter(F.col("destination") == destination)
    return q.orderBy("queued_at", "export_id").limit(limit)


def apply_send_results(queue: DataFrame, results: DataFrame, config: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """EXP5: results (export_id, external_id, error) -> new queue (failed / sent) and history rows.

    Several results of one export count once: a success over a failure (it was sent), then the
    lowest external id and error text. Results without an export id are ignored.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    res = (results.where("export_id is not null").groupBy(F.col("export_id").alias("_eid"))
           .agg(F.min(F.struct(F.col("error").isNotNull().alias("failed"), "external_id", "error")).alias("r"))
           .select("_eid", F.col("r.external_id").alias("external_id"), F.col("r.error").alias("_err")))
    j = queue.join(res, queue["export_id"] == res["_eid"], "left")
    has = F.col("_eid").isNotNull()
    failed = has & F.col("_err").isNotNull()
    sent = has & F.col("_err").isNull()
    cols = [c for c in queue.columns if c not in ("status", "error_message", "sent_at", "external_id")]
    old = lambda c, t: F.col(c).cast(t) if c in queue.columns else F.lit(None).cast(t)
    new_q = j.select(*cols,
                     F.when(failed, "failed").when(sent, "sent").otherwise(F.col("status")).alias("status"),
                     F.when(failed, F.col("_err")).otherwise(old("error_message", "string")).alias("error_message"),
                     F.when(sent, now).otherwise(old("sent_at", "timestamp_ntz")).alias("sent_at"),
                     F.when(sent, F.col("external_id")).otherwise(old("external_id", "string")).alias("external_id"))
    hist = (j.filter(sent).join(config.select("destination", "cost_per_record"), "destination", "left")
            .select(F.left(F.md5(F.concat(F.col("export_id"), F.lit("-sent"))), F.lit(12)).alias("history_id"),
                    "export_id", "provider_id", "destination", now.alias("sent_at"), "external_id",
                    F.coalesce("cost_per_record", F.lit(0.0)).alias("estimated_cost")))
    return new_q, hist


def add_suppression(suppression: DataFrame, new: DataFrame, as_of: str) -> DataFrame:
    """EXP6: append new suppressions (id from their keys and ``as_of``), active."""
    add = new.select(
        C.short_id(F.coalesce("email", F.lit("")), F.coalesce("license_number", F.lit("")),
                   F.coalesce("npi", F.lit("")), F.lit(as_of)).alias("suppression_id"),
        "email", "license_number", "npi", "destination", F.lit(True).alias("is_active"),
        F.col("expires_at").cast("date").alias("expires_at"))
    return suppression.unionByName(add, allowMissingColumns=True)


def _json(struct_col: Column) -> Column:
    # Keep NULL fields (the source serialises missing values as null, not by omission).
    return F.to_json(struct_col, {"ignoreNullFields": "false"})


def crm_contact_payload(golden_df: DataFrame, location_id: str) -> DataFrame:
    """EXP7: CRM contact payload of a golden record (tags: type, licence state, new licensee)."""
    tags = F.array_compact(F.array(
        F.concat(F.lit("license_"), F.coalesce(F.col("professional_type"), F.lit("unknown"))),
        F.concat(F.lit("state_"), F.coalesce(F.col("license_state"), F.lit("unknown"))),
        F.when(F.coalesce(F.col("is_new_licensee"), F.lit(False)), F.lit("new_licensee"))))
    payload = F.struct(
        F.lit(location_id).alias("locationId"), F.col("first_name").alias("firstName"),
        F.col("last_name").alias("lastName"), F.col("email").alias("email"), F.col("phone").alias("phone"),
        F.col("address1").alias("address1"), F.col("city").alias("city"), F.col("state").alias("state"),
        F.col("zip_code").alias("postalCode"), F.lit("License Pipeline").alias("source"), tags.alias("tags"))
    return golden_df.select("provider_id", _json(payload).alias("payload"))


def event_contact_payload(events: DataFrame, location_id: str) -> DataFrame:
    """EXP7: contact payload of a new-licensee event (contact fields empty until enriched)."""
    tags = F.array(F.lit("new_licensee"),
                   F.concat(F.lit("license_"), F.coalesce(F.col("professional_type"), F.lit("dentist"))),
                   F.concat(F.lit("county_"), F.coalesce(F.col("county"), F.lit("unknown"))))
    payload = F.struct(
        F.lit(location_id).alias("locationId"), F.col("first_name").alias("firstName"),
        F.col("last_name").alias("lastName"), F.lit("").alias("email"), F.lit("").alias("phone"),
        F.lit("").alias("address1"), F.col("city").alias("city"),
        F.coalesce(F.col("state_code"), F.lit("TX")).alias("state"), F.col("zip_code").alias("postalCode"),
        F.lit("License Pipeline").alias("source"), tags.alias("tags"),
        F.struct(F.col("license_number").alias("license_number"),
                 F.left(F.coalesce(F.col("timestamp"), F.lit("")), F.lit(10)).alias("license_date"),
                 F.col("professional_type").alias("professional_type"),
                 F.col("county").alias("county")).alias("customField"))
    return events.select("event_id", _json(payload).alias("payload"))


def payload_hash(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """EXP10: sha256 of the payload text (dedupe key for history)."""
    return df.withColumn("payload_hash", F.sha2(F.col(payload_col), 256))


def unsent_payloads(payloads: DataFrame, history: DataFrame) -> DataFrame:
    """EXP10: payloads (destination, payload, ...) that were not sent to their destination before, one of each.

    History is compared by ``payload_hash``; equal payloads of one destination in the batch count once (lowest provider).
    """
    hashed = payload_hash(payloads)
    rest = [c for c in hashed.columns if c not in ("destination", "payload_hash")]
    once = (hashed.groupBy("destination", "payload_hash").agg(F.min(F.struct("provider_id", *[c for c in rest if c != "provider_id"]))
                                                              .alias("_row")).select("destination", "payload_hash", "_row.*"))
    return once.join(history.select("destination", "payload_hash"), ["destination", "payload_hash"], "left_anti") \
        .select(*hashed.columns)


def capped_rank(df: DataFrame, keys: list[str], order: list[Column], cap: int | Column,
                salts: int | None = None) -> DataFrame:
    """Rank within ``keys`` by ``order``, keeping only ranks <= ``cap`` — skew-safe.

    Two phases: rank inside (keys, salt) sub-groups and keep the first
    ``cap`` of each (any row of the global top ``cap`` is in the top ``cap``
    of its sub-group), then rank the survivors per key. The second phase
    sees at most ``salts * cap`` rows per key however hot the key is.
    ``order`` must be a total order (end with a unique column). ``cap`` may
    be a column (a per-group cap such as a destination's daily limit). There
    are as many salts as shuffle partitions, so a hot key spreads over all of them.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    salt = (F.abs(F.xxhash64(*order)) % salts).alias("_salt")
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage = df.select("*", salt).withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= cap)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return stage.withColumn("rank_in_group", F.row_number().over(w2)).filter(F.col("rank_in_group") <= cap) \
        .drop("_salt", "_r1")


def rate_limited(queue: DataFrame, config: DataFrame, as_of: str, history: DataFrame | None = None) -> DataFrame:
    """EXP8: ready exports that each destination may still send at ``as_of`` (FIFO); uncapped destinations pass whole.

    A cap holds for the day and the hour of ``as_of``, whenever the exports were queued, and what
    ``history`` says was sent in them already counts. ``allowed`` is what is left of the tighter cap.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    caps = config.select("destination", "rate_limit_per_day",
                         (F.col("rate_limit_per_hour") if "rate_limit_per_hour" in config.columns
                          else F.lit(None).cast("int")).alias("rate_limit_per_hour"))
    if history is not None:
        sent = history.groupBy("destination").agg(
            F.count_if(F.to_date("sent_at") == F.to_date(now)).alias("_day"),
            F.count_if(F.date_trunc("hour", "sent_at") == F.date_trunc("hour", now)).alias("_hour"))
        caps = caps.join(sent, "destination", "left")
    else:
        caps = caps.withColumns({"_day": F.lit(0), "_hour": F.lit(0)})
    left = F.least(F.col("rate_limit_per_day") - F.coalesce("_day", F.lit(0)),
                   F.col("rate_limit_per_hour") - F.coalesce("_hour", F.lit(0)))
    caps = caps.select("destination", "rate_limit_per_day", F.greatest(left, F.when(left.isNotNull(), 0)).cast("int").alias("allowed"))
    ready = ready_to_send_all(queue, as_of).join(caps, "destination", "left")
    uncapped = ready.filter(F.col("allowed").isNull()).withColumn("rank_in_group", F.lit(None).cast("int"))
    capped = first_of_each(ready.filter(F.col("allowed").isNotNull()), "destination", "queued_at", F.col("allowed"))
    ranked = capped_rank(capped, ["destination"], [F.col("queued_at"), F.col("export_id")], F.col("allowed"))
    return uncapped.unionByName(ranked)


def first_of_each(df: DataFrame, key: str, ts: str, cap: Column) -> DataFrame:
    """AGG20: of each ``key`` the rows up to the minute that holds its ``cap``-th row by time, by counting minutes, not ranking rows.

    One aggregate counts each key's rows per minute; the running counts name the last minute needed, and one filter
    keeps the rows up to it: about ``cap`` of each key, however many it has. Rows without a time come first.
    """
    minute = F.coalesce(F.date_trunc("minute", F.col(ts)), F.lit("0001-01-01").cast("timestamp_ntz"))
    counts = df.groupBy(F.col(key).alias("_key"), minute.alias("_minute")).agg(F.count(F.lit(1)).alias("_n"), F.max(cap).alias("_cap"))
    before = Window.partitionBy("_key").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    last = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < F.col("_cap"))
            .groupBy("_key").agg(F.max("_minute").alias("_last")))
    return df.join(last, F.col(key) == F.col("_key")).where(minute <= F.col("_last")).drop("_key", "_last")


def ready_to_send_all(queue: DataFrame, as_of: str) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz")
    sched = F.col("scheduled_send_at") if "scheduled_send_at" in queue.columns else F.lit(None).cast("timestamp_ntz")
    return queue.filter((F.col("status") == "approved") & (sched.isNull() | (sched <= now)))


def export_daily_summary(history: DataFrame, config: DataFrame) -> DataFrame:
    """AGG17: per send day and destination: sent, estimated cost, bounces, complaints."""
    h = history.join(config.select("destination", "cost_per_record"), "destination", "left")
    return h.groupBy(F.to_date("sent_at").alias("send_date"), "destination").agg(
        F.count(F.lit(1)).alias("total_sent"),
        C.money(F.sum(F.coalesce("cost_per_record", F.lit(0.0)))).alias("estimated_cost"),
        F.count_if(F.col("delivery_status") == "bounced").cast("bigint").alias("bounces"),
        F.count_if(F.col("delivery_status") == "complained").cast("bigint").alias("complaints"))


QUEUE_STATES = ["queued", "approved", "scheduled", "sent", "failed", "cancelled"]


def queue_status(queue: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """AGG19: per destination: rows by status (fixed state list), pending approval, ready (approved),
    sent on ``as_of`` and sent all time (from the history table)."""
    q = queue.groupBy("destination").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).cast("bigint").alias(s) for s in QUEUE_STATES],
        F.count_if(F.col("status") == "queued").cast("bigint").alias("pending_approval"),
        F.count_if(F.col("status") == "approved").cast("bigint").alias("ready_to_send"))
    h = history.groupBy("destination").agg(
        F.count_if(F.to_date("sent_at") == F.lit(as_of).cast("date")).cast("bigint").alias("sent_today"),
        F.count(F.lit(1)).alias("sent_all_time"))
    return q.join(h, "destination", "full_outer").select(
        "destination", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in
                         ["total", *QUEUE_STATES, "pending_approval", "ready_to_send", "sent_today", "sent_all_time"]])


def batch_unprocessed(records: DataFrame, done: DataFrame, key: str, order: list[str], limit: int) -> DataFrame:
    """TOP4 / JOIN9 / JOIN10: records not yet processed (null-safe anti-join), first ``limit`` in order."""
    return records.join(done.select(key).distinct(), key, "left_anti").orderBy(*order).limit(limit)


def trigger_results(events: DataFrame, types=None, counties=None, crm_configured: bool = True,
                    webhook_configured: bool = True) -> DataFrame:
    """EXP9: dry-run counts of the new-licensee trigger (NEW_LICENSE events after type/county filters)."""
    from .events import filter_events
    ev = events.filter(F.col("event_type") == "NEW_LICENSE")
    f = filter_events(ev, None, types, counties)
    n = f.select(F.count(F.lit(1))).scalar()
    return ev.agg(F.count(F.lit(1)).alias("total_events")).select(
        "total_events", n.alias("filtered_events"),
        (n if crm_configured else F.lit(0).cast("bigint")).alias("crm_created"),
        (n if webhook_configured else F.lit(0).cast("bigint")).alias("webhook_sent"))
