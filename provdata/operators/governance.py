"""Load governance (GOV1-GOV6, AGG18).

Every lifecycle step is a pure function ``(tables, change, as_of) -> new
table version``: the caller writes the result as a new version directory
(``sources.io.upsert``) instead of updating rows in place. Targets of a step
(load ids) arrive as a DataFrame, so a step over many loads is one join,
not a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import refdata


def _targets(loads: DataFrame, load_ids: DataFrame, col: str = "load_id") -> DataFrame:
    t = load_ids.select(F.col(col).alias("_target")).distinct()
    # The target list of one governance action is small; AQE broadcasts it.
    return loads.join(t, loads["load_id"] == t["_target"], "left")


def loads_ready_to_promote(loads: DataFrame, as_of: str) -> DataFrame:
    """GOV2: validated, passed, and the hold period elapsed."""
    now = F.lit(as_of).cast("timestamp_ntz")
    ready = F.timestamp_add("HOUR", F.col("promotion_delay_hours"), F.col("validated_at")) <= now
    return loads.filter((F.col("status") == "validated") & F.col("validation_passed") & ready)


def promote_loads(loads: DataFrame, load_ids: DataFrame, user: str, as_of: str) -> DataFrame:
    """GOV3: promote targets that are validated and passed; others get an error and stay as they are.

    Returns the new loads table with a ``promotion_result`` column
    (NULL for untouched loads).
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    j = _targets(loads, load_ids)
    hit = F.col("_target").isNotNull()
    ok = hit & (F.col("status") == "validated") & F.coalesce(F.col("validation_passed"), F.lit(False))
    result = (F.when(~hit, F.lit(None).cast("string"))
              .when(F.col("status") != "validated", F.lit("error: Load must be in validated status to promote"))
              .when(~F.coalesce(F.col("validation_passed"), F.lit(False)), F.lit("error: Load did not pass validation"))
              .otherwise(F.lit("promoted")))
    cols = [c for c in loads.columns if c not in ("status", "promoted_at", "promoted_by")]
    return j.select(
        *cols,
        F.when(ok, F.lit("promoted")).otherwise(F.col("status")).alias("status"),
        F.when(ok, now).otherwise(F.col("promoted_at") if "promoted_at" in loads.columns
                                  else F.lit(None).cast("timestamp_ntz")).alias("promoted_at"),
        F.when(ok, F.lit(user)).otherwise(F.col("promoted_by") if "promoted_by" in loads.columns
                                          else F.lit(None).cast("string")).alias("promoted_by"),
        result.alias("promotion_result"))


ACTIVE_EXPORT_STATES = ["queued", "approved", "scheduled"]


def quarantine_loads(loads: DataFrame, queue: DataFrame, load_ids: DataFrame, reason: str, user: str,
                     as_of: str) -> tuple[DataFrame, DataFrame]:
    """GOV4: quarantine loads and cancel their pending exports.

    A target load missing from the registry is created (quarantined).
    Loads that were quarantined earlier keep their own time, user, reason and count.
    Returns (new loads with ``exports_cancelled``, new queue).
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    t = load_ids.select(F.col("load_id").alias("_target")).distinct()
    q = queue.join(t, queue["data_load_id"] == t["_target"], "left")
    hit = F.col("_target").isNotNull() & F.col("status").isin(*ACTIVE_EXPORT_STATES)
    new_queue = q.select(
        *[c for c in queue.columns if c not in ("status", "error_message")],
        F.when(hit, F.lit("cancelled")).otherwise(F.col("status")).alias("status"),
        F.when(hit, F.lit("Source load quarantined: " + reason))
        .otherwise(F.col("error_message") if "error_message" in queue.columns else F.lit(None).cast("string"))
        .alias("error_message"))
    cancelled = q.filter(hit).groupBy(F.col("_target").alias("_cl")).agg(F.count(F.lit(1)).alias("_nc"))
    missing = t.join(loads.select("load_id"), t["_target"] == loads["load_id"], "left_anti") \
        .select(F.col("_target").alias("load_id"))
    base = loads.unionByName(missing, allowMissingColumns=True)
    j = base.join(t, base["load_id"] == t["_target"], "left").join(cancelled, F.col("load_id") == F.col("_cl"), "left")
    hitl = F.col("_target").isNotNull()
    old = lambda c, t: F.col(c).cast(t) if c in loads.columns else F.lit(None).cast(t)
    keep = [c for c in loads.columns if c not in ("status", "quarantined_at", "quarantined_by",
                                                   "quarantine_reason", "exports_cancelled")]
    new_loads = j.select(
        *keep,
        F.when(hitl, F.lit("quarantined")).otherwise(F.col("status")).alias("status"),
        F.when(hitl, now).otherwise(old("quarantined_at", "timestamp_ntz")).alias("quarantined_at"),
        F.when(hitl, F.lit(user)).otherwise(old("quarantined_by", "string")).alias("quarantined_by"),
        F.when(hitl, F.lit(reason)).otherwise(old("quarantine_reason", "string")).alias("quarantine_reason"),
        F.when(hitl, F.coalesce(F.col("_nc"), F.lit(0))).otherwise(old("exports_cancelled", "bigint"))
        .cast("bigint").alias("exports_cancelled"))
    return new_loads, new_queue


def quarantined_loads(loads: DataFrame) -> DataFrame:
    """GOV6."""
    return loads.filter(F.col("status") == "quarantined")


def destination_config(spark) -> DataFrame:
    """Destination settings as a table (5 fixed rows; broadcast is bounded by this list)."""
    return spark.createDataFrame(
        [(d, c, r, a, m, h, lim, None, True) for d, c, r, a, m, h, lim in refdata.DESTINATIONS],
        "destination string, cost_per_record double, is_reversible boolean, auto_approve boolean, "
        "min_confidence_for_auto int, delay_hours int, rate_limit_per_day int, rate_limit_per_hour int, is_active boolean")


def plan_reversals(history: DataFrame, load_ids: DataFrame, config: DataFrame) -> DataFrame:
    """GOV5: sent exports of quarantined loads -> skip (unknown destination) / failure (irreversible) / reverse."""
    t = load_ids.select(F.col("load_id").alias("_target")).distinct()
    sent = history.join(t, history["data_load_id"] == t["_target"], "left_semi")
    j = sent.join(config.select("destination", "is_reversible"), "destination", "left")
    return j.select("*", F.when(F.col("is_reversible").isNull(), "skip_unknown_destination")
                    .when(~F.col("is_reversible"), "cannot_reverse").otherwise("reverse").alias("reversal_action"))


def load_health(loads: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """AGG18: per source type and state over the last ``days``."""
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    return loads.filter(F.col("loaded_at") >= since).groupBy("source_type", "state_code").agg(
        F.max("source_date").alias("latest_source_date"), F.max("loaded_at").alias("latest_load"),
        F.count_if(F.col("status") == "promoted").cast("bigint").alias("promoted_loads"),
        F.count_if(F.col("status") == "quarantined").cast("bigint").alias("quarantined_loads"),
        F.avg(F.col("row_count").cast("double")).alias("avg_row_count"),
        F.round(F.avg(F.col("row_count_delta_pct").cast("double")).cast("decimal(38,12)"), 6).cast("double")
        .alias("avg_delta_pct"))


def register_load(loads: DataFrame, new_loads: DataFrame, as_of: str) -> DataFrame:
    """GOV1: append new load rows (created/updated at ``as_of``); an existing load id is left as is."""
    from ..sources.io import merge_upsert
    now = F.lit(as_of).cast("timestamp_ntz")
    add = new_loads.select("*", now.alias("created_at"), now.alias("updated_at"))
    return merge_upsert(loads, add, ["load_id"], mode="insert_only")


def update_load(loads: DataFrame, updates: DataFrame, as_of: str) -> DataFrame:
    """GOV1: set the given fields of existing loads (``updates`` has load_id + changed columns).

    A field that the table does not have yet is appended, NULL for the other loads. A load named several times takes
    its greatest row of ``updates`` (in column order, NULL least), so it stays one row.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    changed = [c for c in updates.columns if c != "load_id"]
    once = updates.groupBy("load_id").agg(F.max(F.struct(*changed)).alias("_row")).select("load_id", "_row.*") if changed \
        else updates.select("load_id").distinct()
    u = once.select(F.col("load_id").alias("_u"), *[F.col(c).alias(f"_u_{c}") for c in changed])
    j = loads.join(u, loads["load_id"] == u["_u"], "left")
    hit = F.col("_u").isNotNull()
    cols = [F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in loads.columns if c != "updated_at"]
    upd = F.when(hit, now).otherwise(F.col("updated_at") if "updated_at" in loads.columns
                                     else F.lit(None).cast("timestamp_ntz")).alias("updated_at")
    new = [F.col(f"_u_{c}").alias(c) for c in changed if c not in loads.columns and c != "updated_at"]
    return j.select(*cols, *new, upd)
