"""Type-2 history (HIS1-HIS4).

``scd2_apply`` is the snapshot step without MERGE: only the *open* versions
take part in a full outer join with the incoming snapshot on the key;
closed history passes through untouched (``streaming.changes`` gives the step
the open versions alone and keeps closed ones in folders that are written once). Each joined
row emits up to two output rows (close old, open new) through one
``explode`` of a two-element array, so the join is evaluated once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C

# FIXED VALUES: columns whose change opens a new licence version (check strategy).
LICENSE_CHECK_COLS = [
    "status_code", "status_category", "license_expiration_date",
    "address_line_1", "address_line_2", "city", "address_state", "zip_code", "county",
    "has_nitrous_oxide_permit", "has_anesthesia_level_1", "has_anesthesia_level_2",
    "has_anesthesia_level_3", "has_anesthesia_level_4", "has_sealant_certification",
    "has_nitrous_monitoring", "has_local_infiltration_anesthesia", "has_portability",
    "has_disciplinary_action", "has_remedial_plans", "specialty_code", "practice_description",
]

HISTORY_COLS = ["scd_id", "valid_from", "valid_to"]


def changed(check_cols: Sequence[str], a: str = "c", b: str = "s") -> Column:
    """NULL-safe 'any tracked column differs' between two aliased sides (one SQL expression)."""
    return F.expr(" OR ".join(f"NOT ({a}.`{c}` <=> {b}.`{c}`)" for c in check_cols) or "false")


def _struct(side: str, cols: Sequence[str], extra: str) -> str:
    fields = ", ".join(f"'{c}', {side}.`{c}`" for c in cols)
    return f"named_struct({fields}, {extra})"


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, key: str, check_cols: Sequence[str],
               as_of: str, close_missing: bool = True) -> DataFrame:
    """HIS1: apply one full snapshot to a type-2 history.

    unchanged -> keep; changed -> close (valid_to = as_of) + open new;
    new key -> open; key absent from the snapshot -> close when
    ``close_missing``; a key that comes back later opens a new version.
    ``snapshot`` must hold one row per key (dedupe upstream).
    """
    ts = F.lit(as_of).cast("timestamp_ntz")
    cols = [c for c in snapshot.columns]
    if history is None:
        # First snapshot: every key opens a version; no join needed.
        return snapshot.select("*", C.surrogate_key(F.col(key), ts).alias("scd_id"), ts.alias("valid_from"),
                               F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    open_v = history.filter(F.col("valid_to").isNull())
    closed = history.filter(F.col("valid_to").isNotNull())
    j = open_v.alias("c").join(snapshot.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
    in_c = F.col(f"c.{key}").isNotNull()
    in_s = F.col(f"s.{key}").isNotNull()
    diff = changed(check_cols)

    # Wide structs are built as one SQL expression each (one parse, not one JVM call per column).
    def old(valid_to_sql: str) -> Column:
        return F.expr(_struct("c", cols, f"'scd_id', c.scd_id, 'valid_from', c.valid_from, 'valid_to', {valid_to_sql}"))

    ts_sql = f"CAST('{as_of}' AS TIMESTAMP_NTZ)"
    new = F.expr(_struct("s", cols,
                         f"'scd_id', md5(concat_ws('-', coalesce(CAST(s.`{key}` AS STRING), '{C.SURROGATE_NULL}'), "
                         f"CAST({ts_sql} AS STRING))), 'valid_from', {ts_sql}, "
                         f"'valid_to', CAST(NULL AS TIMESTAMP_NTZ)"))
    keep_or_close = (F.when(in_c & in_s & ~diff, old("c.valid_to"))
                     .when(in_c & in_s & diff, old(ts_sql)))
    if close_missing:
        keep_or_close = keep_or_close.when(in_c & ~in_s, old(ts_sql))
    else:
        keep_or_close = keep_or_close.when(in_c & ~in_s, old("c.valid_to"))
    opened = F.when(in_s & (~in_c | diff), new)
    rows = j.select(F.explode(F.filter(F.array(keep_or_close, opened), lambda x: x.isNotNull())).alias("r"))
    return closed.unionByName(rows.select("r.*"))


def scd2_apply_ranges(history: DataFrame, snapshot: DataFrame, inside: Column, key: str, check_cols: Sequence[str],
                      as_of: str) -> DataFrame:
    """HIS1 over the part of the keys that has changed: ``snapshot`` holds the rows of that part, ``inside`` tells its keys.

    Open versions outside pass through untouched, as they would if their equal snapshot rows were joined.
    """
    part = F.col("valid_to").isNull() & F.coalesce(inside, F.lit(False))
    return history.filter(~part).unionByName(scd2_apply(history.filter(part), snapshot, key, check_cols, as_of))


def build_history(snapshots: DataFrame, key: str, check_cols: Sequence[str], dates: Sequence[str],
                  date_col: str = "snapshot_date", checkpoint_every: int = 8) -> DataFrame:
    """HIS1 over many snapshots: apply them in date order.

    Each step's plan contains the previous one, so lineage grows with the
    number of snapshots; every ``checkpoint_every`` steps the history is
    checkpointed (reliable checkpoint under ``spark.checkpoint.dir``, which
    survives executor loss) and the plan restarts from the written data.
    ``dates`` is the (small) list of snapshot dates, not data.
    """
    hist = None
    for i, day in enumerate(sorted(dates)):
        snap = snapshots.filter(F.col(date_col) == day).drop(date_col)
        hist = scd2_apply(hist, snap, key, check_cols, day)
        if checkpoint_every and (i + 1) % checkpoint_every == 0:
            hist = hist.checkpoint(eager=True)
    return hist


def scd2_from_changes(log: DataFrame, key: str, value_cols: Sequence[str], order: Sequence[str],
                      bucket: Column | None = None) -> DataFrame:
    """HIS2: whole history from an ordered change log in one pass.

    A row opens a version when its tracked values differ (NULL-safe) from the
    previous row of the same key; a version ends where the next one starts.

    Rows are cut into ranges of (key, order) and the edges carried over
    (``carry.Ranges``), so a key holding a third of all rows is spread over
    tasks whatever its times are. With ``bucket`` (any expression that never
    decreases along ``order``, e.g. the hour of the timestamp) the windows run
    per (key, bucket) and are stitched through a per-bucket table instead; it
    writes nothing, and suits logs whose buckets are known to be small.
    Repeated rows change nothing and are dropped first.
    """
    vals = F.struct(*value_cols)
    if bucket is None:
        from .carry import Ranges
        ties = [c for c in value_cols if c not in order]
        log = log.select(key, *order, *ties).distinct()
        r = Ranges(log, [key], order, ties).previous(vals, "_prev")
        starts = r.of(r.rows.filter(F.col("_prev").isNull() | ~vals.eqNullSafe(F.col("_prev"))).drop("_prev"))
        return starts.following(F.col(order[0]), "valid_to").rows.select(
            key, *value_cols, F.col(order[0]).alias("valid_from"), "valid_to")
    from .windows import with_next_start, with_previous
    d = with_previous(log, key, order, value_cols, bucket, out="_prev")
    starts = d.filter(F.col("_prev").isNull() | ~vals.eqNullSafe(F.col("_prev"))).drop("_prev")
    out = with_next_start(starts, key, order, order[0], "valid_to")
    return out.select(key, *value_cols, F.col(order[0]).alias("valid_from"), "valid_to")


def as_of_view(history: DataFrame, ts: str) -> DataFrame:
    """HIS3: versions valid at ``ts`` (valid_from <= ts < valid_to, open = infinity)."""
    t = F.lit(ts).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def current_view(history: DataFrame) -> DataFrame:
    """HIS4."""
    return history.filter(F.col("valid_to").isNull())
