"""Licence snapshots as a stream -> history + change events (STR4).

A snapshot date arrives as any number of files over any number of micro-batches. A manifest names
the rows that each (snapshot_date, professional_type) has in all, and a date is applied only when every
type of it has landed whole, in date order: a later date waits for an earlier one. What cannot be applied
is not lost: its rows stay in the landing area, and the loads table says why.

Under ``base``:

* ``landing/batch=<n>/snapshot_date=<d>``: the raw rows of each micro-batch, written before anything else; a replayed
  micro-batch overwrites its own folder. A date is read from its own folders alone.
* ``ledger``: rows per micro-batch, date and type, of undecided dates only. What a micro-batch decides on is this small
  table and the rows it landed itself, so the rows read do not grow with the dates landed.
* ``latest``: the last version of every key, open or closed (merge-on-read, so a snapshot writes the keys that changed).
* ``superseded/day=<d>``: the versions that day ``d`` replaced, written once and never again.
* ``events``: change events, merged insert-only by event id. They come from the changed keys and their last versions:
  neither the history nor the events before are read.
* ``loads``: one row per decided date: applied, or quarantined with its reason.

Every step can be replayed: a day's changes are computed once and kept (``steps/day=<d>``) until ``latest`` has them,
which comes last; superseded versions are skipped when they are there, and events merge insert-only. The same snapshot
applied twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean as C
from ..operators import events as E
from ..operators import history as H
from ..operators import staging as ST
from ..operators.providers import latest_per_key
from ..sources import io as IO
from ..sources.keyed import KeyedTable

KEY = "professional_id"
#: Rows of a landed file at most: a date is read by as many tasks as its rows want, however few files it came in.
LANDED_ROWS = 50_000
LOADS_SCHEMA = "snapshot_date string, status string, rows long, expected_rows long, keys long, open_before long, reason string"
LEDGER_SCHEMA = "batch long, snapshot_date string, professional_type string, rows long"


def latest_table(spark: SparkSession, base: str) -> KeyedTable:
    return KeyedTable(spark, f"{base}/latest", [KEY])


def events_table(spark: SparkSession, base: str) -> KeyedTable:
    return KeyedTable(spark, f"{base}/events", ["event_id"])


def loads_table(spark: SparkSession, base: str) -> KeyedTable:
    return KeyedTable(spark, f"{base}/loads", ["snapshot_date"], buckets=1)


def ledger_table(spark: SparkSession, base: str) -> KeyedTable:
    return KeyedTable(spark, f"{base}/ledger", ["batch", "snapshot_date", "professional_type"], buckets=1)


def read_history(spark: SparkSession, base: str) -> DataFrame | None:
    """The whole history: the last versions and those before them."""
    latest = latest_table(spark, base).read()
    if latest is None:
        return None
    old = f"{base}/superseded"
    if not IO.exists(spark, old):
        return latest
    return latest.unionByName(spark.read.schema(latest.schema).parquet(old).select(*latest.columns))


def read_events(spark: SparkSession, base: str) -> DataFrame | None:
    return events_table(spark, base).read()


def read_loads(spark: SparkSession, base: str) -> DataFrame:
    found = loads_table(spark, base).read()
    return spark.createDataFrame([], LOADS_SCHEMA) if found is None else found


def read_ledger(spark: SparkSession, base: str) -> DataFrame:
    found = ledger_table(spark, base).read()
    return spark.createDataFrame([], LEDGER_SCHEMA) if found is None else found


def date_states(ledger: DataFrame, manifest: DataFrame, loads: DataFrame) -> DataFrame:
    """Undecided dates of the manifest, with their rows landed and expected, and whether a type lacks or exceeds its rows."""
    expected = manifest.groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date"), "professional_type").agg(
        F.max("rows").alias("expected"))
    got = ledger.groupBy("snapshot_date", "professional_type").agg(F.sum("rows").alias("rows"))
    both = expected.join(got, ["snapshot_date", "professional_type"], "full_outer")
    rows, want = F.coalesce("rows", F.lit(0)), F.coalesce("expected", F.lit(0))
    # Rows of a type or date that the manifest does not name (want = 0) are surplus once the manifest names the date.
    per = both.groupBy("snapshot_date").agg(F.sum(rows).alias("rows"), F.sum(want).alias("expected_rows"),
                                            F.max((rows < want).cast("int")).alias("lacking"),
                                            F.max((rows > want).cast("int")).alias("surplus"))
    return (per.where("expected_rows > 0").join(loads.select("snapshot_date"), "snapshot_date", "left_anti"))


def apply_snapshot(spark: SparkSession, raw_snapshot: DataFrame, day: str, base: str,
                   check_cols: Sequence[str] = tuple(H.LICENSE_CHECK_COLS), as_of: str | None = None,
                   max_delta_pct: float | None = 0.20) -> dict:
    """Apply one whole raw snapshot (all licence kinds of one date) to the history and events under ``base``.

    A partial export must not close most of the history: when the snapshot's key count differs
    from the open versions by more than ``max_delta_pct`` (the row-count-delta rule) nothing is written.
    Returns the decision: status ``applied`` or ``quarantined``, keys, open_before, reason.
    """
    staged = ST.stage_tx(raw_snapshot)
    snap = latest_per_key(staged, [KEY], [F.col("source_license_id")])
    table = latest_table(spark, base)
    latest = table.read()
    # Both counts take the columns they need alone: a whole row per key would be shuffled to be counted.
    keys = staged.select(KEY).distinct().count()
    open_before = 0 if latest is None else table.read(only=["valid_to"]).where("valid_to is null").count()
    if latest is not None and max_delta_pct is not None and abs(keys - open_before) > max_delta_pct * max(open_before, 1):
        return {"status": "quarantined", "keys": keys, "open_before": open_before,
                "reason": f"key count moved by more than {max_delta_pct:.0%}"}
    step = f"{base}/steps/day={day}"
    if not IO.exists(spark, f"{step}/_SUCCESS"):
        changed_versions(latest, snap, check_cols, day).write.mode("overwrite").parquet(step)
    done = spark.read.parquet(step)
    if latest is not None and not IO.exists(spark, f"{base}/superseded/day={day}/_SUCCESS"):
        done.where("replaced").select("old.*").write.mode("overwrite").parquet(f"{base}/superseded/day={day}")
    prev = F.when(F.col("old").isNotNull(), F.struct(*[F.col(f"old.{c}").alias(n) for c, n in E.PREV_FIELDS]))
    opened = done.where("opened").select("new.*", prev.alias("prev"))
    events_table(spark, base).upsert(E.version_events(opened, as_of or day), "insert_only")
    table.upsert(done.select("new.*"), one_per_key=True)  # of keys joined one to one
    return {"status": "applied", "keys": keys, "open_before": open_before, "reason": None}


def changed_versions(latest: DataFrame | None, snapshot: DataFrame, check_cols: Sequence[str], day: str) -> DataFrame:
    """HIS1 over last versions, changes only: ``old`` and ``new`` version of each key whose last version changes.

    ``opened``: the snapshot opens a version (new key, changed, or back again); ``replaced``: the old one then belongs to
    the history. A key that is gone has its last version closed.
    """
    ts = F.lit(day).cast("timestamp_ntz")
    fields = snapshot.columns
    fresh = F.struct(*[F.col(f"s.{c}").alias(c) for c in fields], C.surrogate_key(F.col(f"s.{KEY}"), ts).alias("scd_id"),
                     ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    if latest is None:
        new = snapshot.alias("s").select(fresh.alias("new"))
        return new.select(F.lit(None).cast(new.schema["new"].dataType).alias("old"), "new", F.lit(True).alias("opened"),
                          F.lit(False).alias("replaced"))
    j = latest.select(*fields, "scd_id", "valid_from", "valid_to").alias("c").join(
        snapshot.alias("s"), F.col(f"c.{KEY}") == F.col(f"s.{KEY}"), "full_outer")
    had, has = F.col(f"c.{KEY}").isNotNull(), F.col(f"s.{KEY}").isNotNull()
    was_open = had & F.col("c.valid_to").isNull()
    opened = has & (~was_open | H.changed(check_cols))
    gone = was_open & ~has
    old = [F.col(f"c.{c}").alias(c) for c in [*fields, "scd_id", "valid_from"]]
    ended = F.struct(*old, F.when(was_open, ts).otherwise(F.col("c.valid_to")).alias("valid_to"))
    return j.where(opened | gone).select(
        F.when(had, ended).alias("old"), F.when(opened, fresh).otherwise(ended).alias("new"), opened.alias("opened"),
        (opened & had).alias("replaced"))


def _decide(spark: SparkSession, base: str, day: str, rows: int, expected: int, decision: dict) -> None:
    row = (day, decision["status"], rows, expected, decision.get("keys"), decision.get("open_before"), decision["reason"])
    loads_table(spark, base).upsert(spark.createDataFrame([row], LOADS_SCHEMA))
    ledger_table(spark, base).delete(read_ledger(spark, base).where(F.col("snapshot_date") == day))


def apply_complete_dates(spark: SparkSession, base: str, schema, manifest: DataFrame, as_of: str | None = None,
                         max_delta_pct: float | None = 0.20) -> None:
    """Decide every date that has landed whole, oldest first, up to the first that has not."""
    # One row per undecided date of the manifest: metadata, not data.
    for r in date_states(read_ledger(spark, base), manifest, read_loads(spark, base)).orderBy("snapshot_date").collect():
        if r["lacking"]:
            break
        if r["surplus"]:
            decision = {"status": "quarantined", "reason": "more rows than the manifest names"}
        else:
            decision = apply_snapshot(spark, landed(spark, base, schema, r["snapshot_date"]), r["snapshot_date"], base,
                                      as_of=as_of, max_delta_pct=max_delta_pct)
        _decide(spark, base, r["snapshot_date"], r["rows"], r["expected_rows"], decision)


def landed(spark: SparkSession, base: str, schema, day: str) -> DataFrame:
    """The landed raw rows of one date (a partition filter), without the date."""
    rest = [f for f in schema.fields if f.name != "snapshot_date"]
    rows = (spark.read.option("basePath", f"{base}/landing").schema(T.StructType([*rest, T.StructField("snapshot_date", T.StringType())]))
            .parquet(f"{base}/landing"))
    return rows.where(F.col("snapshot_date") == day).select(*[f.name for f in rest])


def land(batch: DataFrame, batch_id: int, base: str) -> None:
    """Write a micro-batch's rows by date and enter their numbers; a replay overwrites both."""
    spark = batch.sparkSession
    folder = f"{base}/landing/batch={batch_id}"
    (batch.withColumn("snapshot_date", F.col("snapshot_date").cast("string")).write.mode("overwrite")
     .option("maxRecordsPerFile", LANDED_ROWS).partitionBy("snapshot_date").parquet(folder))
    rows = spark.read.schema(T.StructType([T.StructField("professional_type", T.StringType()),
                                           T.StructField("snapshot_date", T.StringType())])).parquet(folder)
    decided = read_loads(spark, base).select("snapshot_date")
    counts = (rows.groupBy("snapshot_date", "professional_type").agg(F.count(F.lit(1)).alias("rows"))
              .join(decided, "snapshot_date", "left_anti").withColumn("batch", F.lit(batch_id).cast("long")))
    ledger_table(spark, base).upsert(counts.select("batch", "snapshot_date", "professional_type", "rows"))


def release_snapshot(spark: SparkSession, base: str, schema, day: str, as_of: str | None = None) -> None:
    """Apply a quarantined date after all, from its landed rows; only while no later date has been applied."""
    loads = {r["snapshot_date"]: r for r in read_loads(spark, base).collect()}  # one row per decided date
    if loads.get(day, {"status": None})["status"] != "quarantined":
        raise ValueError(f"{day} is not in quarantine")
    if any(d > day and r["status"] == "applied" for d, r in loads.items()):
        raise ValueError(f"a date later than {day} has been applied")
    decision = apply_snapshot(spark, landed(spark, base, schema, day), day, base, as_of=as_of, max_delta_pct=None)
    _decide(spark, base, day, loads[day]["rows"], loads[day]["expected_rows"], decision)


def change_events_stream(spark: SparkSession, snapshot_dir: str, schema, manifest_path: str, base: str, checkpoint_dir: str,
                         as_of: str | None = None, max_files: int = 1, max_delta_pct: float | None = 0.20):
    """STR4: start the stream over the files under ``snapshot_dir``; returns the query.

    ``manifest_path`` is a Parquet table (snapshot_date, professional_type, rows); it is read anew for each
    micro-batch, so it may grow with the dates.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(snapshot_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id, base)
        apply_complete_dates(spark, base, schema, spark.read.parquet(manifest_path), as_of, max_delta_pct)

    return (raw.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def run_change_events(spark: SparkSession, snapshot_dir: str, schema, manifest_path: str, base: str, checkpoint_dir: str,
                      timeout_s: int = 3600, **options) -> None:
    """Run the stream over everything available; raises if it fails or does not finish in time."""
    from .leads import _finish
    _finish(change_events_stream(spark, snapshot_dir, schema, manifest_path, base, checkpoint_dir, **options), timeout_s)
