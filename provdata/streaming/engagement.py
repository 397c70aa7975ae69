"""Engagement features of a touchpoint stream (STR5): per-lead state, timers, expiry.

``engagement_stream`` keeps one small state per lead: counts by weekday, hour and channel, the days and sessions that are
still open, and totals of those that are closed. Touchpoints may come in any order within the watermark; a session is an
interval that a touch within the gap extends, and two that meet become one. What the watermark has passed can change
no more and is folded into a total, so a lead's state does not grow with its history. Timers do this for leads that stay
silent; with ``expire_after`` they also end a lead's state for good (its row then has ``expired``).

Each micro-batch emits the features of the leads it touched; ``run_engagement`` merges them into a keyed table, which then
equals ``leads.engagement_features`` over the same touchpoints.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.keyed import KeyedTable
from .leads import _finish

DAY = 86_400_000_000
STATE = ("events long, closed_days long, closed_sessions long, last long, dow array<long>, hours array<long>, "
         "channels array<struct<channel string, n long>>, days array<int>, sessions array<struct<start long, stop long>>")
DOW = [f"dow_{d}" for d in range(1, 8)]
OUTPUT = ("lead_id string, events long, active_days long, " + ", ".join(f"{d} long" for d in DOW)
          + ", top_channel string, peak_hour int, sessions long, events_per_active_day double, expired boolean")
#: Keeps Spark's state in files beside the checkpoint; the default store can't hold it.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class LeadState:
    """What is known of one lead; times are microseconds, days are numbers since 1970."""

    def __init__(self, stored: tuple | None = None):
        if stored is None:
            stored = (0, 0, 0, 0, [0] * 7, [0] * 24, [], [], [])
        self.events, self.closed_days, self.closed_sessions, self.last = stored[:4]
        self.dow, self.hours = list(stored[4]), list(stored[5])
        self.channels = {c: n for c, n in stored[6]}
        self.days, self.sessions = set(stored[7]), [(a, b) for a, b in stored[8]]

    def stored(self) -> tuple:
        return (self.events, self.closed_days, self.closed_sessions, self.last, self.dow, self.hours,
                sorted(self.channels.items(), key=str), sorted(self.days), self.sessions)

    def add(self, touches: pd.DataFrame, gap: int) -> None:
        """Touchpoints of one micro-batch: at, hour, day, dow (1 = Sunday), channel."""
        at, channels = touches["at"].to_numpy(np.int64), touches["channel"].tolist()
        self.events += len(at)
        self.last = max(self.last, int(at.max()))
        self.dow = [a + b for a, b in zip(self.dow, np.bincount(touches["dow"].to_numpy(np.int64) - 1, minlength=7).tolist())]
        self.hours = [a + b for a, b in zip(self.hours, np.bincount(touches["hour"].to_numpy(np.int64), minlength=24).tolist())]
        for c, n in Counter(channels).items():
            c = None if pd.isna(c) else c
            self.channels[c] = self.channels.get(c, 0) + n
        self.days |= set(touches["day"].tolist())
        merged: list[tuple[int, int]] = []
        for start, stop in sorted([*self.sessions, *((t, t) for t in set(at.tolist()))]):
            if merged and start - merged[-1][1] < gap:
                merged[-1] = (merged[-1][0], max(merged[-1][1], stop))
            else:
                merged.append((start, stop))
        self.sessions = merged

    def fold(self, watermark: int, gap: int) -> None:
        """Close the days and sessions that no touchpoint behind the watermark can still belong to."""
        open_sessions = [s for s in self.sessions if s[1] + gap > watermark]
        open_days = {d for d in self.days if (d + 1) * DAY > watermark}
        self.closed_sessions += len(self.sessions) - len(open_sessions)
        self.closed_days += len(self.days) - len(open_days)
        self.sessions, self.days = open_sessions, open_days

    def features(self, lead_id, expired: bool) -> pd.DataFrame:
        days = self.closed_days + len(self.days)
        top = min(self.channels.items(), key=lambda c: (-c[1], c[0] is not None, c[0] or ""))[0]
        peak = max(range(24), key=lambda h: (self.hours[h], -h))
        row = [lead_id, self.events, days, *self.dow, top, peak, self.closed_sessions + len(self.sessions), self.events / days, expired]
        return pd.DataFrame([row], columns=["lead_id", "events", "active_days", *DOW, "top_channel", "peak_hour", "sessions",
                                            "events_per_active_day", "expired"])


class EngagementProcessor(StatefulProcessor):
    def __init__(self, session_gap_s: int, expire_after_s: int | None):
        self.gap, self.expiry = session_gap_s * 1_000_000, None if expire_after_s is None else expire_after_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("lead", STATE)

    def _keep(self, lead: LeadState, watermark_ms: int) -> None:
        """Store the state, with one timer at the next moment that changes it."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        lead.fold(watermark_ms * 1000, self.gap)
        moments = [stop + self.gap for _, stop in lead.sessions] + [(d + 1) * DAY for d in lead.days]
        moments += [] if self.expiry is None else [lead.last + self.expiry]
        if moments:
            self.handle.registerTimer(max(min(moments) // 1000 + 1, watermark_ms + 1))
        self.state.update(lead.stored())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lead = LeadState(self.state.get() if self.state.exists() else None)
        for touches in rows:
            lead.add(touches, self.gap)
        yield lead.features(key[0], False)
        self._keep(lead, max(timerValues.getCurrentWatermarkInMs(), 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.state.exists():
            lead = LeadState(self.state.get())
            if self.expiry is not None and lead.last + self.expiry <= watermark * 1000:
                yield lead.features(key[0], True)
                self.state.clear()
            else:
                self._keep(lead, watermark)

    def close(self) -> None:
        pass


def engagement_stream(tp: DataFrame, ts: str = "event_timestamp", delay: str = "1 hour", session_gap_s: int = 1800,
                      expire_after_s: int | None = None) -> DataFrame:
    """STR5 over a ``readStream`` DataFrame: the features of every lead a micro-batch touches (update mode).

    Touchpoints without a lead or a time are left out, as the batch form's joins do.
    """
    at = tp.where(F.col("lead_id").isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    touches = at.select(F.col("lead_id").cast("string").alias("lead_id"), "channel", F.col(ts), F.unix_micros(ts).alias("at"),
                        F.hour(ts).alias("hour"), F.unix_date(F.to_date(ts)).alias("day"), F.dayofweek(ts).alias("dow"))
    return touches.groupBy("lead_id").transformWithStateInPandas(
        statefulProcessor=EngagementProcessor(session_gap_s, expire_after_s), outputStructType=OUTPUT, outputMode="Update",
        timeMode="EventTime")


def run_engagement(spark: SparkSession, tp: DataFrame, base: str, checkpoint_dir: str, timeout_s: int = 3600, **options) -> KeyedTable:
    """Run the stream over everything available into the keyed table at ``base`` (one row per lead)."""
    table = KeyedTable(spark, base, ["lead_id"])
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}

    def merge(batch: DataFrame, batch_id: int) -> None:
        # A lead that is touched and expires in one micro-batch has two rows; the expired one is the greater.
        KeyedTable(batch.sparkSession, base, ["lead_id"]).upsert(batch)

    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        _finish(engagement_stream(tp, **options).writeStream.outputMode("update").foreachBatch(merge)
                .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(), timeout_s)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return table
