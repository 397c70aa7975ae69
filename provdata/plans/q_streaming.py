"""Touchpoint stream operators, run as their batch twins (STR1-3, STR5-6, HIS2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import history as H
from ..session import ensure_checkpoint_dir
from ..sources.bindings import AS_OF, TOUCHPOINTS, binding, sql_cte
from ..streaming import changes as CH
from ..streaming import engagement as G
from ..streaming import leads as L
from .memo import per_session
from .q_staging import _EVENTS_SQL, HISTORY_SQL, SNAPSHOTS_SQL
from .registry import query

_TP = sql_cte("touchpoints")


def touchpoints(spark, sf):
    return binding(spark, sf, "touchpoints")


@query("lead_rollup", _TP + """
select lead_id, cast(count_if(event_type = 'email_sent') as bigint) as total_emails_sent,
  cast(count_if(event_type = 'email_open') as bigint) as total_opens,
  cast(count_if(event_type in ('email_click', 'ad_click')) as bigint) as total_clicks,
  cast(count_if(event_type = 'page_view') as bigint) as total_page_views, count(*) as total_touchpoints,
  min(event_timestamp) as first_seen_at,
  max(case when event_type not in ('email_sent', 'ad_impression') then event_timestamp end) as last_engaged_at
from touchpoints group by lead_id
""", "STR1 (batch twin)")
def q_lead_rollup(spark, sf):
    return L.lead_rollup(touchpoints(spark, sf))


@query("lead_stage", _TP + """
, g as (select lead_id, max(case when event_type in ('email_sent', 'ad_impression') then 1
    when event_type in ('email_open', 'email_click', 'ad_click', 'page_view') then 2 when event_type = 'form_submit' then 3
    when event_type = 'demo_booked' then 4 when event_type = 'deal_won' then 5 else 1 end) as stage_rank
  from touchpoints group by lead_id)
select lead_id, stage_rank, case stage_rank when 1 then 'new' when 2 then 'engaged' when 3 then 'qualified'
  when 4 then 'opportunity' when 5 then 'customer' end as current_stage from g
""", "STR6 (batch twin)")
def q_lead_stage(spark, sf):
    return L.lead_stage(touchpoints(spark, sf))


@query("attribution_daily", _TP + """
select date_trunc('day', event_timestamp) as window_start, date_trunc('day', event_timestamp) + interval 1 day as window_end,
  channel, campaign_id, event_type, count(*) as touchpoints
from touchpoints group by all
""", "STR2 (tumbling window, batch twin)")
def q_attribution_daily(spark, sf):
    return L.attribution_rollup(touchpoints(spark, sf))


@query("attribution_sliding", _TP + """
, hops as (select *, unnest(range(0, 4)) as h from touchpoints),
w as (select *, date_trunc('hour', event_timestamp) - interval 1 hour * (hour(event_timestamp) % 6) - interval 6 hour * h
        as window_start from hops)
select window_start, window_start + interval 1 day as window_end, channel, campaign_id, event_type, count(*) as touchpoints
from w group by all
""", "STR2 (sliding 1-day windows every 6 hours, batch twin)")
def q_attribution_sliding(spark, sf):
    return L.attribution_rollup(touchpoints(spark, sf), window="1 day", slide="6 hours")


@query("channel_attribution", _TP + """
select channel, campaign_id, event_type, count(*) as touchpoints, count(distinct lead_id) as leads
from touchpoints group by all
""", "STR2 (exact distinct leads)")
def q_channel_attr(spark, sf):
    return L.channel_attribution(touchpoints(spark, sf))


@query("dedupe_events", _TP + """
select * from (select *, row_number() over (partition by event_id order by event_timestamp) as rn from touchpoints)
where rn = 1
""".replace("select * from (", "select * exclude (rn) from ("), "STR3 (batch twin)")
def q_dedupe(spark, sf):
    return L.dedupe_events(touchpoints(spark, sf))


_ENGAGEMENT_SQL = _TP + """
, base as (select lead_id, count(*) as events, count(distinct cast(event_timestamp as date)) as active_days,
    cast(count_if(dayofweek(event_timestamp) = 0) as bigint) as dow_1, cast(count_if(dayofweek(event_timestamp) = 1) as bigint) as dow_2,
    cast(count_if(dayofweek(event_timestamp) = 2) as bigint) as dow_3, cast(count_if(dayofweek(event_timestamp) = 3) as bigint) as dow_4,
    cast(count_if(dayofweek(event_timestamp) = 4) as bigint) as dow_5, cast(count_if(dayofweek(event_timestamp) = 5) as bigint) as dow_6,
    cast(count_if(dayofweek(event_timestamp) = 6) as bigint) as dow_7
  from touchpoints group by lead_id),
ch as (select lead_id, channel, count(*) as n from touchpoints group by all),
top_ch as (select lead_id, channel as top_channel from (select *, row_number() over (partition by lead_id order by n desc, channel) as r from ch) where r = 1),
hr as (select lead_id, cast(hour(event_timestamp) as integer) as hour, count(*) as n from touchpoints group by all),
peak as (select lead_id, hour as peak_hour from (select *, row_number() over (partition by lead_id order by n desc, hour) as r from hr) where r = 1),
ordered as (select lead_id, event_timestamp, lag(event_timestamp) over (partition by lead_id order by event_timestamp) as prev from touchpoints),
sess as (select lead_id, count(*) as sessions from ordered where prev is null or event_timestamp - prev >= interval 30 minute group by lead_id)
select base.*, top_channel, peak_hour, sessions, cast(events as double) / active_days as events_per_active_day
from base join top_ch using (lead_id) join peak using (lead_id) join sess using (lead_id)
"""


@query("engagement_features", _ENGAGEMENT_SQL, "STR5 (batch twin)")
def q_engagement(spark, sf):
    return L.engagement_features(touchpoints(spark, sf))


def _in_three_files(spark, sf, root: str):
    """The events as three files in event-time order, so that each moves the watermark; their stream as touchpoints."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    third = F.least(F.floor((at - F.lit(low)) * 3 / F.lit(max(high - low, 1))), F.lit(2))
    for k in range(3):
        events.where(third == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    return spark.sql(TOUCHPOINTS, events=raw).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


@query("engagement_stream", _ENGAGEMENT_SQL, "STR5 (per-lead state over a stream of three files)")
def q_engagement_stream(spark, sf):
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/engagement-{uuid.uuid4().hex}"
    lead = spark.sql(TOUCHPOINTS, events=spark.read.parquet(f"{sf}/events.parquet")).schema["lead_id"].dataType
    table = G.run_engagement(spark, _in_three_files(spark, sf, root), f"{root}/out", f"{root}/progress", delay="1 hour")
    return table.read().drop("expired").withColumn("lead_id", F.col("lead_id").cast(lead))


_LEAD_WINDOWS = _TP + """
, windows as (select date_trunc('day', event_timestamp) as window_start, date_trunc('day', event_timestamp) + interval 1 day as window_end,
  channel, campaign_id, event_type, count(*) as touchpoints, count(distinct lead_id) as leads
from touchpoints group by all)
select * from windows
"""


@query("lead_windows", _LEAD_WINDOWS, "STR2 (exact distinct leads per window, batch twin)")
def q_lead_windows(spark, sf):
    return L.lead_windows(touchpoints(spark, sf))


@query("lead_windows_stream", _LEAD_WINDOWS + """
where window_end <= (select max(event_timestamp) - interval 1 hour from touchpoints)
""", "STR2 (exact distinct leads over a stream of three files: the windows that its watermark passed)")
def q_lead_windows_stream(spark, sf):
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lead-windows-{uuid.uuid4().hex}"
    out = L.run_available_now(L.lead_windows(_in_three_files(spark, sf, root)), f"{root}/progress", f"{root}/out", "append")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("touchpoint_metadata", _TP + """
select count(*) as touchpoints, cast(count(json_extract(event_metadata, '$.k')) as bigint) as with_k,
  cast(sum(cast(json_extract(event_metadata, '$.k') as integer)) as bigint) as sum_k
from touchpoints
""", "event metadata VARIANT (parse_json / variant_get)")
def q_metadata(spark, sf):
    m = L.metadata_fields(touchpoints(spark, sf))
    return m.agg(F.count(F.lit(1)).alias("touchpoints"), F.count("meta_k").cast("bigint").alias("with_k"),
                 F.sum(F.col("meta_k").cast("bigint")).alias("sum_k"))


@query("state_log_history", sql_cte("state_log") + """
, l as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as p from state_log),
v as (select user_id, ts, event_id, event_type from l where p is null or p <> event_type)
select user_id, event_type, ts as valid_from, lead(ts) over (partition by user_id order by ts, event_id) as valid_to from v
""", "HIS2")
def q_state_log_history(spark, sf):
    return H.scd2_from_changes(binding(spark, sf, "state_log"), "user_id", ["event_type"], ["ts", "event_id"])


@per_session
def change_stream(spark, sf) -> str:
    """Run STR4 over the licence files: three files per date and type, and a third date that holds half the keys.

    Returns the folder of its tables (history, events, loads).
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/change-stream-{uuid.uuid4().hex}"
    raw = binding(spark, sf, "tx_license_raw")
    half = raw.where("snapshot_date = '2025-06-30' and lic_id % 2 = 0").withColumn("snapshot_date", F.lit("2025-07-01"))
    files = raw.union(half)
    for day in ("2025-06-29", "2025-06-30", "2025-07-01"):
        for kind in ("dentist", "hygienist"):
            (files.where((F.col("snapshot_date") == day) & (F.col("professional_type") == kind))
             .repartition(3, "lic_id").write.mode("append").parquet(f"{root}/in"))
    (files.groupBy("snapshot_date", "professional_type").agg(F.count(F.lit(1)).alias("rows"))
     .write.parquet(f"{root}/manifest"))
    CH.run_change_events(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema, f"{root}/manifest", f"{root}/tables",
                         f"{root}/progress", as_of=AS_OF, max_files=5)
    return f"{root}/tables"


@query("license_stream_history", HISTORY_SQL + "select * from history", "STR4, HIS1 (stream over files)")
def q_stream_history(spark, sf):
    return CH.read_history(spark, change_stream(spark, sf))


@query("license_stream_events", _EVENTS_SQL + "select * from events_out", "STR4, EVT0-EVT10 (stream over files)")
def q_stream_events(spark, sf):
    return CH.read_events(spark, change_stream(spark, sf))


@query("license_stream_loads", SNAPSHOTS_SQL + """
, k as (select (select count(*) from s0) as k0, (select count(*) from s1) as k1,
  (select count(*) from tx_license_raw where snapshot_date = '2025-06-29') as r0,
  (select count(*) from tx_license_raw where snapshot_date = '2025-06-30') as r1,
  (select count(*) from tx_license_raw where snapshot_date = '2025-06-30' and lic_id % 2 = 0) as r2,
  (select count(distinct professional_id) from staged where snapshot_date = '2025-06-30' and source_license_id % 2 = 0) as k2)
select '2025-06-29' as snapshot_date, 'applied' as status, r0 as rows, r0 as expected_rows, k0 as keys, cast(0 as bigint) as open_before,
  cast(null as varchar) as reason from k
union all select '2025-06-30', 'applied', r1, r1, k1, k0, null from k
union all select '2025-07-01', 'quarantined', r2, r2, k2, k1, 'key count moved by more than 20%' from k
""", "STR4 (a refused snapshot is a row, not lost), SNK2 (the writer)")
def q_stream_loads(spark, sf):
    return CH.read_loads(spark, change_stream(spark, sf))
