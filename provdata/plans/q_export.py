"""Export queue queries (JOIN11-12, EXP1-10, TOP3-4, AGG17, AGG19, JOIN9-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export as X
from ..operators import governance as G
from ..sources.bindings import AS_OF, binding, data_loads, export_history, sql_cte
from .registry import query

_CFG = """cfg as (select * replace (cast(cost_per_record as double) as cost_per_record) from (values
  ('ghl', 0.0, true, true, 70, 0, cast(null as integer), true),
  ('instantly', 0.01, false, true, 85, 0, 500, true),
  ('lob_postcard', 0.50, true, false, 95, 24, cast(null as integer), true),
  ('lob_letter', 1.50, true, false, 95, 48, cast(null as integer), true),
  ('webhook', 0.0, false, true, 70, 0, cast(null as integer), true))
  v(destination, cost_per_record, is_reversible, auto_approve, min_confidence_for_auto, delay_hours, rate_limit_per_day, is_active))"""

_SUPP_KEYS = f"""sk as (
  select destination as s_destination, 'email' as key_type, lower(email) as key from suppression_list
    where coalesce(is_active, true) and (expires_at is null or cast(expires_at as timestamp) > timestamp '{AS_OF}') and email is not null and email <> ''
  union all select destination, 'license', license_number from suppression_list
    where coalesce(is_active, true) and (expires_at is null or cast(expires_at as timestamp) > timestamp '{AS_OF}') and license_number is not null and license_number <> ''
  union all select destination, 'npi', npi from suppression_list
    where coalesce(is_active, true) and (expires_at is null or cast(expires_at as timestamp) > timestamp '{AS_OF}') and npi is not null and npi <> ''
)"""

_BASE = sql_cte("export_queue", "suppression_list", "data_loads") + f", {_CFG}, {_SUPP_KEYS}"


def _queue(spark, sf):
    return binding(spark, sf, "export_queue")


def _records(spark, sf):
    """Queue rows with the payload's NPI (the provider id of an NPI-keyed export)."""
    return _queue(spark, sf).withColumn("npi_number", F.col("provider_id"))


def _supp(spark, sf):
    return binding(spark, sf, "suppression_list")


# Oracle: the warehouse view's NOT EXISTS with the OR of three keys, after approving every queued row.
@query("exports_ready_to_send", _BASE + f"""
, approved as (select * replace (case when status = 'queued' then 'approved' else status end as status) from export_queue)
select q.* from approved q join data_loads l on q.data_load_id = l.load_id join cfg c on q.destination = c.destination
where q.status = 'approved' and l.status = 'promoted' and c.is_active
  and not exists (select 1 from suppression_list s where coalesce(s.is_active, true)
    and (s.destination is null or s.destination = q.destination)
    and (s.expires_at is null or cast(s.expires_at as timestamp) > timestamp '{AS_OF}')
    and (s.license_number = q.license_number or lower(s.email) = lower(q.email) or s.npi = q.provider_id))
""", "JOIN12, JOIN11")
def q_ready(spark, sf):
    q = _queue(spark, sf)
    approved = X.approve(_records(spark, sf), AS_OF)
    ready = X.exports_ready(approved, data_loads(spark, sf), G.destination_config(spark), _supp(spark, sf), AS_OF)
    return ready.select(*q.columns)


@query("suppressed_exports", _BASE + f"""
select q.export_id from export_queue q where exists (select 1 from suppression_list s where coalesce(s.is_active, true)
    and (s.destination is null or s.destination = q.destination)
    and (s.expires_at is null or cast(s.expires_at as timestamp) > timestamp '{AS_OF}')
    and (s.license_number = q.license_number or lower(s.email) = lower(q.email) or s.npi = q.provider_id))
""", "JOIN11")
def q_suppressed(spark, sf):
    return X.suppressed_ids(_records(spark, sf), _supp(spark, sf), AS_OF, "export_id") \
        .select(F.col("_rid").alias("export_id"))


# EXP1: re-offer failed/cancelled exports to their destination, in export id order.
_RETRY = "status in ('failed', 'cancelled')"

_ENQ_SQL = _BASE + f""",
rec as (select *, cast(export_id as bigint) as rid from export_queue where {_RETRY}),
rk as (
  select rid, destination as r_destination, 'email' as key_type, lower(email) as key from rec where email is not null and email <> ''
  union all select rid, destination, 'license', license_number from rec where license_number is not null and license_number <> ''
  union all select rid, destination, 'npi', provider_id from rec where provider_id is not null and provider_id <> ''
),
sup as (select distinct rid from rk join sk using (key_type, key) where s_destination is null or s_destination = r_destination),
act as (select distinct provider_id, destination from export_queue where status in ('queued', 'approved', 'scheduled')),
flag as (
  select rec.*, sup.rid is not null as is_sup, act.provider_id is not null as is_act,
    coalesce(provider_id, '') <> '' as has_id
  from rec left join sup on rec.rid = sup.rid left join act using (provider_id, destination)
),
firsts as (select provider_id, destination, min(rid) as first_rid from flag where has_id and not is_sup and not is_act
           group by provider_id, destination),
outc as (
  select f.*, case when not has_id then 'skipped' when is_sup then 'suppressed'
    when is_act or f.rid <> fi.first_rid then 'skipped' else 'queued' end as outcome,
    c.auto_approve and coalesce(match_confidence, 0) >= c.min_confidence_for_auto as auto, c.delay_hours
  from flag f left join firsts fi using (provider_id, destination) left join cfg c using (destination)
)
"""


def _enqueue(spark, sf):
    q = _queue(spark, sf)
    recs = _records(spark, sf).filter(F.expr(_RETRY)).withColumn("rid", F.col("export_id").cast("bigint"))
    return X.enqueue(recs, q, _supp(spark, sf), G.destination_config(spark), "retry-2025-06-30", AS_OF, "rid")


@query("enqueue_outcomes", _ENQ_SQL + f"""
select export_id, provider_id, destination, status, data_load_id, match_confidence, email, license_number, queued_at,
  provider_id as npi_number, rid, outcome,
  case when outcome = 'queued' then left(md5(concat_ws('-', provider_id, destination, '{AS_OF}', cast(rid as varchar))), 12) end as new_export_id,
  case when outcome = 'queued' then case when auto then 'approved' else 'queued' end end as new_status,
  case when outcome = 'queued' then not auto end as requires_approval,
  case when outcome = 'queued' and auto then timestamp '{AS_OF}' end as approved_at,
  case when outcome = 'queued' and auto then 'auto' end as approved_by,
  case when outcome = 'queued' and delay_hours > 0 then timestamp '{AS_OF}' + interval 1 hour * delay_hours end as scheduled_send_at,
  case when outcome = 'queued' then 'retry-2025-06-30' end as new_data_load_id
from outc
""", "EXP1, JOIN11, KEY2")
def q_enqueue(spark, sf):
    return _enqueue(spark, sf)


@query("enqueue_counts", _ENQ_SQL + """
select cast(count_if(outcome = 'queued') as bigint) as queued, cast(count_if(outcome = 'queued' and auto) as bigint) as auto_approved,
  cast(count_if(outcome = 'suppressed') as bigint) as suppressed, cast(count_if(outcome = 'skipped') as bigint) as skipped
from outc
""", "EXP1 counts")
def q_enqueue_counts(spark, sf):
    return X.enqueue_counts(_enqueue(spark, sf))


@query("pending_approval", sql_cte("export_queue") + """
select * from export_queue where status = 'queued' and destination = 'lob_letter'
""", "EXP2")
def q_pending(spark, sf):
    return X.pending_approval(_queue(spark, sf), "lob_letter")


@query("approve_exports", sql_cte("export_queue") + f"""
select export_id, provider_id, destination, data_load_id, match_confidence, email, license_number, queued_at,
  case when status = 'queued' and match_confidence >= 80 and destination = 'ghl' then 'approved' else status end as status,
  case when status = 'queued' and match_confidence >= 80 and destination = 'ghl' then timestamp '{AS_OF}' end as approved_at,
  case when status = 'queued' and match_confidence >= 80 and destination = 'ghl' then 'manual' end as approved_by
from export_queue
""", "EXP3")
def q_approve(spark, sf):
    return X.approve(_queue(spark, sf), AS_OF, destination="ghl", min_confidence=80)


@query("ready_to_send_fifo", sql_cte("export_queue") + """
select * from export_queue where status = 'approved' and destination = 'instantly'
order by queued_at, export_id limit 100
""", "EXP4, TOP3")
def q_ready_fifo(spark, sf):
    return X.ready_to_send(_queue(spark, sf), AS_OF, "instantly", 100)


_SEND_SQL = sql_cte("export_queue") + f""", {_CFG},
res as (select export_id, 'ext-' || export_id as external_id,
          case when cast(export_id as bigint) % 9 = 0 then 'HTTP 500' end as error
        from export_queue where status = 'approved'),
two as (select * from res union all
        select export_id, 'again-' || export_id, case when cast(export_id as bigint) % 2 = 0 then 'late retry' end
        from export_queue where status = 'approved' and cast(export_id as bigint) % 9 in (0, 4)),
one as (select * exclude (rn) from (select *, row_number() over (
          partition by export_id order by error is not null, external_id, error) as rn from two) where rn = 1)
"""


def _send(spark, sf):
    q = _queue(spark, sf)
    ok, number = q.filter(F.col("status") == "approved"), F.col("export_id").cast("bigint")
    res = ok.select("export_id", F.concat(F.lit("ext-"), F.col("export_id")).alias("external_id"),
                    F.when(number % 9 == 0, F.lit("HTTP 500")).alias("error"))
    again = ok.filter((number % 9).isin(0, 4)).select(
        "export_id", F.concat(F.lit("again-"), F.col("export_id")),
        F.when(number % 2 == 0, F.lit("late retry")))
    res = res.union(again)
    return X.apply_send_results(q, res, G.destination_config(spark), AS_OF)


@query("send_results_queue_status", _SEND_SQL + """
select destination, case when r.export_id is null then q.status when r.error is not null then 'failed' else 'sent' end as status,
  count(*) as exports
from export_queue q left join one r using (export_id) group by 1, 2
""", "EXP5 (queue; several results of one export)")
def q_send_queue(spark, sf):
    return _send(spark, sf)[0].groupBy("destination", "status").agg(F.count(F.lit(1)).alias("exports"))


@query("send_results_history", _SEND_SQL + f"""
select left(md5(q.export_id || '-sent'), 12) as history_id, q.export_id, q.provider_id, q.destination,
  timestamp '{AS_OF}' as sent_at, r.external_id, coalesce(c.cost_per_record, 0.0) as estimated_cost
from export_queue q join one r using (export_id) left join cfg c on q.destination = c.destination where r.error is null
""", "EXP5 (history)")
def q_send_hist(spark, sf):
    return _send(spark, sf)[1]


SEND_TIME = "1998-08-02 12:00:00"


@query("rate_limited_sends", sql_cte("export_queue", "export_history") + f""", {_CFG},
sent as (select destination, count(*) as n from export_history where cast(sent_at as date) = date '1998-08-02' group by 1),
r as (select q.*, c.rate_limit_per_day, cast(greatest(c.rate_limit_per_day - coalesce(sent.n, 0), 0) as integer) as allowed
      from export_queue q left join cfg c using (destination) left join sent using (destination) where q.status = 'approved'),
ranked as (select *, row_number() over (partition by destination order by queued_at, export_id) as rn from r
           where rate_limit_per_day is not null)
select * exclude (rn), cast(rn as integer) as rank_in_group from ranked where rn <= allowed
union all select * replace (cast(null as integer) as allowed), cast(null as integer) from r where rate_limit_per_day is null
""", "EXP8 (day's cap over all queue days, less what was sent)")
def q_rate_limited(spark, sf):
    return X.rate_limited(_queue(spark, sf), G.destination_config(spark), SEND_TIME, export_history(spark, sf))


# A tight hourly cap on two destinations, so that both caps and the sent history bind on small tables.
@query("rate_limited_by_hour", sql_cte("export_queue", "export_history") + f"""
, caps as (select * from (values ('ghl', 7, 40), ('instantly', cast(null as integer), 25)) v(destination, per_hour, per_day)),
sent as (select destination, count_if(cast(sent_at as date) = date '1998-08-02') as d,
    count_if(date_trunc('hour', sent_at) = timestamp '{SEND_TIME}') as h from export_history group by 1),
a as (select c.destination, per_day as rate_limit_per_day,
    cast(greatest(least(per_day - coalesce(d, 0), per_hour - coalesce(h, 0)), 0) as integer) as allowed
  from caps c left join sent using (destination)),
ranked as (select q.*, a.rate_limit_per_day, a.allowed, row_number() over (partition by destination order by queued_at, export_id) as rn
           from export_queue q join a using (destination) where status = 'approved')
select destination, rate_limit_per_day, allowed, count(*) as sends, max(queued_at) as last_queued_at
from ranked where rn <= allowed group by all
""", "EXP8 (hourly cap)")
def q_rate_hour(spark, sf):
    caps = spark.createDataFrame([("ghl", 7, 40), ("instantly", None, 25)],
                                 "destination string, rate_limit_per_hour int, rate_limit_per_day int")
    return (X.rate_limited(_queue(spark, sf), caps, SEND_TIME, export_history(spark, sf)).where("allowed is not null")
            .groupBy("destination", "rate_limit_per_day", "allowed")
            .agg(F.count(F.lit(1)).alias("sends"), F.max("queued_at").alias("last_queued_at")))


@query("export_daily_summary", sql_cte("export_queue", "export_history") + f""", {_CFG}
select cast(sent_at as date) as send_date, h.destination, count(*) as total_sent,
  cast(round(cast(sum(coalesce(c.cost_per_record, 0.0)) as decimal(38,12)), 6) as double) as estimated_cost,
  cast(count_if(delivery_status = 'bounced') as bigint) as bounces,
  cast(count_if(delivery_status = 'complained') as bigint) as complaints
from export_history h left join cfg c on h.destination = c.destination group by 1, 2
""", "AGG17")
def q_daily_summary(spark, sf):
    return X.export_daily_summary(export_history(spark, sf), G.destination_config(spark))


QUEUE_DAY = "1998-08-02"


@query("queue_status", sql_cte("export_queue", "export_history") + f"""
, q as (select destination, count(*) as total,
  cast(count_if(status = 'queued') as bigint) as queued, cast(count_if(status = 'approved') as bigint) as approved,
  cast(count_if(status = 'scheduled') as bigint) as scheduled, cast(count_if(status = 'sent') as bigint) as sent,
  cast(count_if(status = 'failed') as bigint) as failed, cast(count_if(status = 'cancelled') as bigint) as cancelled,
  cast(count_if(status = 'queued') as bigint) as pending_approval, cast(count_if(status = 'approved') as bigint) as ready_to_send
  from export_queue group by destination),
h as (select destination, cast(count_if(cast(sent_at as date) = date '{QUEUE_DAY}') as bigint) as sent_today,
  count(*) as sent_all_time from export_history group by destination)
select coalesce(q.destination, h.destination) as destination, coalesce(total, 0) as total, coalesce(queued, 0) as queued,
  coalesce(approved, 0) as approved, coalesce(scheduled, 0) as scheduled, coalesce(sent, 0) as sent,
  coalesce(failed, 0) as failed, coalesce(cancelled, 0) as cancelled, coalesce(pending_approval, 0) as pending_approval,
  coalesce(ready_to_send, 0) as ready_to_send, coalesce(sent_today, 0) as sent_today, coalesce(sent_all_time, 0) as sent_all_time
from q full outer join h on q.destination = h.destination
""", "AGG19")
def q_queue_status(spark, sf):
    return X.queue_status(_queue(spark, sf), export_history(spark, sf), QUEUE_DAY)


def _crm_sql():
    from .q_enrich import GOLDEN_SQL
    return GOLDEN_SQL + """,
p as (select provider_id, cast(json_object('locationId', 'loc-1', 'firstName', first_name, 'lastName', last_name,
    'email', email, 'phone', phone, 'address1', address1, 'city', city, 'state', state, 'postalCode', zip_code,
    'source', 'License Pipeline', 'tags', list_filter(['license_' || coalesce(professional_type, 'unknown'),
      'state_' || coalesce(license_state, 'unknown'), case when coalesce(is_new_licensee, false) then 'new_licensee' end],
      lambda x: x is not null)) as varchar) as payload from golden)
select provider_id, payload, sha256(payload) as payload_hash from p
"""


@query("crm_contact_payloads", _crm_sql(), "EXP7, EXP10")
def q_payloads(spark, sf):
    from .q_enrich import golden
    return X.payload_hash(X.crm_contact_payload(golden(spark, sf), "loc-1"))
