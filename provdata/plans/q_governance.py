"""Validation and load-governance queries (VAL1-9, SNK5, GOV1-6, AGG18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance as G
from ..operators import validate as V
from ..sources.bindings import AS_OF, binding, data_loads, export_history, sql_cte
from .registry import query


def _tx_raw(spark, sf, day):
    raw = binding(spark, sf, "tx_license_raw")
    return raw.filter(F.col("snapshot_date") == day).drop("snapshot_date")


def _pct(cnt: str, n: str) -> str:
    return f"cast({cnt} as double) / {n}"


# Oracle twin: each rule as its own SELECT over the same load.
_TX_VALIDATION_SQL = sql_cte("tx_license_raw") + f""",
cur as (select * exclude (snapshot_date) from tx_license_raw where snapshot_date = '2025-06-30'),
prev as (select * from tx_license_raw where snapshot_date = '2025-06-29'),
s as (select count(*) as n,
        count_if(lic_nbr is not null and trim(lic_nbr) <> '') as p_lic,
        count_if(last_nme is not null and trim(last_nme) <> '') as p_last,
        count_if(first_nme is not null and trim(first_nme) <> '') as p_first,
        count_if(city is not null and trim(city) <> '') as p_city,
        count(try_strptime(trim(lic_orig_dte), '%m/%d/%Y')) as dv,
        count_if(try_strptime(trim(lic_orig_dte), '%m/%d/%Y')::date < date '1900-01-01') as old,
        count_if(try_strptime(trim(lic_orig_dte), '%m/%d/%Y')::date > date '{AS_OF}') as new,
        count_if(cast(lic_sta_cde as varchar) = '20') as v20
      from cur),
p as (select count(*) as pn from prev),
d as (select coalesce(sum(c) filter (where c > 1), 0) as dup from (select lic_id, count(*) as c from cur group by lic_id)),
results as (
  select 0 as rule_index, 'row_count_min' as rule_name, 'row_count_min' as rule_type, 'error' as severity,
    n >= 1000 as passed, cast(n as double) as observed, 1000.0 as threshold, '' as detail from s
  union all select 1, 'row_count_delta', 'row_count_delta', 'error', abs(n - pn) / pn <= 0.2,
    cast(abs(n - pn) as double) / pn, 0.2, '' from s, p
  union all select 2, 'field_populated_lic_nbr', 'field_populated', 'error', {_pct('p_lic', 'n')} >= 0.99, {_pct('p_lic', 'n')}, 0.99, '' from s
  union all select 3, 'field_populated_last_nme', 'field_populated', 'error', {_pct('p_last', 'n')} >= 0.99, {_pct('p_last', 'n')}, 0.99, '' from s
  union all select 4, 'field_populated_first_nme', 'field_populated', 'error', {_pct('p_first', 'n')} >= 0.98, {_pct('p_first', 'n')}, 0.98, '' from s
  union all select 5, 'field_populated_city', 'field_populated', 'error', {_pct('p_city', 'n')} >= 0.9, {_pct('p_city', 'n')}, 0.9, '' from s
  union all select 6, 'no_duplicates', 'no_duplicates', 'error', dup = 0, cast(dup as double), 0.0, '' from d
  union all select 7, 'date_range_lic_orig_dte', 'date_range', 'error', old + new = 0, cast(old + new as double), 0.0,
    cast(old as varchar) || ';' || cast(new as varchar) from s
  union all select 8, 'value_distribution_lic_sta_cde_20', 'value_distribution', 'error', {_pct('v20', 'n')} >= 0.5,
    {_pct('v20', 'n')}, 0.5, '' from s
)
"""


def tx_validation(spark, sf):
    return V.validate_load(_tx_raw(spark, sf, "2025-06-30"), V.TX_LICENSE_RULES,
                           prev=_tx_raw(spark, sf, "2025-06-29"), as_of=AS_OF)


@query("validate_tx_license", _TX_VALIDATION_SQL + "select * replace (cast(threshold as double) as threshold) from results",
       "VAL1, VAL2, VAL3, VAL5, VAL6, VAL7, VAL8, VAL9")
def q_validate_tx(spark, sf):
    return tx_validation(spark, sf)


@query("load_verdict_tx", _TX_VALIDATION_SQL + """
select count_if(not passed and severity = 'error') = 0 as passed,
  cast(count_if(not passed and severity = 'error') as bigint) as errors, cast(0 as bigint) as warnings,
  count(*) as rules
from results
""", "VAL8 verdict")
def q_verdict(spark, sf):
    return V.load_verdict(tx_validation(spark, sf))


@query("validate_npi", sql_cte("npi_raw") + """
, s as (select count(*) as n, count_if(npi is not null and trim(npi) <> '') as pop, count(npi) as nn,
          count_if(regexp_matches(npi, '^(?:^\\d{10}$)')) as fm from npi_raw),
d as (select coalesce(sum(c) filter (where c > 1), 0) as dup from (select npi, count(*) as c from npi_raw group by npi))
select 0 as rule_index, 'row_count_min' as rule_name, 'row_count_min' as rule_type, 'error' as severity,
  n >= 100000 as passed, cast(n as double) as observed, 100000.0 as threshold, '' as detail from s
union all select 1, 'row_count_delta', 'row_count_delta', 'warning', true, null, 0.1, 'skipped: no previous load'
union all select 2, 'field_populated_npi', 'field_populated', 'error', cast(pop as double) / n >= 0.9999,
  cast(pop as double) / n, 0.9999, '' from s
union all select 3, 'field_format_npi', 'field_format', 'error', cast(fm as double) / nn >= 0.99, cast(fm as double) / nn,
  0.99, '' from s
union all select 4, 'no_duplicates', 'no_duplicates', 'error', dup = 0, cast(dup as double), 0.0, '' from d
""".replace("select 0 as rule_index", "select * replace (cast(threshold as double) as threshold) from (select 0 as rule_index")
   + ")", "VAL1, VAL2 (no previous), VAL3, VAL4, VAL5")
def q_validate_npi(spark, sf):
    return V.validate_load(binding(spark, sf, "npi_raw").drop("version"), V.NPI_RULES, prev=None, as_of=AS_OF)


@query("source_freshness", sql_cte("export_queue", "data_loads") + """
, g as (select source_type, max(loaded_at) as latest_loaded_at from data_loads group by source_type)
select source_type, latest_loaded_at,
  cast(date_diff('hour', latest_loaded_at, timestamp '2025-07-10 00:00:00') as double) / 24 as age_days,
  case when cast(date_diff('hour', latest_loaded_at, timestamp '2025-07-10 00:00:00') as double) / 24 > 14 then 'error'
       when cast(date_diff('hour', latest_loaded_at, timestamp '2025-07-10 00:00:00') as double) / 24 > 7 then 'warn'
       else 'pass' end as freshness
from g
""", "SNK5")
def q_freshness(spark, sf):
    return V.source_freshness(data_loads(spark, sf), "loaded_at", "2025-07-10", by=["source_type"])


_LOADS = sql_cte("export_queue", "data_loads")


@query("loads_ready_to_promote", _LOADS + """
select * from data_loads where status = 'validated' and validation_passed
  and validated_at + interval 1 hour * promotion_delay_hours <= timestamp '2025-06-20 00:00:00'
""", "GOV2")
def q_ready_promote(spark, sf):
    return G.loads_ready_to_promote(data_loads(spark, sf), "2025-06-20 00:00:00")


@query("promote_loads", _LOADS + f"""
, t as (select distinct load_id as target from data_loads where source_type = 'tx_hygienist')
select load_id, validation_passed, source_type, state_code, row_count, row_count_delta_pct, loaded_at, source_date,
  validated_at, promotion_delay_hours,
  case when t.target is not null and status = 'validated' and coalesce(validation_passed, false) then 'promoted' else status end as status,
  case when t.target is not null and status = 'validated' and coalesce(validation_passed, false) then timestamp '{AS_OF}' end as promoted_at,
  case when t.target is not null and status = 'validated' and coalesce(validation_passed, false) then 'ops' end as promoted_by,
  case when t.target is null then null
       when status != 'validated' then 'error: Load must be in validated status to promote'
       when not coalesce(validation_passed, false) then 'error: Load did not pass validation'
       else 'promoted' end as promotion_result
from data_loads left join t on load_id = t.target
""", "GOV3")
def q_promote(spark, sf):
    loads = data_loads(spark, sf)
    return G.promote_loads(loads, loads.filter(F.col("source_type") == "tx_hygienist").select("load_id"),
                           "ops", AS_OF)


# Quarantine targets derived from the data: pending loads whose row count jumped by more than 5 %.
_Q_TARGETS = "status = 'pending' and row_count_delta_pct > 0.05"


def _quarantine(spark, sf):
    loads = data_loads(spark, sf)
    queue = binding(spark, sf, "export_queue")
    targets = loads.filter(F.expr(_Q_TARGETS)).select("load_id")
    return G.quarantine_loads(loads, queue, targets, "row count jump", "ops", AS_OF)


_QUAR_SQL = _LOADS + f"""
, t as (select distinct load_id as target from data_loads where {_Q_TARGETS}),
newq as (
  select q.* exclude (status), case when t.target is not null and status in ('queued', 'approved', 'scheduled')
    then 'cancelled' else status end as status,
    case when t.target is not null and status in ('queued', 'approved', 'scheduled')
    then 'Source load quarantined: row count jump' end as error_message,
    t.target is not null and status in ('queued', 'approved', 'scheduled') as hit
  from export_queue q left join t on q.data_load_id = t.target
),
c as (select data_load_id, count(*) as nc from newq where hit group by data_load_id)
"""


@query("quarantine_loads", _QUAR_SQL + f"""
select load_id, validation_passed, source_type, state_code, row_count, row_count_delta_pct, loaded_at, source_date,
  validated_at, promotion_delay_hours,
  case when t.target is not null then 'quarantined' else status end as status,
  case when t.target is not null then timestamp '{AS_OF}' end as quarantined_at,
  case when t.target is not null then 'ops' end as quarantined_by,
  case when t.target is not null then 'row count jump' end as quarantine_reason,
  case when t.target is not null then cast(coalesce(c.nc, 0) as bigint) end as exports_cancelled
from data_loads left join t on load_id = t.target left join c on load_id = c.data_load_id
""", "GOV4 (loads)")
def q_quarantine(spark, sf):
    return _quarantine(spark, sf)[0]


# A second quarantine by someone else must leave the first one's record as it is.
@query("quarantine_twice", _QUAR_SQL + f"""
, t2 as (select distinct load_id as target from data_loads where source_type = 'tx_hygienist' and not ({_Q_TARGETS})),
c2 as (select q.data_load_id, count(*) as nc from newq q join t2 on q.data_load_id = t2.target
       where status in ('queued', 'approved', 'scheduled') group by 1)
select load_id, validation_passed, source_type, state_code, row_count, row_count_delta_pct, loaded_at, source_date,
  validated_at, promotion_delay_hours,
  case when t.target is not null or t2.target is not null then 'quarantined' else status end as status,
  case when t2.target is not null then timestamp '2025-07-01' when t.target is not null then timestamp '{AS_OF}' end as quarantined_at,
  case when t2.target is not null then 'qa' when t.target is not null then 'ops' end as quarantined_by,
  case when t2.target is not null then 'format change' when t.target is not null then 'row count jump' end as quarantine_reason,
  case when t2.target is not null then cast(coalesce(c2.nc, 0) as bigint)
       when t.target is not null then cast(coalesce(c.nc, 0) as bigint) end as exports_cancelled
from data_loads left join t on load_id = t.target left join c on load_id = c.data_load_id
  left join t2 on load_id = t2.target left join c2 on load_id = c2.data_load_id
""", "GOV4 (earlier quarantine records stay)")
def q_quarantine_twice(spark, sf):
    loads, queue = _quarantine(spark, sf)
    second = data_loads(spark, sf).filter(F.expr(f"source_type = 'tx_hygienist' and not ({_Q_TARGETS})")).select("load_id")
    return G.quarantine_loads(loads, queue, second, "format change", "qa", "2025-07-01")[0]


@query("quarantine_queue_status", _QUAR_SQL + """
select destination, status, count(*) as exports from newq group by destination, status
""", "GOV4 (queue cascade)")
def q_quarantine_queue(spark, sf):
    return _quarantine(spark, sf)[1].groupBy("destination", "status").agg(F.count(F.lit(1)).alias("exports"))


@query("quarantined_loads", _QUAR_SQL + """
select load_id from data_loads left join t on load_id = t.target where t.target is not null or status = 'quarantined'
""", "GOV6")
def q_quarantined(spark, sf):
    return G.quarantined_loads(_quarantine(spark, sf)[0]).select("load_id")


@query("plan_reversals", sql_cte("export_queue", "data_loads", "export_history") + f"""
, t as (select distinct load_id as target from data_loads where {_Q_TARGETS}),
cfg as (select * from (values ('ghl', true), ('instantly', false), ('lob_postcard', true), ('lob_letter', true),
        ('webhook', false)) v(destination, is_reversible))
select h.destination, h.history_id, h.export_id, h.provider_id, h.data_load_id, h.sent_at, h.delivery_status,
  h.email, h.license_number, cfg.is_reversible,
  case when cfg.is_reversible is null then 'skip_unknown_destination' when not cfg.is_reversible then 'cannot_reverse'
       else 'reverse' end as reversal_action
from export_history h left join cfg on h.destination = cfg.destination
where h.data_load_id in (select target from t)
""", "GOV5")
def q_reversals(spark, sf):
    loads = data_loads(spark, sf)
    return G.plan_reversals(export_history(spark, sf), loads.filter(F.expr(_Q_TARGETS)).select("load_id"),
                            G.destination_config(spark))


@query("load_health", _LOADS + f"""
select source_type, state_code, max(source_date) as latest_source_date, max(loaded_at) as latest_load,
  cast(count_if(status = 'promoted') as bigint) as promoted_loads,
  cast(count_if(status = 'quarantined') as bigint) as quarantined_loads,
  avg(cast(row_count as double)) as avg_row_count,
  cast(round(cast(avg(cast(row_count_delta_pct as double)) as decimal(38,12)), 6) as double) as avg_delta_pct
from data_loads where loaded_at >= cast(date '{AS_OF}' - 30 as timestamp) group by source_type, state_code
""", "AGG18")
def q_load_health(spark, sf):
    return G.load_health(data_loads(spark, sf), AS_OF, 30)
