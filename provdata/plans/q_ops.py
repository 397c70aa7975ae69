"""Response parsing, run statistics, budgets, summaries (ENR1-2, ENR6-8, AGG15-16, AGG20-21, WIN8, EXP9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import export as X
from ..operators import metrics as MET
from ..operators import responses as R
from ..operators import staging as ST
from ..sources.bindings import AS_OF, PERSON_RESPONSES, binding, sql_cte
from .q_providers import PROVIDERS_SQL, pct_sql
from .q_staging import STAGED_SQL, SNAP1, _EVENTS_SQL, license_events, staged
from .memo import per_session
from .registry import query

_PERSON_SQL = sql_cte("person_responses") + """,
pr as (
  select *, json_extract(response, '$.error') is not null as has_err,
    (json_extract(response, '$.person') is null or json_type(json_extract(response, '$.person')) = 'NULL'
     or replace(cast(json_extract(response, '$.person') as varchar), ' ', '') = '{}') as no_person,
    from_json(json_extract(response, '$.person.phone_numbers'), '[{"type": "VARCHAR", "sanitized_number": "VARCHAR"}]') as phones
  from person_responses
),
parsed as (
  select license_id, license_number, response,
    case when has_err then json_extract_string(response, '$.error') when no_person then 'No match found' end as api_error,
    case when not has_err and not no_person then json_extract_string(response, '$.person.id') end as apollo_id,
    case when not has_err and not no_person then json_extract_string(response, '$.person.email') end as email,
    case when not has_err and not no_person then json_extract_string(response, '$.person.email_status') end as email_status,
    case when not has_err and not no_person then list_filter(phones, lambda x: coalesce(x.type, '') <> 'mobile')[-1].sanitized_number end as phone,
    case when not has_err and not no_person then list_filter(phones, lambda x: x.type = 'mobile')[-1].sanitized_number end as mobile_phone,
    case when not has_err and not no_person then json_extract_string(response, '$.person.linkedin_url') end as linkedin_url,
    case when not has_err and not no_person then coalesce(nullif(json_extract_string(response, '$.person.employment_history[0].organization_name'), ''),
      json_extract_string(response, '$.person.organization.name')) end as company_name,
    case when not has_err and not no_person then json_extract_string(response, '$.person.employment_history[0].title') end as title,
    case when not has_err and not no_person then json_extract_string(response, '$.person.organization.primary_domain') end as company_domain,
    case when not has_err and not no_person then json_extract_string(response, '$.person.city') end as apollo_city,
    case when not has_err and not no_person then json_extract_string(response, '$.person.state') end as apollo_state,
    case when not has_err and not no_person then json_extract_string(response, '$.person.country') end as apollo_country
  from pr
)
"""


@per_session
def person(spark, sf):
    return R.parse_person_response(binding(spark, sf, "person_responses"))


@query("person_responses_parsed", _PERSON_SQL + "select * from parsed", "ENR1")
def q_person(spark, sf):
    return person(spark, sf)


@query("enrichment_run_stats", _PERSON_SQL + f"""
select count(*) as processed, cast(count_if(api_error is null) as bigint) as matched,
  cast(count_if(email is not null) as bigint) as emails_found,
  cast(count_if(phone is not null or mobile_phone is not null) as bigint) as phones_found,
  cast(count_if(api_error is not null and api_error <> 'No match found') as bigint) as errors,
  {pct_sql("count_if(api_error is null)", "count(*)")} as match_rate,
  {pct_sql("count_if(email is not null)", "count(*)")} as email_rate
from parsed
""", "AGG16")
def q_run_stats(spark, sf):
    return MET.run_stats(person(spark, sf))


@query("enrichment_budget_cut", _PERSON_SQL + """
, o as (select *, cast(license_id as bigint) as k, case when api_error is null then 1 else 0 end as m from parsed),
c as (select *, coalesce(sum(m) over (order by k rows between unbounded preceding and 1 preceding), 0) as credits_before from o)
select license_id, license_number, api_error, cast(credits_before as bigint) as credits_before from c where credits_before < 500
""", "WIN8 (sums carried over ranges)")
def q_budget_cut(spark, sf):
    p = person(spark, sf).select("license_id", "license_number", "api_error",
                                 F.col("api_error").isNull().alias("matched"),
                                 F.col("license_id").cast("bigint").alias("k"))
    out = MET.budget_cut(p, ["k"], "matched", 500)
    return out.select("license_id", "license_number", "api_error", F.col("credits_before").cast("bigint"))


_CREDITS_SQL = sql_cte("enrichments") + """,
runs as (select enriched_at, 1 as credits from enrichments where source = 'apollo' and email is not null),
usage as (select strftime(enriched_at, '%Y-%m') as cycle, cast(sum(credits) as bigint) as credits_used, count(*) as runs
          from runs group by 1)
"""


@per_session
def usage(spark, sf):
    runs = binding(spark, sf, "enrichments").filter((F.col("source") == "apollo") & F.col("email").isNotNull()) \
        .withColumn("credits", F.lit(1))
    return MET.credit_usage(runs, AS_OF)


@query("credit_usage", _CREDITS_SQL + f"""
select cycle, credits_used, runs, cast(2500 as bigint) as monthly_budget,
  greatest(cast(0 as bigint), 2500 - credits_used) as remaining, cycle = '{AS_OF[:7]}' as is_current_cycle
from usage
""", "AGG15")
def q_usage(spark, sf):
    return usage(spark, sf)


@query("plan_enrichment_requests", STAGED_SQL.replace("with ", _CREDITS_SQL[:-1] + ",\n", 1) + f""",
person_responses as ({PERSON_RESPONSES.format(customer='customer')}),
done as (select cast(license_id as integer) as source_license_id from person_responses
         where json_extract_string(response, '$.error') is distinct from 'rate limited'),
todo as (select * from staged s where snapshot_date = '{SNAP1}' and status_category = 'ACTIVE'
         and not exists (select 1 from done d where d.source_license_id = s.source_license_id)
         order by source_license_id limit 200)
select *, cast(greatest(0, 2500 - (select coalesce(sum(credits_used), 0) from usage where cycle = '{AS_OF[:7]}')) as integer) as effective_credit_limit
from todo
""", "ENR2, JOIN10, TOP4")
def q_plan(spark, sf):
    lic = staged(spark, sf).filter((F.col("snapshot_date") == SNAP1) & (F.col("status_category") == "ACTIVE"))
    # Already processed: every licence with a stored response except the rate-limited ones.
    done = person(spark, sf).filter(~F.coalesce(F.col("api_error") == "rate limited", F.lit(False))) \
        .select(F.col("license_id").cast("int").alias("source_license_id"))
    out = MET.plan_requests(lic, done, "source_license_id", ["source_license_id"], AS_OF, usage(spark, sf), limit=200)
    return out.withColumn("effective_credit_limit", F.col("effective_credit_limit").cast("int"))


_ADDR_SQL = sql_cte("address_responses") + """,
ar as (select *, json_extract(response, '$.error') is not null as err from address_responses),
addr as (
  select provider_id, response,
    not err and coalesce(json_extract_string(response, '$.status'), 'unknown') = 'valid'
      and coalesce(cast(json_extract(response, '$.deliverable') as boolean), false) as valid,
    case when err then 0.0 else coalesce(cast(json_extract(response, '$.metadata.confidence') as double), 0.0) end as confidence,
    case when err then '' else concat_ws(' ', nullif(coalesce(json_extract_string(response, '$.address.delivery_line_1'), ''), ''),
      nullif(coalesce(json_extract_string(response, '$.address.delivery_line_2'), ''), '')) end as normalized_address,
    case when err then '' else coalesce(json_extract_string(response, '$.address.delivery_line_1'), '') end as delivery_line_1,
    case when err then '' else coalesce(json_extract_string(response, '$.address.delivery_line_2'), '') end as delivery_line_2,
    case when err then '' else coalesce(json_extract_string(response, '$.address.city'), '') end as city,
    case when err then '' else coalesce(json_extract_string(response, '$.address.state'), '') end as state,
    case when err then '' else coalesce(json_extract_string(response, '$.address.zip'), '') end as zip,
    case when err then '' else coalesce(json_extract_string(response, '$.address.zip4'), '') end as zip4,
    case when not err then json_extract_string(response, '$.metadata.dpv_match') end as dpv_match,
    case when err then cast([] as varchar[]) else coalesce(cast(json_extract(response, '$.metadata.dpv_footnotes') as varchar[]), cast([] as varchar[])) end as dpv_footnotes
  from ar
)
"""

_PHONE_SQL = sql_cte("phone_responses") + """,
ph as (
  select provider_id, response, coalesce(cast(json_extract(response, '$.valid') as boolean), false) as valid,
    cast(case when coalesce(cast(json_extract(response, '$.valid') as boolean), false) then 1.0 else 0.0 end as double) as confidence,
    coalesce(json_extract_string(response, '$.national_format'), '') as formatted_number,
    coalesce(json_extract_string(response, '$.phone_number'), '') as e164_format,
    coalesce(nullif(json_extract_string(response, '$.line_type_intelligence.type'), ''),
      json_extract_string(response, '$.carrier.type'), 'unknown') as line_type,
    coalesce(nullif(json_extract_string(response, '$.line_type_intelligence.carrier_name'), ''),
      nullif(json_extract_string(response, '$.carrier.name'), ''), 'unknown') as carrier,
    coalesce(json_extract_string(response, '$.country_code'), '') as country_code
  from phone_responses
)
"""


@query("address_responses_parsed", _ADDR_SQL + "select * from addr", "ENR6")
def q_addr(spark, sf):
    return R.parse_address_response(binding(spark, sf, "address_responses"))


@query("phone_responses_parsed", _PHONE_SQL + "select * from ph", "ENR7, PRJ7-style formats")
def q_phone(spark, sf):
    return R.parse_phone_response(binding(spark, sf, "phone_responses"))


@query("validated_contacts", PROVIDERS_SQL + "," + _ADDR_SQL[len("with "):] + "," + _PHONE_SQL[len("with "):] + """
select p.npi as provider_id, a.normalized_address, a.confidence as address_confidence, h.formatted_number as validated_phone,
  h.line_type as phone_line_type, h.carrier as phone_carrier
from providers p left join addr a on p.npi = a.provider_id left join ph h on p.npi = h.provider_id
""", "ENR8")
def q_validated(spark, sf):
    from .q_providers import providers
    recs = providers(spark, sf).select(F.col("npi").alias("provider_id"))
    return R.validated_contacts(recs, R.parse_address_response(binding(spark, sf, "address_responses")),
                                R.parse_phone_response(binding(spark, sf, "phone_responses")))


@query("event_summary", _EVENTS_SQL + """
, ranked as (select event_type, professional_type, license_number,
    row_number() over (partition by event_type, professional_type order by license_number, event_id) as r from events_out),
smp as (select event_type, professional_type, list_sort(list(license_number)) as sample_license_numbers
        from ranked where r <= 3 group by all),
cnt as (select event_type, professional_type, count(*) as events from events_out group by all)
select cnt.*, smp.sample_license_numbers from cnt left join smp using (event_type, professional_type)
""", "AGG20 (bounded samples)")
def q_event_summary(spark, sf):
    return MET.event_summary(license_events(spark, sf))


@query("status_distribution", STAGED_SQL + f"""
, g as (select snapshot_date, status_category, count(*) as rows from staged group by all)
select snapshot_date, status_category, rows, {pct_sql("rows", "sum(rows) over (partition by snapshot_date)", 2)} as pct from g
""", "AGG21")
def q_status_dist(spark, sf):
    return MET.distribution(staged(spark, sf), "status_category", "snapshot_date")


@query("new_licensee_trigger_dry_run", STAGED_SQL + f"""
, ev as (select * from staged where snapshot_date = '{SNAP1}' and license_issue_date >= date '{AS_OF}' - 1000
         and ((professional_type in ('dentist', 'hygienist') and status_code in (20, 46, 70))
              or (professional_type = 'dental_assistant' and status_code in (20, 46)))),
f as (select * from ev where professional_type in ('dentist') and upper(coalesce(county, '')) in ('COUNTY1', 'COUNTY3'))
select (select count(*) from ev) as total_events, (select count(*) from f) as filtered_events,
  (select count(*) from f) as crm_created, (select count(*) from f) as webhook_sent
""", "EXP9, FLT7")
def q_trigger(spark, sf):
    s = staged(spark, sf).filter(F.col("snapshot_date") == SNAP1)
    ev = E.recent_to_events(ST.recent_licenses(s, 1000, AS_OF))
    return X.trigger_results(ev, ["dentist"], ["county1", "County3"])
