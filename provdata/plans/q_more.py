"""State-board transforms, phone formats, source union, provider waterfall, queues, roles
(STG5-STG9, PRJ7, JOIN18, SET3, ENR3, ENR5, EXP6, ROLE1, AGG21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import enrich as N
from ..operators import export as X
from ..operators import match as M
from ..operators import metrics as MET
from ..operators import people as PE
from ..operators import governance as G
from ..operators import staging as ST
from ..operators import validate as V
from ..sources.bindings import AS_OF, NPI_RAW_FULL, binding, data_loads, export_history, sql_cte
from .q_staging import STAGED_SQL, staged
from .registry import query

WA_SCHEMA = ("credentialnumber string, credentialtype string, status string, firstname string, middlename string, "
             "lastname string, birthyear string, firstissuedate string, lastissuedate string, expirationdate string, "
             "ceduedate string, actiontaken string")
CO_SCHEMA = ("licensenumber string, licensetype string, licensestatusdescription string, firstname string, "
             "middlename string, lastname string, city string, state string, mailzipcode string, "
             "licensefirstissuedate string, licenselastreneweddate string, licenseexpirationdate string, "
             "linktoverifylicense struct<url: string>, linktoviewhealthcareprofile struct<url: string>")
FL_SCHEMA = ("LicenseNumber string, Name string, Address string, City string, State string, ZipCode string, "
             "County string, Status string, OriginalIssueDate string, ExpirationDate string, LastRenewalDate string")


def _records(spark, sf, name, schema):
    return binding(spark, sf, name).select(F.from_json("record", schema).alias("r")).select("r.*")


def _j(field: str) -> str:
    return f"coalesce(json_extract_string(record, '$.{field}'), '')"


def _iso(field: str) -> str:
    v = _j(field)
    return f"case when length({v}) = 8 then substr({v}, 1, 4) || '-' || substr({v}, 5, 2) || '-' || substr({v}, 7, 2) else '' end"


_WA_CASE = "case " + _j("credentialtype") + " " + " ".join(f"when '{k}' then '{v}'" for k, v in ST.WA_TYPES) + " else 'other' end"


@query("stage_wa_records", sql_cte("wa_records") + f"""
select 'WA' as state_code, {_WA_CASE} as professional_type, {_j('credentialtype')} as credential_type,
  {_j('credentialnumber')} as license_number, {_j('status')} as status, {_j('firstname')} as first_name,
  {_j('middlename')} as middle_name, {_j('lastname')} as last_name, {_j('birthyear')} as birth_year,
  {_iso('firstissuedate')} as first_issue_date, {_iso('lastissuedate')} as last_issue_date,
  {_iso('expirationdate')} as expiration_date, {_iso('ceduedate')} as ce_due_date,
  coalesce(json_extract_string(record, '$.actiontaken'), 'No') = 'Yes' as has_enforcement_action
from wa_records
""", "STG6")
def q_wa(spark, sf):
    return ST.stage_wa(_records(spark, sf, "wa_records", WA_SCHEMA))


_CO_TYPE = "case " + _j("licensetype") + " " + " ".join(f"when '{k}' then '{t}'" for k, t, _ in ST.CO_TYPES) + " else 'other' end"
_CO_DESC = "coalesce(case " + _j("licensetype") + " " + " ".join(f"when '{k}' then '{d}'" for k, _, d in ST.CO_TYPES) + f" end, {_j('licensetype')})"


@query("stage_co_records_active", sql_cte("co_records") + f"""
select * from (
select 'CO' as state_code, {_CO_TYPE} as professional_type, {_j('licensetype')} as license_type_code,
  {_CO_DESC} as license_type_description, {_j('licensenumber')} as license_number,
  {_j('licensestatusdescription')} as status, {_j('firstname')} as first_name, {_j('middlename')} as middle_name,
  {_j('lastname')} as last_name, {_j('city')} as city, {_j('state')} as state, {_j('mailzipcode')} as zip_code,
  left({_j('licensefirstissuedate')}, 10) as first_issue_date, left({_j('licenselastreneweddate')}, 10) as last_renewed_date,
  left({_j('licenseexpirationdate')}, 10) as expiration_date,
  coalesce(json_extract_string(record, '$.linktoverifylicense.url'), '') as verification_url,
  coalesce(json_extract_string(record, '$.linktoviewhealthcareprofile.url'), '') as healthcare_profile_url
from co_records) where status = 'Active'
""", "STG7, STG9 (active-only)")
def q_co(spark, sf):
    return ST.stage_co(_records(spark, sf, "co_records", CO_SCHEMA), active_only=True)


_FL_STATUS = "case " + _j("Status") + " " + " ".join(f"when '{k}' then '{v}'" for k, v in ST.FL_STATUS) + " else 'UNKNOWN' end"


@query("stage_fl_records", sql_cte("fl_records") + f"""
, p as (select *, string_split({_j('Name')}, ', ') as parts from fl_records)
select 'FL' as state_code, 'dentist' as professional_type, 'Dentist' as license_type,
  {_j('LicenseNumber')} as license_number, {_j('Status')} as status, {_FL_STATUS} as status_category,
  case when len(parts) > 1 then string_split(parts[2], ' ')[1] else '' end as first_name,
  case when len(parts) > 1 and len(string_split(parts[2], ' ')) > 1 then array_to_string(string_split(parts[2], ' ')[2:], ' ') else '' end as middle_name,
  parts[1] as last_name, {_j('Name')} as full_name, {_j('Address')} as address, {_j('City')} as city,
  {_j('State')} as state, {_j('ZipCode')} as zip_code, {_j('County')} as county,
  {_j('OriginalIssueDate')} as original_issue_date, {_j('ExpirationDate')} as expiration_date,
  {_j('LastRenewalDate')} as last_renewal_date, 'Board of Dentistry' as board
from p
""", "STG8")
def q_fl(spark, sf):
    return ST.stage_fl(_records(spark, sf, "fl_records", FL_SCHEMA), "DEN")


@query("stage_tx_etn", sql_cte("tx_etn_raw") + """
select trim(lic_nbr) as license_number, cast(lic_sta_cde as integer) as status_code, trim(lic_sta_desc) as status_description,
  try_strptime(trim(rank_efct_dte), '%m/%d/%Y')::date as rank_effective_date, upper(trim(erx_waiver)) = 'YES' as has_erx_waiver
from tx_etn_raw
""", "STG5")
def q_etn(spark, sf):
    return ST.stage_tx_etn(binding(spark, sf, "tx_etn_raw"))


@query("phone_e164", sql_cte("npi_raw") + """
, d as (select npi, practice_phone, practice_country, regexp_replace(practice_phone, '[^0-9]', '', 'g') as digits
        from npi_raw)
select npi, practice_phone, practice_country,
  case when practice_phone is null then null when starts_with(practice_phone, '+') then practice_phone
       when practice_country = 'US' and length(digits) = 10 then '+1' || digits else '+' || digits end as phone_e164
from d
""", "PRJ7, PRJ6")
def q_e164(spark, sf):
    n = binding(spark, sf, "npi_raw")
    return n.select("npi", "practice_phone", "practice_country",
                    C.to_e164("practice_phone", "practice_country").alias("phone_e164"))


@query("license_to_npi", STAGED_SQL + f""", npi_raw_full as ({NPI_RAW_FULL.format(customer='customer')}),
n as (select trim(license_number) as l, trim(license_state) as st, min(cast(npi as varchar)) as npi_number from npi_raw_full
      where trim(license_number) is not null and trim(license_state) is not null group by all)
select s.professional_id, s.license_number, s.professional_type, s.state_code, s.snapshot_date, n.npi_number
from staged s left join n on s.license_number = n.l and s.state_code = n.st
""", "JOIN18")
def q_lic_npi(spark, sf):
    lic = staged(spark, sf).select("professional_id", "license_number", "professional_type", "state_code", "snapshot_date")
    return M.license_entity_to_npi(lic, binding(spark, sf, "npi_raw_full"))


def _source_tables(spark, sf):
    e = binding(spark, sf, "enrichments")
    apollo = e.filter(F.col("source") == "apollo").drop("source").withColumnRenamed("website", "website_url")
    wiza = e.filter(F.col("source") == "wiza").drop("source", "employee_count").withColumnRenamed("website", "company_website")
    scraped = (e.filter(F.col("source") == "scraped").select("provider_id", "phone", "email", "website",
               F.col("company_name").alias("practice_name"), F.col("enriched_at").alias("scraped_at")))
    return apollo, wiza, scraped


@query("union_enrichment_sources", sql_cte("enrichments", "npi_raw") + """
select npi as provider_id, 'npi' as source, practice_phone as phone, cast(null as varchar) as email,
  cast(null as varchar) as linkedin_url, cast(null as varchar) as website, organization_name as company_name,
  cast(null as varchar) as title, cast(null as integer) as employee_count,
  try_strptime(trim(last_update_date), '%m/%d/%Y')::date as enriched_at
from npi_raw where entity_type_code = '1'
union all select provider_id, 'apollo', phone, email, linkedin_url, website, company_name, title, employee_count, enriched_at
  from enrichments where source = 'apollo' and email is not null
union all select provider_id, 'wiza', phone, email, linkedin_url, website, company_name, title, cast(null as integer), enriched_at
  from enrichments where source = 'wiza'
union all select provider_id, 'scraped', phone, email, cast(null as varchar), website, company_name, cast(null as varchar),
  cast(null as integer), enriched_at from enrichments where source = 'scraped'
""", "SET3")
def q_union_sources(spark, sf):
    apollo, wiza, scraped = _source_tables(spark, sf)
    return N.union_enrichment_sources(binding(spark, sf, "npi_raw"), apollo, wiza, scraped)


_FIRST_SQL = sql_cte("enrichments") + """
, r as (select provider_id, source, email, phone, row_number() over (partition by provider_id, source
          order by enriched_at, email, phone) as rn from enrichments where email is not null and source in ('apollo', 'wiza', 'scraped')),
p as (select provider_id,
        max(case when source = 'apollo' and rn = 1 then email end) as a_email, max(case when source = 'apollo' and rn = 1 then phone end) as a_phone,
        bool_or(source = 'apollo') as has_a,
        max(case when source = 'wiza' and rn = 1 then email end) as w_email, max(case when source = 'wiza' and rn = 1 then phone end) as w_phone,
        bool_or(source = 'wiza') as has_w,
        max(case when source = 'scraped' and rn = 1 then email end) as s_email, max(case when source = 'scraped' and rn = 1 then phone end) as s_phone,
        bool_or(source = 'scraped') as has_s
      from r group by provider_id)
select provider_id,
  case when has_a then 'apollo' when has_w then 'wiza' when has_s then 'scraped' end as enriched_by,
  case when has_a then a_email when has_w then w_email when has_s then s_email end as email,
  case when has_a then a_phone when has_w then w_phone when has_s then s_phone end as phone
from p
"""


@query("first_successful_provider", _FIRST_SQL, "ENR3")
def q_first(spark, sf):
    e = binding(spark, sf, "enrichments").filter(F.col("email").isNotNull())
    res = lambda s: F.min(F.when(F.col("source") == s, F.struct("enriched_at", "email", "phone")))
    per = e.groupBy("provider_id").agg(res("apollo").alias("apollo"), res("wiza").alias("wiza"),
                                       res("scraped").alias("scraped"))
    out = N.first_success(per, ["apollo", "wiza", "scraped"])
    return out.select("provider_id", "enriched_by", F.col("enrichment_result.email").alias("email"),
                      F.col("enrichment_result.phone").alias("phone"))


@query("enrichment_queue_ready", sql_cte("enrichments") + f"""
, q as (select provider_id, source, case (day(enriched_at) + length(provider_id)) % 4 when 0 then 'pending' when 1 then 'processing'
          when 2 then 'pending' else 'failed' end as status, cast(100 - day(enriched_at) as integer) as priority,
          cast(enriched_at as timestamp) + interval 1 day * 170 as process_after,
          case when day(enriched_at) % 3 = 0 then cast(enriched_at as timestamp) + interval 1 day * 190 end as next_retry_at
        from enrichments)
select * from q where status = 'pending' and (process_after is null or process_after <= timestamp '{AS_OF}')
  and (next_retry_at is null or next_retry_at <= timestamp '{AS_OF}')
""", "ENR5")
def q_queue_ready(spark, sf):
    e = binding(spark, sf, "enrichments")
    d = F.dayofmonth("enriched_at")
    q = e.select("provider_id", "source",
                 F.element_at(F.array(F.lit("pending"), F.lit("processing"), F.lit("pending"), F.lit("failed")),
                              ((d + F.length("provider_id")) % 4 + 1).cast("int")).alias("status"),
                 (100 - d).alias("priority"),
                 F.timestamp_add("DAY", F.lit(170), F.col("enriched_at").cast("timestamp_ntz")).alias("process_after"),
                 F.when(d % 3 == 0, F.timestamp_add("DAY", F.lit(190), F.col("enriched_at").cast("timestamp_ntz")))
                 .alias("next_retry_at"))
    return MET.enrichment_queue_ready(q, AS_OF)


@query("suppress_bounced", sql_cte("export_queue", "suppression_list", "export_history") + f"""
select * from suppression_list
union all select left(md5(concat_ws('-', email, '', '', '{AS_OF}')), 12), email, cast(null as varchar), cast(null as varchar),
  destination, true, cast(null as date)
from export_history where delivery_status = 'bounced'
""", "EXP6")
def q_suppress_bounced(spark, sf):
    new = export_history(spark, sf).filter(F.col("delivery_status") == "bounced").select(
        "email", F.lit(None).cast("string").alias("license_number"), F.lit(None).cast("string").alias("npi"),
        "destination", F.lit(None).cast("date").alias("expires_at"))
    return X.add_suppression(binding(spark, sf, "suppression_list"), new, AS_OF)


@query("title_roles", sql_cte("enrichments") + """
select title, case when regexp_matches(upper(coalesce(title, '')), '\\b(OWNER|CEO|PRESIDENT|PARTNER|CO-?FOUNDER)\\b') then 'DECISION_MAKER'
    when regexp_matches(upper(coalesce(title, '')), '\\bOFFICE MANAGER\\b') then 'INFLUENCER'
    when regexp_matches(upper(coalesce(title, '')), '\\b(CFO|CONTROLLER)\\b') then 'BUDGET_HOLDER' end as inferred_role,
  count(*) as contacts
from enrichments where title is not null group by all
""", "ROLE1")
def q_roles(spark, sf):
    e = binding(spark, sf, "enrichments").filter(F.col("title").isNotNull())
    return e.groupBy("title", PE.infer_role("title").alias("inferred_role")).agg(F.count(F.lit(1)).alias("contacts"))


@query("type_distribution", STAGED_SQL + """
, g as (select snapshot_date, professional_type, count(*) as rows from staged group by all)
select snapshot_date, professional_type, rows, cast(round(cast(cast(rows as double) * 100
  / cast(sum(rows) over (partition by snapshot_date) as double) as decimal(20,6)), 2) as double) as pct from g
""", "AGG21")
def q_type_dist(spark, sf):
    return MET.distribution(staged(spark, sf), "professional_type", "snapshot_date")


# WA: no previous load. CO: the previous load holds nine tenths of the records.
@query("validate_wa", sql_cte("wa_records") + f"""
, cur as (select {_j('credentialnumber')} as credential_number, {_j('lastname')} as last_name from wa_records),
s as (select count(*) as n, count_if(trim(credential_number) <> '') as p1, count_if(trim(last_name) <> '') as p2 from cur),
d as (select coalesce(sum(c) filter (where c > 1), 0) as dup from (select credential_number, count(*) as c from cur group by 1))
select 0 as rule_index, 'row_count_min' as rule_name, 'row_count_min' as rule_type, 'error' as severity, n >= 1000 as passed,
  cast(n as double) as observed, cast(1000 as double) as threshold, '' as detail from s
union all select 1, 'row_count_delta', 'row_count_delta', 'warning', true, null, 0.2, 'skipped: no previous load'
union all select 2, 'field_populated_credential_number', 'field_populated', 'error', cast(p1 as double) / n >= 0.99, cast(p1 as double) / n, 0.99, '' from s
union all select 3, 'field_populated_last_name', 'field_populated', 'error', cast(p2 as double) / n >= 0.99, cast(p2 as double) / n, 0.99, '' from s
union all select 4, 'no_duplicates', 'no_duplicates', 'error', dup = 0, cast(dup as double), 0.0, '' from d
""", "VAL8 (Washington rules)")
def q_validate_wa(spark, sf):
    wa = ST.stage_wa(_records(spark, sf, "wa_records", WA_SCHEMA)).withColumnRenamed("license_number", "credential_number")
    return V.validate_load(wa, V.WA_LICENSE_RULES, as_of=AS_OF)


@query("validate_co", sql_cte("co_records") + f"""
, cur as (select {_j('licensenumber')} as license_number, {_j('lastname')} as last_name from co_records),
prev as (select count(*) as pn from cur where right(license_number, 1) <> '7'),
s as (select count(*) as n, count_if(trim(license_number) <> '') as p1, count_if(trim(last_name) <> '') as p2 from cur),
d as (select coalesce(sum(c) filter (where c > 1), 0) as dup from (select license_number, count(*) as c from cur group by 1))
select 0 as rule_index, 'row_count_min' as rule_name, 'row_count_min' as rule_type, 'error' as severity, n >= 500 as passed,
  cast(n as double) as observed, cast(500 as double) as threshold, '' as detail from s
union all select 1, 'row_count_delta', 'row_count_delta', 'error', abs(n - pn) / pn <= 0.2, cast(abs(n - pn) as double) / pn, 0.2, '' from s, prev
union all select 2, 'field_populated_license_number', 'field_populated', 'error', cast(p1 as double) / n >= 0.99, cast(p1 as double) / n, 0.99, '' from s
union all select 3, 'field_populated_last_name', 'field_populated', 'error', cast(p2 as double) / n >= 0.99, cast(p2 as double) / n, 0.99, '' from s
union all select 4, 'no_duplicates', 'no_duplicates', 'error', dup = 0, cast(dup as double), 0.0, '' from d
""", "VAL8 (Colorado rules)")
def q_validate_co(spark, sf):
    co = ST.stage_co(_records(spark, sf, "co_records", CO_SCHEMA))
    return V.validate_load(co, V.CO_LICENSE_RULES, prev=co.where(~F.col("license_number").endswith("7")), as_of=AS_OF)


@query("load_row_delta", sql_cte("tx_license_raw") + """
, c as (select cast(count_if(snapshot_date = '2025-06-30') as bigint) as row_count,
    cast(count_if(snapshot_date = '2025-06-29') as bigint) as row_count_prev from tx_license_raw)
select *, cast(row_count - row_count_prev as double) / row_count_prev as row_count_delta from c
""", "VAL8 (signed row delta)")
def q_row_delta(spark, sf):
    raw = binding(spark, sf, "tx_license_raw")
    return V.row_delta(raw.where("snapshot_date = '2025-06-30'"), raw.where("snapshot_date = '2025-06-29'"))


@query("validation_details", sql_cte("npi_raw") + """
, f as (select npi as value, count(*) as rows from npi_raw where npi is not null and not regexp_matches(npi, '^(?:^\\d{10}$)') group by 1),
v as (select taxonomy_code as value, count(*) as rows from npi_raw where taxonomy_code is not null group by 1)
select 0 as rule_index, 'field_format_npi' as rule_name, * from (select * from f order by value limit 5)
union all select 1, 'value_distribution_taxonomy_code_1223G0001X', * from (select * from v order by rows desc, value limit 10)
""", "VAL4 (samples), VAL7 (top values)")
def q_validation_details(spark, sf):
    rules = [("field_format", {"field": "npi", "pattern": r"^\d{10}$", "min_pct": 0.99}),
             ("value_distribution", {"field": "taxonomy_code", "value": "1223G0001X", "min_pct": 0.1})]
    return V.rule_details(binding(spark, sf, "npi_raw"), rules)


@query("update_loads", sql_cte("export_queue", "data_loads") + f"""
select * exclude (status), case when source_type = 'tx_hygienist' then 'validated' else status end as status,
  case when source_type = 'tx_hygienist' then 'checked by hand' end as note,
  case when source_type = 'tx_hygienist' then timestamp '{AS_OF}' end as updated_at
from data_loads
""", "GOV1 (update_load; a new field)")
def q_update_loads(spark, sf):
    loads = data_loads(spark, sf)
    updates = loads.where("source_type = 'tx_hygienist'").select(
        "load_id", F.lit("validated").alias("status"), F.lit("checked by hand").alias("note"))
    return G.update_load(loads, updates, AS_OF)


@query("unsent_payloads", sql_cte("export_queue") + """
, p as (select provider_id, destination, 'to ' || coalesce(email, '') || ' at ' || cast(match_confidence as varchar) as payload, status from export_queue),
h as (select destination, sha256(payload) as payload_hash from p where status = 'sent')
select min(provider_id) as provider_id, destination, payload, sha256(payload) as payload_hash from p
where status <> 'sent' and not exists (select 1 from h where h.destination = p.destination and h.payload_hash = sha256(p.payload))
group by destination, payload
""", "EXP10 (history de-duplicated by payload)")
def q_unsent(spark, sf):
    p = binding(spark, sf, "export_queue").select(
        "provider_id", "destination", "status", F.concat(F.lit("to "), F.coalesce("email", F.lit("")), F.lit(" at "),
                                                         F.col("match_confidence").cast("string")).alias("payload"))
    sent = X.payload_hash(p.where("status = 'sent'").drop("status"))
    return X.unsent_payloads(p.where("status <> 'sent'").drop("status"), sent)


@query("enrichment_metrics", sql_cte("enrichments") + f"""
, e as (select *, email as enriched_email, case when email is not null and phone is not null then 'HIGH' when phone is not null then 'LOW' end as match_confidence from enrichments),
d as (select *, lower(split_part(email, '@', -1)) in ({', '.join(f"'{x}'" for x in MET.PERSONAL_DOMAINS)}) as personal from e)
select source, cast(count_if(match_confidence = 'HIGH') as bigint) as count_high_confidence,
  cast(count_if(enriched_email is not null) as bigint) as count_enriched,
  cast(round(cast(cast(count_if(enriched_email is not null) as double) * 100 / cast(count(*) as double) as decimal(20,6)), 1) as double) as enrichment_rate,
  cast(count_if(email is not null and not personal) as bigint) as count_work_email, cast(count_if(personal) as bigint) as count_personal_email
from d group by source
""", "AGG22 (contact measures)")
def q_enrichment_metrics(spark, sf):
    e = binding(spark, sf, "enrichments")
    e = e.withColumns({"enriched_email": F.col("email"), "match_confidence": F.when(
        F.col("email").isNotNull() & F.col("phone").isNotNull(), "HIGH").when(F.col("phone").isNotNull(), "LOW")})
    return MET.metric(e, ["source"], ["count_high_confidence", "count_enriched", "enrichment_rate", "count_work_email", "count_personal_email"])
