"""Enrichment, golden record and readiness queries (WIN3-5, JOIN5, GLD1-2, ENR4, AGG12-14)."""

from __future__ import annotations


from ..operators import enrich as N
from ..sources.bindings import AS_OF, ENRICHMENTS, binding, sql_cte
from .q_match import MATCH_SQL, matches
from .q_staging import SNAP1, snapshot
from .memo import per_session
from .registry import query


def _prio(field: str) -> str:
    from ..functions import refdata
    whens = " ".join(f"when '{s}' then {p}" for s, p in refdata.FIELD_PRIORITIES[field].items())
    return f"(case source {whens} else 99 end)"


def _fv(field: str, out: str, src_out: str | None) -> str:
    w = (f"over (partition by provider_id order by {_prio(field)}, enriched_at desc nulls last, {field}, source "
         "rows between unbounded preceding and unbounded following)")
    s = f"first_value({field} ignore nulls) {w} as {out}"
    if src_out:
        s += f", first_value(case when {field} is not null then source end ignore nulls) {w} as {src_out}"
    return s


# Oracle: the warehouse form (one FIRST_VALUE IGNORE NULLS window per field, then one row per provider).
WATERFALL_CTE = f"""
wf_rows as (
  select provider_id, {_fv('email', 'email', 'email_source')}, {_fv('phone', 'phone', 'phone_source')},
    {_fv('linkedin_url', 'linkedin_url', 'linkedin_source')}, {_fv('website', 'website', 'website_source')},
    {_fv('company_name', 'company_name', 'company_source')}, {_fv('title', 'title', None)},
    {_fv('employee_count', 'employee_count', None)},
    max(enriched_at) over (partition by provider_id) as last_enriched_at
  from enrichments
),
wf as (
  select distinct *, email is not null as has_email, phone is not null as has_phone,
    linkedin_url is not null as has_linkedin, website is not null as has_website,
    cast((case when email is not null then 40 else 0 end) + (case when phone is not null then 20 else 0 end)
      + (case when linkedin_url is not null then 15 else 0 end) + (case when website is not null then 15 else 0 end)
      + (case when company_name is not null then 10 else 0 end) as integer) as enrichment_score
  from wf_rows
)
"""

WATERFALL_SQL = sql_cte("enrichments") + "," + WATERFALL_CTE

GOLDEN_SQL = MATCH_SQL + f""",
enrichments as ({ENRICHMENTS.format(customer='customer')}),
{WATERFALL_CTE},
npid as (
  select * from (
    select cast(npi as varchar) as npi_number, practice_city, practice_state, practice_zip, practice_phone,
      taxonomy_code, organization_name,
      row_number() over (partition by npi order by try_strptime(trim(last_update_date), '%m/%d/%Y') desc nulls last,
                         last_update_date desc) as rn
    from npi_raw where entity_type_code = '1') where rn = 1
),
golden as (
  select coalesce(m.npi_number, m.state_code || '-' || m.license_number) as provider_id, m.npi_number,
    m.state_code as license_state, m.license_number, l.first_name, l.middle_name, l.last_name,
    concat_ws(' ', l.first_name, nullif(l.middle_name, ''), l.last_name) as full_name, l.gender,
    l.professional_type, n.taxonomy_code, e.email, e.email_source,
    coalesce(e.phone, n.practice_phone, l.phone) as phone,
    coalesce(e.phone_source, case when n.practice_phone is not null then 'npi' when l.phone is not null then 'license' end) as phone_source,
    cast(null as varchar) as fax, e.linkedin_url, e.linkedin_source, e.website, e.website_source,
    coalesce(cast(null as varchar), l.address_line_1) as address1, coalesce(cast(null as varchar), l.address_line_2) as address2,
    coalesce(n.practice_city, l.city) as city, coalesce(n.practice_state, l.address_state) as state,
    coalesce(n.practice_zip, l.zip_code) as zip_code, l.address_line_1 as license_address1,
    l.address_line_2 as license_address2, l.city as license_city,
    l.address_state as license_state_addr, l.zip_code as license_zip, l.county, l.status_category as license_status,
    l.status_code as license_status_code, l.license_issue_date as license_original_date, l.license_expiration_date,
    l.practice_description as practice_type, l.specialty_code as specialty_codes,
    l.has_disciplinary_action as disciplinary_action, l.school_name as school, l.graduation_year, l.birth_year,
    coalesce(e.company_name, n.organization_name) as company_name, coalesce(e.company_source, 'npi') as company_source,
    e.title, e.employee_count, m.match_confidence, m.match_type, m.needs_manual_review, m.auto_approve_for_email,
    m.auto_approve_for_mail, coalesce(e.enrichment_score, 0) as enrichment_score,
    m.npi_number is null as missing_npi, e.email is null as missing_email,
    coalesce(e.phone, n.practice_phone, l.phone) is null as missing_phone, e.linkedin_url is null as missing_linkedin,
    coalesce(l.city != n.practice_city and m.npi_number is not null, false) as address_mismatch,
    coalesce(l.license_issue_date >= date '{AS_OF}' - 180, false) as is_new_licensee,
    cast(date '{AS_OF}' - l.license_issue_date as integer) as days_since_licensed,
    case when e.email is not null and m.match_confidence >= 85 then 'email_ready'
         when coalesce(e.phone, n.practice_phone) is not null then 'phone_only'
         when l.address_line_1 is not null then 'mail_only' else 'no_contact' end as outreach_readiness,
    e.last_enriched_at
  from match_out m join s1 l on m.professional_id = l.professional_id
  left join npid n on m.npi_number = n.npi_number
  left join wf e on coalesce(m.npi_number, m.state_code || '-' || m.license_number) = e.provider_id
)
"""


@per_session
def enrichments(spark, sf):
    return binding(spark, sf, "enrichments")


@per_session
def golden(spark, sf):
    lic = snapshot(spark, sf, SNAP1)
    m = matches(spark, sf)
    # Attributes are needed only for the NPIs the match chose.
    return N.golden(m, lic, N.npi_details(binding(spark, sf, "npi_raw"), only=m),
                    N.waterfall(enrichments(spark, sf)), AS_OF)


@query("enrichment_waterfall", WATERFALL_SQL + "select * from wf", "WIN3, WIN4, WIN5, SET3")
def q_waterfall(spark, sf):
    return N.waterfall(enrichments(spark, sf))


@query("provider_golden", GOLDEN_SQL + "select * from golden", "JOIN5, GLD1, GLD2")
def q_golden(spark, sf):
    return golden(spark, sf)


@query("needs_enrichment", GOLDEN_SQL + """
select provider_id, npi_number, license_state, license_number, first_name, last_name, company_name, city, state,
  is_new_licensee, days_since_licensed, enrichment_score,
  case when is_new_licensee and days_since_licensed <= 30 then 100 when is_new_licensee then 80
       when days_since_licensed <= 365 then 50 else 30 end as enrichment_priority
from golden where email is null and license_status_code in (20, 46, 70)
""", "ENR4")
def q_needs(spark, sf):
    return N.needs_enrichment(golden(spark, sf))


@query("enrichment_coverage", GOLDEN_SQL + """
select license_state, professional_type, count(*) as total_providers,
  cast(count_if(email is not null) as bigint) as has_email, cast(count_if(phone is not null) as bigint) as has_phone,
  cast(count_if(linkedin_url is not null) as bigint) as has_linkedin, cast(count_if(website is not null) as bigint) as has_website,
  cast(round(cast(cast(count_if(email is not null) as double) * 100 / cast(count(*) as double) as decimal(20,6)), 1) as double) as email_pct,
  cast(round(cast(cast(count_if(phone is not null) as double) * 100 / cast(count(*) as double) as decimal(20,6)), 1) as double) as phone_pct,
  avg(cast(enrichment_score as double)) as avg_enrichment_score
from golden where license_status_code in (20, 46, 70) group by 1, 2
""", "AGG12")
def q_coverage(spark, sf):
    return N.enrichment_coverage(golden(spark, sf))


@query("outreach_readiness_summary", GOLDEN_SQL + """
select outreach_readiness, count(*) as providers, cast(count_if(missing_npi) as bigint) as missing_npi,
  cast(count_if(missing_email) as bigint) as missing_email, cast(count_if(missing_phone) as bigint) as missing_phone,
  cast(count_if(missing_linkedin) as bigint) as missing_linkedin,
  cast(count_if(address_mismatch) as bigint) as address_mismatch, cast(count_if(is_new_licensee) as bigint) as is_new_licensee
from golden group by outreach_readiness
""", "GLD1, GLD2 rollup")
def q_readiness(spark, sf):
    return N.quality_flags_summary(golden(spark, sf))


@query("enrichment_daily", sql_cte("enrichments") + """
select cast(enriched_at as date) as load_date, source, count(*) as records_loaded,
  cast(count_if(email is not null) as bigint) as emails_found
from enrichments where source <> 'npi' group by 1, 2
""", "AGG13")
def q_daily(spark, sf):
    return N.enrichment_daily(enrichments(spark, sf))


COSTS = {"apollo": 0.10, "wiza": 0.15, "scraped": 0.0}


@query("enrichment_cost_rollup", sql_cte("enrichments") + """
, g as (
  select cast(enriched_at as date) as date, source,
    cast(count_if(email is not null or phone is not null) as bigint) as credits_used, count(*) as records_enriched,
    cast(count_if(email is not null or phone is not null) as bigint) as records_found,
    sum(case when email is not null or phone is not null then
      (case source when 'apollo' then 0.10 when 'wiza' then 0.15 when 'scraped' then 0.0 else 0.0 end) else 0.0 end) as total_cost_usd,
    count_if(email is not null) as e, count_if(phone is not null) as p
  from enrichments where source <> 'npi' group by 1, 2)
select date, source, credits_used, records_enriched, records_found,
  cast(records_found as double) / records_enriched as success_rate,
  cast(round(cast(cast(total_cost_usd as double) as decimal(38,12)), 6) as double) as total_cost_usd,
  cast(round(cast(cast(round(cast(cast(total_cost_usd as double) as decimal(38,12)), 6) as double) / nullif(records_found, 0) as decimal(38,12)), 6) as double) as cost_per_enriched_record,
  cast(round(cast(cast(e as double) * 100 / cast(records_enriched as double) as decimal(20,6)), 1) as double) as email_found_pct,
  cast(round(cast(cast(p as double) * 100 / cast(records_enriched as double) as decimal(20,6)), 1) as double) as phone_found_pct
from g
""", "AGG14")
def q_costs(spark, sf):
    return N.enrichment_cost_rollup(enrichments(spark, sf), COSTS)
