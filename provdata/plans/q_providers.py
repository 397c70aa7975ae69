"""Provider build, views and segment queries (FLT*, PRJ*, WIN1, VIEW1, AGG1-11, AGG23-24, SEG1)."""

from __future__ import annotations


from ..functions import refdata
from ..operators import providers as P
from ..operators import segments as S
from ..sources.bindings import AS_OF, binding, sql_cte
from .memo import per_session
from .registry import query

_STATES = ", ".join(f"'{s}'" for s in refdata.US_STATES)
_TAX = " union all ".join(f"select '{c}' as taxonomy_code, '{n.replace(chr(39), chr(39) * 2)}' as specialty_name"
                          for c, n in refdata.DENTAL_TAXONOMY)
_NEW = "practice_age_cohort in ('Very New (0-2 yrs)', 'New (2-5 yrs)')"


def pct_sql(num: str, den: str, scale: int = 1) -> str:
    return f"cast(round(cast(cast({num} as double) * 100 / cast(nullif({den}, 0) as double) as decimal(20,6)), {scale}) as double)"


# Oracle twin of clean_providers: the straightforward row_number formulation.
PROVIDERS_SQL = sql_cte("npi_raw") + f""",
base as (
  select cast(npi as varchar) as npi, entity_type_code,
    case entity_type_code when '1' then 'Individual' when '2' then 'Organization' else 'Unknown' end as entity_type,
    nullif(trim(first_name), '') as first_name, cast(null as varchar) as middle_name,
    nullif(trim(last_name), '') as last_name, cast(null as varchar) as name_prefix,
    cast(null as varchar) as name_suffix, cast(null as varchar) as credential,
    nullif(trim(organization_name), '') as organization_name, cast(null as varchar) as dba_name,
    cast(null as varchar) as practice_address_1, cast(null as varchar) as practice_address_2,
    nullif(trim(practice_city), '') as practice_city, nullif(trim(practice_state), '') as practice_state,
    nullif(trim(practice_zip), '') as practice_zip_full, nullif(trim(practice_country), '') as practice_country,
    nullif(trim(practice_phone), '') as practice_phone_raw,
    nullif(trim(taxonomy_code), '') as primary_taxonomy_code, nullif(trim(sex_code), '') as gender_code,
    try_strptime(trim(enumeration_date), '%m/%d/%Y')::date as enumeration_date,
    try_strptime(trim(last_update_date), '%m/%d/%Y')::date as npi_last_update_date,
    last_update_date as last_update_raw
  from npi_raw
  where starts_with(taxonomy_code, '1223')
    and (deactivation_date is null or trim(deactivation_date) = '')
    and practice_country = 'US'
),
ranked as (
  select *, row_number() over (partition by npi order by npi_last_update_date desc nulls last,
                                last_update_raw desc) as rn
  from base
),
providers as (
  select npi, entity_type_code, entity_type, first_name, middle_name, last_name, name_prefix, name_suffix,
    credential,
    case when entity_type_code = '1' then coalesce(name_prefix || ' ', '') || coalesce(first_name, '') || ' '
           || coalesce(last_name, '') || coalesce(', ' || credential, '')
         else coalesce(organization_name, dba_name, 'Unknown Organization') end as display_name,
    trim(regexp_replace(concat_ws(' ', name_prefix, first_name, middle_name, last_name, name_suffix), '\\s+', ' ', 'g')) as provider_full_name,
    organization_name, dba_name, practice_address_1, practice_address_2,
    coalesce(practice_address_1, '') || case when practice_address_2 is not null then ', ' || practice_address_2 else '' end as practice_address_full,
    practice_city, practice_state, left(practice_zip_full, 5) as practice_zip, practice_zip_full, practice_country,
    practice_phone_raw, regexp_replace(practice_phone_raw, '[^0-9]', '', 'g') as practice_phone_clean,
    cast(null as varchar) as practice_fax_raw, cast(null as varchar) as mailing_address_1,
    cast(null as varchar) as mailing_address_2, cast(null as varchar) as mailing_city,
    cast(null as varchar) as mailing_state, cast(null as varchar) as mailing_zip,
    primary_taxonomy_code, cast(null as varchar) as secondary_taxonomy_code,
    cast(null as varchar) as tertiary_taxonomy_code, gender_code,
    case gender_code when 'M' then 'Male' when 'F' then 'Female' end as gender,
    cast(null as varchar) as auth_official_first_name, cast(null as varchar) as auth_official_last_name,
    cast(null as varchar) as auth_official_full_name, cast(null as varchar) as auth_official_phone,
    cast(null as varchar) as auth_official_credential,
    enumeration_date, npi_last_update_date,
    case when enumeration_date is null then 'Legacy (20+ yrs)'
         when year(date '{AS_OF}') - year(enumeration_date) <= 2 then 'Very New (0-2 yrs)'
         when year(date '{AS_OF}') - year(enumeration_date) <= 5 then 'New (2-5 yrs)'
         when year(date '{AS_OF}') - year(enumeration_date) <= 10 then 'Established (5-10 yrs)'
         when year(date '{AS_OF}') - year(enumeration_date) <= 20 then 'Mature (10-20 yrs)'
         else 'Legacy (20+ yrs)' end as practice_age_cohort,
    cast(null as varchar) as license_number, cast(null as varchar) as license_state,
    cast(null as varchar) as is_sole_proprietor, false as is_sole_proprietor_flag,
    cast(null as boolean) as address_validated, cast(null as double) as address_confidence,
    cast(null as boolean) as phone_validated, cast(null as varchar) as phone_line_type,
    cast(null as varchar) as enriched_email, cast(null as varchar) as enriched_linkedin_url,
    cast(null as varchar) as enrichment_source, cast(null as timestamp) as enriched_at
  from ranked where rn = 1
),
us as (select * from providers where practice_state in ({_STATES})),
taxonomy as ({_TAX}),
individuals as (
  select npi, display_name, first_name, last_name, credential, practice_city as city, practice_state as state,
    practice_zip as zip, practice_phone_clean as phone, primary_taxonomy_code as taxonomy_code, gender,
    practice_age_cohort, enumeration_date, 'Individual' as record_type
  from us where entity_type = 'Individual'
),
orgs as (
  select npi, organization_name, dba_name, practice_address_full as address, practice_city as city,
    practice_state as state, practice_zip as zip, practice_phone_clean as phone,
    primary_taxonomy_code as taxonomy_code, auth_official_full_name, auth_official_credential,
    auth_official_phone, practice_age_cohort, 'Organization' as record_type
  from us where entity_type = 'Organization'
)
"""


@per_session
def providers(spark, sf):
    return P.clean_providers(binding(spark, sf, "npi_raw"), AS_OF)


def individuals(spark, sf):
    return P.v_individual_dentists(providers(spark, sf))


def organizations(spark, sf):
    return P.v_organizations(providers(spark, sf))


@query("clean_providers", PROVIDERS_SQL + "select * from providers",
       "PRJ1-12, FLT1, FLT2, WIN1, KEY-free clean build")
def q_clean_providers(spark, sf):
    return providers(spark, sf)


@query("v_individual_dentists", PROVIDERS_SQL + "select * from individuals", "VIEW1, FLT4")
def q_individuals(spark, sf):
    return individuals(spark, sf)


@query("v_organizations", PROVIDERS_SQL + "select * from orgs", "VIEW1, FLT4")
def q_orgs(spark, sf):
    return organizations(spark, sf)


_STATE_INSIGHTS_SQL = f"""
select practice_state as state, count(*) as total_dentists,
  cast(count_if(gender = 'Female') as bigint) as female_dentists,
  {pct_sql("count_if(gender = 'Female')", "count(*)")} as female_pct,
  cast(count_if({_NEW}) as bigint) as new_practices,
  cast(count_if(practice_age_cohort = 'Established (5-10 yrs)') as bigint) as growth_practices,
  cast(count_if(practice_age_cohort = 'Mature (10-20 yrs)') as bigint) as established_practices,
  {pct_sql(f"count_if({_NEW})", "count(*)")} as innovation_score,
  count(distinct practice_zip) as zip_count, count(distinct practice_city) as city_count
from us group by practice_state
"""


@query("state_insights", PROVIDERS_SQL + _STATE_INSIGHTS_SQL, "AGG1")
def q_state_insights(spark, sf):
    return S.state_insights(providers(spark, sf))


@query("city_density", PROVIDERS_SQL + f"""
select practice_city as city, practice_state as state, count(*) as provider_count,
  cast(count_if(gender = 'Female') as bigint) as female_count,
  {pct_sql("count_if(gender = 'Female')", "count(*)")} as female_pct,
  cast(count_if({_NEW}) as bigint) as new_practice_count,
  cast(count_if(practice_age_cohort = 'Established (5-10 yrs)') as bigint) as mid_practice_count,
  cast(count_if(practice_age_cohort = 'Mature (10-20 yrs)') as bigint) as established_count,
  {pct_sql(f"count_if({_NEW})", "count(*)")} as innovation_score,
  concat_ws(', ', practice_city, practice_state) as city_state
from us group by practice_city, practice_state
""", "AGG2")
def q_city_density(spark, sf):
    return S.city_density(providers(spark, sf))


# FIXED VALUES in the SQL below: market-type thresholds, as in operators/segments.py.
_MARKET_SQL = f"""
, city_stats as (
  select practice_city as city, practice_state as state, count(*) as total_providers,
    cast(count_if({_NEW}) as bigint) as new_practices,
    {pct_sql(f"count_if({_NEW})", "count(*)")} as new_practice_pct,
    {pct_sql("count_if(gender = 'Female')", "count(*)")} as female_pct
  from us group by practice_city, practice_state
),
market as (
  select city, state, concat_ws(', ', city, state) as market, total_providers, new_practices, new_practice_pct,
    female_pct,
    case when total_providers >= 50 and new_practice_pct >= 15 then 'High Growth'
         when total_providers >= 20 and new_practice_pct >= 10 then 'Growing'
         when total_providers >= 10 and new_practice_pct >= 5 then 'Mid-Size'
         when total_providers >= 5 then 'Established' else 'Emerging' end as market_type
  from city_stats
)
"""


@query("market_opportunity", PROVIDERS_SQL + _MARKET_SQL + "select * from market", "AGG3")
def q_market(spark, sf):
    return S.market_opportunity(providers(spark, sf))


@query("practice_age_distribution", PROVIDERS_SQL + f"""
, g as (select practice_age_cohort, count(*) as provider_count from us group by practice_age_cohort)
select practice_age_cohort, provider_count,
  {pct_sql("provider_count", "sum(provider_count) over ()")} as percentage,
  case practice_age_cohort when 'Very New (0-2 yrs)' then 1 when 'New (2-5 yrs)' then 2
    when 'Established (5-10 yrs)' then 3 when 'Mature (10-20 yrs)' then 4 when 'Legacy (20+ yrs)' then 5 end as cohort_rank
from g
""", "AGG4, WIN7, TOP2")
def q_age_dist(spark, sf):
    return S.practice_age_distribution(providers(spark, sf))


@query("state_share_top10", PROVIDERS_SQL + f"""
, g as (select practice_state, count(*) as provider_count from providers group by practice_state)
select practice_state, provider_count, {pct_sql("provider_count", "sum(provider_count) over ()", 2)} as pct
from g order by provider_count desc, practice_state asc nulls last limit 10
""", "AGG5, WIN7, TOP1")
def q_state_share(spark, sf):
    return S.state_share(providers(spark, sf), 10)


@query("specialty_counts", PROVIDERS_SQL + """
select t.specialty_name, count(*) as provider_count
from providers p left join taxonomy t on p.primary_taxonomy_code = t.taxonomy_code
group by t.specialty_name
""", "AGG6, JOIN1")
def q_specialty_counts(spark, sf):
    prov = P.with_taxonomy(providers(spark, sf), P.taxonomy_dim(spark))
    return S.specialty_counts(prov)


_SPEC_BY_STATE = """
, sbs as (
  select practice_state as state, coalesce(t.specialty_name, 'Other') as specialty, count(*) as provider_count
  from us p left join taxonomy t on p.primary_taxonomy_code = t.taxonomy_code
  where entity_type = 'Individual' group by 1, 2
)
"""


@query("specialty_by_state", PROVIDERS_SQL + _SPEC_BY_STATE + "select * from sbs", "AGG6, JOIN1")
def q_specialty_by_state(spark, sf):
    prov = P.with_taxonomy(providers(spark, sf), P.taxonomy_dim(spark))
    return S.specialty_by_state(prov)


@query("top_state_specialties", PROVIDERS_SQL + _SPEC_BY_STATE + f"""
, si as ({_STATE_INSIGHTS_SQL})
select * from sbs where state in (select state from si order by total_dentists desc, state limit 10)
""", "JOIN16, TOP1")
def q_top_state_specialties(spark, sf):
    prov = P.with_taxonomy(providers(spark, sf), P.taxonomy_dim(spark))
    return S.top_state_specialties(prov, 10)


_ORG_AGGS = f"""count(*) as org_count, cast(count_if({_NEW}) as bigint) as new_orgs,
  {pct_sql(f"count_if({_NEW})", "count(*)")} as innovation_score"""


@query("org_by_state", PROVIDERS_SQL + f"select state, {_ORG_AGGS} from orgs group by state", "AGG7")
def q_org_by_state(spark, sf):
    return S.org_by_state(organizations(spark, sf))


@query("org_by_city", PROVIDERS_SQL + f"""
select state, city, {_ORG_AGGS} from orgs group by state, city having count(*) >= 3
order by org_count desc, state, city nulls last limit 200
""", "AGG7, TOP1")
def q_org_by_city(spark, sf):
    return S.org_by_city(organizations(spark, sf))


@query("provider_counts", PROVIDERS_SQL + """
select 'Total Dental Providers' as metric, count(*) as value from providers
union all select 'Individual Dentists', count(*) from providers where entity_type = 'Individual'
union all select 'Organizations', count(*) from providers where entity_type = 'Organization'
""", "AGG11")
def q_provider_counts(spark, sf):
    return S.provider_counts(providers(spark, sf))


@query("dentists_by_state_gender", PROVIDERS_SQL + """
select state, count(*) as count, cast(count_if(gender = 'Male') as bigint) as male,
  cast(count_if(gender = 'Female') as bigint) as female
from individuals where state is not null group by state
""", "AGG10")
def q_dentists_by_state_gender(spark, sf):
    return S.dentists_by_state_gender(individuals(spark, sf))


@query("age_cohorts", PROVIDERS_SQL + """
select practice_age_cohort as cohort, count(*) as count from individuals
where practice_age_cohort is not null group by practice_age_cohort
""", "AGG10")
def q_age_cohorts(spark, sf):
    return S.age_cohorts(individuals(spark, sf))


@query("gender_counts", PROVIDERS_SQL + """
select gender, count(*) as count from individuals where gender is not null group by gender
""", "AGG10")
def q_gender_counts(spark, sf):
    return S.gender_counts(individuals(spark, sf))


@query("specialty_labels", PROVIDERS_SQL + """
select case taxonomy_code when '1223G0001X' then 'General Dentist' when '1223P0221X' then 'Pediatric'
  when '1223S0112X' then 'Oral Surgery' when '1223E0200X' then 'Endodontics'
  when '1223P0300X' then 'Periodontics' when '1223D0001X' then 'Orthodontics'
  when '1223P0700X' then 'Prosthodontics' else 'Other Specialty' end as specialty, count(*) as count
from individuals group by 1
""", "AGG10")
def q_specialty_labels(spark, sf):
    return S.specialty_labels(individuals(spark, sf))


@query("cohort_pie", PROVIDERS_SQL + f"""
, si as ({_STATE_INSIGHTS_SQL}),
s as (select cast(sum(new_practices) as bigint) as new, cast(sum(growth_practices) as bigint) as growth,
        cast(sum(established_practices) as bigint) as established from si)
select new, growth, established, {pct_sql("new", "new + growth + established")} as new_pct from s
""", "AGG23")
def q_cohort_pie(spark, sf):
    return S.cohort_pie(S.state_insights(providers(spark, sf)))


@query("market_type_counts", PROVIDERS_SQL + _MARKET_SQL + """
select market_type, count(*) as market_count from market group by market_type
""", "AGG24")
def q_market_type_counts(spark, sf):
    return S.market_type_counts(S.market_opportunity(providers(spark, sf)))


@query("top_growth_markets", PROVIDERS_SQL + _MARKET_SQL + """
select * from market where market_type in ('High Growth', 'Growing')
order by new_practice_pct desc, total_providers desc, state, city nulls last limit 25
""", "AGG24, TOP1")
def q_top_growth(spark, sf):
    return S.top_growth_markets(S.market_opportunity(providers(spark, sf)), 25)


@query("innovation_ready_targets", PROVIDERS_SQL + f"""
select * from individuals where {_NEW}
""", "SEG1")
def q_innovation_ready(spark, sf):
    return S.innovation_ready_targets(individuals(spark, sf))


_MH_FILTER = " or ".join(f"starts_with(taxonomy_code, '{p}')" for p in refdata.MENTAL_HEALTH_PREFIXES)
MH_SQL = PROVIDERS_SQL.replace("where starts_with(taxonomy_code, '1223')", f"where ({_MH_FILTER})")
assert MH_SQL != PROVIDERS_SQL
_MH_TAX = " union all ".join(
    f"select '{c}' as taxonomy_code, '{cat}' as provider_category, '{n.replace(chr(39), chr(39) * 2)}' as specialty_name, "
    f"{str(f).lower()} as is_facility" for c, cat, n, f in refdata.MENTAL_HEALTH_TAXONOMY)


@query("clean_mental_health_providers", MH_SQL + f"""
, mh_tax as ({_MH_TAX})
select p.*, t.provider_category, t.specialty_name, t.is_facility
from providers p left join mh_tax t on p.primary_taxonomy_code = t.taxonomy_code
""", "FLT2 (mental-health prefixes), JOIN1 (category dimension), PRJ*, WIN1")
def q_mental_health(spark, sf):
    return P.mental_health_providers(binding(spark, sf, "npi_raw"), P.mental_health_taxonomy_dim(spark), AS_OF)
