"""Decision makers, officials, geography, catalog and semantic-layer queries
(JOIN13-15, JOIN19, VIEW2-3, ROLE1, AGG8-10, AGG22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as N
from ..operators import geo as GEO
from ..operators import metrics as MET
from ..operators import people as PE
from ..operators import providers as P
from ..operators import segments as S
from ..functions import refdata
from ..sources.bindings import AS_OF, ENRICHMENTS, binding, sql_cte
from ..sources.catalog import query_sql, register_catalog
from .q_enrich import WATERFALL_CTE
from .q_providers import PROVIDERS_SQL, pct_sql
from .q_staging import STAGED_SQL, SNAP1
from .memo import per_session
from .registry import query

# Oracle twin of clean_providers over the registry extract with official / credential fields.
FULL_SQL = (PROVIDERS_SQL.replace(sql_cte("npi_raw"), sql_cte("npi_raw_full"))
            .replace("from npi_raw\n", "from npi_raw_full\n")
            .replace("cast(null as varchar) as credential,", "nullif(trim(credential), '') as credential,")
            .replace("cast(null as varchar) as dba_name,", "nullif(trim(dba_name), '') as dba_name,")
            .replace("nullif(trim(sex_code), '') as gender_code,",
                     "nullif(trim(sex_code), '') as gender_code, "
                     "nullif(trim(auth_official_first_name), '') as auth_official_first_name, "
                     "nullif(trim(auth_official_last_name), '') as auth_official_last_name, "
                     "nullif(trim(auth_official_phone), '') as auth_official_phone, "
                     "nullif(trim(auth_official_credential), '') as auth_official_credential, "
                     "nullif(trim(license_number), '') as license_number, "
                     "nullif(trim(license_state), '') as license_state,")
            .replace("cast(null as varchar) as auth_official_first_name, cast(null as varchar) as auth_official_last_name,",
                     "auth_official_first_name, auth_official_last_name,")
            .replace("cast(null as varchar) as auth_official_full_name, cast(null as varchar) as auth_official_phone,",
                     "case when auth_official_first_name is not null and auth_official_last_name is not null "
                     "then auth_official_first_name || ' ' || auth_official_last_name end as auth_official_full_name, "
                     "auth_official_phone,")
            .replace("    cast(null as varchar) as auth_official_credential,", "    auth_official_credential,")
            .replace("cast(null as varchar) as license_number, cast(null as varchar) as license_state,",
                     "license_number, license_state,"))
assert FULL_SQL.count("npi_raw_full") >= 2
_STATES = ", ".join(f"'{x}'" for x in refdata.US_STATES)

DM_SQL = FULL_SQL + """,
ind as (select *, upper(trim(first_name)) as fn, upper(trim(last_name)) as ln, upper(trim(practice_state)) as st,
          upper(trim(practice_city)) as ct from providers
        where entity_type = 'Individual' and first_name is not null and last_name is not null),
org as (select *, upper(trim(auth_official_first_name)) as fn, upper(trim(auth_official_last_name)) as ln,
          upper(trim(practice_state)) as st, upper(trim(practice_city)) as ct from providers
        where entity_type = 'Organization' and auth_official_first_name is not null and auth_official_last_name is not null),
pairs as (
  select org.npi as organization_npi, org.organization_name, org.dba_name, org.practice_address_full as org_address,
    org.practice_city as org_city, org.practice_state as org_state, org.practice_zip as org_zip,
    org.practice_phone_clean as org_phone, ind.npi as owner_npi, ind.display_name as owner_name,
    ind.first_name as owner_first_name, ind.last_name as owner_last_name, ind.credential as owner_credential,
    ind.gender as owner_gender, ind.practice_phone_clean as owner_phone, ind.primary_taxonomy_code as owner_taxonomy,
    case when org.ct = ind.ct then 'HIGH' else 'MEDIUM' end as match_confidence, org.practice_age_cohort,
    row_number() over (partition by org.npi order by case when org.ct = ind.ct then 0 else 1 end, ind.npi) as rn
  from org join ind on org.fn = ind.fn and org.ln = ind.ln and org.st = ind.st
),
dm as (select * exclude (rn) from pairs where rn = 1)
"""


@per_session
def full_providers(spark, sf):
    return P.clean_providers(binding(spark, sf, "npi_raw_full"), AS_OF)


@per_session
def dms(spark, sf):
    return PE.decision_makers(full_providers(spark, sf))


@query("decision_makers", DM_SQL + "select * from dm", "JOIN13, VIEW2")
def q_dm(spark, sf):
    return dms(spark, sf)


@query("decision_makers_by_state", DM_SQL + """
select org_state as state, count(*) as count from dm where org_state is not null group by org_state
""", "AGG10")
def q_dm_state(spark, sf):
    return PE.decision_makers_by_state(dms(spark, sf))


_CAT = """case when regexp_replace(upper(trim(auth_official_credential)), '[.\\s]', '', 'g') is null
      or regexp_replace(upper(trim(auth_official_credential)), '[.\\s]', '', 'g') = '' then 'unknown'
    when regexp_replace(upper(trim(auth_official_credential)), '[.\\s]', '', 'g') in ('DDS', 'DMD') then 'dentist_no_npi_match'
    when regexp_replace(upper(trim(auth_official_credential)), '[.\\s]', '', 'g') in ('MBA', 'CPA', 'CEO', 'CFO', 'COO', 'PRESIDENT', 'OWNER') then 'business_professional'
    when regexp_replace(upper(trim(auth_official_credential)), '[.\\s]', '', 'g') in ('RDH', 'RDA', 'CDA', 'EFDA') then 'dental_staff'
    else 'other' end"""

OFFICIALS_SQL = DM_SQL + f""",
enrichments as ({ENRICHMENTS.format(customer='customer')}),
{WATERFALL_CTE},
un as (select * from providers where entity_type = 'Organization' and npi not in (select organization_npi from dm)),
officials as (
  select u.npi as organization_npi, organization_name, dba_name, practice_address_1 as address, practice_city as city,
    practice_state as state, practice_zip as zip, auth_official_full_name, auth_official_first_name,
    auth_official_last_name, auth_official_credential, auth_official_phone, {_CAT} as credential_category,
    case {_CAT} when 'dentist_no_npi_match' then 1 when 'business_professional' then 2 when 'unknown' then 3 else 4 end as enrichment_priority,
    w.email as enriched_email, w.linkedin_url as enriched_linkedin_url, w.title as enriched_title,
    w.email_source as enrichment_source, w.last_enriched_at as enriched_at,
    case when regexp_matches(upper(coalesce(w.title, '')), '\\b(OWNER|CEO|PRESIDENT|PARTNER|CO-?FOUNDER)\\b') then 'DECISION_MAKER'
         when regexp_matches(upper(coalesce(w.title, '')), '\\bOFFICE MANAGER\\b') then 'INFLUENCER'
         when regexp_matches(upper(coalesce(w.title, '')), '\\b(CFO|CONTROLLER)\\b') then 'BUDGET_HOLDER' end as inferred_role,
    case when w.email is not null then 'Enriched' else 'Pending' end as enrichment_status
  from un u left join wf w on u.npi = w.provider_id
)
"""


def officials(spark, sf):
    prov = full_providers(spark, sf)
    return PE.auth_officials_to_enrich(prov, PE.decision_makers(prov), N.waterfall(binding(spark, sf, "enrichments")))


@query("auth_officials_to_enrich", OFFICIALS_SQL + "select * from officials", "JOIN14, VIEW2, ROLE1")
def q_officials(spark, sf):
    return officials(spark, sf)


@query("overview_stats", OFFICIALS_SQL + f"""
, a as (select count(*) as auth_officials, count(enriched_email) as enriched from officials)
select (select count(*) from providers where entity_type = 'Individual' and practice_state in ({_STATES})) as dentists,
  (select count(*) from providers where entity_type = 'Organization' and practice_state in ({_STATES})) as orgs,
  (select count(*) from dm) as decision_makers, auth_officials, enriched,
  {pct_sql('enriched', 'auth_officials')} as enrichment_rate
from a
""", "AGG9 (overview)")
def q_overview(spark, sf):
    prov = full_providers(spark, sf)
    dm = PE.decision_makers(prov)
    off = PE.auth_officials_to_enrich(prov, dm, N.waterfall(binding(spark, sf, "enrichments")))
    return PE.overview_stats(P.v_individual_dentists(prov), P.v_organizations(prov), dm, off)


@query("kpis", DM_SQL + f"""
select (select count(*) from individuals) as dentists, (select count(*) from orgs) as orgs,
  (select count(*) from dm where org_state in ({_STATES})) as decision_makers,
  cast(51 as bigint) as states, (select count(distinct city) from individuals) as cities
""", "AGG9")
def q_kpis(spark, sf):
    prov = full_providers(spark, sf)
    dm = PE.decision_makers(prov).filter(F.col("org_state").isin(*refdata.US_STATES))
    return S.kpis(P.v_individual_dentists(prov), P.v_organizations(prov), dm)


_XWALK = STAGED_SQL + f""",
addr as (select left(zip_code, 5) as zip5, upper(trim(county)) as county from staged
         where left(zip_code, 5) is not null and county is not null and upper(trim(county)) <> ''),
g as (select zip5, county, count(*) as n from addr group by all),
xw as (select zip5, county, cast(n as double) / total as ratio from (
  select *, sum(n) over (partition by zip5) as total,
    row_number() over (partition by zip5 order by n desc, county) as r from g) where r = 1)
"""


def crosswalk(spark, sf):
    from .q_staging import staged
    return GEO.zip_county_crosswalk(staged(spark, sf))


@query("zip_county_crosswalk", _XWALK + "select * from xw", "JOIN15")
def q_xwalk(spark, sf):
    return crosswalk(spark, sf)


@query("county_density", PROVIDERS_SQL + ",\n" + _XWALK[len("with "):] + f"""
, pc as (select p.*, xw.county from providers p left join xw on left(p.practice_zip, 5) = xw.zip5),
cg as (select practice_state as state, county, count(*) as provider_count,
        cast(count_if(practice_age_cohort in ('Very New (0-2 yrs)', 'New (2-5 yrs)')) as bigint) as new_practice_count,
        {pct_sql("count_if(practice_age_cohort in ('Very New (0-2 yrs)', 'New (2-5 yrs)'))", "count(*)")} as innovation_score
      from pc where county is not null group by all)
select state, county, concat_ws(', ', county, state) as state_county, provider_count, new_practice_count, innovation_score
from cg order by provider_count desc, state, county limit 500
""", "AGG8, JOIN15")
def q_county_density(spark, sf):
    from .q_providers import providers
    return GEO.county_density(GEO.with_county(providers(spark, sf), crosswalk(spark, sf)))


@query("state_insights_named", PROVIDERS_SQL + f"""
, si as (select practice_state as state, count(*) as total_dentists from us group by practice_state),
dim as (select * from (values {", ".join(f"('{n}', '{c}')" for n, c in refdata.STATE_NAMES)}) v(state_name, state_code))
select si.state, si.total_dentists, d.state_code, d.state_name from si left join dim d on upper(trim(si.state)) = upper(d.state_code)
  or upper(trim(si.state)) = upper(d.state_name)
""", "JOIN19")
def q_state_named(spark, sf):
    from .q_providers import providers
    si = S.state_insights(providers(spark, sf)).select("state", "total_dentists")
    return GEO.normalize_state(si, GEO.state_dim(spark), "state")


@query("catalog_sql_query", PROVIDERS_SQL + """
select practice_state, entity_type, count(*) as n from providers group by all
""", "VIEW3 (named views + SQL text)")
def q_catalog(spark, sf):
    from .q_providers import providers
    names = register_catalog(spark, {"providers": providers(spark, sf)}, prefix="cat_")
    return query_sql(spark, f"select practice_state, entity_type, count(*) as n from {names['providers']} group by all")


@query("provider_metrics", FULL_SQL + """
select practice_state, cast(year(enumeration_date) as integer) as enumeration_year, count(*) as count,
  cast(count_if(entity_type = 'Individual') as bigint) as count_individuals,
  cast(count_if(entity_type = 'Organization') as bigint) as count_organizations,
  cast(count_if(gender = 'Male') as bigint) as count_male, cast(count_if(gender = 'Female') as bigint) as count_female
from providers group by all
""", "AGG22 (semantic-layer measures by dimension groups)")
def q_metrics(spark, sf):
    prov = full_providers(spark, sf)
    return MET.metric(prov, ["practice_state", F.year("enumeration_date").alias("enumeration_year")],
                      ["count", "count_individuals", "count_organizations", "count_male", "count_female"])
