"""Matching queries (JOIN2-JOIN4, WIN2, SET2, SET4, FLT3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import refdata
from ..functions.soundex_sql import soundex_sql
from ..operators import match as M
from ..operators import staging as ST
from ..sources.bindings import NPI_RAW, binding, sql_cte
from .q_staging import SNAP1, SNAPSHOTS_SQL, snapshot
from .memo import per_session
from .registry import query

_CODES = ", ".join(f"'{c}'" for c in refdata.MATCH_TAXONOMY_CODES)

# Oracle: the all-pairs form of the warehouse model (block join, CASE score, row_number, NOT EXISTS).
SIDES_SQL = SNAPSHOTS_SQL + f""",
npi_raw as ({NPI_RAW.format(customer='customer')}),
npi as (
  select cast(npi as varchar) as npi_number, upper(trim(first_name)) as first_name, upper(trim(last_name)) as last_name,
    {soundex_sql('first_name')} as first_sx, {soundex_sql('last_name')} as last_sx,
    upper(trim(practice_city)) as city, upper(trim(practice_state)) as state, left(practice_zip, 5) as zip5,
    practice_phone as phone
  from npi_raw where taxonomy_code in ({_CODES}) and entity_type_code = '1'
    and (deactivation_date is null or trim(deactivation_date) = '')
),
lic as (
  select professional_id, state_code, license_number, professional_type,
    upper(trim(first_name)) as first_name, upper(trim(last_name)) as last_name,
    {soundex_sql('first_name')} as first_sx, {soundex_sql('last_name')} as last_sx,
    upper(trim(city)) as city, upper(trim(address_state)) as state, left(zip_code, 5) as zip5
  from s1 where status_code in (20, 46, 70)
)
"""

MATCH_SQL = SIDES_SQL + """,
pairs as (
  select lic.*, npi.npi_number, npi.first_name as nf, npi.last_name as nl, npi.city as nc, npi.state as ns,
    npi.zip5 as nz, npi.phone as np,
    case when lic.first_name = npi.first_name and lic.last_name = npi.last_name and lic.city = npi.city and lic.state = npi.state then 95
         when lic.first_name = npi.first_name and lic.last_name = npi.last_name and lic.zip5 = npi.zip5 then 90
         when lic.first_sx = npi.first_sx and lic.last_sx = npi.last_sx and lic.city = npi.city and lic.state = npi.state then 85
         when lic.first_sx = npi.first_sx and lic.last_sx = npi.last_sx and lic.zip5 = npi.zip5 then 80
         when lic.first_sx = npi.first_sx and lic.last_sx = npi.last_sx and lic.state = npi.state then 70
         else 0 end as conf
  from lic join npi on lic.first_sx = npi.first_sx and lic.last_sx = npi.last_sx and lic.state = npi.state
),
ranked as (select *, row_number() over (partition by professional_id order by conf desc, npi_number,
             nf nulls first, nl nulls first, nc nulls first, ns nulls first, nz nulls first, np nulls first) as rk
           from pairs where conf > 0 and regexp_matches(npi_number, '^[0-9]{1,10}$')),
best as (select * from ranked where rk = 1),
matches as (
  select professional_id, state_code, license_number, professional_type, first_name as lic_first_name,
    last_name as lic_last_name, city as lic_city, state as lic_state, zip5 as lic_zip5, npi_number,
    nf as npi_first_name, nl as npi_last_name, nc as npi_city, ns as npi_state, nz as npi_zip5, np as npi_phone,
    conf as match_confidence,
    case conf when 95 then 'exact_name_city_state' when 90 then 'exact_name_zip' when 85 then 'soundex_name_city_state'
      when 80 then 'soundex_name_zip' else 'soundex_name_state' end as match_type
  from best
  union all
  select professional_id, state_code, license_number, professional_type, first_name, last_name, city, state, zip5,
    null, null, null, null, null, null, null, 0, 'no_match'
  from lic where not exists (select 1 from best b where b.professional_id = lic.professional_id)
),
match_out as (
  select *, case when match_confidence >= 90 then false when match_confidence >= 70 then true else false end as needs_manual_review,
    match_confidence >= 85 as auto_approve_for_email, match_confidence >= 95 as auto_approve_for_mail
  from matches
)
"""


@per_session
def licenses(spark, sf):
    return ST.active_licenses(snapshot(spark, sf, SNAP1))


@per_session
def matches(spark, sf):
    return M.best_match(licenses(spark, sf), binding(spark, sf, "npi_raw"))


@query("npi_license_matches", MATCH_SQL + "select * from match_out", "JOIN2, JOIN3, JOIN4, WIN2, SET2, SET4, FLT3")
def q_matches(spark, sf):
    return matches(spark, sf)


@query("match_tier_counts", MATCH_SQL + """
select match_type, match_confidence, count(*) as licenses, cast(count_if(needs_manual_review) as bigint) as review
from match_out group by match_type, match_confidence
""", "JOIN3 summary")
def q_tier_counts(spark, sf):
    return matches(spark, sf).groupBy("match_type", "match_confidence").agg(
        F.count(F.lit(1)).alias("licenses"), F.count_if("needs_manual_review").cast("bigint").alias("review"))


@query("match_candidate_counts", SIDES_SQL + """
select lic.professional_id, lic.license_number, lic.professional_type, lic.first_sx, lic.last_sx, lic.state,
  count(npi.npi_number) as candidate_count
from lic left join npi on lic.first_sx = npi.first_sx and lic.last_sx = npi.last_sx and lic.state = npi.state
group by all
""", "JOIN2 (candidate counts without pair emission)")
def q_candidates(spark, sf):
    return M.candidate_counts(licenses(spark, sf), binding(spark, sf, "npi_raw"))


@query("match_block_histogram", SIDES_SQL + """
, a as (select first_sx, last_sx, state, count(*) as licenses from lic
        where first_sx is not null and last_sx is not null group by all),
b as (select first_sx, last_sx, state, count(*) as npi_rows from npi
        where first_sx is not null and last_sx is not null group by all)
select a.first_sx, a.last_sx, a.state, licenses, npi_rows, licenses * npi_rows as pairs
from a join b using (first_sx, last_sx, state)
""", "JOIN2 skew profile")
def q_blocks(spark, sf):
    return M.block_histogram(licenses(spark, sf), binding(spark, sf, "npi_raw"))


@query("npi_unusable", sql_cte("npi_raw") + """
select trim(npi) as npi, count(*) as rows from npi_raw
where npi is null or not regexp_matches(trim(npi), '^[0-9]{1,10}$') group by 1
""", "JOIN4 (registry rows set aside)")
def q_unusable(spark, sf):
    return M.unusable_npis(binding(spark, sf, "npi_raw"))


@query("match_candidates", MATCH_SQL + """
, c as (select professional_id, license_number, professional_type, npi_number, max(conf) as conf from pairs
        where conf > 0 and regexp_matches(npi_number, '^[0-9]{1,10}$') group by all),
first as (select *, row_number() over (partition by professional_id, license_number, professional_type
                                       order by conf desc, cast(npi_number as bigint)) as rk from c)
select professional_id, license_number, professional_type, cast(rk as integer) as candidate_rank, npi_number,
  conf as match_confidence,
  case conf when 95 then 'exact_name_city_state' when 90 then 'exact_name_zip' when 85 then 'soundex_name_city_state'
    when 80 then 'soundex_name_zip' else 'soundex_name_state' end as match_type, conf < 90 as needs_manual_review
from first where rk <= 5
""", "JOIN2 (first five candidates of each licence)")
def q_match_candidates(spark, sf):
    return M.match_candidates(licenses(spark, sf), binding(spark, sf, "npi_raw"), 5)
