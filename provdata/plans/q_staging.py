"""Licence staging, dimension and history/event queries (STG1-4, SET1-2, DIM1, HIS1-4, EVT0-12, FLT5-7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import refdata
from ..operators import events as E
from ..operators import history as H
from ..operators import staging as ST
from ..operators import dims as D
from ..operators.providers import latest_per_key
from ..session import ensure_checkpoint_dir
from ..sources.bindings import AS_OF, binding, sql_cte
from ..sources.ranges import RangedSnapshots
from .memo import per_session
from .registry import query

SNAP0, SNAP1 = "2025-06-29", "2025-06-30"

def status_sql(kinds=refdata.STATUS_MAP) -> str:
    """Status category of ``lic_sta_cde`` per type, from the reference lists."""
    return "case " + " ".join(f"when professional_type = '{kind}' and lic_sta_cde in ({', '.join(map(str, codes))}) then '{category}'"
                              for kind in kinds for codes, category in refdata.STATUS_MAP[kind]) + " else 'UNKNOWN' end"


_STATUS = status_sql(["dentist", "hygienist"])
_SPEC = "case trim(prac_types) " + " ".join(f"when '{code}' then '{text}'" for code, text in refdata.SPECIALTIES) + " end"

# Oracle twin of stage_tx over the combined dentist+hygienist extract.
def _permit_date(c):
    return (f"case when professional_type = 'dentist' and not ({c} in ('No Permit', '')) "
            f"then try_strptime(trim({c}), '%m/%d/%Y')::date end")


def _permit(c):
    return f"case when professional_type = 'dentist' then not ({c} in ('No Permit', '')) else false end"


def _says(c, kind, test="= 'YES'"):
    return f"case when professional_type = '{kind}' then upper(trim({c})) {test} else false end"


_LEVELS = (1, 2, 3, 4)

STAGED_SQL = sql_cte("tx_license_raw") + f""",
staged as (
  select md5(concat_ws('-', 'TX', professional_type, trim(lic_nbr))) as professional_id,
    'TX' as state_code, professional_type, cast(lic_id as integer) as source_license_id,
    trim(lic_nbr) as license_number, try_cast(entity_nbr as integer) as entity_number,
    cast(lic_sta_cde as integer) as status_code, trim(lic_sta_desc) as status_description,
    {_STATUS} as status_category,
    try_strptime(trim(lic_orig_dte), '%m/%d/%Y')::date as license_issue_date,
    try_strptime(trim(lic_expr_dte), '%m/%d/%Y')::date as license_expiration_date,
    trim(first_nme) as first_name, trim(middle_nme) as middle_name, trim(coalesce(last_nme, last_mne)) as last_name,
    trim(former_last_nme) as former_last_name, trim(gender) as gender,
    nullif(trim(birth_year), '') as birth_year, nullif(trim(grad_yr), '') as graduation_year,
    trim(school) as school_name, trim(address1) as address_line_1,
    trim(address2) as address_line_2, trim(city) as city, trim(state) as address_state,
    trim(zip) as zip_code, trim(county) as county, trim(country) as country,
    trim(phone) as phone, case when professional_type = 'dentist' then trim(prac_desc) end as practice_description,
    case when professional_type = 'dentist' then trim(prac_types) end as specialty_code,
    case when professional_type = 'dentist' then {_SPEC} end as specialty_description,
    {_permit_date('nox_permit_dte')} as nitrous_oxide_permit_date, {_permit('nox_permit_dte')} as has_nitrous_oxide_permit,
    {', '.join(f"{_permit(f'level_{k}_dte')} as has_anesthesia_level_{k}" for k in _LEVELS)},
    {_says('portability', 'dentist')} as has_portability,
    {_says('sealant', 'hygienist')} as has_sealant_certification,
    {_says('nom_mod', 'hygienist')} as has_nitrous_monitoring,
    {_says('lia_mod', 'hygienist')} as has_local_infiltration_anesthesia,
    upper(trim(disc_action)) = 'YES' as has_disciplinary_action, upper(trim(remedial_plns)) = 'YES' as has_remedial_plans,
    {', '.join(f"{_permit_date(f'level_{k}_dte')} as anesthesia_level_{k}_date" for k in _LEVELS)},
    {_says('shrp_mod', 'dentist', "<> 'NO'")} as has_shrp_modifier, {_says('spp_mod', 'dentist', "<> 'NO'")} as has_spp_modifier,
    {_says('erx_waiver', 'dentist')} as has_erx_waiver, {_says('level_exempt', 'dentist')} as is_level_exempt,
    cast(null as varchar) as business_name, cast(null as varchar) as owner_name, cast(null as varchar) as manager_name,
    cast(null as varchar) as certified_dental_technician, cast(null as varchar) as lab_type,
    snapshot_date
  from tx_license_raw
)
"""

# One row per key per snapshot (highest source licence id), as the history step requires.
SNAPSHOTS_SQL = STAGED_SQL + """,
snap as (
  select * exclude (rn) from (
    select *, row_number() over (partition by professional_id, snapshot_date order by source_license_id desc) as rn
    from staged) where rn = 1
),
s0 as (select * exclude (snapshot_date) from snap where snapshot_date = '2025-06-29'),
s1 as (select * exclude (snapshot_date) from snap where snapshot_date = '2025-06-30')
"""

_CHECK = " or ".join(f"c.{c} is distinct from s.{c}" for c in H.LICENSE_CHECK_COLS)
_COLS = [c for c in ST.STAGED_COLUMNS]
_C = ", ".join(f"c.{c}" for c in _COLS)
_S = ", ".join(f"s.{c}" for c in _COLS)

# Oracle twin of two scd2_apply steps: the first snapshot opens everything; the
# second keeps unchanged, closes changed + removed, opens changed + added.
HISTORY_SQL = SNAPSHOTS_SQL + f""",
h0 as (
  select *, md5(concat_ws('-', professional_id, '2025-06-29 00:00:00')) as scd_id,
    cast('2025-06-29' as timestamp) as valid_from, cast(null as timestamp) as valid_to from s0
),
history as (
  select {_C}, c.scd_id, c.valid_from, c.valid_to
    from h0 c join s1 s on c.professional_id = s.professional_id where not ({_CHECK})
  union all
  select {_C}, c.scd_id, c.valid_from, cast('2025-06-30' as timestamp)
    from h0 c join s1 s on c.professional_id = s.professional_id where ({_CHECK})
  union all
  select {_C}, c.scd_id, c.valid_from, cast('2025-06-30' as timestamp)
    from h0 c where not exists (select 1 from s1 s where s.professional_id = c.professional_id)
  union all
  select {_S}, md5(concat_ws('-', s.professional_id, '2025-06-30 00:00:00')), cast('2025-06-30' as timestamp), cast(null as timestamp)
    from s1 s left join h0 c on c.professional_id = s.professional_id
    where c.professional_id is null or ({_CHECK})
)
"""


@per_session
def staged(spark, sf):
    return ST.stage_tx(binding(spark, sf, "tx_license_raw"))


@per_session
def snapshots(spark, sf):
    """One row per (professional, snapshot date) for every snapshot, in one aggregate."""
    return latest_per_key(staged(spark, sf), ["professional_id", "snapshot_date"], [F.col("source_license_id")])


@per_session
def snapshot(spark, sf, day):
    return snapshots(spark, sf).filter(F.col("snapshot_date") == day).drop("snapshot_date")


@per_session
def history(spark, sf):
    h = H.scd2_apply(None, snapshot(spark, sf, SNAP0), "professional_id", H.LICENSE_CHECK_COLS, SNAP0)
    return H.scd2_apply(h, snapshot(spark, sf, SNAP1), "professional_id", H.LICENSE_CHECK_COLS, SNAP1)


@query("stage_tx_licenses", STAGED_SQL + "select * from staged", "STG1, STG2, KEY1, PRJ8")
def q_staged(spark, sf):
    return staged(spark, sf)


@query("active_licenses", STAGED_SQL + "select * from staged where status_code in (20, 46, 70)", "FLT5, SET2")
def q_active(spark, sf):
    return ST.active_licenses(staged(spark, sf))


_RECENT_ACTIVE = """((professional_type in ('dentist', 'hygienist') and status_code in (20, 46, 70))
  or (professional_type = 'dental_assistant' and status_code in (20, 46)))"""


@query("recent_licenses", STAGED_SQL + f"""
select * from staged where snapshot_date = '2025-06-30'
  and license_issue_date >= date '2025-06-30' - 365 and {_RECENT_ACTIVE}
  and professional_type in ('dentist', 'hygienist') and upper(county) in ('COUNTY1', 'COUNTY2')
""", "FLT6")
def q_recent(spark, sf):
    s = staged(spark, sf).filter(F.col("snapshot_date") == SNAP1)
    return ST.recent_licenses(s, 365, AS_OF, ["dentist", "hygienist"], ["county1", "County2"])


@query("recent_license_events", STAGED_SQL + f"""
select left(md5(concat_ws('-', state_code, license_number, 'NEW_LICENSE')), 12) as event_id, 'NEW_LICENSE' as event_type,
  strftime(cast(license_issue_date as timestamp), '%Y-%m-%dT%H:%M:%S') as timestamp, state_code, professional_type,
  license_number, coalesce(trim(first_name), '') as first_name, coalesce(trim(last_name), '') as last_name,
  coalesce(trim(city), '') as city, coalesce(trim(county), '') as county, coalesce(trim(zip_code), '') as zip_code,
  coalesce(trim(address_state), state_code) as state, 'HIGH' as priority, 'new_licensee_campaign' as marketing_action
from staged where snapshot_date = '2025-06-30'
  and license_issue_date >= date '2025-06-30' - 1000 and {_RECENT_ACTIVE}
""", "EVT12, FLT6")
def q_recent_events(spark, sf):
    s = staged(spark, sf).filter(F.col("snapshot_date") == SNAP1)
    return E.recent_to_events(ST.recent_licenses(s, 1000, AS_OF))


@query("license_history", HISTORY_SQL + "select * from history", "HIS1")
def q_history(spark, sf):
    return history(spark, sf)


@query("license_history_changed_ranges", HISTORY_SQL + "select * from history", "HIS1, SRC5 (only key ranges whose digests differ)")
def q_history_ranges(spark, sf):
    ranged = RangedSnapshots(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranged-{uuid.uuid4().hex}",
                             ["professional_type", "license_number"], ["professional_id", *H.LICENSE_CHECK_COLS], fanout=4)
    for day in (SNAP0, SNAP1):
        ranged.write(day, snapshot(spark, sf, day), staged(spark, sf).filter(F.col("snapshot_date") == day))
    first = H.scd2_apply(None, ranged.read(SNAP0), "professional_id", H.LICENSE_CHECK_COLS, SNAP0)
    changed = ranged.changed(SNAP0, SNAP1)
    return H.scd2_apply_ranges(first, ranged.read(SNAP1, changed), ranged.inside(changed), "professional_id",
                               H.LICENSE_CHECK_COLS, SNAP1)


@query("license_history_current", HISTORY_SQL + "select * from history where valid_to is null", "HIS4")
def q_history_current(spark, sf):
    return H.current_view(history(spark, sf))


@query("license_history_as_of", HISTORY_SQL + """
select * from history where valid_from <= timestamp '2025-06-29 12:00:00'
  and (valid_to is null or valid_to > timestamp '2025-06-29 12:00:00')
""", "HIS3")
def q_history_as_of(spark, sf):
    return H.as_of_view(history(spark, sf), "2025-06-29 12:00:00")


_EVENTS_SQL = HISTORY_SQL + """,
v as (
  select h.*, p.status_category as p_cat, p.license_expiration_date as p_exp, p.address_line_1 as p_a1,
    p.city as p_city, p.address_state as p_state, p.zip_code as p_zip, p.county as p_county,
    p.has_nitrous_oxide_permit as p_nitrous, p.has_anesthesia_level_4 as p_anes4,
    p.has_sealant_certification as p_sealant, p.professional_id is null as is_new
  from (select *, lag(scd_id) over (partition by professional_id order by valid_from) as prev_id from history) h
  left join history p on h.prev_id = p.scd_id
),
ev as (
  select *, 'NEW_LICENSE' as rk, 'NEW_LICENSE' as event_type, 'New licensee detected' as event_description,
    cast(null as varchar) as previous_value, status_category as current_value, 'HIGH' as priority,
    'onboarding' as marketing_action from v where is_new
  union all select *, 'STATUS_LAPSED', 'STATUS_LAPSED', 'License cancelled or expired', p_cat, status_category,
    'MEDIUM', 'winback_or_suppress' from v where not is_new and p_cat = 'ACTIVE' and status_category = 'LAPSED'
  union all select *, 'STATUS_REINSTATED', 'STATUS_REINSTATED', 'License reinstated', p_cat, status_category,
    'HIGH', 'reengagement' from v where not is_new and p_cat in ('LAPSED', 'SUSPENDED') and status_category = 'ACTIVE'
  union all select *, 'STATUS_DECEASED', 'STATUS_DECEASED', 'Licensee deceased - remove from all lists', p_cat,
    status_category, 'CRITICAL', 'suppress_all' from v where not is_new and p_cat != 'DECEASED' and status_category = 'DECEASED'
  union all select *, 'ADDRESS_CHANGE', 'ADDRESS_CHANGE', 'Practice address changed',
    coalesce(p_city, '') || ', ' || coalesce(p_state, ''), coalesce(city, '') || ', ' || coalesce(address_state, ''),
    'LOW', 'update_crm_territory' from v where not is_new and (coalesce(p_a1, '') != coalesce(address_line_1, '')
      or coalesce(p_city, '') != coalesce(city, '') or coalesce(p_zip, '') != coalesce(zip_code, ''))
  union all select *, 'TERRITORY_CHANGE', 'TERRITORY_CHANGE', 'County/territory changed', p_county, county,
    'MEDIUM', 'territory_reassignment' from v where not is_new and coalesce(p_county, '') != coalesce(county, '')
      and county is not null
  union all select *, 'NEW_CERT_NITROUS', 'NEW_CERTIFICATION', 'Obtained nitrous oxide permit', 'No permit',
    'Nitrous oxide permit', 'HIGH', 'upsell_sedation_products' from v
    where not is_new and p_nitrous = false and has_nitrous_oxide_permit = true
  union all select *, 'NEW_CERT_ANES_4', 'NEW_CERTIFICATION', 'Obtained anesthesia level 4 permit', 'No level 4 permit',
    'Anesthesia level 4 permit', 'HIGH', 'upsell_advanced_sedation' from v
    where not is_new and p_anes4 = false and has_anesthesia_level_4 = true
  union all select *, 'NEW_CERT_SEALANT', 'NEW_CERTIFICATION', 'Obtained sealant certification', 'No certification',
    'Sealant certification', 'MEDIUM', 'upsell_preventive_products' from v
    where not is_new and professional_type = 'hygienist' and p_sealant = false and has_sealant_certification = true
  union all select *, 'EXPIRATION_APPROACHING', 'EXPIRATION_APPROACHING', 'License expiring within 90 days',
    cast(p_exp as varchar), cast(license_expiration_date as varchar), 'MEDIUM', 'renewal_reminder' from v
    where status_category = 'ACTIVE' and license_expiration_date between date '2025-06-30' and date '2025-06-30' + 90
      and coalesce(p_exp, date '1900-01-01') != license_expiration_date
),
events_out as (
  select md5(concat_ws('-', professional_id, cast(valid_from as varchar), rk)) as event_id, professional_id,
    state_code, professional_type, license_number, first_name, last_name, valid_from as event_timestamp,
    event_type, event_description, previous_value, current_value, priority, marketing_action
  from ev where valid_from > timestamp '1900-01-01'
)
"""


@per_session
def license_events(spark, sf):
    return E.license_events(history(spark, sf), AS_OF)


@query("license_events", _EVENTS_SQL + "select * from events_out", "EVT0-EVT10, JOIN6, WIN6, JOIN17")
def q_events(spark, sf):
    return license_events(spark, sf)


@query("license_events_incremental", _EVENTS_SQL + """
select * from events_out where event_timestamp > timestamp '2025-06-29 00:00:00'
""", "EVT0 incremental (JOIN17 watermark from previous run)")
def q_events_incr(spark, sf):
    h = history(spark, sf)
    first_run = E.license_events(H.as_of_view(h, SNAP0), AS_OF)
    return E.license_events(h, AS_OF, previous_events=first_run)


@query("event_type_counts", _EVENTS_SQL + """
select event_type, count(*) as event_count from events_out group by event_type
""", "AGG20")
def q_event_counts(spark, sf):
    return license_events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


# Differ: per-type dedupe by highest lic_id, anti-join / inner join on licence number.
_DIFF_SQL = sql_cte("tx_license_raw") + """,
r as (select * exclude (rn) from (select *, row_number() over (partition by snapshot_date, professional_type, trim(lic_nbr)
        order by lic_id desc) as rn from tx_license_raw) where rn = 1),
c as (select * from r where snapshot_date = '2025-06-30'),
p as (select * from r where snapshot_date = '2025-06-29'),
new_rows as (select c.* from c where lic_sta_cde in (20, 46, 70) and not exists
  (select 1 from p where p.professional_type = c.professional_type and trim(p.lic_nbr) = trim(c.lic_nbr))),
ch as (select c.*, p.lic_sta_cde as prev_code, p.lic_sta_desc as prev_desc from c join p on p.professional_type = c.professional_type
  and trim(p.lic_nbr) = trim(c.lic_nbr) where p.lic_sta_cde is distinct from c.lic_sta_cde),
shaped as (
  select 'NEW' as pfx, 'NEW_LICENSE' as event_type, cast(null as varchar) as previous_value, 'HIGH' as priority,
    'onboarding_sequence' as marketing_action, * from new_rows
  union all select 'LAPSED', 'LAPSED', coalesce(prev_desc, ''), 'MEDIUM', 'suppress_or_winback', * exclude (prev_code, prev_desc) from ch
    where prev_code in (20, 46, 70) and lic_sta_cde in (45, 48, 60)
  union all select 'REINSTATED', 'REINSTATED', coalesce(prev_desc, ''), 'HIGH', 'reengagement_sequence', * exclude (prev_code, prev_desc) from ch
    where prev_code in (45, 48, 60) and lic_sta_cde in (20, 46, 70)
)
select pfx || '_' || trim(lic_nbr) || '_2025-06-30' as event_id,
  concat_ws('_', pfx, professional_type, trim(lic_nbr), '2025-06-30') as event_key, event_type,
  '2025-06-30' as timestamp, 'TX' as state_code, professional_type, trim(lic_nbr) as license_number,
  trim(coalesce(first_nme, '')) as first_name, trim(coalesce(last_nme, last_mne, '')) as last_name,
  nullif(trim(city), '') as city, nullif(trim(county), '') as county, nullif(left(trim(zip), 5), '') as zip_code,
  previous_value, coalesce(lic_sta_desc, '') as current_value, priority, marketing_action
from shaped
"""


@query("snapshot_diff_events", _DIFF_SQL, "EVT11, JOIN7, JOIN8, SET5")
def q_diff(spark, sf):
    raw = binding(spark, sf, "tx_license_raw")
    return E.snapshot_diff(raw.filter(F.col("snapshot_date") == SNAP1),
                           raw.filter(F.col("snapshot_date") == SNAP0), AS_OF)


# Each kind staged from its own file, without the columns it has no use for, then stacked.
_DENTIST_ONLY = [c for c in ST.STAGED_COLUMNS if "anesthesia_level" in c or c in (
    "has_nitrous_oxide_permit", "has_portability", "has_shrp_modifier", "has_spp_modifier", "has_erx_waiver", "is_level_exempt")]
_HYGIENIST_ONLY = ["has_sealant_certification", "has_nitrous_monitoring", "has_local_infiltration_anesthesia"]


@query("professionals_union", STAGED_SQL + "select * from staged", "SET1")
def q_union(spark, sf):
    raw = binding(spark, sf, "tx_license_raw")
    kinds = {k: ST.stage_tx(raw.where(F.col("professional_type") == k), k) for k in ("dentist", "hygienist")}
    return ST.union_professionals(kinds["dentist"].drop(*_HYGIENIST_ONLY), kinds["hygienist"].drop(*_DENTIST_ONLY))


# Events of every rule, so that a rule that no row reaches shows as a missing line.
@query("license_event_rules", _EVENTS_SQL + """
select event_type, event_description, priority, marketing_action, count(*) as events,
  count(previous_value) as with_previous, count(current_value) as with_current
from events_out group by all
""", "EVT1-EVT10 (each rule fires)")
def q_event_rules(spark, sf):
    return license_events(spark, sf).groupBy("event_type", "event_description", "priority", "marketing_action").agg(
        F.count(F.lit(1)).alias("events"), F.count("previous_value").alias("with_previous"),
        F.count("current_value").alias("with_current"))


# The previous snapshot holds no hygienist file: only dentists can be compared.
@query("snapshot_diff_new_type", _DIFF_SQL.replace("snapshot_date = '2025-06-29'", "snapshot_date = '2025-06-29' and professional_type = 'dentist'")
       .replace("snapshot_date = '2025-06-30'", "snapshot_date = '2025-06-30' and professional_type = 'dentist'"),
       "EVT11 (a type absent from the previous snapshot is skipped)")
def q_diff_new_type(spark, sf):
    raw = binding(spark, sf, "tx_license_raw")
    return E.snapshot_diff(raw.filter(F.col("snapshot_date") == SNAP1),
                           raw.filter((F.col("snapshot_date") == SNAP0) & (F.col("professional_type") == "dentist")), AS_OF)


# FIXED VALUES in the SQL below: expiry bands, sedation order, segments and priority scores, as in operators/dims.py.
@query("dim_professionals", HISTORY_SQL + """
select professional_id, state_code, professional_type, source_license_id, license_number, status_code,
  status_category, license_issue_date, license_expiration_date,
  cast(year(date '2025-06-30') - year(license_issue_date) as integer) as years_licensed,
  cast(license_expiration_date - date '2025-06-30' as integer) as days_until_expiration,
  case when license_expiration_date < date '2025-06-30' then 'EXPIRED'
       when license_expiration_date < date '2025-06-30' + 30 then 'EXPIRING_30_DAYS'
       when license_expiration_date < date '2025-06-30' + 90 then 'EXPIRING_90_DAYS' else 'VALID' end as expiration_status,
  first_name, last_name, concat(first_name, ' ', last_name) as full_name,
  cast(year(date '2025-06-30') - try_cast(birth_year as integer) as integer) as approximate_age,
  cast(year(date '2025-06-30') - try_cast(graduation_year as integer) as integer) as years_since_graduation,
  city, address_state, zip_code, left(zip_code, 5) as zip5, county, specialty_code, specialty_description,
  case when has_anesthesia_level_4 then 'LEVEL_4' when has_anesthesia_level_3 then 'LEVEL_3'
       when has_anesthesia_level_2 then 'LEVEL_2' when has_anesthesia_level_1 then 'LEVEL_1'
       when has_nitrous_oxide_permit then 'NITROUS_ONLY' else 'NONE' end as sedation_level,
  cast((case when has_nitrous_oxide_permit then 1 else 0 end) + (case when has_anesthesia_level_1 then 1 else 0 end)
    + (case when has_anesthesia_level_2 then 1 else 0 end) + (case when has_anesthesia_level_3 then 1 else 0 end)
    + (case when has_anesthesia_level_4 then 1 else 0 end) + (case when has_sealant_certification then 1 else 0 end)
    + (case when has_nitrous_monitoring then 1 else 0 end)
    + (case when has_local_infiltration_anesthesia then 1 else 0 end) as integer) as certification_count,
  case when professional_type = 'dentist' and specialty_code in ('GEN', '') then 'General Dentist'
       when professional_type = 'dentist' then 'Specialist' when professional_type = 'hygienist' then 'Hygienist'
       when professional_type = 'dental_assistant' then 'Assistant' else 'Other' end as professional_segment,
  case when status_category != 'ACTIVE' then 0 when has_disciplinary_action then 1
       when professional_type = 'dentist' and has_anesthesia_level_4 then 5
       when professional_type = 'dentist' and specialty_code in ('OMS', 'PERI', 'ORTH') then 4
       when professional_type = 'dentist' then 3 when professional_type = 'hygienist' then 2 else 1 end as marketing_priority_score,
  valid_from as record_valid_from, entity_number, status_description, middle_name, former_last_name, gender, birth_year, graduation_year, school_name, address_line_1, address_line_2, country, phone, practice_description, has_nitrous_oxide_permit, has_anesthesia_level_1, has_anesthesia_level_2, has_anesthesia_level_3, has_anesthesia_level_4, has_portability, has_sealant_certification, has_nitrous_monitoring, has_local_infiltration_anesthesia, has_disciplinary_action, has_remedial_plans
from history where valid_to is null
""", "DIM1, HIS4")
def q_dim(spark, sf):
    return D.dim_professionals(history(spark, sf), AS_OF)


@query("new_licensee_payloads", STAGED_SQL + f"""
, ev as (select left(md5(concat_ws('-', state_code, license_number, 'NEW_LICENSE')), 12) as event_id,
    strftime(cast(license_issue_date as timestamp), '%Y-%m-%dT%H:%M:%S') as timestamp, state_code, professional_type,
    license_number, coalesce(trim(first_name), '') as first_name, coalesce(trim(last_name), '') as last_name,
    coalesce(trim(city), '') as city, coalesce(trim(county), '') as county, coalesce(trim(zip_code), '') as zip_code
  from staged where snapshot_date = '2025-06-30' and license_issue_date >= date '2025-06-30' - 1000 and {_RECENT_ACTIVE}),
p as (select event_id, cast(json_object('locationId', 'loc-1', 'firstName', first_name, 'lastName', last_name, 'email', '',
    'phone', '', 'address1', '', 'city', city, 'state', coalesce(state_code, 'TX'), 'postalCode', zip_code,
    'source', 'License Pipeline', 'tags', ['new_licensee', 'license_' || coalesce(professional_type, 'dentist'),
    'county_' || coalesce(county, 'unknown')],
    'customField', json_object('license_number', license_number, 'license_date', left(coalesce(timestamp, ''), 10),
      'professional_type', professional_type, 'county', county)) as varchar) as payload from ev)
select event_id, payload, sha256(payload) as payload_hash from p
""", "EXP7, EXP10, EVT12")
def q_payloads_events(spark, sf):
    from ..operators import export as X
    s = staged(spark, sf).filter(F.col("snapshot_date") == SNAP1)
    ev = E.recent_to_events(ST.recent_licenses(s, 1000, AS_OF))
    return X.payload_hash(X.event_contact_payload(ev, "loc-1"))
