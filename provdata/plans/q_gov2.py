"""Table-driven validation, load registration, enrichment backlog, contact import (VAL9, GOV1, JOIN9, JOIN20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import export as X
from ..operators import governance as G
from ..operators import people as PE
from ..operators import validate as V
from ..operators import enrich as N
from ..sources.bindings import AS_OF, CONTACT_IMPORT, DATA_LOADS, ENRICHMENTS, EXPORT_QUEUE, binding, data_loads
from .q_governance import _TX_VALIDATION_SQL, _tx_raw
from .q_providers import PROVIDERS_SQL, providers
from .q_enrich import WATERFALL_CTE
from .registry import query

TX_COLUMN_MAP = {"LICENSE_NUMBER": "lic_nbr", "LAST_NAME": "last_nme", "CITY": "city", "STATUS_CODE": "lic_sta_cde",
                 "LICENSE_ORIGINAL_DATE": "lic_orig_dte"}


def table_validation(spark, sf):
    rules = V.rules_from_table(V.rules_table(spark), "tx_license", TX_COLUMN_MAP)
    return V.validate_load(_tx_raw(spark, sf, "2025-06-30"), rules, prev=_tx_raw(spark, sf, "2025-06-29"), as_of=AS_OF)


@query("validate_tx_table_rules", _TX_VALIDATION_SQL + """
select * replace (cast(threshold as double) as threshold) from (
  select 0 as rule_index, 'row_count_min' as rule_name, 'row_count_min' as rule_type, 'error' as severity, n >= 1000 as passed,
    cast(n as double) as observed, 1000.0 as threshold, '' as detail from s
  union all select 1, 'row_count_delta', 'row_count_delta', 'error', abs(n - pn) / pn <= 0.2, cast(abs(n - pn) as double) / pn, 0.2, '' from s, p
  union all select 2, 'row_count_delta', 'row_count_delta', 'warning', abs(n - pn) / pn <= 0.05, cast(abs(n - pn) as double) / pn, 0.05, '' from s, p
  union all select 3, 'field_populated_lic_nbr', 'field_populated', 'error', cast(p_lic as double) / n >= 0.99, cast(p_lic as double) / n, 0.99, '' from s
  union all select 4, 'field_populated_last_nme', 'field_populated', 'error', cast(p_last as double) / n >= 0.99, cast(p_last as double) / n, 0.99, '' from s
  union all select 5, 'field_populated_city', 'field_populated', 'warning', cast(p_city as double) / n >= 0.9, cast(p_city as double) / n, 0.9, '' from s
  union all select 6, 'value_distribution_lic_sta_cde_20', 'value_distribution', 'error', cast(v20 as double) / n >= 0.5, cast(v20 as double) / n, 0.5, '' from s
  union all select 7, 'date_range_lic_orig_dte', 'date_range', 'error', new = 0, cast(new as double), 0.0, '0;' || cast(new as varchar) from s
  union all select 8, 'date_range_lic_orig_dte', 'date_range', 'error', old = 0, cast(old as double), 0.0, cast(old as varchar) || ';0' from s
)
""", "VAL9 (rules as data, severity override)")
def q_table_rules(spark, sf):
    return table_validation(spark, sf)


@query("register_validated_load", _TX_VALIDATION_SQL + f"""
, loads as ({DATA_LOADS.format(export_queue=EXPORT_QUEUE.format(orders='orders'))}),
v as (select count_if(not passed and severity = 'error') = 0 as ok from results)
select *, cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at from loads
union all
select left(md5(concat_ws('-', 'tx_license', '{AS_OF}')), 12), case when ok then 'validated' else 'quarantined' end, ok,
  'tx_license', 'TX', cast(n as bigint), cast(n - pn as double) / pn, timestamp '{AS_OF}', date '{AS_OF}',
  case when ok then timestamp '{AS_OF}' end, 24, timestamp '{AS_OF}', timestamp '{AS_OF}'
from s, p, v
""", "GOV1")
def q_register(spark, sf):
    cur, prev = _tx_raw(spark, sf, "2025-06-30"), _tx_raw(spark, sf, "2025-06-29")
    verdict = V.load_verdict(V.validate_load(cur, V.TX_LICENSE_RULES, prev=prev, as_of=AS_OF))
    n = cur.select(F.count(F.lit(1))).scalar()
    pn = prev.select(F.count(F.lit(1))).scalar()
    now = F.lit(AS_OF).cast("timestamp_ntz")
    # The id is attached through a column of the verdict row, so it stays a join key (a folded
    # literal would turn the registry anti-join into a nested loop).
    new = verdict.select(
        F.when(F.col("rules") > 0, C.short_id(F.lit("tx_license"), F.lit(AS_OF))).alias("load_id"),
        F.when(F.col("passed"), "validated").otherwise("quarantined").alias("status"),
        F.col("passed").alias("validation_passed"), F.lit("tx_license").alias("source_type"),
        F.lit("TX").alias("state_code"), n.cast("bigint").alias("row_count"),
        ((n - pn).cast("double") / pn).alias("row_count_delta_pct"), now.alias("loaded_at"),
        F.lit(AS_OF).cast("date").alias("source_date"), F.when(F.col("passed"), now).alias("validated_at"),
        F.lit(24).alias("promotion_delay_hours"))
    loads = data_loads(spark, sf).select("*", F.lit(None).cast("timestamp_ntz").alias("created_at"),
                                         F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return G.register_load(loads, new, AS_OF)


@query("not_yet_enriched", PROVIDERS_SQL + f""", enrichments as ({ENRICHMENTS.format(customer='customer')}),
{WATERFALL_CTE}
select * from providers p where entity_type = 'Individual'
  and not exists (select 1 from wf where wf.provider_id = p.npi and wf.email is not null)
order by npi limit 100
""", "JOIN9, TOP4")
def q_not_enriched(spark, sf):
    done = N.waterfall(binding(spark, sf, "enrichments")).filter(F.col("email").isNotNull()) \
        .select(F.col("provider_id").alias("npi"))
    ind = providers(spark, sf).filter(F.col("entity_type") == "Individual")
    return X.batch_unprocessed(ind, done, "npi", ["npi"], 100)


@query("contact_import_matches", PROVIDERS_SQL + f""", contact_import as ({CONTACT_IMPORT.format(customer='customer')}),
side as (select upper(trim(first_name)) as fn, upper(trim(last_name)) as ln, upper(trim(practice_state)) as st,
           min(npi) as npi from providers where entity_type = 'Individual' and first_name is not null and last_name is not null group by all),
named as (select s.*, p.display_name from side s join providers p on s.npi = p.npi)
select c.*, n.npi as matched_npi, n.display_name as matched_name,
  case when c.email is null then null when lower(split_part(c.email, '@', 2)) in ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com', 'aol.com', 'icloud.com') then 'personal' else 'work' end as email_type,
  n.npi is not null as is_matched
from contact_import c left join named n on upper(trim(c.first_name)) = n.fn and upper(trim(c.last_name)) = n.ln and upper(trim(c.state)) = n.st
""", "JOIN20")
def q_import(spark, sf):
    return PE.match_import(binding(spark, sf, "contact_import"), providers(spark, sf))
