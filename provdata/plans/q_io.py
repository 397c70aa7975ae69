"""Snapshot fingerprints, snapshot pairs and keyed merges (SRC4, SRC5, SNK2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from ..sources.bindings import binding, sql_cte
from ..sources.keyed import KeyedTable
from .registry import query

_CONTENT = ["lic_id", "lic_nbr", "lic_sta_cde", "lic_orig_dte", "lic_expr_dte", "first_nme", "last_nme", "address1",
            "city", "state", "zip", "county", "nox_permit_dte", "prac_types"]
_DIGEST = ("sum(cast(cast(('0x' || left(md5(concat_ws('|', "
           + ", ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '\\N')" for c in _CONTENT)
           + ")), 15)) as bigint) as decimal(38,0)))")

_FP_SQL = sql_cte("tx_license_raw") + f""",
fp as (select snapshot_date, professional_type, count(*) as rows, {_DIGEST} as digest from tx_license_raw group by all)
"""


def _raw(spark, sf):
    return binding(spark, sf, "tx_license_raw").select("snapshot_date", "professional_type", *_CONTENT)


@query("snapshot_fingerprints", _FP_SQL + "select * from fp", "SRC5")
def q_fp(spark, sf):
    return IO.snapshot_fingerprint(_raw(spark, sf), ["snapshot_date", "professional_type"])


@query("snapshot_unchanged", _FP_SQL + """
, c as (select * from fp where snapshot_date = '2025-06-30'), p as (select * from fp where snapshot_date = '2025-06-29')
select coalesce(c.professional_type, p.professional_type) as professional_type, c.rows as rows_current,
  c.digest as digest_current, p.rows as rows_previous, p.digest as digest_previous,
  coalesce(c.digest = p.digest, false) as unchanged
from c full outer join p on c.professional_type = p.professional_type
""", "SRC5 (unchanged files)")
def q_unchanged(spark, sf):
    raw = _raw(spark, sf)
    fp = IO.snapshot_fingerprint(raw, ["snapshot_date", "professional_type"])
    cur = fp.filter(F.col("snapshot_date") == "2025-06-30").drop("snapshot_date")
    prev = fp.filter(F.col("snapshot_date") == "2025-06-29").drop("snapshot_date")
    return IO.unchanged_snapshots(cur, prev, ["professional_type"])


@query("latest_snapshot_pair", sql_cte("tx_license_raw") + """
, d as (select distinct cast(snapshot_date as date) as snapshot_date from tx_license_raw)
select max(snapshot_date) as current_date,
  coalesce((select max(snapshot_date) from d where snapshot_date < (select max(snapshot_date) from d)), max(snapshot_date)) as previous_date
from d
""", "SRC4")
def q_pair(spark, sf):
    return IO.latest_pair(binding(spark, sf, "tx_license_raw"))


_MERGE_SQL = sql_cte("enrichments") + """,
tgt as (select * from enrichments where day(enriched_at) <= 20),
upd as (select * replace (upper(email) as email) from enrichments where day(enriched_at) >= 10)
"""


def _merge_inputs(spark, sf):
    e = binding(spark, sf, "enrichments")
    return (e.filter(F.dayofmonth("enriched_at") <= 20),
            e.filter(F.dayofmonth("enriched_at") >= 10).withColumn("email", F.upper("email")))


@query("upsert_replace", _MERGE_SQL + """
select * from tgt t where not exists (select 1 from upd u where u.provider_id = t.provider_id and u.source = t.source
  and u.enriched_at = t.enriched_at)
union all select * from upd
""", "SNK2 (replace)")
def q_upsert_replace(spark, sf):
    t, u = _merge_inputs(spark, sf)
    return IO.merge_upsert(t, u, ["provider_id", "source", "enriched_at"], "replace")


@query("upsert_insert_only", _MERGE_SQL + """
select * from tgt union all
select * from upd u where not exists (select 1 from tgt t where u.provider_id = t.provider_id and u.source = t.source
  and u.enriched_at = t.enriched_at)
""", "SNK2 (insert only)")
def q_upsert_insert(spark, sf):
    t, u = _merge_inputs(spark, sf)
    return IO.merge_upsert(t, u, ["provider_id", "source", "enriched_at"], "insert_only")


_KEYED_SQL = _MERGE_SQL + """,
merged as (
  select * from tgt t where not exists (select 1 from upd u where u.provider_id = t.provider_id and u.source = t.source
    and u.enriched_at = t.enriched_at)
  union all select * from upd),
kept as (select * from merged where day(enriched_at) <> 15)
"""


def _keyed_table(spark, sf):
    """Target, upserts and deletions as commits of a merge-on-read table under the checkpoint folder."""
    table = KeyedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}",
                       ["provider_id", "source", "enriched_at"], buckets=8)
    target, updates = _merge_inputs(spark, sf)
    table.upsert(target)
    table.compact()
    table.upsert(updates)
    table.delete(table.read().where(F.dayofmonth("enriched_at") == 15))
    return table


@query("keyed_table_merge_on_read", _KEYED_SQL + "select * from kept", "SNK2 (deltas and tombstones over a base)")
def q_keyed(spark, sf):
    return _keyed_table(spark, sf).read()


@query("keyed_table_compacted", _KEYED_SQL + """
select * replace (case when day(enriched_at) >= 28 then null else email end as email) from kept
union all select * replace ('late-' || provider_id as provider_id) from tgt where day(enriched_at) <= 3
""", "SNK2 (insert-only and replace after a compaction)")
def q_keyed_compacted(spark, sf):
    table = _keyed_table(spark, sf)
    table.compact()
    now = table.read()
    table.upsert(now.where(F.dayofmonth("enriched_at") >= 28).withColumn("email", F.lit(None).cast("string")))
    target = _merge_inputs(spark, sf)[0]
    late = target.where(F.dayofmonth("enriched_at") <= 3).withColumn("provider_id", F.concat(F.lit("late-"), "provider_id"))
    table.upsert(late.unionByName(now.withColumn("email", F.lit("never"))), "insert_only")
    table.vacuum(1)
    return table.read()
