"""Connector round trips and the other Texas file kinds (SRC1-SRC3, SRC6, SNK1, SNK3, SNK4, STG3, STG4).

Each round trip writes rows Spark derives from the driver tables with the
library's writer (under the shared ``spark.checkpoint.dir``), reads them
back with the library's reader and returns what was read, so the oracle
compares the end-to-end file path with the source rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import staging as ST
from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from ..sources.bindings import binding, sql_cte
from .q_staging import status_sql
from .registry import query

_LIC_COLS = ["lic_id", "lic_nbr", "professional_type", "lic_sta_cde", "lic_orig_dte", "lic_expr_dte", "first_nme",
             "last_nme", "address1", "city", "state", "zip", "county", "nox_permit_dte", "prac_types"]


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip/{name}-{uuid.uuid4().hex}"


def _as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


_TEXT_SQL = sql_cte("tx_license_raw") + ", t as (select " + ", ".join(
    f"nullif(trim(cast({c} as varchar)), '') as {c}" for c in _LIC_COLS) + \
    " from tx_license_raw)\n"


def _csv_roundtrip(spark, sf, sep):
    rows = _as_text(binding(spark, sf, "tx_license_raw").select(*_LIC_COLS))
    path = _scratch(spark, "csv")
    rows.write.option("header", True).option("sep", sep).csv(path)
    good, _ = IO.read_license_csv(spark, path, _LIC_COLS, sep=sep)
    return good


@query("license_csv_roundtrip", _TEXT_SQL + "select * from t", "SRC2 (CSV reader, NULL tokens, trimming)")
def q_csv(spark, sf):
    return _csv_roundtrip(spark, sf, ",")


@query("license_pipe_roundtrip", _TEXT_SQL + "select * from t", "SRC3 (pipe-delimited reader)")
def q_pipe(spark, sf):
    return _csv_roundtrip(spark, sf, "|")


_NPI_COLS = ["npi", "entity_type_code", "first_name", "last_name", "organization_name", "practice_state",
             "practice_city", "practice_zip", "practice_country", "practice_phone", "taxonomy_code", "sex_code",
             "deactivation_date", "enumeration_date", "last_update_date"]


@query("npi_csv_roundtrip", sql_cte("npi_raw") + "select " + ", ".join(
        f"nullif(cast({c} as varchar), '') as {c}" for c in _NPI_COLS) + " from npi_raw",
       "SRC1 (registry CSV reader: quoted, multi-line capable, PERMISSIVE)")
def q_npi_csv(spark, sf):
    rows = binding(spark, sf, "npi_raw").select(*_NPI_COLS[::-1])  # the reader finds them by header
    path = _scratch(spark, "npi")
    (rows.write.option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    df = IO.read_npi(spark, path, _NPI_COLS)
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in _NPI_COLS])


@query("events_json_roundtrip", sql_cte("touchpoints") + "select * from touchpoints",
       "SRC6 (event objects written and read as JSON)")
def q_json(spark, sf):
    tp = binding(spark, sf, "touchpoints")
    path = _scratch(spark, "events")
    IO.write_events_json(tp, path)
    schema = ("event_id bigint, lead_id string, event_timestamp timestamp_ntz, event_type string, channel string, "
              "campaign_id string, event_metadata string")
    return IO.read_events_json(spark, path, schema)


@query("clustered_write_roundtrip", sql_cte("tx_license_raw") + "select * from tx_license_raw",
       "SNK1 (range-clustered replace)")
def q_clustered(spark, sf):
    df = binding(spark, sf, "tx_license_raw")
    path = _scratch(spark, "clustered")
    IO.write_clustered(df, path, ["state", "professional_type"], num_files=4)
    return spark.read.parquet(path).select(*df.columns)


@query("by_type_write_roundtrip", sql_cte("tx_license_raw") + "select * from tx_license_raw",
       "SNK3 (one directory per professional type)")
def q_by_type(spark, sf):
    df = binding(spark, sf, "tx_license_raw")
    path = _scratch(spark, "bytype")
    IO.write_by_type(df, path)
    return spark.read.parquet(path).select(*df.columns)


@query("batch_insert_roundtrip", sql_cte("tx_license_raw") + "select * from tx_license_raw",
       "SNK4 (append batches)")
def q_append(spark, sf):
    df = binding(spark, sf, "tx_license_raw")
    path = _scratch(spark, "append")
    IO.batch_insert(df.filter(F.col("snapshot_date") == "2025-06-29"), path)
    IO.batch_insert(df.filter(F.col("snapshot_date") == "2025-06-30"), path)
    return spark.read.parquet(path).select(*df.columns)


@query("stage_tx_assistants_labs", sql_cte("tx_other_raw") + """
select md5(concat_ws('-', 'TX', professional_type, trim(lic_nbr))) as professional_id, 'TX' as state_code, professional_type,
  cast(lic_id as integer) as source_license_id, trim(lic_nbr) as license_number, cast(null as integer) as entity_number,
  lic_sta_cde as status_code, cast(null as varchar) as status_description,
  """ + status_sql(["dental_assistant", "dental_lab"]) + """ as status_category,
  try_strptime(trim(lic_orig_dte), '%m/%d/%Y')::date as license_issue_date,
  try_strptime(trim(lic_expr_dte), '%m/%d/%Y')::date as license_expiration_date,
  case when professional_type <> 'dental_lab' then trim(first_nme) end as first_name, cast(null as varchar) as middle_name,
  case when professional_type <> 'dental_lab' then trim(last_nme) end as last_name, cast(null as varchar) as former_last_name,
  cast(null as varchar) as gender, cast(null as varchar) as birth_year, cast(null as varchar) as graduation_year,
  cast(null as varchar) as school_name, trim(address1) as address_line_1, cast(null as varchar) as address_line_2,
  trim(city) as city, trim(state) as address_state, trim(zip) as zip_code, trim(county) as county,
  cast(null as varchar) as country, cast(null as varchar) as phone, cast(null as varchar) as practice_description,
  cast(null as varchar) as specialty_code, cast(null as varchar) as specialty_description,
  cast(null as date) as nitrous_oxide_permit_date, false as has_nitrous_oxide_permit, false as has_anesthesia_level_1,
  false as has_anesthesia_level_2, false as has_anesthesia_level_3, false as has_anesthesia_level_4,
  false as has_portability, false as has_sealant_certification,
  case when professional_type = 'dental_assistant' then upper(trim(nom_mod)) = 'YES' else false end as has_nitrous_monitoring,
  false as has_local_infiltration_anesthesia, upper(trim(disc_action)) = 'YES' as has_disciplinary_action,
  cast(null as boolean) as has_remedial_plans,
  cast(null as date) as anesthesia_level_1_date, cast(null as date) as anesthesia_level_2_date,
  cast(null as date) as anesthesia_level_3_date, cast(null as date) as anesthesia_level_4_date,
  false as has_shrp_modifier, false as has_spp_modifier, false as has_erx_waiver, false as is_level_exempt,
  case when professional_type = 'dental_lab' then trim(lab_nme) end as business_name,
  case when professional_type = 'dental_lab' then trim(lab_owner) end as owner_name,
  case when professional_type = 'dental_lab' then trim(lab_manager) end as manager_name,
  case when professional_type = 'dental_lab' then trim(lab_cdt) end as certified_dental_technician,
  case when professional_type = 'dental_lab' then trim(lab_type) end as lab_type
from tx_other_raw
""", "STG3, STG4 (assistant and lab kinds)")
def q_other_kinds(spark, sf):
    return ST.stage_tx(binding(spark, sf, "tx_other_raw"))
