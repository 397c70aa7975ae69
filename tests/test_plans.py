"""Physical-plan properties the operators were designed for."""

import re

import pytest
from pyspark.sql import functions as F

from provdata.plans.registry import load_all
from tests.conftest import SF_SMALL


def plan(spark, name):
    df = load_all()[name].build(spark, SF_SMALL)
    # A plan that has run already shows its initial form as well.
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(load_all()))
def test_no_python_udf_or_nested_loop(spark, name):
    p = plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in p, f"{name}: {bad}"


def test_waterfall_is_one_aggregate_without_window(spark):
    p = plan(spark, "enrichment_waterfall")
    assert "Window" not in p


def test_match_has_no_pair_ranking_window(spark):
    p = plan(spark, "npi_license_matches")
    assert "Window" not in p


def _nodes(plan_text, name):
    return [ln for ln in plan_text.splitlines() if re.match(rf"[\s:+\-]*(\*\(\d+\) )?{name}\b", ln)]


def test_events_single_window_for_previous_version(spark):
    assert len(_nodes(plan(spark, "license_events"), "Window")) == 1


def test_match_reads_the_registry_twice_and_is_evaluated_once(spark):
    """Licences are read once, the registry for the tier keys and for the attributes; unmatched rows share no key."""
    from provdata.operators import match as M
    from provdata.plans.q_match import licenses
    from provdata.sources.bindings import binding
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = M.best_match(licenses(spark, SF_SMALL), binding(spark, SF_SMALL, "npi_raw"))
        p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(_nodes(p, "FileScan")) + len(_nodes(p, "Scan")) == 3
        assert len(_nodes(p, "SortMergeJoin")) == 2 and "NestedLoop" not in p and "pmod(xxhash64(professional_id" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_golden_record_gives_unmatched_licences_keys_of_their_own(spark):
    assert "none-" in plan(spark, "provider_golden")


def test_filters_and_columns_reach_the_parquet_scan(spark, tmp_path):
    from provdata.operators import providers as P
    from provdata.sources.bindings import binding
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "npi")
    binding(spark, SF_SMALL, "npi_raw").write.parquet(path)
    df = P.clean_providers(spark.read.parquet(path), "2025-06-30")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(taxonomy_code,1223)" in p
    assert "EqualTo(practice_country,US)" in p
    # The scan reads only the columns the build uses.
    scan = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "version" not in scan


def test_bucketed_tables_join_without_shuffle(spark):
    from pyspark.sql import functions as F
    from provdata.sources import io as IO
    from provdata.plans.q_providers import providers
    from provdata.sources.bindings import binding
    prov = providers(spark, SF_SMALL).select("npi", "practice_state", "practice_age_cohort")
    enr = binding(spark, SF_SMALL, "enrichments").select(F.col("provider_id").alias("npi"), "source", "email")
    IO.write_bucketed(prov, "t_prov_bucketed", ["npi"], 8)
    IO.write_bucketed(enr, "t_enr_bucketed", ["npi"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_prov_bucketed").join(spark.table("t_enr_bucketed"), "npi")
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == prov.join(enr, "npi").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidates_are_limited_before_the_shuffle(spark):
    """A hot block sends its k lowest NPIs per task: a group limit on both sides of the exchange, and no pair join."""
    plan = load_all()["match_candidates"].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_differ_reads_each_snapshot_once_for_its_rows(spark):
    plan = load_all()["snapshot_diff_events"].build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[|LogicalRelation", plan)) <= 4 and len(re.findall(r"Join ", plan)) <= 1
