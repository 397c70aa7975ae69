"""Every registered query runs over the small tables, has its contract's columns, and equals its SQL where it has one."""

import pytest
from tests.conftest import SF_SMALL

from provdata.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_layout_text": {"page_id", "text"},
    "op3_compression_bands": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op5_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op6_tool_calls": {"conv_id", "turn", "place", "call_id", "json"},
    "op7_url_rules": {"page_id", "host", "path", "rule", "verdict"},
    "op8_pitman_yor": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op10_source_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op11_conversation_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    "op12_bpe_transducer": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op13_lexical_search": {"item_id", "rank", "doc_id", "score"},
}


def test_queries_and_pipeline():
    import __spark_entry__
    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_runs_whole_table(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert COLUMNS[name] <= set(df.columns)
    rows = df.collect()
    table, key = next((t, k) for t, k in (("pages", "page_id"), ("benchmark", "item_id"), ("conversations", "conv_id"),
                                          ("documents", "doc_id")) if k in df.columns)
    if name not in ("op6_tool_calls", "op13_lexical_search"):
        ids = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect()}
        assert {r[key] for r in rows} == ids
    if name not in ("op6_tool_calls", "op9_best_fit_packing", "op13_lexical_search"):
        assert len(rows) == len(ids)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    from tools.check_oracle import compare, duck

    class Q:
        build, oracle = staticmethod(QUERIES[name]), ORACLES[name]
    assert compare(spark, duck(SF_SMALL), Q, SF_SMALL)[0] == []


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op10_source_mix"])
def test_native_queries_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if w in plan]
