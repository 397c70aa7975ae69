"""Load validation (VAL1-VAL9).

All column-level rules of a load are evaluated in ONE aggregate pass over the
data (``df.agg(*counters)``); duplicate-key rules add one ``groupBy`` each.
The per-rule verdicts are then produced from that one-row result with an
``inline`` of rule structs, so the output is a small DataFrame (one row per
rule) computed entirely by Spark; nothing but the tiny rule configuration
lives on the driver.

Rules are ``(rule_type, params)`` or ``(rule_type, params, severity)``:
row_count_min(min_rows), row_count_delta(max_delta_pct), field_populated(field,
min_pct), field_format(field, pattern, min_pct), no_duplicates(key_fields),
date_range(field, min_date, max_date), value_distribution(field, value,
min_pct). An unknown rule type yields a failed warning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from .heavy import lowest_values, top_values

# FIXED VALUES: rules of the Texas licence source (column names lower-cased).
TX_LICENSE_RULES = [
    ("row_count_min", {"min_rows": 1000}),
    ("row_count_delta", {"max_delta_pct": 0.20}),
    ("field_populated", {"field": "lic_nbr", "min_pct": 0.99}),
    ("field_populated", {"field": "last_nme", "min_pct": 0.99}),
    ("field_populated", {"field": "first_nme", "min_pct": 0.98}),
    ("field_populated", {"field": "city", "min_pct": 0.90}),
    ("no_duplicates", {"key_fields": ["lic_id"]}),
    ("date_range", {"field": "lic_orig_dte", "min_date": "1900-01-01", "max_date": "CURRENT_DATE()"}),
    ("value_distribution", {"field": "lic_sta_cde", "value": 20, "min_pct": 0.50}),
]

# FIXED VALUES: rules of the NPI source.
NPI_RULES = [
    ("row_count_min", {"min_rows": 100000}),
    ("row_count_delta", {"max_delta_pct": 0.10}),
    ("field_populated", {"field": "npi", "min_pct": 0.9999}),
    ("field_format", {"field": "npi", "pattern": r"^\d{10}$", "min_pct": 0.99}),
    ("no_duplicates", {"key_fields": ["npi"]}),
]

# FIXED VALUES: rules of the Washington and Colorado sources.
WA_LICENSE_RULES = [
    ("row_count_min", {"min_rows": 1000}),
    ("row_count_delta", {"max_delta_pct": 0.20}),
    ("field_populated", {"field": "credential_number", "min_pct": 0.99}),
    ("field_populated", {"field": "last_name", "min_pct": 0.99}),
    ("no_duplicates", {"key_fields": ["credential_number"]}),
]
CO_LICENSE_RULES = [
    ("row_count_min", {"min_rows": 500}),
    ("row_count_delta", {"max_delta_pct": 0.20}),
    ("field_populated", {"field": "license_number", "min_pct": 0.99}),
    ("field_populated", {"field": "last_name", "min_pct": 0.99}),
    ("no_duplicates", {"key_fields": ["license_number"]}),
]

RESULT_SCHEMA = ["rule_index", "rule_name", "rule_type", "severity", "passed", "observed", "threshold", "detail"]


def _r(i: int, name: str, rtype: str, severity: Column | str, passed: Column, observed: Column,
       threshold, detail: Column | str = "") -> Column:
    return F.struct(
        F.lit(i).alias("rule_index"), F.lit(name).alias("rule_name"), F.lit(rtype).alias("rule_type"),
        (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        (detail if isinstance(detail, Column) else F.lit(detail)).cast("string").alias("detail"))


def validate_load(df: DataFrame, rules, prev: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """VAL1-VAL8: every rule's verdict as rows (rule_index, rule_name, type, severity, passed, observed, threshold)."""
    cols = set(df.columns)
    types = dict(df.dtypes)
    aggs: dict[str, Column] = {"_n": F.count(F.lit(1))}
    extra: list[DataFrame] = []
    structs: list[Column] = []
    for i, rule in enumerate(rules):
        rtype, params = rule[0], rule[1]
        sev_override = rule[2] if len(rule) > 2 else None
        n = F.col("_n")
        if rtype == "row_count_min":
            structs.append(_r(i, rtype, rtype, sev_override or "error", n >= params["min_rows"], n, params["min_rows"]))
        elif rtype == "row_count_delta":
            if prev is None:
                structs.append(_r(i, rtype, rtype, "warning", F.lit(True), F.lit(None), params["max_delta_pct"],
                                  "skipped: no previous load"))
                continue
            extra.append(prev.agg(F.count(F.lit(1)).alias(f"_prev{i}")))
            p = F.col(f"_prev{i}")
            delta = F.try_divide(F.abs(n - p).cast("double"), p)
            # An empty previous load is treated as 'no previous load'.
            structs.append(F.when(p == 0, _r(i, rtype, rtype, "warning", F.lit(True), F.lit(None),
                                              params["max_delta_pct"], "skipped: no previous load"))
                           .otherwise(_r(i, rtype, rtype, sev_override or "error",
                                         delta <= params["max_delta_pct"], delta, params["max_delta_pct"])))
        elif rtype in ("field_populated", "field_format", "date_range", "value_distribution") and params["field"] not in cols:
            structs.append(_r(i, f"{rtype}_{params['field']}", rtype, "error", F.lit(False), F.lit(None),
                              params.get("min_pct"), f"field '{params['field']}' not found"))
        elif rtype == "field_populated":
            f = params["field"]
            ok = C.col_(f).isNotNull()
            if types[f] == "string":
                ok = ok & (F.trim(F.col(f)) != "")
            aggs[f"_pop{i}"] = F.count_if(ok)
            share = F.try_divide(F.col(f"_pop{i}").cast("double"), n)
            structs.append(_r(i, f"field_populated_{f}", rtype, sev_override or "error",
                              share >= params["min_pct"], share, params["min_pct"]))
        elif rtype == "field_format":
            f = params["field"]
            s = F.col(f).cast("string")
            aggs[f"_nn{i}"] = F.count(s)
            # Match anchored at the start only (prefix match), like re.match.
            aggs[f"_fm{i}"] = F.count_if(s.rlike(f"^(?:{params['pattern']})"))
            share = F.try_divide(F.col(f"_fm{i}").cast("double"), F.col(f"_nn{i}"))
            structs.append(F.when(F.col(f"_nn{i}") == 0,
                                  _r(i, f"field_format_{f}", rtype, "error", F.lit(False), F.lit(None),
                                     params["min_pct"], "no non-null values"))
                           .otherwise(_r(i, f"field_format_{f}", rtype, sev_override or "error",
                                         share >= params["min_pct"], share, params["min_pct"])))
        elif rtype == "no_duplicates":
            keys = params["key_fields"]
            missing = [k for k in keys if k not in cols]
            if missing:
                structs.append(_r(i, rtype, rtype, "error", F.lit(False), F.lit(None), 0,
                                  f"key fields not found: {missing}"))
                continue
            # Rows in key groups of size > 1 (every member counted; NULL keys group together).
            g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
            extra.append(g.agg(F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0))
                               .alias(f"_dup{i}")))
            d = F.col(f"_dup{i}")
            structs.append(_r(i, rtype, rtype, sev_override or "error", d == 0, d, 0))
        elif rtype == "date_range":
            f = params["field"]
            dcol = C.safe_date(f) if types[f] == "string" else F.col(f).cast("date")
            aggs[f"_dv{i}"] = F.count(dcol)
            lo, hi = params.get("min_date"), params.get("max_date")
            if hi == "CURRENT_DATE()":
                if as_of is None:
                    raise ValueError(f"the date rule on {f} compares with the current date: pass as_of")
                hi = as_of
            aggs[f"_old{i}"] = F.count_if(dcol < F.lit(lo).cast("date")) if lo else F.lit(0)
            aggs[f"_new{i}"] = F.count_if(dcol > F.lit(hi).cast("date")) if hi else F.lit(0)
            bad = F.col(f"_old{i}") + F.col(f"_new{i}")
            structs.append(F.when(F.col(f"_dv{i}") == 0,
                                  _r(i, f"date_range_{f}", rtype, "warning", F.lit(True), F.lit(None), 0,
                                     "no valid dates"))
                           .otherwise(_r(i, f"date_range_{f}", rtype, sev_override or "error", bad == 0, bad, 0,
                                         F.concat_ws(";", F.col(f"_old{i}").cast("string"),
                                                     F.col(f"_new{i}").cast("string")))))
        elif rtype == "value_distribution":
            f = params["field"]
            # Compared as text: a file may hold the code as '20' or 20.
            aggs[f"_vd{i}"] = F.count_if(F.col(f).cast("string") == str(params["value"]))
            share = F.try_divide(F.col(f"_vd{i}").cast("double"), n)
            structs.append(_r(i, f"value_distribution_{f}_{params['value']}", rtype, sev_override or "error",
                              share >= params["min_pct"], share, params["min_pct"]))
        else:
            structs.append(_r(i, rtype, "unknown", "warning", F.lit(False), F.lit(None), None,
                              f"unknown rule: {rtype}"))
    one = df.agg(*[v.alias(k) for k, v in aggs.items()])
    # Side counters (previous-load size, duplicate counts) are one-row aggregates:
    # attach them as scalar subqueries (each runs once; no join).
    side = [e.select(F.col(e.columns[0])).scalar().alias(e.columns[0]) for e in extra]
    return one.select("*", *side).select(F.inline(F.array(*structs)))


def row_delta(df: DataFrame, prev: DataFrame) -> DataFrame:
    """VAL8: row counts of a load and its predecessor, and the signed change (NULL after an empty one)."""
    counts = prev.agg(F.count(F.lit(1)).alias("row_count_prev")).select(F.col("row_count_prev")).scalar()
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", counts.alias("row_count_prev"),
        F.try_divide((F.col("row_count") - counts).cast("double"), counts).alias("row_count_delta"))


def rule_details(df: DataFrame, rules, samples: int = 5, top: int = 10) -> DataFrame:
    """VAL4, VAL7: what the verdict rows leave out, as (rule_index, rule_name, value, rows).

    Of each field_format rule the ``samples`` lowest values that do not match, of each value_distribution rule
    the ``top`` commonest values (ties: lowest first). Neither groups the whole column: see ``heavy``.
    """
    out = None
    for i, rule in enumerate(rules):
        rtype, params = rule[0], rule[1]
        if rtype not in ("field_format", "value_distribution") or params["field"] not in df.columns:
            continue
        value = F.col(params["field"]).cast("string")
        if rtype == "field_format":
            name = f"field_format_{params['field']}"
            found = lowest_values(df, F.when(~value.rlike(f"^(?:{params['pattern']})"), value), samples)
        else:
            name = f"value_distribution_{params['field']}_{params['value']}"
            found = top_values(df, value, top)
        found = found.select(F.lit(i).alias("rule_index"), F.lit(name).alias("rule_name"), "value", "rows")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return df.sparkSession.createDataFrame([], "rule_index int, rule_name string, value string, rows long")
    return out


def load_verdict(results: DataFrame) -> DataFrame:
    """Load-level outcome: passed = no failed error; counts of errors and warnings."""
    failed_err = (~F.col("passed")) & (F.col("severity") == "error")
    warn = (F.col("severity") == "warning") & ((~F.col("passed")) | F.col("detail").startswith("skipped")
                                               | (F.col("detail") == "no valid dates"))
    return results.agg(
        (F.count_if(failed_err) == 0).alias("passed"),
        F.count_if(failed_err).cast("bigint").alias("errors"),
        F.count_if(warn).cast("bigint").alias("warnings"),
        F.count(F.lit(1)).alias("rules"))


def source_freshness(df: DataFrame, loaded_at: str, as_of: str, by=None, warn_days: int = 7,
                     error_days: int = 14) -> DataFrame:
    """SNK5: pass / warn / error per source by the age of its newest row."""
    today = F.lit(as_of).cast("timestamp_ntz")
    grp = df.groupBy(*(by or [])).agg(F.max(loaded_at).alias("latest_loaded_at"))
    age = F.timestamp_diff("HOUR", F.col("latest_loaded_at"), today).cast("double") / 24
    return grp.select("*", age.alias("age_days"),
                      F.when(age > error_days, "error").when(age > warn_days, "warn").otherwise("pass").alias("freshness"))


_RULE_TYPES = {"row_count": "row_count_min", "row_count_delta": "row_count_delta", "field_populated": "field_populated",
               "field_format": "field_format", "value_distribution": "value_distribution", "date_range": "date_range"}


def rules_from_table(rules: DataFrame, source_type: str, column_map: dict[str, str]) -> list:
    """VAL9: active rules of one source from a rules table -> ``validate_load`` rules (severity kept).

    The rules table is configuration (a few dozen rows), so it is read on
    the driver; ``column_map`` maps warehouse field names to input columns.
    """
    import json
    out = []
    sel = rules.filter((F.col("source_type") == source_type)
                       & F.coalesce(F.col("is_active"), F.lit(True))).orderBy("rule_id")
    for r in sel.select("rule_name", "rule_type", "rule_config", "severity").collect():
        cfg = json.loads(r["rule_config"])
        rtype = _RULE_TYPES.get(r["rule_type"], r["rule_type"])
        if "field" in cfg:
            cfg["field"] = column_map.get(cfg["field"], cfg["field"].lower())
        if rtype == "row_count_min":
            cfg = {"min_rows": cfg["min"]}
        if rtype == "date_range":
            cfg = {"field": cfg["field"], "min_date": cfg.get("min"), "max_date": cfg.get("max")}
        out.append((rtype, cfg, r["severity"]))
    return out


def rules_table(spark) -> DataFrame:
    from ..functions import refdata
    return spark.createDataFrame(
        [(a, b, c, d, e, f, True) for a, b, c, d, e, f in refdata.VALIDATION_RULES],
        "rule_id string, source_type string, rule_name string, rule_type string, rule_config string, "
        "severity string, is_active boolean")
