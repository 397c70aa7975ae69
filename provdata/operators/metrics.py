"""Operational metrics (AGG15, AGG16, AGG20, AGG21, AGG22) and budget planning (ENR2, ENR5, WIN8).

The semantic layer (AGG22) is a dictionary of named measures (Column
expressions); ``metric(df, by, names)`` is one grouped aggregate computing
the requested measures, so a dashboard tile is one Spark job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata

# FIXED VALUES: free-mail domains that make an e-mail 'personal'.
PERSONAL_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com"]


def _email_domain() -> Column:
    return F.lower(F.substring_index(F.col("email"), "@", -1))


def measures() -> dict[str, Column]:
    """AGG22: measure name -> aggregate Column (each applies only to columns the input has)."""
    n = lambda c: F.count_if(c).cast("bigint")
    return {
        "count": F.count(F.lit(1)),
        "count_individuals": n(F.col("entity_type") == "Individual"),
        "count_organizations": n(F.col("entity_type") == "Organization"),
        "count_high_confidence": n(F.col("match_confidence") == "HIGH"),
        "count_male": n(F.col("gender") == "Male"),
        "count_female": n(F.col("gender") == "Female"),
        "count_enriched": n(F.col("enriched_email").isNotNull()),
        "enrichment_rate": C.percent(F.count_if(F.col("enriched_email").isNotNull()), F.count(F.lit(1))),
        "count_work_email": n(F.col("email").isNotNull() & ~_email_domain().isin(*PERSONAL_DOMAINS)),
        "count_personal_email": n(_email_domain().isin(*PERSONAL_DOMAINS)),
    }


def metric(df: DataFrame, by: Sequence[str | Column], names: Sequence[str]) -> DataFrame:
    """AGG22: the named measures grouped by dimension columns (``F.year(...)``/``F.trunc(...)`` for date groups)."""
    m = measures()
    return df.groupBy(*by).agg(*[m[name].alias(name) for name in names])


def credit_usage(runs: DataFrame, as_of: str, budget: int = refdata.MONTHLY_CREDIT_BUDGET,
                 ts_col: str = "enriched_at", credits_col: str = "credits") -> DataFrame:
    """AGG15: credits per billing cycle (YYYY-MM), remaining = max(0, budget - used), current-cycle flag."""
    g = runs.groupBy(F.date_format(F.col(ts_col).cast("timestamp_ntz"), "yyyy-MM").alias("cycle")).agg(
        F.sum(credits_col).cast("bigint").alias("credits_used"), F.count(F.lit(1)).alias("runs"))
    return g.select("cycle", "credits_used", "runs", F.lit(budget).cast("bigint").alias("monthly_budget"),
                    F.greatest(F.lit(0).cast("bigint"), F.lit(budget) - F.col("credits_used")).alias("remaining"),
                    (F.col("cycle") == F.lit(as_of[:7])).alias("is_current_cycle"))


def run_stats(results: DataFrame) -> DataFrame:
    """AGG16: processed / matched / e-mails / phones / errors and rates for an enrichment run."""
    n = F.count(F.lit(1))
    matched = F.count_if(F.col("api_error").isNull())
    return results.agg(
        n.alias("processed"), matched.cast("bigint").alias("matched"),
        F.count_if(F.col("email").isNotNull()).cast("bigint").alias("emails_found"),
        F.count_if(F.col("phone").isNotNull() | F.col("mobile_phone").isNotNull()).cast("bigint").alias("phones_found"),
        F.count_if(F.col("api_error").isNotNull() & (F.col("api_error") != "No match found")).cast("bigint").alias("errors"),
        C.percent(matched, n).alias("match_rate"),
        C.percent(F.count_if(F.col("email").isNotNull()), n).alias("email_rate"))


def event_summary(events: DataFrame, samples: int = 3) -> DataFrame:
    """AGG20: events per type and professional type with the first ``samples`` licence numbers.

    The samples are a capped rank (skew-safe, at most ``samples`` rows per
    group reach the final collect), never a collect of the whole group.
    """
    from .export import capped_rank
    counts = events.groupBy("event_type", "professional_type").agg(F.count(F.lit(1)).alias("events"))
    top = capped_rank(events.select("event_type", "professional_type", "license_number", "event_id"),
                      ["event_type", "professional_type"], [F.col("license_number"), F.col("event_id")], samples)
    smp = top.groupBy("event_type", "professional_type").agg(
        F.array_sort(F.collect_list(F.col("license_number"))).alias("sample_license_numbers"))
    return counts.join(smp, ["event_type", "professional_type"], "left")


def distribution(df: DataFrame, col: str, by: str) -> DataFrame:
    """AGG21: value counts of one column and their share within each ``by`` (a snapshot)."""
    g = df.groupBy(by, col).agg(F.count(F.lit(1)).alias("rows"))
    total = g.groupBy(by).agg(F.sum("rows").alias("_total"))
    return g.join(total, by).select(by, col, "rows", C.percent(F.col("rows"), F.col("_total"), 2).alias("pct"))


def budget_cut(df: DataFrame, order: Sequence[str], matched_col: str, limit: int,
               bucket: Column | None = None, fan: int = 1000) -> DataFrame:
    """WIN8: keep rows while the matched credits *before* the row are below ``limit``.

    Distributed prefix sum, no single-task window over all rows: the rows are cut into ranges of ``order``,
    each range is summed, and the sums before it are carried into it (``carry.Ranges``). ``order`` must be
    total, or the order among its ties is open.

    With ``bucket``, non-decreasing in ``order`` (e.g. a prefix of a
    sortable key), nothing is written: level 1 sums matches per bucket (one row per bucket);
    level 2 turns those into bucket offsets with a window over the bucket
    table, by groups of ``fan`` buckets first, so that neither window grows beyond the
    square root of a large input's buckets; buckets that start at or above the limit are dropped before
    the rows are sorted, and a window *partitioned by bucket* adds the in-bucket running sum.
    """
    if bucket is None:
        from .carry import Ranges
        ranges = Ranges(df, [], order).before(F.col(matched_col).cast("int"), "credits_before", below=limit)
        return ranges.plain().select(*df.columns, "credits_before")
    d = df.withColumn("_b", bucket).withColumn("_m", F.col(matched_col).cast("int"))
    per = d.groupBy("_b").agg(F.sum("_m").alias("_bm"))
    per = per.withColumn("_g", F.floor(F.col("_b") / fan))
    groups = per.groupBy("_g").agg(F.sum("_bm").alias("_gm"))
    before_g = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_g", F.coalesce(F.sum("_gm").over(before_g), F.lit(0)).alias("_goff")).where(F.col("_goff") < limit)
    before_b = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = (per.join(groups, "_g").select("_b", (F.col("_goff") + F.coalesce(F.sum("_bm").over(before_b), F.lit(0))).alias("_off"))
           .where(F.col("_off") < limit))
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    j = d.join(off, "_b")
    before = F.col("_off") + F.coalesce(F.sum("_m").over(w), F.lit(0))
    return j.select(*df.columns, before.alias("credits_before")).filter(F.col("credits_before") < limit)


def plan_requests(inputs: DataFrame, done: DataFrame, key: str, order: Sequence[str], as_of: str,
                  usage: DataFrame, limit: int | None = None, max_credits: int | None = None,
                  budget: int = refdata.MONTHLY_CREDIT_BUDGET) -> DataFrame:
    """ENR2: resume (skip done ids), optional row limit, and the credit budget of this run.

    ``usage`` is the AGG15 table; remaining = max(0, budget - used this
    cycle); ``max_credits`` overrides it; a zero remaining budget yields no
    requests. Returns the inputs to send with ``effective_credit_limit``.
    """
    todo = inputs.join(done.select(key).distinct(), key, "left_anti")
    if limit is not None:
        todo = todo.orderBy(*order).limit(limit)
    used = usage.filter(F.col("cycle") == as_of[:7]).select(F.coalesce(F.sum("credits_used"), F.lit(0))).scalar()
    remaining = F.greatest(F.lit(0), F.lit(budget) - used)
    eff = F.lit(max_credits) if max_credits is not None else remaining
    return todo.select("*", eff.alias("effective_credit_limit")).filter(remaining > 0)


def enrichment_queue_ready(queue: DataFrame, as_of: str) -> DataFrame:
    """ENR5: pending items whose process_after / next_retry_at has passed, by priority desc, then ``queued_at`` if there is one."""
    now = F.lit(as_of).cast("timestamp_ntz")
    ok = ((F.col("status") == "pending") & (F.col("process_after").isNull() | (F.col("process_after") <= now))
          & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)))
    return queue.filter(ok).orderBy(F.desc("priority"), *[c for c in ("queued_at",) if c in queue.columns])
