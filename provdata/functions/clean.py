"""Scalar cleaning expressions (PRJ*, KEY*, date helpers).

Everything here returns a ``Column`` built from built-in functions, so the
expressions stay inside whole-stage codegen; there is no Python on the row
path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import refdata

DATE_FMT = "M/d/yyyy"  # accepts both 1/5/2020 and 01/05/2020
# FIXED VALUE: NULL placeholder of the warehouse surrogate-key macro.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """PRJ1: trim, then '' -> NULL."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def is_blank(c: str | Column) -> Column:
    return col_(c).isNull() | (F.trim(col_(c)) == "")


def safe_date(c: str | Column, fmt: str = DATE_FMT) -> Column:
    """PRJ8: text date -> DATE, unparsable -> NULL (ANSI-safe)."""
    return F.try_to_date(F.trim(col_(c).cast("string")), fmt)


def digits_only(c: str | Column) -> Column:
    """PRJ6: strip every non-digit."""
    return F.regexp_replace(col_(c), r"[^0-9]", "")


def zip5(c: str | Column) -> Column:
    """PRJ5: first five characters of a ZIP."""
    return F.left(col_(c), F.lit(5))


def decode_entity_type(c: str | Column) -> Column:
    """PRJ2."""
    c = col_(c)
    return (F.when(c == "1", "Individual").when(c == "2", "Organization")
            .otherwise("Unknown"))


def decode_gender(c: str | Column) -> Column:
    """PRJ2: M/F -> Male/Female, anything else NULL."""
    c = col_(c)
    return F.when(c == "M", "Male").when(c == "F", "Female")


def full_name(*parts: str | Column) -> Column:
    """PRJ3: parts joined by one space, NULLs skipped, whitespace collapsed."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *[col_(p) for p in parts]), r"\s+", " "))


def display_name(entity_code: str | Column, prefix, first, last, credential, org, dba) -> Column:
    """PRJ4: '[prefix ]first last[, credential]' for people; org name chain otherwise."""
    person = F.concat(
        F.coalesce(F.concat(col_(prefix), F.lit(" ")), F.lit("")),
        F.coalesce(col_(first), F.lit("")), F.lit(" "), F.coalesce(col_(last), F.lit("")),
        F.coalesce(F.concat(F.lit(", "), col_(credential)), F.lit("")),
    )
    company = F.coalesce(col_(org), col_(dba), F.lit("Unknown Organization"))
    return F.when(col_(entity_code) == "1", person).otherwise(company)


def address_full(line1: str | Column, line2: str | Column) -> Column:
    """PRJ5: 'line1[, line2]'."""
    return F.concat(F.coalesce(col_(line1), F.lit("")),
                    F.when(col_(line2).isNotNull(), F.concat(F.lit(", "), col_(line2)))
                    .otherwise(F.lit("")))


def to_e164(phone: str | Column, country: str | Column | None = None) -> Column:
    """PRJ7: '+...' unchanged; US with 10 digits -> '+1' + digits; else '+' + digits."""
    p = col_(phone)
    country = F.lit("US") if country is None else col_(country)
    d = digits_only(p)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(F.startswith(p, F.lit("+")), p)
            .when((col_(country) == "US") & (F.length(d) == 10), F.concat(F.lit("+1"), d))
            .otherwise(F.concat(F.lit("+"), d)))


def year_diff(later: str | Column, earlier: str | Column) -> Column:
    """Calendar-year boundaries crossed (warehouse DATEDIFF(year) semantics)."""
    return F.year(col_(later)) - F.year(col_(earlier))


def practice_age_cohort(d: str | Column, as_of: str, null_cohort: str = refdata.COHORT_ELSE) -> Column:
    """PRJ9: five cohort labels by year-boundary age; unknown date -> ``null_cohort``."""
    age = year_diff(F.lit(as_of).cast("date"), d)
    expr = None
    for bound, label in refdata.COHORTS:
        expr = F.when(age <= bound, label) if expr is None else expr.when(age <= bound, label)
    return F.when(col_(d).isNull(), F.lit(null_cohort)).otherwise(expr.otherwise(refdata.COHORT_ELSE))


def auth_official_name(first: str | Column, last: str | Column) -> Column:
    """PRJ10."""
    return F.when(col_(first).isNotNull() & col_(last).isNotNull(),
                  F.concat(col_(first), F.lit(" "), col_(last)))


def yes_flag(c: str | Column) -> Column:
    """PRJ11: 'Y' -> true, anything else false."""
    return F.coalesce(col_(c) == "Y", F.lit(False))


def prefix_any(c: str | Column, prefixes: Iterable[str]) -> Column:
    """FLT2: any-of prefix match; ``startswith`` pushes to parquet as StringStartsWith."""
    out = None
    for p in prefixes:
        e = F.startswith(col_(c), F.lit(p))
        out = e if out is None else (out | e)
    return out


def surrogate_key(*cols: str | Column) -> Column:
    """KEY1: md5 of '-'-joined, NULL-safe text of the columns."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def short_id(*cols: str | Column) -> Column:
    """KEY2: first 12 hex digits of md5 over '-'-joined parts."""
    return F.left(F.md5(F.concat_ws("-", *[col_(c).cast("string") for c in cols])), F.lit(12))


def soundex_key(c: str | Column) -> Column:
    """Blocking key: soundex of the trimmed, upper-cased name; blank names -> NULL.

    Spark's ``soundex`` passes non-alphabetic input through, so untrimmed
    input (' Robert') would never match; blank names would all share ''.
    """
    t = F.upper(F.trim(col_(c)))
    return F.when(t != "", F.soundex(t))


def case_map(c: str | Column, pairs, default=None) -> Column:
    """``CASE c WHEN k THEN v ...`` from a list of (k, v) pairs."""
    c = col_(c)
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def status_category(code: str | Column, professional_type: str | Column) -> Column:
    """Per-type licence status code -> category (dentist 70 is ACTIVE, lab 80 is CLOSED)."""
    code = col_(code)
    ptype = col_(professional_type)
    expr = None
    for ptype_name, rules in refdata.STATUS_MAP.items():
        for codes, cat in rules:
            cond = (ptype == ptype_name) & code.isin(*codes)
            expr = F.when(cond, cat) if expr is None else expr.when(cond, cat)
    return expr.otherwise("UNKNOWN")


def percent(num: Column, den: Column, scale: int = 1) -> Column:
    """ROUND(num * 100 / NULLIF(den, 0), scale) evaluated in decimal, returned as DOUBLE.

    Rounding happens on an exact decimal so half-up ties round the same way
    in every engine; the result is a plain double.
    """
    raw = num.cast("double") * 100 / F.nullif(den, F.lit(0)).cast("double")
    return F.round(raw.cast("decimal(20,6)"), scale).cast("double")


def money(c: Column, scale: int = 6) -> Column:
    """A sum or average of non-integral doubles rounded on an exact decimal.

    Double addition is not associative, so the last bits of a sum depend on
    the order partitions are combined in; rounding on a decimal makes the
    value independent of that order (and equal across engines).
    """
    return F.round(c.cast("decimal(38,12)"), scale).cast("double")
