"""URL filters: host rules, then pattern rules indexed by their rarest literal token.

The literal tokens that any URL matched by a pattern must hold are read out of the pattern itself
(``required_tokens``), so no rule can be filed under a token that its URLs may lack. The corpus says how many
URLs hold each of them, and the rule is filed under the rarest. A URL's tokens fetch the rules filed
under them, and only those run their regular expressions. Rules without a token run on every URL.

The index is a table joined by key: distinct URLs are exploded into their tokens and the suffixes of their hosts, join
the rules filed there, and keep their deciding rule; the verdicts go back to the rows by URL. Repeated URLs are
judged once. Rules come as lists (a parameter of the job, 10^5 of them and more); they are broadcast only if
Spark finds their table small. Rules without a token are filed under ``SPREAD`` keys, one of which each URL asks
for, so no task gets all URLs.

Defined results: a null URL or one without ``://`` has empty host and path, fits no host rule and, if
null, no pattern; a very long URL is read whole; an empty table gives an empty result; equal rows get equal verdicts;
null ids stay null; other columns, whatever their names, are left out; of host rules that fit, the longest wins, of equally
long ones the first in code-point order (then the first listed); of patterns, an allowing one, then the first listed.
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Keys that rules without a token are filed under, each URL asking for one.
SPREAD = 64


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains if the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class PatternRule:
    """Fits URLs (A-Z lower-cased) that match ``pattern``; ``tokens`` are those it requires, read from it unless given."""

    verdict: str
    name: str
    pattern: str
    tokens: tuple[str, ...] | None = None

    def required(self) -> tuple[str, ...]:
        return required_tokens(self.pattern) if self.tokens is None else self.tokens


# ---- what a pattern requires -----------------------------------------------------------------------------------------

#: Parts of a pattern: a letter or digit stands for itself, EDGE for a character or place that ends a token, OPEN for the rest.
EDGE, OPEN = "|", "?"
_REPEAT = re.compile(r"([?*+]|\{([0-9]+)(,[0-9]*)?\})[?+]?")


def _parts(pattern: str, at: int) -> tuple[list[list[str]], int]:
    """Alternatives from ``at`` to the end of their group, each as its parts, and where they end."""
    found: list[list[str]] = [[]]
    while at < len(pattern) and pattern[at] != ")":
        c = pattern[at]
        if c == "|":
            found.append([])
            at += 1
            continue
        here = found[-1]
        part: list[str] = [OPEN]
        group = None
        if c == "(":
            if pattern[at + 1:at + 2] == "?" and pattern[at + 2:at + 3] != ":":
                raise ValueError("flags, look-around and names are not read")
            group, at = _parts(pattern, at + (3 if pattern.startswith("(?:", at) else 1))
            at += 1
            if len(group) == 1:
                part = group[0]
            elif all(g == [EDGE] for g in group):
                part = [EDGE]
        elif c == "[":
            end = pattern.index("]", at + (3 if pattern.startswith("[^", at) else 2))
            inside = pattern[at + 1:end]
            if "[" in inside or "&&" in inside:
                raise ValueError("nested classes are not read")
            if not re.search(r"[a-zA-Z0-9^\\-]", inside) and inside.isascii():
                part = [EDGE]
            at = end + 1 + (inside.endswith("\\"))
            if inside.endswith("\\"):
                raise ValueError("an escaped bracket in a class is not read")
        elif c == "\\":
            escaped = pattern[at + 1:at + 2]
            if escaped.isalnum() and escaped not in "bdDsSwW":
                raise ValueError("this escape is not read")
            part, at = [OPEN if escaped in "dDSwW" else EDGE], at + 2
        else:
            part = [OPEN] if c == "." else [c] if re.match("[a-z0-9]", c) else [EDGE]
            at += 1
        repeat = _REPEAT.match(pattern, at)
        if repeat:
            at = repeat.end()
            if repeat[1] in ("?", "*") or repeat[2] == "0":
                # a part that may be missing ends a token if what stands before it does and it does itself
                part = [EDGE] if part and part[-1] == EDGE and here and here[-1] == EDGE else [OPEN]
            elif part != [EDGE]:
                part = [OPEN]
        here.extend(part)
    return found, at


def required_tokens(pattern: str) -> tuple[str, ...]:
    """Tokens that every match of ``pattern`` shows in the URL around it; fewer where the pattern is not understood.

    A run of literal letters and digits is a token of the URL if characters that end tokens enclose it.
    """
    try:
        found, at = _parts(pattern, 0)
    except (ValueError, IndexError):
        return ()
    if len(found) != 1 or at < len(pattern):
        return ()
    # The lookahead leaves an edge to be the next run's as well.
    return tuple(dict.fromkeys(re.findall(r"\|([a-z0-9]+)(?=\|)", "".join(found[0]))))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 after lower-casing A-Z."""
    return F.array_distinct(F.split(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER), "[^a-z0-9]+"))


def token_counts(df: DataFrame, rules: list[PatternRule], url_col: str = "url") -> dict[str, int]:
    """How many URLs hold each token of the rules. At most one row per such token comes back."""
    wanted = sorted({t for r in rules for t in r.required()})
    if not wanted:
        return {}
    asked = df.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    rows = (df.select(F.explode(url_tokens(F.col(url_col))).alias("token")).groupBy("token").count()
            .join(asked, "token", "left_semi").collect())
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in rows}


def pattern_index(rules: list[PatternRule], counts: dict[str, int]) -> dict[str, list[dict]]:
    """Rules filed under their rarest token (ties: code-point order), under "" if they have none."""
    index: dict[str, list[dict]] = {}
    for rule in rules:
        at = min(rule.required(), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(at, []).append({k: v for k, v in asdict(rule).items() if k != "tokens"})
    return index


def judge_urls(df: DataFrame, host_rules: list[HostRule], pattern_rules: list[PatternRule],
               url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per input row: page_id, host, path, rule, pattern (name), candidates, verdict.

    The longest host rule decides. Without one, a URL is blocked if a blocking pattern fits and no
    allowing one does. ``candidates`` counts the patterns that were run.
    """
    spark, held = df.sparkSession, df.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"))
    index = pattern_index(pattern_rules, token_counts(df, pattern_rules, url_col))
    place = {(r.verdict, r.name, r.pattern): k for k, r in reversed(list(enumerate(pattern_rules)))}
    filed = [("pattern", key, place[r["verdict"], r["name"], r["pattern"]], r["verdict"], r["name"], r["pattern"])
             for at, found in index.items() for key in ([at] if at else [f"#{k}" for k in range(SPREAD)]) for r in found]
    filed += [("host", r.host, k, r.verdict, r.host + r.path, r.path) for k, r in enumerate(host_rules)]
    rules = spark.createDataFrame(filed, "kind string, key string, nr int, verdict string, name string, what string")
    host, path = host_and_path(F.col("url"))
    labels = F.split(F.col("host"), "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    spread = F.concat(F.lit("#"), F.pmod(F.xxhash64("url"), F.lit(SPREAD)))

    def keyed(kind, keys):
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    urls = held.select("url").distinct().withColumns({"host": host, "path": path, "lowered": F.translate("url", _UPPER, _LOWER)})
    fetched = urls.select("url", "path", "lowered", F.inline(F.concat(
        keyed("host", suffixes), keyed("pattern", F.array_append(url_tokens(F.col("url")), spread))))).join(rules, ["kind", "key"])
    is_host = F.col("kind") == "host"
    # A path is no pattern and a pattern no path: each is looked at for its kind alone.
    fits = F.when(is_host, F.col("path").startswith(F.col("what"))).otherwise(F.rlike("lowered", F.when(~is_host, F.col("what"))))
    order = F.struct(F.when(is_host, -F.length("name")).otherwise((F.col("verdict") != "allow").cast("int")).alias("first"),
                     F.when(is_host, F.col("name")).otherwise(F.lit("")).alias("then"), "nr")
    best = F.min(F.when(fits, F.struct(order.alias("o"), "name", "verdict")))
    judged = fetched.groupBy("url", "kind").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    judged = judged.groupBy("url").agg(*[F.max(F.when(F.col("kind") == k, F.col(c))).alias(f"{k}_{c}")
                                         for k in ("host", "pattern") for c in ("best", "n")]).withColumnRenamed("url", "judged")
    return (held.join(judged, F.col("url").eqNullSafe(F.col("judged")), "left").withColumns({"host": host, "path": path})
            .select(id_col, "host", "path", F.col("host_best.name").alias("rule"), F.col("pattern_best.name").alias("pattern"),
                    F.coalesce("pattern_n", F.lit(0)).cast("long").alias("candidates"),
                    F.coalesce("host_best.verdict", "pattern_best.verdict", F.lit("allow")).alias("verdict")))
