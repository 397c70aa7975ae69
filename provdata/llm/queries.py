"""Registered queries of the operators in this subpackage, with DuckDB SQL where it can express them.

A query is thin: it reads its whole table, calls its operator with production parameters and
names the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provdata.llm import (bpe_fst, conversation_repair, exact_dedup, hpy_lm, html_text, jaccard_join, lexical_search, mixing, packing,
                          quality, tool_chat, toxicity, url_rules)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))


@_query("""
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


@_query(r"""
with sized as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))) as key
  from documents),
per as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, (row_number() over (order by source is null, source) - 1) % 3 + 1 as weight from per),
run as (
  select *, sum(source_size) over ()::bigint as total, sum(weight) over ()::bigint as weights,
         coalesce(sum(source_size * 3) over before, 0)::bigint as capped,
         coalesce(sum(weight) over before, 0)::bigint as gone,
         row_number() over (order by source_size / weight, source is null, source) as nr
  from ranked
  window before as (order by source_size / weight, source is null, source
                    rows between unbounded preceding and 1 preceding)),
level as (
  select min_by((total - capped)::double / (weights - gone), nr) as share from run
  where (total - capped)::double / (weights - gone) * weight <= source_size * 3),
targets as (
  select source as t_source, source_size,
         coalesce(least((select share from level) * weight, (source_size * 3)::double), 0.0) as target from run),
placed as (
  select s.*, t.source_size, t.target,
         case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as epochs,
         coalesce(sum(size) over (partition by source order by key, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sized s join targets t on s.source is not distinct from t.t_source)
select doc_id, source, size, source_size, target,
       least(epochs + (start + size / 2 <= target - epochs * source_size and source_size > 0)::bigint, 3)::bigint
         as copies,
       (least(epochs + (start + size / 2 <= target - epochs * source_size and source_size > 0)::bigint, 3)
         * size)::bigint as taken
from placed
""")
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


@_query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: Host rules of the contract, and pattern rules for pages that a crawl holds several times over.
HOST_RULES = [
    url_rules.HostRule("allow", "com", "/"), url_rules.HostRule("block", "example.com", "/en/"),
    url_rules.HostRule("allow", "www.example.com", "/en/"), url_rules.HostRule("block", "net", "/es/"),
    url_rules.HostRule("block", "net", "/fr/"),
]
PATTERN_RULES = [
    url_rules.PatternRule("block", "paged listing", r"[?&]page=[0-9]+(&|#|$)"),
    url_rules.PatternRule("block", "referral link", r"[?&]ref=[a-z0-9]+(&|#|$)"),
    url_rules.PatternRule("block", "paged referral", r"[?&]page=[0-9]+&ref="),
    url_rules.PatternRule("block", "session", r"[?&;](sid|phpsessid|jsessionid)=[a-z0-9]+"),
    url_rules.PatternRule("block", "campaign", r"[?&]utm_(source|medium|campaign)="),
    url_rules.PatternRule("block", "advert host", r"://(ads?|banner)[0-9]*\."),
    url_rules.PatternRule("block", "log in", r"/(user/)?login(/|[?#]|$)"),
    url_rules.PatternRule("allow", "first page", r"[?&]page=1(&|#|$)"),
    url_rules.PatternRule("allow", "static document", r"^https?://www\.[^/]+/[a-z]{2}/[0-9]+\.html([?#]|$)"),
]


def _pattern_rows() -> str:
    quoted = [(r.verdict, r.name, r.pattern) for r in PATTERN_RULES]
    return ", ".join("(" + str(k) + ", " + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")"
                     for k, row in enumerate(quoted))


@_query()
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(_table(spark, sf_dir, "documents"))


@_query(f"""
with host_rules(verdict, host, path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
pattern_rules(nr, verdict, name, pattern) as (values {_pattern_rows()}),
parsed as (
  select row_number() over () as row, page_id, url,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select row, page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as url,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parsed),
fits as (
  select row, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) as best
  from split s join host_rules r
    on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
  group by row),
hits as (
  select row, arg_min(struct_pack(name := r.name, verdict := r.verdict), (r.verdict <> 'allow')::int * 1000 + nr) as hit
  from split s join pattern_rules r on regexp_matches(s.url, r.pattern)
  group by row)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, hit.verdict, 'allow') as verdict
from split left join fits using (row) left join hits using (row)
""")
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_rules.judge_urls(_table(spark, sf_dir, "pages"), HOST_RULES, PATTERN_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


@_query()
def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"))


@_query()
def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpy_lm.score_texts(_table(spark, sf_dir, "documents"))


@_query()
def op2_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


#: Argument schemas of the two tools that the calls read out of ``conversations`` use.
TOOL_SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 100},
        "after": {"type": "array", "items": {"type": "string"}}}},
    "note": {"type": "object", "required": ["query"], "properties": {
        "query": {"type": "string", "maxLength": 400}, "limit": {"type": "integer", "minimum": 2}}},
}


@_query()
def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_chat.calls_of_conversations(_table(spark, sf_dir, "conversations"))
    return tool_chat.link_tool_calls(calls, results, TOOL_SCHEMAS)


@_query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    edits = conversation_repair.repair(conversation_repair.damage(conversations), conversations)
    return conversation_repair.report(edits)


@_query()
def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_fst.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                              public_tokenizers.PATTERN)


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@_query(f"""
with doc as (select row_number() over () as row, doc_id, text from documents),
item as (select row_number() over () as item, item_id, text from benchmark),
tf as (select row, term, count(*)::bigint as tf from (select row, unnest({_TERMS}) as term from doc) group by row, term),
size as (select row, sum(tf)::bigint as n from tf group by row),
total as (select count(*)::bigint as docs, sum(n)::bigint as length from size),
asked as (select distinct item, term from (select item, unnest({_TERMS}) as term from item)),
weight as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w
           from (select term, count(*)::bigint as df from tf group by term), total),
scored as (
  select item, row,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::bigint as score
  from asked join weight using (term) join tf using (term) join size using (row), total
  group by item, row),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item order by score desc, doc_id nulls first)::int as rank
  from scored join doc using (row) join item using (item) where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
