"""Quality rules, toxicity, HTML rendering, tool calls and URL rules on awkward rows, against brute force."""

import json
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from provdata.llm import html_text, quality, tool_chat, toxicity, url_rules
from provdata.llm.arrays import slices, words
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, docs, long_text, split_words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x0c\r\x1c\x85é#|", max_size=40)), max_size=8))
def test_words_and_slices(texts):
    found = words(pa.array(texts, pa.string()), lower=True)
    plain = found.dictionary.to_pylist()
    got = [[plain[c] for c in found.codes[a:b]] for a, b in zip(found.offsets[:-1], found.offsets[1:])]
    assert got == [split_words(t, lower=True) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    cut = list(slices([batch], "text", 10))
    assert [t for b in cut for t in b["text"].to_pylist()] == texts
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b["text"].to_pylist()) <= 10 for b in cut)


# ---- quality ---------------------------------------------------------------------------------------------------------

def base_measures(text):
    w = split_words(text)
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    marked = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return (len(w), sum(map(len, w)), sum(len(re.findall(r"[#*$%&|<>]", x)) for x in w), len(lines) - len(set(lines)), len(marked))


def test_quality_base_measures(spark):
    rnd = random.Random(5)
    rows = AWKWARD + [(100 + k, "\n".join(" ".join(rnd.choice("ab#c|") * rnd.randrange(1, 3) for _ in range(rnd.randrange(12)))
                                          for _ in range(rnd.randrange(6)))) for k in range(60)]
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality.judge_quality(docs(spark, rows)).collect())
    assert got == Counter((r[0], *base_measures(r[1])) for r in rows)


def test_quality_bands(spark):
    rnd = random.Random(6)
    parts = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "ion", "er", "ous")]
    prose = " ".join("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 4))) for _ in range(3000))
    noise = " ".join("".join(rnd.choice([chr(k) for k in range(0x21, 0x7f)]) for _ in range(60)) for _ in range(80))
    periodic = " ".join(f"word{k % 9} {'x' * (k % 5 + 1)}{k}" + " filler text here" * 3 for k in range(400))
    rows = [(1, prose), (2, noise), (3, "same line again\n" * 400), (4, None), (5, periodic), (6, "tiny text " * 3)]
    got = {r.doc_id: r for r in quality.judge_quality(docs(spark, rows)).collect()}
    assert got[1].kept and not got[2].kept and not got[2].base_failed and not got[3].kept and not got[4].kept
    assert got[5].ratio < 0.3 and not got[5].kept
    wide = quality.Bands(whole=(), chunk=(0.0, 9.0))
    assert {r.doc_id: r.kept for r in quality.judge_quality(docs(spark, rows), wide).collect()}[2]
    assert quality.judge_quality(docs(spark, [])).count() == 0


@pytest.mark.parametrize("good,junk", [(4096, 4094), (3000, 1000), (4096 * 3, 1024), (1500, 600)])
def test_quality_checks_every_byte(good, junk):
    """Prose with a tail of base64: kept without the tail, rejected with it, wherever the chunks end."""
    import base64

    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    docs_ = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text"])["text"].to_pylist()
    prose = "\n".join(dict.fromkeys(t for t in docs_ if t and len(t) < 3000)).encode()[:good]
    noise = base64.b64encode(random.Random(7).randbytes(junk))[:junk]
    assert quality._ratios(prose, compress, quality.Bands())[3]
    for text in (prose + noise, noise + prose, prose[:good // 2] + noise + prose[good // 2:]):
        assert not quality._ratios(text, compress, quality.Bands())[3]


# ---- toxicity --------------------------------------------------------------------------------------------------------

BAD = ["villain", "rotter", "scoundrel"]


def labelled(n=260, seed=2):
    rnd = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        text = [f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(8, 60))]
        toxic = k % 3 == 0
        if toxic:
            for _ in range(2):
                text.insert(rnd.randrange(len(text)), rnd.choice(BAD) + rnd.choice(["", "s", "ish", "!"]))
        rows.append((k, " ".join(text), "a", "en" if k % 2 else None))
        marks.append((k, int(toxic)))
    return rows, marks


PARAMS = toxicity.Params(buckets=1 << 12, epochs=8, least_per_language=5)


def test_toxicity_learns_and_handles_awkward_rows(spark):
    rows, marks = labelled()
    every = docs(spark, rows + [(1000 + k, *r[1:]) for k, r in enumerate(AWKWARD)] + [(None, "a rotter", None, None)])
    labels = spark.createDataFrame([(i, 1, t) for i, t in marks] + [(None, 1, 1), (5, 1, None), (77777, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(every, labels, PARAMS)
    got = toxicity.score_documents(every, model).collect()
    assert len(got) == len(rows) + len(AWKWARD) + 1
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(marks)
    held = {r[0] for r in every.select("doc_id").where(toxicity.held_out(every.doc_id)).collect()}
    late = [r for r in got if r.doc_id in truth and r.doc_id in held]
    assert len(late) > 30 and np.mean([r.predicted == truth[r.doc_id] for r in late]) >= 0.9
    stay = toxicity.drop_toxic(every, model)
    assert stay.columns == every.columns
    assert {r.doc_id for r in stay.collect()} == {r.doc_id for r in got if not r.toxic}
    assert "en" in model.by_language
    # Nothing but the text makes the score.
    again = every.withColumns({"lang": every.source, "source": every.lang, "doc_id": every.doc_id + 3})
    assert sorted(r.score for r in toxicity.score_documents(again, model).collect()) == sorted(r.score for r in got)


def test_toxicity_sample_is_bounded_and_spares_the_held_out(spark):
    rows, marks = labelled()
    labels = spark.createDataFrame([(i, t) for i, t in marks], "doc_id long, toxic int")
    sample, share = toxicity.training_sample(docs(spark, rows), labels, toxicity.Params(most_toxic=11, most_clean=17))
    held = {r[0] for r in labels.select("doc_id").where(toxicity.held_out(labels.doc_id)).collect()}
    texts = {r[1]: r[0] for r in rows}
    assert Counter(t for _, t, _ in sample) == {1: 11, 0: 17} and 0.2 < share < 0.5
    assert not {texts[t] for t, _, _ in sample} & held


def test_toxicity_without_two_classes(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    df = docs(spark, AWKWARD)
    assert {r.score for r in toxicity.score_documents(df, toxicity.fit(df, empty)).collect()} == {0.0}
    ones = spark.createDataFrame([(k, 1) for k in range(10)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(df, toxicity.fit(df, ones)).collect()} == {1.0}
    assert toxicity.score_documents(docs(spark, []), toxicity.fit(docs(spark, []), empty)).count() == 0


def test_toxicity_slices_agree_with_whole_batches():
    rows, marks = labelled(120)
    model = toxicity.train([r[1] for r in rows], [t for _, t in marks], [r[3] for r in rows], PARAMS)
    texts = ["", "villains", long_text(5000) + " rotter", None, "a b"]
    alone = [toxicity.scores(pa.array([t], pa.string()), model)[0] for t in texts]
    assert np.allclose(alone, toxicity.scores(pa.array(texts, pa.string()), model), atol=1e-6)


# ---- HTML ------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("page,text", [
    ("<p>One <b>two<p>three<br>four", "One two\n\nthree\nfour"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x", "- a\n- b\n  - c\n- d\n\nx"),
    ("<ol start=9><li>i<li value=20>j<li>k</ol>", "9. i\n20. j\n21. k"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td colspan=2>both columns</table>", "Name  | Qty\napple | 3\nboth columns"),
    ("<table><tr><td>a<td><table><tr><td>in<td>ner</table><tr><td>bcd<td>e</table>", "a   | in | ner\nbcd | e"),
    ("<style>.x, b.z{display:none} #y{visibility: hidden}</style><i class='q x'>no</i><b class=z>no</b><i class=z>yes</i><p id=y>no", "yes"),
    ("a<div hidden>no</div><span style='display : none'>no</span><input type=hidden value=no>b", "ab"),  # what is not drawn breaks no line
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<head><title>no</title></head><script>no</script><!-- no --><noscript>no</noscript>x&amp;y&nbsp;z", "x&y\xa0z"),
    ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    ("<div>a <i> b</i>\n c</div><div>d</div>", "a b c\nd"),
    ("<dl><dt>t<dd>def</dl>", "t\n    def"),
    # style rules: media, cascade, inheritance
    ("<style>@media print{.nav{display:none}}</style><i class=nav>seen</i>", "seen"),
    ("<style>@media screen and (max-width: 600px){.m{display:none}} @media (min-width:50em){.w{display:none}}</style>"
     "<i class=m>a</i><i class=w>no</i>", "a"),
    ("<style media=print>.nav{display:none}</style><style media=screen>.x{display:none}</style><i class=nav>a</i><i class=x>no</i>", "a"),
    ("<style>p{display:none} p{display:block}</style><p>seen", "seen"),
    ("<style>#a{display:block} .b{display:none} i.c{display:none!important} #c{display:inline}</style>"
     "<i id=a class=b>x</i><i id=c class=c>no</i><i class=c style='display:inline'>no</i>", "x"),
    ("<style>@keyframes k{from{display:none}} @font-face{src:url(a)} q::before{content:'}.n{display:none}'}</style><b class=n>x</b>", "x"),
    ("<style>[hidden]{x:y} div{display:block}</style><div hidden>seen</div><span hidden>no</span>", "seen"),
    ("<style>.open</style><b>x</b>", "x"), ("<style>b{display:none</style><b>no</b>x", "x"),
    ("<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p>no</div>", "yes"),
    # drawn text beside HTML's own
    ("<p>E <math><mi>m</mi><mo>=</mo><mn>2</mn></math> <svg><title>no</title><defs><text>no</text></defs><text>lab</text></svg>", "E m=2 lab"),
    ("<button>Go</button><textarea>t</textarea><input type=submit value=Send><input value=no>", "Go t Send"),
    # cells
    ("<table><tr><td>k<td><ul><li>a<li>b</ul><p>x<p>y<tr><td>l<td>z</table>", "k | - a\n  | - b\n\n  | x\n\n  | y\nl | z"),
    ("<table><tr><td rowspan=2>one<td>a<tr><td>b<tr><td>two<td>c</table>", "one | a\n    | b\ntwo | c"),
    ("<table><tbody><tr><td rowspan=0>x<td>1<tr><td>2<tbody><tr><td>y<td>3</table>", "x | 1\n  | 2\ny | 3"),
    ("<table><tr><td colspan=1000>w<td>v<tr><td>a<td>b</table>", "w     | v\na | b"),
    ("", ""), ("<p> </p>", ""), ("<b>never closed", "never closed"), ("</p></div>x", "x"), ("<![foo[x]]>y", "y"),
])
def test_html_layout(page, text):
    assert html_text.render_page(page) == text


def test_html_depth_and_width_stay_in_proportion():
    assert html_text.render_page("<div>" * 30_000 + "x").strip() == "x"
    page = "<table>" + "<tr><td>a<td>b" * 500 + "<tr><td>" + "long " * 5000 + "<td>c</table>"
    assert len(html_text.render_page(page)) < 2 * len(page)
    page = "<table>" + "<tr>" + "<td>" + "x" * 40 + "<td>y" * 300 + ("<tr><td colspan=900>" + "<p>q" * 20 + "<td>z") * 200 + "</table>"
    assert len(html_text.render_page(page)) < 2 * len(page)
    page = "<table><tr><td>" + "<p>long cell" * 3000 + "<td>" * 500 + "side</table>"
    text = html_text.render_page(page)
    assert text.count("long cell") == 3000 and text.endswith("side") and len(text) < 2 * len(page)


def test_media_queries():
    assert all(map(html_text.on_screen, ["", "screen", "all", "only screen", "print, screen", "not print", "(max-width:90em)"]))
    assert not any(map(html_text.on_screen, ["print", "not screen", "screen and (max-width: 999px)", "(prefers-color-scheme: dark)"]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "<tr>", "<td colspan=x>", "</table>", "<li>", "<ul>", "</ul>", "x", " ",
                                 "<!--", "<![", "&#x0;", "<b", ">", "<br/>", "</br>", "<details>", "<pre>", "<td rowspan=2>", "<style>", "</style>", "@media x{b{display:none}", "<svg>", "<input type=submit value=v>", "\n", "<body>", "<dd>"]),
                max_size=25))
def test_html_never_fails(parts):
    text = html_text.render_page("".join(parts))
    assert text == text.encode().decode() and not re.search(r"[ \t]+$", text, re.M)


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "<p>a<p>b", "u"), (2, None, "u"), (None, "", "u"), (1, "<p>a<p>b", "u")],
                               "page_id long, html string, text string")
    got = Counter(tuple(r) for r in html_text.extract_text(df).collect())
    assert got == {(1, "a\n\nb", 4, 3): 2, (2, None, None, None): 1, (None, "", 0, 0): 1}
    assert html_text.extract_text(df.limit(0)).count() == 0


# ---- tool calls ------------------------------------------------------------------------------------------------------

SCHEMAS = {"f": {"type": "object", "required": ["a"], "additionalProperties": False,
                 "properties": {"a": {"type": "integer", "minimum": 1}, "on": {"type": "array", "items": {"type": "string"}},
                                "k": {"enum": ["x", "y"]}}}}


def linked(spark, calls, results=()):
    c = spark.createDataFrame([(*r, "extra") for r in calls],
                              "conv_id long, turn long, position int, call_id string, name string, arguments string, content string")
    r = spark.createDataFrame(list(results), "conv_id long, turn long, call_id string, content string")
    return sorted(tool_chat.link_tool_calls(c, r, SCHEMAS).collect(), key=lambda x: (x.conv_id or -1, x.turn or -1, x.place))


def test_tool_calls_in_order_with_results(spark):
    got = linked(spark, [(1, 1, 0, "p", "f", '{"on": ["$q"], "a": 2}'), (1, 1, 1, "q", "f", '{"a":1}'),
                         (1, 3, 0, "r", "f", '{"a": 1.0, "on": ["$p", "$nowhere"]}'), (2, 1, 0, "p", "f", '{"a": 5, "on": ["$r"]}')],
                 [(1, 2, "p", "late"), (1, 2, "q", "found"), (1, 4, "q", "again"), (9, 1, "p", "stray")])
    assert [(r.call_id, r.status, r.errors, r.linked) for r in got] == [
        ("q", "ok", [], True), ("p", "ok", [], True), ("r", "invalid", ["$: no call nowhere"], False),
        ("p", "invalid", ["$: no call r"], False)]
    assert got[0].json == '{"arguments":{"a":1},"id":"q","name":"f","result":"found"}'
    assert got[1].json == '{"arguments":{"a":2,"on":["$q"]},"id":"p","name":"f","result":"late"}'


def test_tool_calls_awkward_rows(spark):
    got = linked(spark, [(1, 1, 0, "p", "f", '{"a": 1, "on": ["$q"]}'), (1, 1, 1, "q", "f", '{"a": 1, "on": ["$p"]}'),
                         (1, 1, 2, "s", "f", '{"a": 1, "on": ["$q"]}'), (1, 1, 3, "t", "f", None), (1, 1, 4, "u", "g", "{}"),
                         (1, 1, 5, None, "f", '{"a": 0, "b": 1, "k": "z"}'), (1, 1, 5, None, "f", "[NaN]"),
                         (1, 2, 0, "t", "f", '{"a": 1, "a": 2}'), (None, None, None, "v", "f", '{"a": "\\ud800"}'),
                         (3, 1, 0, "w", "f", '{"a": 1, "on": ["$x"]}'), (3, 2, 0, "x", "f", '{"a": 1}')],
                 [(1, 2, None, "no"), (None, 1, "v", None), (1, 1, "t", "yes")])
    assert Counter((r.call_id, r.status) for r in got) == {
        ("p", "cyclic"): 1, ("q", "cyclic"): 1, ("s", "cyclic"): 1, ("t", "invalid"): 1, ("u", "invalid"): 1, (None, "invalid"): 2,
        ("t", "duplicate"): 1, ("v", "invalid"): 1, ("w", "invalid"): 1, ("x", "ok"): 1}
    by = {(r.call_id, r.status): r for r in got}
    assert by["t", "invalid"].linked and json.loads(by["t", "invalid"].json)["arguments"] is None
    assert by["v", "invalid"].linked and "\\ud800" in by["v", "invalid"].json
    message = [r.call_id for r in got if (r.conv_id, r.turn) == (1, 1)]
    assert message[-3:] == ["p", "q", "s"]
    assert linked(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 8).flatmap(lambda n: st.lists(st.sets(st.integers(0, max(0, n - 1))), min_size=n, max_size=n)))
def test_topological_order(needs):
    order, stuck = tool_chat.topological(needs)
    assert sorted(order) == list(range(len(needs)))
    seen = set()
    for k in order:
        assert k in stuck or needs[k] <= seen
        seen.add(k)
    assert all(needs[k] & stuck for k in stuck)


def test_equal_numbers_are_written_alike():
    for some, text in (([1, 1.0], "1"), ([0, -0.0, 0.0], "0"), ([10 ** 16, 1e16], "1" + "0" * 16), ([0.1, 1e-1], "0.1"), ([True], "true")):
        assert {tool_chat.canonical(v) for v in some} == {text}
    read = [tool_chat.canonical(tool_chat.read_json(t)) for t in ('{"b":[1.0,-0],"a":1E2}', '{"a":100,"b":[1,0.0]}')]
    assert read == ['{"a":100,"b":[1,0]}'] * 2
    with pytest.raises(ValueError):
        tool_chat.canonical(tool_chat.read_json("1e400"))



@settings(max_examples=60, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(),
                    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12))
def test_canonical_json_round_trip(value):
    text = tool_chat.canonical(value)
    assert tool_chat.read_json(text) == value and tool_chat.canonical(tool_chat.read_json(text)) == text
    assert text.encode()


# ---- URLs ------------------------------------------------------------------------------------------------------------

HOSTS = [url_rules.HostRule("block", "ex.com", "/a/"), url_rules.HostRule("allow", "w.ex.com", "/a/"), url_rules.HostRule("allow", "com", "/")]
PATTERNS = [url_rules.PatternRule("block", "page", r"[?&]page=[0-9]+", ("page",)),
            url_rules.PatternRule("allow", "first", r"page=1$", ("page", "1")),
            url_rules.PatternRule("block", "any", r"zz+")]


def by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fits = [r for r in HOSTS if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict
    hits = [r.verdict for r in PATTERNS if url is not None and re.search(r.pattern, url.lower())]
    return host, path, None, "allow" if "allow" in hits or not hits else "block"


def test_urls_against_all_rules(spark):
    rnd = random.Random(8)
    urls = [None, "", "no scheme", "://", "http://ex.com", "http://EX.com/a/b?x", "http://w.ex.com/a/", "x://notex.com/a/", "http://a\nb.com/x",
            "http://h.org/?page=2", "http://h.org/?page=1", "http://h.org/?PAGE=2#page=1", "http://h.org/zzz", "http://h.org/q?page=x"]
    urls += ["".join(rnd.choice(["http", "://", "ex", ".com", "w.", "/a/", "?", "#", "page=", "1", "2", "zz", "&"]) for _ in range(8))
             for _ in range(300)]
    df = spark.createDataFrame([(k % 7 or None, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rows = url_rules.judge_urls(df, HOSTS, PATTERNS).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == Counter(
        (k % 7 or None, *by_hand(u)) for k, u in enumerate(urls))
    assert all(r.candidates >= 1 for r in rows)  # the rule without a token
    assert url_rules.judge_urls(df.limit(0), HOSTS, PATTERNS).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(df, [], []).collect()} == {"allow"}


def test_url_rules_are_filed_under_their_rarest_token():
    index = url_rules.pattern_index(PATTERNS, {"page": 5, "1": 2})
    assert {at: [r["name"] for r in rules] for at, rules in index.items()} == {"page": ["page"], "1": ["first"], "": ["any"]}


def test_tokens_that_patterns_require():
    want = {r"[?&]page=[0-9]+(&|#|$)": ("page",), r"[?&]page=[0-9]+&ref=": ("page", "ref"), r"page=1$": ("1",), r"/(user/)?login(/|[?#]|$)": ("login",),
            r"^https?://www\.[^/]+/[a-z]{2}/[0-9]+\.html([?#]|$)": ("www", "html"), r"://(ads?|banner)[0-9]*\.": (), r"a|/b/": (),
            r"(?i)/b/": (), r"/ab+/": (), r"/ab?/": (), r"/a{2}/c{1}/": (), r"/x(?:/y/)z/": ("x", "y", "z"), r"\bfoo\b": ("foo",), r"/\d1/": (),
            r"/b(?!c)/": (), r"[/\]a]x/": (), r"/q*/z/": ("z",), r"/a/*/b/": ("b",), r"[^/]a/": (), r"/A/b/": ("b",), r"/a_b/": ("a", "b"),
            "(": (), "[": (), "a)": (), "": ()}
    assert {p: url_rules.required_tokens(p) for p in want} == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["/", "a", "b", "1", "=", "?", "*", "+", "{2}", "{0,1}", "(", ")", "(?:", "|", "[/=]", "[a/]", "[^a]", ".", "^", "$",
                                 r"\.", r"\d", r"\b"]), max_size=9), st.lists(st.sampled_from("/ab1=.-"), max_size=12))
def test_matches_hold_the_required_tokens(parts, url):
    pattern, url = "".join(parts), "".join(url)
    try:
        hit = re.search(pattern, url)
    except re.error:
        return
    if hit:
        assert set(url_rules.required_tokens(pattern)) <= set(re.split("[^a-z0-9]+", url))


def test_ten_thousand_rules_equal_running_them_all(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(4))
    rules = [url_rules.PatternRule(rnd.choice(["allow", "block"]), f"r{k}", rnd.choice([
        f"/{word()}/{word()}(/|$)", f"[?&]{word()}=[0-9]+", f"^http://{word()}\\.", f"/{word()}_[0-9]/"])) for k in range(10_000)]
    rules.append(url_rules.PatternRule("block", "no token", "zz+"))
    urls = [f"http://{word()}.org/{word()}/{word()}{rnd.choice(['', '/', '_1/'])}?{word()}={rnd.choice(['1', 'x'])}{rnd.choice(['', 'zz'])}"
            for _ in range(60)] + [None, "", "HTTP://ABCD.org"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls + urls)], "page_id long, url string")
    compiled = [re.compile(r.pattern) for r in rules]
    got = url_rules.judge_urls(df, [], rules).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        url = urls[r.page_id % len(urls)]
        hits = [x for x, p in zip(rules, compiled) if url is not None and p.search(url.lower())]
        first = min(hits, key=lambda x: (x.verdict != "allow", int(x.name[1:]) if x.name != "no token" else 10_000), default=None)
        assert (r.pattern, r.verdict) == ((first.name, first.verdict) if first else (None, "allow"))
        assert len(hits) <= r.candidates < 200
