"""Exact de-duplication and the Jaccard join on awkward rows, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from provdata.llm import exact_dedup, jaccard_join
from provdata.llm.graph import components
from tests.llm.helpers import AWKWARD, docs, split_words


def test_exact_awkward_rows(spark):
    rows = exact_dedup.exact_duplicates(docs(spark, AWKWARD, 3)).collect()
    assert len(rows) == len(AWKWARD)
    groups = defaultdict(list)
    for i, text, *_ in AWKWARD:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(i)
    for r in rows:
        own = groups[r.text_sha256]
        assert r.group_size == len(own)
        assert r.keep_id == max((i for i in own if i is not None), default=None)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert kept == Counter(dict.fromkeys(groups, 1))  # of rows repeated with one id, too


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_exact_keeps_the_asked_end_over_many_runs(spark, keep, best):
    rnd = random.Random(3)
    rows = [(k, rnd.choice(["x", "x", "x", f"t{k % 7}", f"only {k}"])) for k in range(400)]
    found = exact_dedup.exact_duplicates(docs(spark, rows, 9), keep=keep, fan_in=2).collect()
    want = defaultdict(list)
    for i, t in rows:
        want[t].append(i)
    texts = dict(rows)
    assert all(r.keep_id == best(want[texts[r.doc_id]]) and r.kept == (r.doc_id == r.keep_id) for r in found)


def test_exact_rows_that_stay(spark):
    df = docs(spark, AWKWARD, 3)
    stay = exact_dedup.drop_exact_duplicates(df)
    assert stay.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in stay.collect())
    want = {}
    for i, text, *_ in AWKWARD:
        best = want.get(text or "")
        if best is None or (i is not None and (best[0] is None or i > best[0])):
            want[text or ""] = (i, text)
    assert got == Counter({v: 1 for v in want.values()})


def test_empty_tables(spark):
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs(spark, [])).count() == 0
    assert jaccard_join.link_components(docs(spark, [])).count() == 0
    assert jaccard_join.drop_near_duplicates(docs(spark, [])).count() == 0


def shingles(text):
    w = split_words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def brute(rows):
    """Row number -> (set size, name of its component)."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for k, r in enumerate(rows):
        members[find(k)].append(r[0])
    return Counter((r[0], len(sets[k]), min((i for i in members[find(k)] if i is not None), default=None))
                   for k, r in enumerate(rows))


def near_copies(seed, n, length, edits, first=100):
    """Chains of edited copies, so that ends of a component need not be linked themselves."""
    rnd = random.Random(seed)
    base = [f"v{rnd.randrange(400)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(rnd.choice(rows)[1].split() if rows and rnd.random() < 0.5 else base)
        for _ in range(rnd.randrange(edits)):
            words[rnd.randrange(length)] = f"e{rnd.randrange(10 ** 6)}"
        rows.append((first + k, " ".join(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("params", [{}, {"pairwise": 2, "block_tokens": 900, "buffer_tokens": 500}, {"pairwise": 1, "look": 5}])
def test_join_equals_brute_force(spark, params):
    passage = " ".join(f"p{k}" for k in range(60))
    rnd = random.Random(1)
    shared = [(5000 + k, passage + " " + " ".join(f"q{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(5, 90))))
              for k in range(40)]
    rows = AWKWARD + near_copies(1, 90, 60, 7) + near_copies(2, 12, 20, 3, 900) + shared
    df = docs(spark, rows, 5)
    got = Counter(tuple(r) for r in jaccard_join.link_components(df, jaccard_join.Params(**params)).collect())
    assert got == brute(rows)


def test_join_at_the_threshold(spark):
    """Sets of exactly 75 % overlap are linked, just below they are not; 100 * both = 75 * union."""
    words = [f"a{k}" for k in range(304)]  # 300 shingles
    tail = [f"b{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:229] + tail[:50])), (3, " ".join(words[:200] + tail[10:60]))]
    rows += [(k, " ".join(f"c{k}-{j}" for j in range(9 + k))) for k in range(10, 14)]
    rows += [(20, " ".join(f"d{j}" for j in range(10))), (21, " ".join(f"d{j}" for j in range(12)))]  # 6 of 8 shingles
    rows += [(22, " ".join(f"f{j}" for j in range(9))), (23, " ".join(f"f{j}" for j in range(11)))]  # 5 of 7
    got = Counter(tuple(r) for r in jaccard_join.link_components(docs(spark, rows)).collect())
    assert got == brute(rows)
    names = {i: c for (i, _, c), _ in got.items()}
    assert names[21] == 20 and names[23] == 23


def test_join_rows_that_stay(spark):
    rows = AWKWARD + near_copies(4, 30, 40, 4)
    df = docs(spark, rows, 3)
    stay = jaccard_join.drop_near_duplicates(df)
    assert stay.columns == df.columns
    names = {i: c for (i, _, c), _ in brute(rows).items()}
    want = Counter(i for i in {r[0] for r in rows} if i is not None and names[i] == i)
    want[None] = sum(r[0] is None for r in rows)
    assert Counter(r.doc_id for r in stay.collect()) == want


def test_join_judges_rows_by_their_text(spark):
    """Repeated and null ids: a clean text stays whatever else has its id, and each component keeps one row."""
    def text(name, n=30):
        return " ".join(f"{name}{k}" for k in range(n))
    rows = [(50, text("clean")), (50, text("a")), (40, text("a") + " end"),  # one row of 50 is a copy of 40, one is clean
            (60, text("b")), (60, text("c") + " end"), (30, text("c")), (61, text("b") + " end"),  # 60 heads b, follows 30 in c
            (None, text("d")), (None, text("d") + " end"), (None, text("e")), (20, text("e") + " end"),
            (None, text("lone")), (None, ""), (None, " "), (70, ""), (70, None), (80, text("f")), (80, text("f"))]
    want = Counter([(50, text("clean")), (40, text("a") + " end"), (60, text("b")), (30, text("c")), (20, text("e") + " end"),
                    (None, text("lone")), (None, ""), (None, " "), (70, ""), (70, None), (80, text("f"))])
    for parts in (1, 4):
        stay = jaccard_join.drop_near_duplicates(docs(spark, rows, parts), spare_unnamed=False)
        got = Counter((r.doc_id, r.text) for r in stay.collect())
        one_of_d = got - want
        assert want - got == Counter() and list(one_of_d.values()) == [1] and next(iter(one_of_d))[1].startswith(text("d"))
        spared = Counter((r.doc_id, r.text) for r in jaccard_join.drop_near_duplicates(docs(spark, rows, parts)).collect())
        assert spared == Counter({k: n for k, n in want.items() if k[0] is not None}) + Counter(r for r in rows if r[0] is None)


def test_join_reads_the_texts_of_one_hot_id_once(spark):
    """Rows that share an id and differ in text: as many come out of the fetch of the texts as there are classes."""
    rows = [(7, f"t{k} a b c d") for k in range(60)]
    df = docs(spark, rows, 3).select("doc_id", "text")
    classes = df.select(F.encode("text", "utf-8").alias("class"), F.col("doc_id").alias("first_id"),
                        jaccard_join._text_digest(F.col("text")).alias("first_digest"))
    assert jaccard_join._with_first_text(df, classes).count() == 60
    near = [(7, " ".join(f"x{j}" for j in range(40)) + f" end{k}") for k in range(8)] + rows
    assert Counter(tuple(r) for r in jaccard_join.link_components(docs(spark, near, 3)).collect()) == brute(near)


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {100: 100, 200: 100, 150: 100, 300: 300, 301: 300}
