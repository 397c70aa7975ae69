"""Language model, packing, mixing and the pipeline on awkward rows, against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from provdata.llm import hpy_lm, mixing, packing
from provdata.llm.tables import prefix_sums
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, docs, split_words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# ---- language model ----------------------------------------------------------------------------------------------------

SMALL = hpy_lm.Params(hot=8, named=4, classes=3, buffer_tokens=300)


def add_one(rows):
    def trains(i):
        return i is None or zlib.crc32(str(i).encode()) % 7 != 2
    tokens = [split_words(r[1], lower=True) + ["\n"] for r in rows]
    counts = Counter(w for r, t in zip(rows, tokens) if trains(r[0]) for w in t)
    n, v = sum(counts.values()), len(counts)
    return Counter((r[0], not trains(r[0]), len(t), sum(counts[w] > 0 for w in t), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows, tokens))


def texts(n, seed):
    rnd = random.Random(seed)
    return [(100 + k, " ".join(rnd.choice(["The", "the", "of"] + [f"w{int(rnd.paretovariate(0.9))}"] * 3)
                               for _ in range(rnd.randrange(0, 80)))) for k in range(n)]


def test_lm_base_and_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] not in (7, 8)] + texts(120, 1)
    got = hpy_lm.score_texts(docs(spark, rows, 3), SMALL).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == add_one(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    same = defaultdict(set)
    for (i, text, *_), r in zip(sorted(rows, key=str), sorted(got, key=str)):
        same[text or ""].add(None)
    assert [round(r.score, 9) for r in got if r.doc_id in (1, 2)][0] == [round(r.score, 9) for r in got if r.doc_id in (1, 2)][1]


def test_lm_beats_the_unigram_on_held_out_texts_with_order(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join(w for _ in range(30) for w in rnd.choice([("red", f"apple{rnd.randrange(40)}"), ("blue", f"sky{rnd.randrange(40)}")])))
            for k in range(300)]
    got = [r for r in hpy_lm.score_texts(docs(spark, rows, 3), hpy_lm.Params(hot=16, named=8, classes=3)).collect() if r.held_out]
    assert len(got) > 20 and sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_lm_without_training_rows_and_empty(spark):
    df = docs(spark, AWKWARD[:6])
    assert {(r.score, r.base_score, r.n_known) for r in hpy_lm.score_texts(df, SMALL, train=F.lit(False)).collect()} == {(0.0, 0.0, 0)}
    assert hpy_lm.score_texts(docs(spark, []), SMALL).count() == 0


@pytest.mark.parametrize("bad", [{"classes": 60}, {"hot": 70_000}, {"hot": 50}])
def test_lm_parameters_that_do_not_fit_are_refused(bad):
    with pytest.raises(ValueError):
        hpy_lm.Params(**bad)


def test_lm_probabilities_add_up_to_one():
    """Over the vocabulary and the unknown word, in every context, with the totals of the seating."""
    rng = np.random.default_rng(0)
    p, n_words = SMALL, 40
    keys = np.unique(rng.integers(0, n_words * p.contexts, 150))
    word, context = keys // p.contexts, keys % p.contexts
    known, word = np.unique(word, return_inverse=True)
    # every word in every context, most without customers
    customers = np.zeros(len(known) * p.contexts, np.int64)
    customers[word * p.contexts + context] = rng.integers(1, 400, len(word))
    all_words, all_contexts = np.divmod(np.arange(len(customers)), p.contexts)
    seats = hpy_lm.Restaurants(all_words, all_contexts, customers, len(known), p, 0)
    totals = [hpy_lm._totals(seats.sums(), p)]
    for _ in range(4):
        seats.sweep(totals[-1])
        totals.append(hpy_lm._totals(seats.sums(), p))
    t = totals[-1]
    assert t.vocabulary == len(known)
    unknown_parent = (p.strength + t.parent_discount * t.parent_tables) / (t.vocabulary + 1) / (p.strength + t.parent_customers)
    mass = np.bincount(all_contexts, seats.probability(t), p.contexts)
    unknown = (p.strength + t.discount * t.tables) * unknown_parent / (p.strength + t.customers)
    assert np.allclose(mass + unknown, 1)
    # Seating the types that have customers alone gives the same.
    some = np.flatnonzero(customers)
    fewer = hpy_lm.Restaurants(all_words[some], all_contexts[some], customers[some], len(known), p, 0)
    for k in range(4):
        fewer.sweep(totals[k])
    assert (fewer.tables == seats.tables[some]).all()


def test_seating_has_the_process_distribution():
    """Table counts of the block seating against one customer at a time."""
    rng = np.random.default_rng(1)
    customers = np.array([1, 2, 5, 40, 900])
    opening, discount, rounds = np.array([0.5, 3.0, 1.0, 2.0, 5.0]), 0.6, 400
    got = np.mean([hpy_lm.seat(customers, opening, discount, rng) for _ in range(rounds)], axis=0)
    want = np.zeros(5)
    for k, (c, a) in enumerate(zip(customers, opening)):
        for _ in range(rounds):
            t = 1
            for n in range(1, c):
                t += rng.random() < a / (a + n - discount * t)
            want[k] += t / rounds
    assert np.allclose(got, want, rtol=0.06) and (hpy_lm.seat(np.array([0, 1]), np.ones(2), 0.5, rng) == [0, 1]).all()


def test_many_customers_are_seated_exactly():
    """Without a discount the mean is known: each customer opens a table with odds ``opening`` against those seated."""
    rng = np.random.default_rng(2)
    for customers, opening in ((5000, 50.0), (400, 30.0), (100, 2.0)):
        got = hpy_lm.seat(np.full(4000, customers), np.full(4000, opening), 0.0, rng).mean()
        want = 1 + np.sum(opening / (opening + np.arange(1, customers)))
        assert abs(got / want - 1) < 0.01, (customers, opening, got, want)
    # Openings so small that their chance underflows open nothing; so large that each customer opens one.
    assert (hpy_lm.seat(np.array([2, 10**9]), np.full(2, 1e-200), 0.5, rng) == 1).all()
    assert (hpy_lm.seat(np.array([2, 50]), np.full(2, 1e15), 0.5, rng) == [2, 50]).all()


# ---- packing -------------------------------------------------------------------------------------------------------------

def encode_all(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    return [np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4") for r in rows]


def check_packing(got, ids, size):
    pieces = Counter()
    for doc_id, own in ids:
        first = len(own) - (len(own) - 1) // size * size
        cuts = [0, *range(first, len(own) + 1, size)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pieces[doc_id, k, a, b - a, zlib.crc32(own[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(sequences)


@pytest.mark.parametrize("parts,fan_in", [(1, 8), (7, 2)])
def test_packing_awkward_rows(spark, parts, fan_in):
    odd = ["  two  blanks ", " lead", "trail ", "tab \t tab", "a\u00a0 b", "<|endoftext|> x", "don't  we'll", "1 234 5", "é\u3000x", "a \n b", "😀 ok"]
    rows = AWKWARD + [(200 + k, t) for k, t in enumerate(odd)] + texts(150, 3)
    got = packing.pack(docs(spark, rows, parts), VOCABULARY, size=64, open_bins=4, fan_in=fan_in).collect()
    ids = [(r[0], i) for r, i in zip(rows, encode_all(rows))]
    n = check_packing(got, ids, 64)
    assert n <= 1.08 * -(-sum(len(i) for _, i in ids) // 64) + 2
    assert packing.pack(docs(spark, []), VOCABULARY).count() == 0


def test_best_fit_against_a_list_of_bins():
    rnd = random.Random(9)
    lengths = [rnd.randrange(1, 101) for _ in range(3000)]
    fast, slow, bins = packing.BestFit(100, 6, 0), [], {}
    placed, count = [fast.place(n) for n in lengths], 0
    for n in lengths:
        fits = [b for b, free in bins.items() if free >= n]
        if fits:
            least = min(bins[b] for b in fits)
            best = [b for b in fits if bins[b] == least]
        else:
            best, bins[count] = [count], 100
            count += 1
        slow.append((best, 100 - bins[best[0]]))
        took = placed[len(slow) - 1]
        assert took[0] in best and took[1] == 100 - bins[took[0]]
        bins[took[0]] -= n
        if bins[took[0]] == 0:
            del bins[took[0]]
        elif len(bins) > 6:
            fullest = min(bins.values())
            closed = [b for b, free in bins.items() if free == fullest]
            open_now = {b for own in fast_state(lengths[:len(slow)]) for b in [own]}
            gone = [b for b in closed if b not in open_now]
            assert len(gone) == 1
            del bins[gone[0]]
    assert len(fast.rest()) <= 6


def fast_state(lengths):
    again = packing.BestFit(100, 6, 0)
    for n in lengths:
        again.place(n)
    return [b for b, _ in again.rest()]


def test_encoder_whose_vocabulary_is_no_byte_level_bpe():
    whole = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert whole.fast is None
    assert [list(x) for x in whole(pa.array(["a b", None]))] == [whole.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a b", "")]


def test_added_tokens_have_their_own_ids(spark):
    rows = [(1, "hello <|endoftext|> world"), (2, "<|endoftext|>"), (3, "a<|endoftext|><|endoftext|>\nb <|endo ftext|>"), (4, "hello world")]
    got = packing.pack(docs(spark, rows), VOCABULARY).collect()
    check_packing(got, [(r[0], ids) for r, ids in zip(rows, encode_all(rows))], 2048)
    assert {(r.length, r.ids_crc32) for r in got if r.doc_id == 1} == {(5, 4120161527)}


# ---- mixing --------------------------------------------------------------------------------------------------------------

def water_fill(sizes, weights, cap):
    """Shares by weight; capped sources leave, the rest share again."""
    total, capped = float(sum(sizes.values())), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        targets = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if targets[s] > cap * sizes[s]]
        if not over:
            return targets | capped
        capped |= {s: float(cap * sizes[s]) for s in over}


def test_mix_awkward_rows(spark):
    rnd = random.Random(12)
    rows = AWKWARD + [(300 + k, " ".join("x" * rnd.randrange(1, 60))) for k in range(0)]
    for k in range(400):
        source = "hot" if k % 3 == 0 else rnd.choice(["a", "b", "é", "Z", None, "tiny"] if k % 50 else ["rare"])
        rows.append((1000 + k, " ".join("w" for _ in range(rnd.randrange(0, 40 if source != "tiny" else 3))), source))
    got = mixing.mix_sources(docs(spark, rows, 4)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[2] if len(r) > 2 else "a"] += len(split_words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = water_fill(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(split_words(r[1]))) for r in rows)
    taken, longest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], abs_tol=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - targets[s]) <= longest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix_sources(docs(spark, rows[::-1], 7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_repeats_rows(spark):
    rows = [r for r in AWKWARD if r[0] != 5] + [(50 + k, "a b c", "a") for k in range(30)]
    df = docs(spark, rows, 3)
    copies = {(r.doc_id, r.source, r.size): r.copies for r in mixing.mix_sources(df).collect()}
    out = mixing.repeat_to_mix(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.source, len(split_words(r.text))) for r in out.collect())
    assert got == {k: n for k, n in copies.items() if n}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_mix_cuts_rows_without_an_id_of_their_own(spark, doc_id):
    """Of 300 rows of ten words, all with one id, each source yields its target: 1,000 and 2,000 words."""
    same = [(doc_id, "w " * 10, "a")] * 150 + [(doc_id, f"v{k} " * 10, "a") for k in range(50)]
    rows = same + [(doc_id, f"x{k % 40} " * 10, "b") for k in range(100)]
    df = docs(spark, rows, 5)
    taken = {r.source: r.words for r in mixing.mix_sources(df).groupBy("source").agg(F.sum("taken").alias("words")).collect()}
    out = mixing.repeat_to_mix(df)
    assert out.columns == df.columns
    sizes = {r.source: r["count"] * 10 for r in out.groupBy("source").count().collect()}
    assert taken == sizes == {"a": 1000, "b": 2000}


def test_mix_without_words(spark):
    assert mixing.mix_sources(docs(spark, [])).count() == 0 and mixing.repeat_to_mix(docs(spark, [])).count() == 0
    assert {(r.target, r.taken) for r in mixing.mix_sources(docs(spark, [(1, None, None), (2, "", "a")])).collect()} == {(0.0, 0)}


def test_prefix_sums_of_one_hot_value(spark):
    df = spark.range(2000).select((F.col("id") % 10 == 0).cast("int").alias("g"), F.xxhash64("id").alias("k"), (F.col("id") % 5).alias("v"))
    rows = prefix_sums(df, [F.col("k")], {"s": F.col("v")}, by="g").collect()
    for g in (0, 1):
        run = 0
        for r in sorted((r for r in rows if r.g == g), key=lambda r: r.k):
            assert r.s == run
            run += r.v


# ---- pipeline ------------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near duplicates", "source mix", "packing"]
    docs_ = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs_.columns, {r[0] for r in docs_.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs_.count()
        out = stage(spark, docs_, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        docs_ = spark.read.parquet(str(tmp_path / str(k)))
        now = [r[0] for r in docs_.select("doc_id").collect()]
        assert set(now) <= ids
        if name == "packing":
            assert {r[0] for r in spark.read.parquet(str(tmp_path / str(k - 1))).select("doc_id").collect()} == set(now)
            break
        assert docs_.columns == columns
        if name in ("exact dedup", "near duplicates"):
            texts_ = [r[0] for r in docs_.select("text").collect()]
            assert len(texts_) == len(set(texts_)) <= before
        ids = set(now)
    assert corpus_pipeline.run(spark, SF_SMALL).columns == docs_.columns


def test_pipeline_handles_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
