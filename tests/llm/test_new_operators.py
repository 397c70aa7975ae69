"""Conversation repair, the byte-level BPE transducer and lexical search against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from provdata.llm import bpe_fst, conversation_repair as cr, lexical_search as ls
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, docs

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- conversation repair ------------------------------------------------------------------------

CONVERSATION = "conv_id long, turn long, role string, text string, segment string, place string, kind string, edits string"


def conversations(spark, rows, parts=3):
    full = [(*r, "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(full, CONVERSATION).repartition(parts) if full else spark.createDataFrame([], CONVERSATION)


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        drawn = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not drawn else "d" if (role, text) in seen else "t" if drawn[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, messages) by dynamic programming over prefixes, keeping the least pair for each last role."""
    def closed(best):
        while True:
            more = {}
            for state, (cost, audit, said) in best.items():
                role = "assistant" if state == "u" else "user"
                new = (cost + 5, audit + "I", said + [f"{role}:"])
                if role[0] not in best or new[:2] < best[role[0]][:2]:
                    if role[0] not in more or new[:2] < more[role[0]][:2]:
                        more[role[0]] = new
            if not more:
                return best
            best = best | more

    best = closed({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        options = []
        for state, (cost, audit, said) in best.items():
            options.append((state, (cost + 2, audit + "D", said)))
            if fault in "bd":
                continue
            extra = 5 if fault == "t" else 0
            if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and role:
                options.append((role[0], (cost + extra, audit + "K", said + [f"{role}:{text}"])))
            new = "assistant" if state == "u" else "user"
            options.append((new[0], (cost + extra + 1, audit + "R", said + [f"{new}:{text}"])))
        best = {}
        for state, option in options:
            if state not in best or option[:2] < best[state][:2]:
                best[state] = option
        best = closed(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda o: o[:2])


def repaired(rows, ids):
    found = set()
    for conv_id in ids:
        mine = sorted(((t, r, x) for c, t, r, x in rows if c == conv_id), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in mine if t is not None]
        faults = faults_of(mine)
        cost, audit, said = cheapest(mine, faults)
        found.add((conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                   *(faults.count(f) for f in "bdt"),
                   sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
                   cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return found


def random_rows(seed, n_conversations, longest):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "User", "", "a", "user", "assistant"]
    texts = ["hi.", "ok", "why? ", "", None, "yes!\n", ".x", "é。", " \t", "no.", "so.", "x" * 5000 + "."]
    return [(None if c == 0 else c, rnd.choice([t, t, t, None, t // 2]), rnd.choice(roles), rnd.choice(texts))
            for c in range(n_conversations) for t in range(rnd.randrange(1, longest))]


@pytest.mark.parametrize("segment", [2, 64])
def test_repair_equals_dynamic_programming(spark, monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = random_rows(segment, 60, 12) + random_rows(segment + 1, 1, 2) + [r for r in random_rows(9, 1, 400)]
    df = conversations(spark, rows)
    got = cr.report(cr.repair(cr.damage(df), df)).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {tuple(r) for r in got} == repaired(damaged(rows), {r[0] for r in rows})


def test_repair_of_given_conversations(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    got = {tuple(r) for r in cr.report(cr.repair(cr.damage(df), df)).collect()}
    assert got == repaired(damaged(rows), {r[0] for r in rows})


def test_repair_without_rows_and_with_many_equal_rows(spark):
    empty = conversations(spark, [])
    assert cr.report(cr.repair(empty)).collect() == []
    rows = [(1, 0, "user", "hi.")] * 500 + [(1, 1, "assistant", "ho.")] + [(2, None, "user", " ")] * 300
    ids = conversations(spark, rows + [(3, 0, "user", "x")])
    got = {r.conv_id: r for r in cr.report(cr.repair(conversations(spark, rows), ids)).collect()}
    assert (got[1].audit, got[1].cost, got[1].duplicate, got[1].illegal) == ("K" + "D" * 499 + "K", 998, 499, 499)
    assert (got[2].audit, got[2].blank, got[2].gaps) == ("D" * 300, 300, 0)
    assert (got[3].audit, got[3].cost, got[3].repaired_sha256) == ("", 0, hashlib.sha256().hexdigest())


def test_edits_are_the_repaired_conversation(spark):
    rows = [(7, 0, "assistant", "a."), (7, 1, "user", "cut"), (7, 2, "user", "q?")]
    edits = cr.repair(conversations(spark, rows)).orderBy("place").collect()
    assert [(e.edits, e.role, e.text) for e in edits if e.edits] == [
        ("R", "user", "a."), ("D", "user", "cut"), ("R", "assistant", "q?")]


def all_audits(symbols, entry, terminal, most):
    """Cost -> audits of every sequence of edits with at most ``most`` inserts."""
    best = {}

    def go(place, state, cost, audit, inserts):
        if place == len(symbols) and terminal[state] is not None:
            best.setdefault(cost + terminal[state], []).append(audit)
        if inserts < most:
            go(place, cr.FOLLOWS[state, cr.WANTED[state][0]], cost + 5, audit + "I", inserts + 1)
        if place < len(symbols):
            go(place + 1, state, cost + 2, audit + "D", inserts)
            if symbols[place] != "x":
                extra = 5 if symbols[place].isupper() else 0
                if (state, symbols[place].lower()) in cr.FOLLOWS:
                    go(place + 1, cr.FOLLOWS[state, symbols[place].lower()], cost + extra, audit + "K", inserts)
                go(place + 1, cr.FOLLOWS[state, cr.WANTED[state][0]], cost + extra + 1, audit + "R", inserts)

    go(0, entry, 0, "", 0)
    return min(best), min(best[min(best)])


def test_auction_equals_enumeration():
    for symbols in itertools.chain([""], *(map("".join, itertools.product("suaoUAx", repeat=n)) for n in (1, 2, 3))):
        arcs = cr._arcs(symbols, cr.DONE)
        prices = cr.auction(arcs, 0)
        assert all(prices[i] <= cost + prices[to] for i, some in enumerate(arcs) for _, to, cost in some
                   if to in cr._leading_to(len(arcs) - 1, arcs, lambda *_: True))
        cost, letters = all_audits(symbols, 0, cr.DONE, 3)
        assert prices[0] == cost and cr.audit(symbols, 0, cr.DONE) == letters
    for entry in range(4):
        assert cr.audit("uaA", entry, (9, 1, None, 4)) == all_audits("uaA", entry, (9, 1, None, 4), 3)[1]
        assert list(cr.crossing("sux")[entry]) == [
            None if not ok else all_audits("sux", entry, tuple(0 if s == leave else None for s in range(4)), 4)[0]
            for leave in range(4) for ok in [cr.crossing("sux")[entry][leave] is not None]]


# --- byte-level BPE -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fst.read_ranks(VOCABULARY), special_tokens={})


def odd_texts():
    rnd = random.Random(5)
    letters = [chr(c) for c in range(32, 127)] + list("éüßñ中文字한국어あいう😀👍🏽́﻿\x00\t\n\r\x85 　①²") + ["՘", "\U00018d85"]
    for k in range(1500):
        yield "".join(rnd.choice(letters if k % 2 else "  aabcdeinrst'T") for _ in range(rnd.choice((3, 10, 60))))
    yield from ("", "a" * 5000, " " * 3000, "ab" * 4000, "\n" * 999 + "x", "中" * 2000, "=-" * 700, "<|endoftext|> a")


@pytest.mark.parametrize("max_states", [bpe_fst.MAX_STATES, 40])
def test_transducer_equals_library(library, max_states):
    encoder, decoder = bpe_fst.Encoder(VOCABULARY, public_tokenizers.PATTERN), bpe_fst.Decoder(VOCABULARY)
    encoder.machine.max_states = max_states
    for text in odd_texts():
        lengths, ids = encoder(pa.array([text]))
        assert ids.tolist() == library.encode_ordinary(text) and lengths.tolist() == [len(ids)]
        assert decoder(ids) == text.encode()
        assert len(encoder.machine.alive) <= max(max_states, 2)


def test_compatible_equals_merging():
    ranks = bpe_fst.read_ranks(VOCABULARY)
    machine, rnd = bpe_fst.Transducer(ranks), random.Random(2)
    ids = list(machine.halves)
    for _ in range(4000):
        left, right = rnd.choice(ids), rnd.choice(ids)
        whole = machine.bytes_of[rnd.choice(ids)]
        cut = rnd.randrange(1, len(whole))
        if rnd.random() < 0.5 and whole[:cut] in ranks and whole[cut:] in ranks:
            left, right = ranks[whole[:cut]], ranks[whole[cut:]]
        two = [machine.bytes_of[left], machine.bytes_of[right]]
        assert machine.compatible(left, right) == (bpe_fst.merge_by_rank(b"".join(two), ranks)[0] == two)


def test_lookahead_is_bounded():
    machine = bpe_fst.Transducer(bpe_fst.read_ranks(VOCABULARY))
    for piece in (b"internationalisation" * 40, "中文字".encode() * 90, b"=" * 900):
        machine.encode(piece)
    longest = max(map(len, machine.ranks))
    assert max(sum(len(machine.bytes_of[t]) for t in alive[-1][2]) for alive in machine.alive) <= 2 * longest


def test_small_vocabulary_with_an_unreachable_token(tmp_path):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259, b"cab": 260}
    machine = bpe_fst.Transducer(ranks)
    for letters in itertools.chain(*(itertools.product(b"abcxyz", repeat=n) for n in range(1, 6))):
        piece = bytes(letters)
        want = [ranks[piece]] if piece in ranks else [ranks[p] for p in bpe_fst.merge_by_rank(piece, ranks)[0]]
        assert machine.encode(piece) == want
    with pytest.raises(ValueError):
        bpe_fst.Transducer({b"a": 0})


def test_utf8_stream_cuts_anywhere():
    rnd = random.Random(3)
    for text in ("aé中😀z", "é" * 9, "😀中"):
        data = text.encode()
        for cut in itertools.product((True, False), repeat=min(len(data) - 1, 9)):
            stream, out, piece = bpe_fst.Utf8Stream(), [], bytearray()
            for k, byte in enumerate(data):
                piece.append(byte)
                if k >= len(cut) or cut[k]:
                    out.append(stream.feed(bytes(piece)))
                    piece.clear()
            out += [stream.feed(bytes(piece)), stream.finish()]
            assert b"".join(out) == data
            for chunk in out:
                chunk.decode()  # never cut inside a character
    for _ in range(300):  # malformed bytes come out unchanged
        data = bytes(rnd.choice((0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xED, 0xF0, 0xF4, 0xFF)) for _ in range(8))
        stream = bpe_fst.Utf8Stream()
        assert b"".join([stream.feed(data[:3]), stream.feed(data[3:]), stream.finish()]) == data


def test_round_trip_of_awkward_rows(spark, library):
    df = docs(spark, [(r + ("a",))[:3] for r in AWKWARD])
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in
           bpe_fst.round_trip(df, VOCABULARY, public_tokenizers.PATTERN).collect()}
    want = set()
    for row in AWKWARD:
        ids = library.encode_ordinary(row[1] or "")
        want.add((row[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((row[1] or "").encode()).hexdigest()))
    assert got == want
    both = bpe_fst.decode_ids(bpe_fst.encode_texts(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    assert both.columns == [*df.columns, "ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both.collect())
    assert bpe_fst.round_trip(docs(spark, []), VOCABULARY, public_tokenizers.PATTERN).collect() == []


# --- lexical search -----------------------------------------------------------------------------

def plain_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(rows, items, top=10):
    bags = [(d, plain_terms(t)) for d, t in rows]
    total, length = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = {}
    for _, bag in bags:
        for term in set(bag):
            df[term] = df.get(term, 0) + 1
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            score = 0
            for term in set(plain_terms(text)) & set(bag):
                m = 100 - 90 + (90 * len(bag) * total) // length
                tf = bag.count(term)
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        out += [(item_id, k + 1, d if known else None, -s) for k, (s, known, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id long, text string, score string, block string")


@pytest.mark.parametrize("block", [4 << 20, 30])
def test_search_equals_brute_force(spark, block):
    rnd = random.Random(8)
    words = ["the", "The", "ou-on", "é1", "x", "in", "of", "rare", "中文", "a1b2", "zz"]
    rows = [(k, " ".join(rnd.choices(words, weights=range(len(words), 0, -1), k=rnd.randrange(0, 12)))) for k in range(300)]
    rows += [(r[0], r[1]) for r in AWKWARD] + [(k, "the same bag") for k in range(1000, 1100)] + [(k, "bag same, THE") for k in range(900, 960)]
    items = [(1, "the same"), (2, None), (3, ""), (4, "é1 rare 中文"), (5, "nowhere"), (5, "rare zz"), (None, "in of"), (6, "one a b w77")]
    got = ls.search(docs(spark, rows, 5), items_of(spark, items), max_block_bytes=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_search(rows, items)


def test_search_of_empty_tables(spark):
    assert ls.search(docs(spark, []), items_of(spark, [(1, "a")])).collect() == []
    none = ls.search(docs(spark, [(1, "a")]), items_of(spark, []))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []


def test_classes_keep_the_least_ids_of_equal_bags(spark):
    rows = [(k, "b a b") for k in range(50, 0, -1)] + [(None, "b a b"), (99, "a b")]
    vectors = ls.document_vectors(docs(spark, rows), pa.array(["a", "b"]))
    classes = ls.bag_classes(vectors, 52, 155, 3).collect()
    assert sorted([m.doc_id for m in c.members] for c in classes if len(c.members) > 1) == [[None, 1, 2]]
    assert len(classes) == 2 and {tuple(c.tfs) for c in classes} == {(1, 2), (1, 1)}


def test_terms_of_sliced_arrays():
    texts = pa.array(["skip me", None, "Ä a-B c1", "", "x\x00y"])
    found = ls.terms(texts.slice(1))
    words = found.dictionary.to_pylist()
    assert [[words[c] for c in found.codes[a:b]] for a, b in zip(found.offsets, found.offsets[1:])] == [[], ["Ä", "a", "b", "c1"], [], ["x", "y"]]


def test_scan_reads_two_columns(spark):
    plan = ls.document_vectors(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), pa.array(["a"]))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan._jdf.queryExecution().executedPlan().toString()
