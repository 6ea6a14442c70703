"""Substring spans, lexical ranking and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from orderflow.llm import queries, ranking, repair, substrings
from tests.llm.conftest import SF


# -- substring spans -----------------------------------------------------------------

def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_spans(rows, window=20):
    """Per row (id, text): words, removed words, kept text; nulls first."""
    def key(i):
        return (i is not None, i or 0)
    first = {}
    for i, text in rows:
        w = space_words(text)
        for s in range(len(w) - window + 1):
            g, place = tuple(w[s:s + window]), (key(i), s)
            first[g] = min(first.get(g, place), place)
    out = []
    for i, text in rows:
        w, gone = space_words(text), set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (key(i), s):
                gone.update(range(s, s + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def spans_of(frame, rows, monkeypatch):
    docs = frame([(i, t, None, None) for i, t in rows], extra=("n_words", "row", "doc", "spans", "key"))
    monkeypatch.setattr(queries, "read_table", lambda *a: docs)
    got = queries.op11_relative_lempel_ziv(docs.sparkSession, "").collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "Ü", "x", "x"]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.choice([12, 19, 20, 21, 33, 60]))] for _ in range(9)]
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, " ".join(passages[0] * 3)), (4, "a " * 19), (5, "a " * 20),
            (6, "a " * 500), (7, " ".join(["a b c"] * 40)), (8, "\x00 " * 30), (9, " " + "q " * 25)]
    for i in range(10, 120):
        words = []
        for _ in range(rnd.randrange(1, 7)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(40))]
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(words)))
    rows += [rows[20], rows[20], (rows[21][0], rows[22][1]), (200, rows[23][1]), (-5, rows[24][1]), (300, rows[23][1])]
    return rows


@pytest.mark.parametrize("block,shard", [(None, None), (2000, 700), (100, 1)])
def test_spans_equal_brute_force(frame, monkeypatch, block, shard):
    if block:
        monkeypatch.setattr(substrings, "BLOCK_BYTES", block)      # many blocks, frequent names go by window
        monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
        monkeypatch.setattr(substrings, "HOT", 3)
    rows = corpus(1 if block else 2)
    assert spans_of(frame, rows, monkeypatch) == brute_spans(rows)


def test_a_frequent_phrase_in_many_contexts(frame, monkeypatch):
    """A phrase below the window in every document, with a few shared contexts:
    its name holds most passages and exceeds the block."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 3000)
    rnd = random.Random(3)
    phrase = [f"p{i}" for i in range(17)]
    around = [f"v{i}" for i in range(50)]
    rows = [(i, " ".join([rnd.choice(around) for _ in range(6)] + phrase + [rnd.choice(around[:4]) for _ in range(5)]))
            for i in range(150)]
    assert spans_of(frame, rows, monkeypatch) == brute_spans(rows)


def test_a_frequent_window_travels_once_a_shard(frame, sp, monkeypatch, tmp_path):
    """Texts of two words in turn, of many lengths: thousands of places of two
    windows, under one name."""
    monkeypatch.setattr(substrings, "HOT", 3)
    rows = [(i, ("x " if i % 2 else "") + "a b " * (10 + i) + f"e{i}") for i in range(1, 120)]
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, rows[7][1])]
    packed, pack = [], substrings.window_packs

    def seen(*args):
        packed.append(pack(*args).persist())
        return packed[-1]
    monkeypatch.setattr(substrings, "window_packs", seen)
    assert spans_of(frame, rows, monkeypatch) == brute_spans(rows)
    (packs,) = packed
    entries = np.concatenate([np.frombuffer(r["windows"], substrings._WINDOW)
                              for r in packs.where("windows is not null").collect()])
    places = sum(max(0, len(space_words(t)) - 19) for _, t in rows)
    # every text ends in windows of its own; of the others a shard sends one (and its repeated rows)
    assert len(entries) < places / 3 and packs.count() <= len(entries) + packs.select("shard").distinct().count()
    packs.unpersist()


def test_long_documents_and_empty_table(frame, monkeypatch):
    long = " ".join(f"wort{i % 977}" for i in range(30_000))
    rows = [(1, long), (2, long + " end"), (3, "kurz")]
    assert spans_of(frame, rows, monkeypatch) == brute_spans(rows)
    assert spans_of(frame, [], monkeypatch) == []


def test_kept_text_and_spans(frame):
    shared = [f"s{i}" for i in range(25)]
    docs = frame([(1, " ".join(shared), None, None), (2, " ".join(["x", *shared, "y"]), None, None)])
    got = {r["doc_id"]: r for r in substrings.deduplicated(docs).collect()}
    assert {s["start"] + k for s in got[2]["spans"] for k in range(s["n"])} == {1 + k for k in range(25)}
    assert got[1]["spans"] == [] and (got[1]["kept"], got[2]["kept"]) == (" ".join(shared), "x y")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=6), st.integers(2, 6))
def test_block_factors_cover_exactly_the_earlier_windows(texts, window):
    words = [b" ".join(b"%d" % x for x in t) for t in texts if len(t) >= window]
    if not words:
        return
    docs = list(range(len(words)))
    block = substrings.Block(docs, [0] * len(words), words, window)
    first = {}
    for d, t in enumerate(words):
        w = t.split()
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s:s + window]), (d, s))
    for d, t in enumerate(words):
        w = t.split()
        want = {s + k for s in range(len(w) - window + 1) if first[tuple(w[s:s + window])] < (d, s) for k in range(window)}
        factors = block.parse(d)
        assert {p + k for p, n in factors for k in range(n)} == want and all(n >= window for _, n in factors)


# -- ranking ---------------------------------------------------------------------------

def letter_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_ranking(docs, items, k=10):
    counted = [(i, Counter(letter_words(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    big_n, big_l = len(counted), sum(n for _, _, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    for item, text in items:
        q = Counter(letter_words(text))
        found = []
        for i, c, n in counted:
            m = 100 - 75 + (75 * n * big_n) // big_l
            score = sum(times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1)))
                        * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m)) for w, times in q.items() if c[w])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort()
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def ranked(frame, sp, docs, items, **options):
    table = sp.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string").repartition(2)
    got = ranking.top_documents(frame([(i, t, None, None) for i, t in docs]), table, **options).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str)


def ranking_tables():
    rnd = random.Random(4)
    words = [f"t{i}" for i in range(60)] + ["Ä", "ß1", "x-y", "İ"]
    docs = [(1, None), (2, ""), (3, "!? \n"), (None, "t1 T2"), (4, "t1 t2"), (4, "t1 t2"), (5, "T1,T2!")]
    docs += [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 50, 400])))) for i in range(10, 150)]
    docs += [(i, docs[40][1]) for i in range(200, 230)]                       # ties beyond the tenth
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 40])))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, docs[40][1] * 3), (None, "t5 t6"), (1, "t9")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_ranking_equals_brute_force(frame, sp, monkeypatch, small):
    docs, items = ranking_tables()
    if small:                       # many tiles, blocks of documents and of words, weights dealt over layers
        for name, value in dict(TILE_ITEMS=3, DOC_ROWS=7, WORD_COLUMNS=5, SHARD_BYTES=200, CHUNK=16,
                                EXACT=6000 * ranking.IMPACT).items():
            monkeypatch.setattr(ranking, name, value)
    assert ranked(frame, sp, docs, items) == brute_ranking(docs, items)
    assert ranked(frame, sp, docs, items, k=3) == brute_ranking(docs, items, 3)


def test_ranking_of_empty_tables(frame, sp):
    docs, items = ranking_tables()
    assert ranked(frame, sp, [], items) == [] and ranked(frame, sp, docs, []) == []
    assert ranked(frame, sp, [(1, None), (2, "?")], items) == []


def test_partial_sums_stay_exact():
    rng = np.random.default_rng(5)
    word = np.sort(rng.integers(0, 300, 4000))
    item = rng.integers(0, 40, 4000)
    word, item = (np.array(x) for x in zip(*sorted(set(zip(word.tolist(), item.tolist())))))
    value = rng.integers(0, 10 ** 11, len(word))
    limit = ranking.EXACT // ranking.IMPACT
    total = np.zeros((300, 40), object)
    for columns, weights in ranking.blocks(word, item, value, 40, limit):
        assert weights.sum(axis=0).max() * ranking.IMPACT <= ranking.EXACT and weights.shape[0] <= ranking.WORD_COLUMNS
        total[columns] += weights.astype(np.int64).astype(object)
    want = np.zeros((300, 40), object)
    want[word, item] = value.astype(object)
    assert (total == want).all()


# -- conversation repair -----------------------------------------------------------------

def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def judged(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                 else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def uniform_cost(rows):
    """(cost, edits, repaired) by a search over (cost, edits) in order."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, last, text = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, edits, "\n".join(text)
        turn = "u" if last in ("", "s", "a") else "a"
        name = {"u": "user", "a": "assistant"}[turn]
        heapq.heappush(heap, (cost + 2, edits + "I", i, turn, (*text, f"{name}:")))
        if i == len(rows):
            continue
        role, body, fault = rows[i]
        heapq.heappush(heap, (cost + 3, edits + "D", i + 1, last, text))
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            if role[:1] and role[:1] in step[last]:
                heapq.heappush(heap, (cost + extra, edits + "K", i + 1, role[0], (*text, f"{role}:{body}")))
            heapq.heappush(heap, (cost + 2 + extra, edits + "R", i + 1, turn, (*text, f"{name}:{body}")))


def brute_repair(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = sorted((r for r in damage(table) if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        marks = judged(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        faults = Counter(m[2] for m in marks)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, edits, text = uniform_cost(marks)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"],
                    faults["duplicate"], faults["truncated"], illegal, cost, edits,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def repaired(sp, rows, monkeypatch):
    table = sp.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, "
                                                              "audit string, code string").repartition(3)
    monkeypatch.setattr(queries, "read_table", lambda *a: table)
    got = queries.op13_conversation_repair(sp, "").collect()
    return sorted((tuple(r[c] for c in ("conv_id", *repair.COUNTS, "audit", "repaired_sha256")) for r in got), key=str)


def conversations(seed, n=60):
    rnd = random.Random(seed)
    out = [(None, 0, "user", "A?"), (None, None, None, None), (900, None, "user", "x"), (900, None, "user", "x"),
           (901, 5, "", "Leer."), (902, 1, "tool", "T."), (902, 2, "USER", "U.")]
    for conv in range(n):
        turn = rnd.choice([0, 3])
        for k in range(rnd.choice([1, 2, 4, 5, 9, 30, 75])):
            turn += rnd.choice([0, 1, 1, 1, 1, 2])
            role = rnd.choices(["user", "assistant", "system", "tool", None], [5, 5, 1, 0.3, 0.1])[0] if rnd.random() < .3 \
                else ("user", "assistant")[k % 2]
            out.append((conv, turn if rnd.random() < .97 else None, role,
                        rnd.choice([f"Satz {k}.", f"Frage {k}?", "Ja!", f"offen {k}", "  \n", None, "mit Rand. \t", "é…"])))
    return out


def test_repair_equals_uniform_cost_search(sp, monkeypatch):
    rows = conversations(1)
    want = brute_repair(rows)
    assert repaired(sp, rows, monkeypatch) == want
    assert any(len(w[7]) > 2 * repair.BLOCK for w in want)
    for block in (1, 5):            # the block size changes nothing
        known = [repair.cheapest(bytes(random.Random(7).choices(range(16), k=40)))]
        monkeypatch.setattr(repair, "BLOCK", block)
        assert known == [repair.cheapest(bytes(random.Random(7).choices(range(16), k=40)))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 15), max_size=45))
def test_cheapest_edits_equal_uniform_cost_search(codes):
    rows = [(("system", "user", "assistant", "tool")[c >> 2], "x", ("", "blank", "duplicate", "truncated")[c & 3])
            for c in codes]
    assert repair.cheapest(bytes(codes)) == uniform_cost(rows)[:2]


def test_repair_edges(sp, monkeypatch):
    assert repaired(sp, [], monkeypatch) == []
    empty = hashlib.sha256(b"").hexdigest()
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(sp, [(lost, 0, "user", "x")], monkeypatch) == [(lost, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_rows_rebuild_the_digest(sp):
    rows, report = repair.repair(sp.createDataFrame(conversations(3, 12), "conv_id long, turn long, role string, text string"))
    lines = defaultdict(list)
    for r in sorted(repair.repaired(rows, report).where("place is not null").collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in repair.digests(rows, report).collect():
        assert r["repaired_sha256"] == hashlib.sha256("\n".join(lines[r["conv_id"]]).encode()).hexdigest()
    edits = {r["conv_id"]: r["audit"] for r in report.collect()}
    count = Counter(r["conv_id"] for r in repair.repaired(rows, report).collect())
    assert {c: len(e) for c, e in edits.items() if e} == dict(count)


def test_queries_on_the_small_tables(sp):
    docs = [(r["doc_id"], r["text"]) for r in sp.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_relative_lempel_ziv(sp, SF).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == brute_spans(docs)
    items = [(r["item_id"], r["text"]) for r in sp.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op12_dense_ranking(sp, SF).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == brute_ranking(docs, items)
    turns = [tuple(r) for r in sp.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(sp, SF).collect()
    assert sorted((tuple(r[c] for c in ("conv_id", *repair.COUNTS, "audit", "repaired_sha256")) for r in got),
                  key=str) == brute_repair(turns)
