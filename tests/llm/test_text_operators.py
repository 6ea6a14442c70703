"""Licence scan, host rules, decontamination, quality and language models."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import decontaminate, host_rules, langid, license_scan, quality, queries
from tests.llm.conftest import SF

LONG = " ".join(f"wort{i % 977}" for i in range(60_000))
EDGE = [(1, None, None, None), (2, "", "en", "a"), (3, "  \n\t ", "en", "a"), (4, "Éa cc BY b", "fr", None),
        (5, LONG, "de", "b"), (6, "All rights reserved.", "en", "b"), (6, "All rights reserved.", "en", "b"),
        (None, "x y", None, "c"), (9, "CC BY-NC 4.0 cc by", "en", "a")]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- licence scan --------------------------------------------------------------

BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def base_places(text):
    w = words_of(text)
    return len(w), sorted((i, label) for label, p in BASE.items() for q in [p.split()]
                          for i in range(len(w)) if w[i:i + len(q)] == q)


def check_base(rows, texts):
    for r in rows:
        n, places = base_places(texts[r["doc_id"]])
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((starts[0], starts[-1]) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_license_scan_equals_brute_force(sp, table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    rows = queries.op1_license_scan(sp, SF).collect()
    assert len(rows) == len(texts)
    check_base(rows, texts)


def test_license_labels_positions_and_edges(sp, frame, monkeypatch):
    docs = frame(EDGE + [
        (20, "x Licensed under the Apache License, Version 2.0. y", None, None),
        (21, "apache license one two three", None, None),
        (22, "Released under the MIT License. GNU General Public License version 3", None, None),
        (23, "public license general rights all reserved by cc", None, None)])
    monkeypatch.setattr(queries, "read_table", lambda *a: docs)
    rows = queries.op1_license_scan(sp, "").collect()
    assert len(rows) == 13
    texts = {r[0]: r[1] for r in EDGE} | {r["doc_id"]: r["text"] for r in docs.collect()}
    check_base(rows, texts)
    got = {r["doc_id"]: r for r in rows}
    assert got[20]["labels"] == "apache,apache-2.0" and got[20]["base_labels"] == ""
    assert got[21]["labels"] == "apache" and got[21]["score"] < got[20]["score"] == pytest.approx(1.0)
    assert got[22]["labels"] == "gpl,gpl-3.0,mit" and got[23]["labels"] == "" and got[23]["score"] == 0
    assert got[9]["labels"] == "cc-by,cc-by-nc" and (got[9]["first_word"], got[9]["last_word"]) == (0, 5)


# -- host rules ----------------------------------------------------------------

def brute_stats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_host_rules_equal_brute_force(sp, table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    for r in queries.op3_host_rules(sp, SF).collect():
        want = brute_stats(texts[r["doc_id"]])
        assert tuple(r[1:6]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_repeated_words_and_edges(frame):
    assert host_rules.repeated_words(b"a a a a".split()) == 4
    assert host_rules.repeated_words(b"a b c x a b c".split()) == 6
    assert host_rules.repeated_words(b"a b c".split()) == 0
    got = by_id(host_rules.host_rules(frame(EDGE)))
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0 and got[1]["base_failed"]
    assert got[5]["n_words"] == 60_000 and got[1]["__host"] == ""
    assert host_rules.host_rules(frame([])).count() == 0


def test_bad_host_is_rejected_and_small_host_shrunk(frame):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "en", "good") for i in range(60)] + [(100 + i, "bad", "en", "bad") for i in range(58)]
    rows += [(198, good, "en", "bad"), (300, good, "en", "tiny"), (301, "bad", "en", "tiny2")]
    got = by_id(host_rules.host_rules(frame(rows)))
    assert got[198]["host_rejected"] and not got[198]["kept"] and not got[198]["base_failed"]
    assert got[0]["kept"] and got[300]["kept"]
    assert 0.5 < got[301]["host_rate"] < 1 and 0 < got[300]["host_rate"] < 0.5


def test_a_host_far_above_the_corpus_is_rejected_below_one_half(frame):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(40 * h + i, "bad" if i < 4 else good, "en", f"h{h}") for h in range(25) for i in range(40)]
    rows += [(5000 + i, "bad" if i < 90 else good, "en", "worse") for i in range(200)]       # 45 %
    rows += [(6000 + i, "bad" if i < 2 else good, "en", "few") for i in range(4)]            # half of four
    got = by_id(host_rules.host_rules(frame(rows)))
    assert 0.25 < got[5150]["host_rate"] < 0.5 and got[5150]["host_rejected"] and not got[5150]["kept"]
    assert not got[6003]["host_rejected"] and got[6003]["kept"] and got[39]["kept"]


# -- decontamination -----------------------------------------------------------

def brute_hits(text, items, window=10):
    w, hit, ids = words_of(text), set(), set()
    for item, t in items:
        v = words_of(t)
        size = min(window, len(v))
        wins = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in wins:
                hit |= set(range(i, i + size))
                ids.add(item)
    known = sorted(str(i) for i in ids if i is not None)
    return len(w), len(hit), len(known), hashlib.sha256(",".join(known).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(sp, table):
    items = [(r["item_id"], r["text"]) for r in table("benchmark").collect()]
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    rows = queries.op10_suffix_decontamination(sp, SF).collect()
    assert sum(r["contaminated"] for r in rows) > 0
    for r in rows:
        assert tuple(r[1:]) == brute_hits(texts[r["doc_id"]], items)


def test_decontamination_edges_blocks_and_locations(sp, frame, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(1, passage), (2, "solo"), (3, "three word item"), (4, None), (5, "..."), (None, "nameless item here"),
             (7, "three word item"), (10, "zz " + passage), (256, " ".join(f"q{i}" for i in range(300)))]
    rows = EDGE + [(30, "a b " + passage + " c"), (31, "Solo! p0 p1 p2 three, WORD item"), (32, passage[:40]),
                   (33, "nameless item here"), (34, passage + " " + passage), (35, "three word"), (36, "item")]
    rows += [(40, " ".join(f"q{i}" for i in range(250, 280)))]
    docs = frame(rows)
    bench = sp.createDataFrame(items, "item_id long, text string").repartition(2)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for size in (decontaminate.BLOCK_BYTES, 150):        # one block, many blocks
        monkeypatch.setattr(decontaminate.benchmark_blocks, "__kwdefaults__",
                            decontaminate.benchmark_blocks.__kwdefaults__ | {"block_bytes": size})
        got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
        for d, r in got.items():
            n, hit, n_items, _, _ = brute_hits(texts[d], items)
            assert (r["n_words"], r["n_hit"], len(r["items"])) == (n, hit, n_items), d
        found = {(m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in got[30]["matches"]}
        assert found == {(1, 0, 2, 30), (10, 1, 2, 30)}
        assert {m["item_id"] for m in got[33]["matches"]} == {None} and got[33]["items"] == []
        kept = decontaminate.clean_documents(docs, bench)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["n_hit"] == 0}
    assert decontaminate.contamination(frame([]), bench).count() == 0
    none = decontaminate.contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert none == 0


# -- quality classifier --------------------------------------------------------

def brute_model(x, y, to_pooled=0.1, to_unit=0.05):
    parts = [x[y == k] for k in (0, 1)]
    cov = [np.cov(p.T, bias=True) for p in parts]
    pooled = sum(len(p) * c for p, c in zip(parts, cov)) / len(x)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    logs = []
    for p, c in zip(parts, cov):
        s = (1 - to_unit) * ((1 - to_pooled) * c + to_pooled * pooled) / np.outer(scale, scale) + to_unit * np.eye(len(c))
        logs.append((p.mean(axis=0), np.linalg.inv(s), np.linalg.slogdet(s)[1], np.log(len(p))))

    def score(v):
        d = [-0.5 * ((v - m) / scale @ i @ ((v - m) / scale) + ld) + n for m, i, ld, n in logs]
        return 1 / (1 + np.exp(min(500, d[0] - d[1])))
    return score


def test_quality_scores_equal_direct_discriminant(sp, table):
    docs = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    labels = {r["doc_id"]: r["quality"] for r in table("labels").collect() if r["doc_id"] in docs}
    rows = queries.op6_quality_discriminant(sp, SF).collect()
    train = [r["doc_id"] for r in rows if not r["held_out"] and r["doc_id"] in labels]
    score = brute_model(quality.matrix([docs[d].encode() for d in train]), np.array([labels[d] for d in train]))
    for r in rows:
        assert r["score"] == pytest.approx(score(np.array(quality.features((docs[r["doc_id"]] or "").encode()))), abs=1e-5)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_quality_held_out_accuracy(sp):
    sf = "/root/testdata/sf0.01"
    rows = (queries.op6_quality_discriminant(sp, sf).where("held_out")
            .join(sp.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect())
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97


def test_quality_edges(sp, frame):
    docs = frame(EDGE)
    labels = sp.createDataFrame([(2, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    one = quality.quality_scores(docs, labels).collect()
    assert {r["score"] for r in one} == {1.0} and len(one) == len(EDGE)
    assert [r["held_out"] for r in one if r["doc_id"] is None] == [True]
    none = quality.quality_scores(docs, labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality.quality_scores(frame([]), labels).count() == 0
    assert quality.good_documents(docs, labels).count() == len(EDGE)
    assert quality.good_documents(docs, labels).columns == docs.columns


# -- language identification ---------------------------------------------------

def test_language_accuracy_and_folds(sp):
    sf = "/root/testdata/sf0.01"
    rows = (queries.op9_language_bayes(sp, sf)
            .join(sp.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect())
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert 150 < len(held) < 350
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97


def test_language_equals_direct_bayes(sp, frame):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("le chat et la souris", "fr"), ("der hund und die katze", "de")] * 9)]
    docs = frame(rows)
    got = by_id(langid.identify(docs))
    counts, n = defaultdict(lambda: np.zeros(1 << langid.BITS)), Counter()
    for i, t, lang, _ in rows:
        if not got[i]["held_out"]:
            counts[lang] += np.bincount(langid.hashed_ngrams(t), minlength=1 << langid.BITS)
            n[lang] += 1
    logs = {k: np.log((c + 0.5) / (c + 0.5).sum()) for k, c in counts.items()}
    for i, t, _, _ in rows:
        post = {k: logs[k][langid.hashed_ngrams(t)].sum() + np.log(n[k] / sum(n.values())) for k in logs}
        best = max(sorted(post), key=post.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(np.exp(v - post[best]) for v in post.values()), abs=1e-4)


def test_language_blocks_change_nothing(frame, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(f"{'abcdefghijklm'[i % 13]}{'xyz'[int(k)]}wort" for k in rnd.integers(0, 3, 9)), f"l{i % 13:02}", "s")
            for i in range(160)]
    docs = frame(rows)
    want = {i: (r["lang_pred"], round(r["score"], 9)) for i, r in by_id(langid.identify(docs)).items()}
    assert len({p for p, _ in want.values()}) == 13
    for block, shared in ((3, 64 << 20), (1, 0)):           # several blocks, broadcast or as files
        monkeypatch.setattr(langid, "BLOCK_LANGS", block)
        monkeypatch.setattr(langid, "SHARED_BYTES", shared)
        assert {i: (r["lang_pred"], round(r["score"], 9)) for i, r in by_id(langid.identify(docs)).items()} == want


def test_language_edges(frame):
    docs = frame(EDGE + [(50, "123 !?", "en", "a"), (51, "½²", "en", "a"), (52, "漢字", "zh", "a"),
                         (53, "kurz", "de", "a"), (54, "abc", "en", "a"), (55, "def", "en", "a")])
    got = by_id(langid.identify(docs))
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 50, 51)] == ["und"] * 5
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[None]["held_out"]
    assert got[5]["lang_pred"] in {"de", "en", "fr", "zh"}
    assert langid.identify(frame([])).count() == 0
    assert {r["lang_pred"] for r in langid.identify(frame([(1, "abc", None, None)])).collect()} == {"und"}
