"""Tokens, mixing, page text, archives, near-duplicates and the pipeline."""

import base64
import hashlib
import json
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderflow.llm import decontaminate, mixing, quality, queries, simhash, tokens, warc, wrapper
from tests.llm.conftest import SF
from tests.llm.test_text_operators import EDGE, brute_hits

# -- tokens ----------------------------------------------------------------------

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def brute_tokens(rows):
    """(doc_id, text) in order -> (doc_id, start, n_tokens, crc32, end ids)."""
    at, out = 0, []
    for d, t in rows:
        ids = TOKENIZER.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids.count(2)))
        at += len(ids)
    return out


def test_tokens_equal_direct_encoding(sp, table):
    rows = sorted((r["doc_id"], r["text"]) for r in table("documents").collect())
    assert sorted(tuple(r) for r in queries.op2_wavelet_tokens(sp, SF).collect()) == brute_tokens(rows)


def test_words_encode_like_whole_texts():
    pick = random.Random(7)
    parts = ["abcXYZé", "ÀÖØßÿŸ×÷", "0123", "!.,;:'\"|<>_-", "\u0301\u00a0\u0085\u2028\x1c\x00", "İſǅΣς中語🙂", " \t\n\r\x0b\x0c"]
    words = ["don't", "WE'LL", "x's.", "<|endoftext|>", "a<|startoftext|>b", "Ärger!!", "naïve,"]

    def text():
        return " ".join(pick.choice(words) if pick.random() < 0.3 else
                        "".join(pick.choice(pick.choice(parts)) for _ in range(pick.randint(0, 9)))
                        for _ in range(pick.randint(0, 25)))

    enc = tokens.Encoder("word_bpe_49k.json")
    assert enc.by_word
    for _ in range(5):
        texts = [text() for _ in range(400)]
        ids, n = enc.encode(pa.array(texts))
        want = [e.ids for e in enc.whole.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_edges_and_small_shards(frame):
    rows = EDGE + [(60, "Don't <|endoftext|> stop\x1f!! É́a İx ǅ ß'S 3km, (word). naïve-cóte #2"),
                   (61, "Ångström MÜNCHEN, señor... ﬁ Ⅷ ½ 漢字 q̣̇")]
    docs = frame(rows)
    order = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = brute_tokens(order)
    for size in (tokens.SHARD_TOKENS, 7):
        got = tokens.token_output(docs, shard_tokens=size).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert tokens.token_output(frame([])).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000) | st.integers(0, 3), max_size=300), st.sampled_from([17, 20]),
       st.sampled_from([1, 5, 32 << 10]))
def test_wavelet_matrix(ids, bits, block):
    a = np.array(ids, np.uint32)
    tokens.BLOCK_BYTES = block
    wm = tokens.WaveletMatrix.build(a, bits)
    cut = sorted({len(ids), len(ids) // 3}) if ids else []
    lengths = np.diff([0, *(c for c in cut if c)]).tolist()
    shard = tokens.read_shard(tokens.shard_bytes([5, None][:len(lengths)], lengths, a, bits))
    back = shard.tokens
    assert shard.doc_ids == [5, None][:len(lengths)] and np.diff([0, *shard.ends()]).tolist() == lengths
    for token in {*ids[:3], 1}:
        assert shard.counts(token).tolist() == [ids[e - n:e].count(token) for n, e in zip(lengths, np.cumsum(lengths))]
    for m in (wm, back):
        assert m.decode().tolist() == ids
    for token in {*ids[:5], 1, 99_999}:
        where = [i for i, x in enumerate(ids) if x == token]
        assert back.places(token) == where and back.count(token) == len(where)
        assert back.rank(token, len(ids) // 2) == sum(i < len(ids) // 2 for i in where)
    assert [back.access(i) for i in range(len(ids))] == ids
    with pytest.raises(IndexError):
        back.select(ids[0] if ids else 1, len(ids))


def test_token_access_inflates_the_blocks_it_touches():
    rng = np.random.default_rng(8)
    tokens.BLOCK_BYTES = 1 << 10
    ids = rng.integers(0, 49_000, 200_000).astype(np.uint32)
    shard = tokens.read_shard(tokens.shard_bytes([1, 2], [50_000, 150_000], ids, 16))
    assert [shard.tokens.access(i) for i in (0, 77_777, 199_999)] == ids[[0, 77_777, 199_999]].tolist()
    blocks = sum(len(p.before) - 1 for p in shard.tokens.planes)
    touched = sum(len(p._blocks) for p in shard.tokens.planes)
    assert blocks > 350 and touched <= 3 * 2 * 16
    tokens.BLOCK_BYTES = 32 << 10


def test_token_counts_per_document(sp, table):
    docs = table("documents")
    manifest = tokens.write_tokens(docs)
    texts = {r["doc_id"]: TOKENIZER.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    some = [2, texts[0][0], texts[1][0], 48_000]
    want = sorted((t, d, x.count(t)) for t in set(some) for d, x in texts.items() if t in x)
    assert sorted(set(map(tuple, tokens.token_counts(manifest, some).collect()))) == want


# -- mixing ----------------------------------------------------------------------

def test_raking_meets_the_targets_and_brute_force(frame):
    rng = np.random.default_rng(1)
    words = [f"langeswort{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40))), str(rng.choice(["en", "fr", "de"], p=[.7, .2, .1])),
             str(rng.choice(["a", "b", "c"], p=[.8, .15, .05]))) for i in range(400)]
    goal = {"a": 0.4, "b": 0.3, "c": 0.3, "none": 5.0}
    out = mixing.calibrated(frame(rows), source_targets=goal, n_topics=3, fraction=0.02).collect()
    cells = defaultdict(float)
    for r in out:
        cells[r["source"], r["lang"], r["__topic"]] += r["__tokens"]
    total = sum(cells.values())
    f = {k: 1.0 for k in cells}

    def share(axis):
        s = defaultdict(float)
        for k, v in cells.items():
            s[k[axis]] += v / total
        return s

    targets = [{k: v for k, v in goal.items() if k != "none"}] + [mixing.flattened(share(a), 0.7) for a in (1, 2)]
    for _ in range(200):
        for axis, target in enumerate(targets):
            mass = defaultdict(float)
            for k, v in cells.items():
                mass[k[axis]] += v * f[k]
            for k in cells:
                f[k] *= target[k[axis]] / mass[k[axis]]
    for r in out:
        want = min(1.0, f[r["source"], r["lang"], r["__topic"]] * 0.02 * total)
        assert r["__probability"] == pytest.approx(want, rel=1e-4)
    assert sum(r["__tokens"] * r["__probability"] for r in out) == pytest.approx(0.02 * total, rel=1e-4)


def test_sampling_follows_probabilities(sp):
    rows = queries.op4_raked_mixture(sp, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    assert all(r["kept"] for r in rows if r["probability"] >= 1)
    kept, mean = sum(r["kept"] for r in rows), sum(r["probability"] for r in rows)
    assert abs(kept - mean) < 4 * np.sqrt(sum(r["probability"] * (1 - r["probability"]) for r in rows) + 1)


def drawn(out, column):
    mass = defaultdict(float)
    for r in out:
        mass[r[column]] += r["__tokens"] * r["__probability"]
    total = sum(mass.values())
    return {k: v / total for k, v in mass.items()}


def shares(out, column):
    n = defaultdict(int)
    for r in out:
        n[r[column]] += r["__tokens"]
    return {k: v / sum(n.values()) for k, v in n.items()}


def test_hot_source_and_long_tail_meet_the_targets(frame):
    rng = np.random.default_rng(2)
    tail = np.arange(1, 60) ** -1.1
    names = [f"s{i}" for i in range(60)]
    p = np.append([1 / 3], tail / tail.sum() * 2 / 3)
    words = [f"langeswort{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(words, 20)), str(rng.choice(["en", "fr", "de"], p=[.7, .2, .1])),
             str(rng.choice(names, p=p))) for i in range(3000)]
    docs = frame(rows)
    out = mixing.calibrated(docs, n_topics=2).collect()
    meets(docs, out, n_topics=2)
    # what no bound touches keeps the proportions of the flattened shares
    want, got = mixing.flattened(shares(out, "lang"), 0.7), drawn(out, "lang")
    assert max(abs(want[k] - got[k]) for k in want) < 1e-5
    assert max(r["__probability"] for r in out) == pytest.approx(1)


def meets(docs, out, fraction=0.6, tolerance=1e-5, axes=("source", "lang", "topic"), **options):
    """The drawn tokens are ``fraction`` of all, every category has its bounded
    target, and the tables of the mixture tell the same."""
    total = sum(r["__tokens"] for r in out)
    assert sum(r["__tokens"] * r["__probability"] for r in out) == pytest.approx(fraction * total, rel=1e-4)
    mix, _ = mixing.mixture(docs, fraction=fraction, **options)
    told = {(r["axis"], r["category"]): r for r in mix.marginals.collect()}
    for axis, column in ((a, "__topic" if a == "topic" else a) for a in ("source", "lang", "topic")):
        kept, held = defaultdict(float), defaultdict(float)
        for r in out:
            key = "" if r[column] is None else str(r[column])
            kept[key] += r["__tokens"] * r["__probability"]
            held[key] += r["__tokens"]
        for key in (k for k, n in held.items() if n):
            row = told[axis, key]
            assert row["tokens"] == held[key] and row["drawn"] == pytest.approx(kept[key], rel=1e-6, abs=1e-9)
            assert axis not in axes or abs(row["target"] - kept[key]) <= tolerance * fraction * total
            assert row["target"] <= held[key] * (1 + 1e-9)
            asked = row["asked"] * fraction * total
            assert row["target"] >= min(asked, held[key]) * (1 - 1e-9)          # asked, or the whole category
    cells = mix.cells.collect()
    assert sum(c["tokens"] * c["probability"] for c in cells) == pytest.approx(fraction * total, rel=1e-4)
    assert all(0 <= c["probability"] <= 1 for c in cells)
    return told


def test_one_rare_source_does_not_empty_the_sample(frame):
    rng = np.random.default_rng(4)
    words = [f"langeswort{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(words, 20)), str(rng.choice(["en", "fr"])), "big" if i < 3000 else "small")
            for i in range(3500)] + [(9999, "wort", "en", "tiny")]
    docs = frame(rows)
    out = mixing.calibrated(docs, n_topics=2).collect()
    told = meets(docs, out, n_topics=2)
    assert told["source", "tiny"]["drawn"] == pytest.approx(1)                     # taken whole
    assert abs(sum(r["__kept"] for r in out) / 3501 - 0.6) < 0.04


def test_ten_thousand_sources_of_one_document(frame):
    rng = np.random.default_rng(6)
    rows = [(i, "langeswort wort " * int(rng.integers(1, 30)), str(rng.choice(["en", "fr"], p=[.8, .2])),
             "hot" if i % 3 == 0 else f"s{i}") for i in range(15_000)]
    docs = frame(rows)
    out = mixing.calibrated(docs, n_topics=1).collect()
    # a single document has one language: the languages follow from the sources
    told = meets(docs, out, axes=("source", "topic"), n_topics=1)
    assert sum(1 for k in told if k[0] == "source") == 10_001


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.tuples(st.floats(.01, 1), st.one_of(st.just(0.0), st.floats(1e-9, 3))), min_size=1, max_size=6),
                min_size=1, max_size=5), st.floats(0, 1))
def test_factors_of_bounded_vectors(vectors, share):
    lengths = np.array([len(v) for v in vectors])
    v = np.concatenate([np.array([a for a, _ in x]) / sum(a for a, _ in x) for x in vectors])
    w = np.concatenate([[b for _, b in x] for x in vectors])
    shares_ = np.full(len(vectors), share)
    got = mixing.factors_of(shares_, lengths, v, w)
    at = np.cumsum(lengths) - lengths
    drawn_ = np.add.reduceat(v * np.minimum(1, np.repeat(got, lengths) * w), at)
    most = np.add.reduceat(v * (w > 0), at)
    for x, m in zip(drawn_, most):
        assert x == pytest.approx(min(share, m), abs=1e-9)


def test_nearly_monolingual_sources_are_raked_to_the_end(frame, caplog):
    rng = np.random.default_rng(2)
    langs, words = ["en", "fr", "de", "it"], np.ones((24, 4), int)
    words[np.arange(24), rng.choice(4, 24, p=[.6, .2, .1, .1])] = rng.integers(2000, 20_000, 24)
    rows = [(4 * s + i, "wort " * int(words[s, i]), x, f"s{s}") for s in range(24) for i, x in enumerate(langs)]
    docs = frame(rows)
    with caplog.at_level("WARNING", mixing.__name__):
        out = mixing.calibrated(docs, n_topics=1, fraction=1e-5).collect()      # no stray token saturates
    meets(docs, out, 1e-5, 1e-6, n_topics=1)
    assert "off its target" not in caplog.text


def test_rounds_in_spark_equal_rounds_on_the_driver(frame, monkeypatch):
    docs = frame([(i, "langeswort " * (1 + i * i % 7), "en" if i % 3 else "fr", f"s{i % 5}") for i in range(40)])

    def probabilities():
        return {r["doc_id"]: r["__probability"] for r in mixing.calibrated(docs, n_topics=1).collect()}
    want = probabilities()
    monkeypatch.setattr(mixing, "LOCAL_CELLS", 0)
    assert probabilities() == pytest.approx(want, rel=1e-9)


def test_targets_that_cannot_be_met_are_told(frame, caplog):
    docs = frame([(1, "a b c d", "en", "x"), (2, "a", "fr", "y")])
    with caplog.at_level("WARNING", mixing.__name__):
        mixing.calibrated(docs, source_targets={"x": 1, "y": 1}, lang_targets={"en": 3, "fr": 1}).collect()
    # of 3 tokens y gives its only one; x has the other 2, but en is asked for 2.25
    assert "a marginal is still 0.0833 off its target" in caplog.text


def test_every_language_keeps_its_own_marginal(frame):
    rows = [(1000 * s + i, "wort " * (1 + (2000 if i < 3 else 6) // (1 + i)), f"l{i:03}", f"s{s}")
            for s in range(3) for i in range(230)]
    goal = {"l000": 0.5, "l010": 0.3, "l229": 0.2}
    for targets in (None, goal):
        out = mixing.calibrated(frame(rows), n_topics=1, lang_targets=targets, fraction=0.001).collect()
        want, got = targets or mixing.flattened(shares(out, "lang"), 0.7), drawn(out, "lang")
        assert max(abs(want.get(k, 0) - got[k]) for k in got) < 1e-6
    assert all(r["__probability"] > 0 for r in out if r["lang"] in goal)


def test_mixing_edges(frame):
    docs = frame(EDGE)
    out = mixing.calibrated(docs, max_langs=1)
    assert out.count() == len(EDGE) and out.where("__kept is null or __probability is null").count() == 0
    assert mixing.mixed(docs).columns == docs.columns
    same = mixing.calibrated(docs).where("doc_id = 6").select("__kept").distinct().count()
    assert same == 1
    assert mixing.mixed(frame([])).count() == 0
    assert mixing.calibrated(frame([(1, None, None, None), (2, "", None, None)])).count() == 2


# -- page text ---------------------------------------------------------------------

def page(body, title="T"):
    return (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head>'
            f'<body><nav><ul><li><a href="/x">menu {title}</a></li></ul></nav><!-- ad --><div class="ad">Buy {title}</div>'
            f'{body}<footer>&copy; host</footer></body></html>')


def test_parse_and_main_text():
    def text(html):
        return wrapper.main_text(wrapper.parse(html), set())
    assert text(page("<article><h1>A &amp; B</h1><p><b>one  two<br><p>th<i>re</i>e\n four&am</article>")) == "A & B one two three four&am"
    assert text(page("<main><p>x<p>y</main><div>z</div>")) == "x y"
    assert text("<article><p>a</p><aside>s</aside><form>f</form><div class='cookie-notice'>c</div>"
                "<section id=comments><p>r</p></section><div hidden>h</div><p>b < c") == "a b < c"
    assert text("plain text &lt;b&gt;") == "plain text <b>"
    assert text("") == "" and text("<article><p>cut <b") == "cut"
    assert text("<article><script>if (a < b) '</p>'</script><header>H</header><p>t</article>") == "H t"


@pytest.mark.parametrize("part", ["<svg", "<a", "<a '>' ", "<a b=\"", "<p a='b\">", "<script ", "<!-- ", "</p", "=\"<p>"])
def test_long_broken_markup_is_parsed_in_one_pass(part):
    start = time.monotonic()
    wrapper.main_text(wrapper.parse("<p>x</p>" + part * 50_000), set())
    assert time.monotonic() - start < 20


def test_quotes_in_tags():
    page = wrapper.parse("<p title=\"a>b\" x=' > ' y>1</p><p don't>2</p><p a = \"3>4</p>")
    assert wrapper.main_text(page, set()) == "1 2 4"


def test_marks_of_the_whole_page_drop_nothing():
    body = '<body class="home has-sidebar nav-open" style="display:none"><main id="main-menu"><p>Text.</p></main>' \
           '<div class="sidebar">Other</div></body>'
    assert wrapper.main_text(wrapper.parse(f"<html class=hidden>{body}</html>"), set()) == "Text."


@pytest.mark.parametrize("attrs", [
    'style="overflow:hidden"', 'style="overflow-x: hidden"', 'title="Hidden gems"', 'class="overflow-hidden"',
    'class="site no-sidebar"', 'class="layout has-menu"', 'class="post comments-open"', 'class="search-results"',
    'class="sidebar-left"', 'data-id="menu"'])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_loose_marks_drop_nothing(attrs, tag):
    inner = "<p>First text of the story.</p><p>Second text of the story.</p>"
    html = f'<body><{tag} {attrs}>{inner}</{tag}><div class="site-footer">Imprint</div></body>'
    assert wrapper.main_text(wrapper.parse(html), set()) == "First text of the story. Second text of the story."


def test_marked_containers_of_the_article_are_kept():
    def text(html):
        return wrapper.main_text(wrapper.parse(html), set())
    assert text('<div class="sidebar"><article><p>t</article></div><p class="menu">a long list of menu entries') == "t"
    assert text('<article><p>t</article><div class="toolbar">a long list of entries</div>') == "t"
    assert text('<p>t</p><div class="menu">a long list of menu entries</div>') == "t"
    assert text('<article><div class="promo">the whole text</div><p>t</article>') == "the whole text t"
    assert text('<div id="modal"><div role="main">t</div></div>') == "t"
    assert text('<article><p>t</article><section id="comments"><article><p>a long reply, longer than the page</article>') == "t"
    assert text('<div>the story</div><div class="related"><article>x</article></div><div class="is-hidden">h</div>') == "the story"
    assert text('<p>t<div style="visibility: hidden">h</div><div aria-hidden="true">h</div><div hidden>h</div>') == "t"


def test_articles_bound_the_text_only_if_they_are_most_of_it():
    def text(html):
        return wrapper.main_text(wrapper.parse(html), set())
    story, card = "<p>The whole story of this page, long.</p>" * 3, "<article class='card'><p>More.</p></article>"
    whole = " ".join(["The whole story of this page, long."] * 3)
    assert text(f"<div>{story}</div>{card}{card}") == f"{whole} More. More."
    assert text(f"<main><div>{story}</div></main>{card}{card}") == whole
    assert text(f"<main><article>{story}</article><p>Note</p></main><p>Imprint</p>") == whole
    assert text(f"<article>{story}</article><p>Note</p>") == whole


def test_tree_match_is_the_largest_matching():
    def tree(spec):
        n = wrapper.Node(spec[0])
        n.children = [tree(s) for s in spec[1:]]
        return n

    def brute(a, b):
        if a.label != b.label:
            return 0
        def best(i, j):
            if i == len(a.children) or j == len(b.children):
                return 0
            return max(best(i + 1, j), best(i, j + 1), brute(a.children[i], b.children[j]) + best(i + 1, j + 1))
        return 1 + best(0, 0)

    rng = np.random.default_rng(3)
    def random_tree(depth):
        kids = [random_tree(depth - 1) for _ in range(rng.integers(0, 4))] if depth else []
        return [str(rng.choice(["a", "b"])), *kids]
    for _ in range(60):
        a, b = tree(random_tree(3)), tree(random_tree(3))
        assert wrapper.tree_match(a, b, {}) == brute(a, b)


def test_deep_and_wide_pages(monkeypatch):
    deep = wrapper.parse("<div>" * 20_000 + "x" + "</section>" * 5_000 + "<p>y")
    assert wrapper.main_text(deep, set()) == "x y"
    assert wrapper.aligned_blocks(deep, deep) == [(0, 0), (1, 1)]
    assert wrapper.main_text(wrapper.parse("<a <a " * 50_000), set()) == ""
    assert len(wrapper.parse("<!-- " * 50_000 + "<p>t").texts) == 0
    rng = np.random.default_rng(5)

    def items(n):
        return "".join("<ul><li>a</ul>" if x else "<p>b</p>" for x in rng.integers(0, 2, n))
    a, b = wrapper.parse(items(70)), wrapper.parse(items(50))
    want = wrapper.aligned_blocks(a, b)
    monkeypatch.setattr(wrapper, "TABLE_CELLS", 16)              # halved instead of one table
    got = wrapper.aligned_blocks(a, b)
    assert len(got) == len(want) and got == sorted(got)


def test_constant_nodes_become_template(sp):
    rows = [(i, "http://H.example.com/p", page(f"<article><h1>Head {i}</h1><p>body {i} text</p><p>Share this story</p>"
                                               f"<p>more {i}</p></article>", f"t{i}")) for i in range(8)]
    rows += [(20, "http://copies.example.com/", page("<article><p>same text</p><p>again</p></article>"))] * 3
    rows += [(30, None, "<p>no host"), (31, "http://h.example.com/q", None), (32, "x", ""),
             (None, "http://h.example.com/z", page("<article><p>other page entirely</p></article>"))]
    pages = sp.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = defaultdict(set)
    for r in wrapper.extract(pages).collect():
        got[r["page_id"]].add(r["text"])
    for i in range(8):
        assert got[i] == {f"Head {i} body {i} text more {i}"}
    assert got[20] == {"same text again"} and got[30] == {"no host"} and got[31] == got[32] == {""}
    assert got[None] == {"other page entirely"}
    assert wrapper.extract(pages.limit(0)).count() == 0


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


def test_more_constant_blocks_than_paragraphs(sp):
    rng = np.random.default_rng(6)
    chrome = "".join(f"<div><p>Fixed line {i} of the host</p></div>" for i in range(20))
    story = [[prose(rng, 30) for _ in range(5)] for _ in range(8)]
    html = [f"<html><body>{chrome}<div>{''.join(f'<p>{p}</p>' for p in s)}</div></body></html>" for s in story]
    near = [html[0].replace(story[0][2][:6], f"edit{i}") for i in range(12)]      # near copies of one story
    rows = [(i, "http://h.example.com/", h) for i, h in enumerate(html)]
    rows += [(100 + i, "http://n.example.com/", h) for i, h in enumerate(near)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(
        sp.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == " ".join(story[i])
    for i in range(12):
        assert " ".join(story[0][3:]) in got[100 + i] and f"edit{i}" in got[100 + i]


def test_every_layout_of_a_host_has_its_template(sp):
    rng = np.random.default_rng(8)

    def page_of(layout, tag, story, extra=""):
        lines = "".join(f"<p>Fixed line {i} of {layout}</p>" for i in range(5))
        inner = "".join(f"<p>{p}</p>" for p in story)
        return f"<html><body>{extra}<{tag} class='{layout}'>{lines}</{tag}><div class='t'>{inner}</div></body></html>"
    story = [[prose(rng, 30) for _ in range(3)] for _ in range(26)]
    html = [page_of("shop", "section", s) for s in story[:12]] + [page_of("blog", "div", s) for s in story[12:18]]
    html += [page_of("wiki", "table", s) for s in story[18:25]] + [page_of("shop", "section", story[25], "<section><h2>Own</h2></section>")]
    html += [page_of("blog", "div", ["copy"], "<aside>x</aside>")] * 6         # a layout of copies: no voters of its own
    rows = [(i, "http://h.example.com/", h) for i, h in enumerate(html)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(
        sp.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] == " ".join(story[i]) for i in range(25)] == [True] * 25
    assert got[25] == "Own " + " ".join(story[25])
    assert all("copy" in got[i] for i in range(26, 32))


def test_page_text_of_the_table(sp, table):
    import re
    from html import unescape
    html = {r["page_id"]: r["html"] for r in table("pages").collect()}
    rows = queries.op5_wrapper_text(sp, SF).collect()
    assert len(rows) == len(html)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", html[r["page_id"]], re.S).group(1)
        want = " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


# -- archives ----------------------------------------------------------------------

def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute_archive(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        f = first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_archives_equal_brute_force(sp, table):
    rows = [tuple(r) for r in table("pages").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, queries.op7_warc_dictionary(sp, SF).collect()), key=str) == brute_archive(rows)


def test_archive_edges_and_file_format(sp):
    rows = [(5, "http://a/ b\r\nc", "<p>é</p>"), (3, None, "<p>é</p>"), (3, None, "<p>é</p>"), (None, "u", "<p>é</p>"),
            (7, "u", None), (8, "u", ""), (None, "u", "only"), (9, "u", "x\r\n\r\ny" * 50_000)]
    pages = sp.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    manifest = warc.write_archives(pages.coalesce(1))
    back = warc.read_archives(manifest)
    assert sorted((tuple(r)[:5] for r in back.collect()), key=str) == brute_archive(rows)
    assert bytes(back.where("page_id = 9").first()["payload"]).decode() == rows[-1][2]
    path = manifest.first()["path"].removeprefix("file:")
    with open(path, "rb") as f:
        data = f.read()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert data.count((0xFD2FB528).to_bytes(4, "little")) >= len(rows)       # a frame per record
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


# -- near-duplicates -----------------------------------------------------------------

def brute_components(fps, max_bits=4):
    """{fingerprint: class} by comparing all pairs."""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(b)] = find(a)
    return {f: find(f) for f in fps}


def slow_fingerprint(text):
    import re

    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_duplicates(rows):
    fps = {k: slow_fingerprint(t) for k, t in set(rows)} if len(set(r[0] for r in rows)) == len(rows) else None
    comp = brute_components(fps.values())
    first = defaultdict(lambda: None)
    for d, f in fps.items():
        first[comp[f]] = d if first[comp[f]] is None else min(d, first[comp[f]])
    return {d: (f"{f:016x}", first[comp[f]]) for d, f in fps.items()}


def test_near_duplicates_equal_brute_force(sp, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op8_simhash_pivots(sp, SF).collect()}
    assert got == brute_duplicates(rows)
    assert len({c for _, c in got.values()}) < len(got)


def near_sets(seed, n, flips):
    rng = np.random.default_rng(seed)
    out = []
    for base in rng.integers(0, 2 ** 64, 6, dtype=np.uint64):
        x = int(base)
        for _ in range(n):
            out.append(x)
            for b in rng.choice(64, flips, replace=False):      # a chain of near fingerprints
                x ^= 1 << int(b)
    return np.array(sorted({*out, *map(int, rng.integers(0, 2 ** 64, 50, dtype=np.uint64))}), np.uint64)


@pytest.mark.parametrize("bucket_rows", [4, 8192])
def test_links_span_the_brute_force_components(sp, bucket_rows):
    fps = near_sets(5, 12, 3)
    classes = sp.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(classes, bucket_rows=bucket_rows)).collect()}
    want = brute_components([int(x) for x in fps])
    got = defaultdict(set)
    for x, s in zip(fps.tolist(), fps.view(np.int64).tolist()):
        got[roots.get(s, s)].add(x)
    sets = defaultdict(set)
    for x, c in want.items():
        sets[c].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, sets.values()))
    assert all(r == min(np.array(sorted(got[r]), np.uint64).view(np.int64).tolist()) for r in got)


def test_large_groups_link_like_brute_force():
    fps = near_sets(7, 40, 2)
    i, j = simhash.link_large(fps, simhash.pivot_table(fps, simhash.pivots()), 4)
    assert (np.bitwise_count(fps[i] ^ fps[j]) <= 4).all()
    parent = {int(x): int(x) for x in fps}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in zip(fps[i].tolist(), fps[j].tolist()):
        parent[find(a)] = find(b)
    want = brute_components(fps.tolist())
    pairs = {(find(x), c) for x, c in want.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_near_duplicate_edges(frame):
    docs = frame(EDGE + [(None, "", None, None), (None, "u v w", None, None), (None, "U  v w", None, None)])
    got = defaultdict(set)
    for r in simhash.near_duplicates(docs).collect():
        got[r["doc_id"]].add((r["fp"], r["component_id"]))
    assert got[1] == got[2] == got[3] == {(0, 1)}               # no words: fingerprint zero
    assert got[6] == {(simhash_signed("All rights reserved."), 6)}
    assert (0, 1) in got[None] and (simhash_signed("x y"), None) in got[None]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in kept.collect())
    assert [i for i, _ in ids] == [-1, -1, 1, 4, 5, 6, 9] and [t for i, t in ids if i == -1] == ["U  v w", "x y"]
    assert simhash.near_duplicates(frame([])).count() == 0 and simhash.one_per_group(frame([])).count() == 0


def test_rows_of_one_id_stand_for_their_own_groups(frame):
    a = " ".join(f"wort{i}" for i in range(60))
    b = " ".join(f"autre{i}" for i in range(60))
    kept = simhash.one_per_group(frame([(1, a, None, None), (1, b, None, None), (2, b, None, None), (3, a, None, None),
                                        (None, a + " ", None, None), (None, "x", None, None)])).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(1, a), (1, b), (None, "x")], key=str)


def simhash_signed(text):
    return int(np.array([simhash.fingerprint(text.encode())], np.uint64).view(np.int64)[0])


# -- pipeline ------------------------------------------------------------------------

def test_pipeline_equals_brute_force(sp, table):
    docs = {r["doc_id"]: r for r in table("documents").collect()}
    good = {r["doc_id"] for r in quality.quality_scores(table("documents"), table("labels")).where("predicted = 1").collect()}
    groups = brute_duplicates([(d, docs[d]["text"]) for d in good])
    first = {d for d, (_, c) in groups.items() if d == c}
    items = [(r["item_id"], r["text"]) for r in table("benchmark").collect()]
    clean = {d for d in first if not brute_hits(docs[d]["text"], items)[-1]}
    assert len(docs) > len(good) > len(first) > len(clean) > 0
    left = sp.createDataFrame([docs[d] for d in clean], table("documents").schema)
    kept = {r["doc_id"] for r in mixing.calibrated(left).where("__kept").collect()}
    want = brute_tokens(sorted((d, docs[d]["text"]) for d in kept))
    got = sorted(map(tuple, corpus_pipeline.run(sp, SF).collect()))
    assert got == want and 0 < len(want) < len(clean)


def test_stages_keep_columns_and_handle_edges(sp, frame, tmp_path):
    for name, rows in (("labels", [(2, 1, 0)]), ("benchmark", None)):
        df = (sp.createDataFrame(rows, "doc_id long, quality int, toxic int") if rows else
              sp.createDataFrame([(1, "all rights reserved")], "item_id long, text string"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (frame(EDGE), frame([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(sp, docs, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            out.collect()


HELPERS = ("__source", "__lang", "__draw", "__topic", "__tokens", "__probability", "__kept", "factor", "__first",
           "__row", "__fp", "__root", "root", "component_id", "fp", "__id", "__text", "__utf8", "__host", "held_out",
           "x", "id", "c0", "c1", "score", "predicted", "a.b")


def test_column_names_of_the_operators_own_clash_with_nothing(sp, frame, tmp_path):
    sp.createDataFrame([(2, 1, "x"), (5, 0, "x")], "doc_id long, quality int, __id string") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    sp.createDataFrame([(1, "all rights reserved", "x")], "item_id long, text string, __id string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, plain = frame(EDGE, extra=HELPERS), frame(EDGE, extra=())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(sp, docs, str(tmp_path))
        assert out.columns == docs.columns and all(r["a.b"] == r["__kept"] == "x" for r in out.collect())
        want = stage(sp, plain, str(tmp_path)).collect()
        assert sorted(map(str, want)) == sorted(map(str, out.select(*plain.columns).collect()))
    rows = mixing.calibrated(docs)
    assert [c for c in rows.columns if c in mixing.RESULTS] == list(mixing.RESULTS)
    assert rows.where("__probability between 0 and 1").count() == len(EDGE)
    pages = sp.createDataFrame([(1, "http://a.b/", "<p>x</p>", "x", "x"), (2, None, "<p>x</p>", "x", "x")],
                               "page_id long, url string, html string, __first string, __payload string")
    got = warc.read_archives(warc.write_archives(pages)).select("page_id", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, 1)]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])
    assert decontaminate.BLOCK_BYTES > 0
