"""Main-text extraction by wrapper induction.

1. A host's pages are grouped by layout, a hash of their containers' labels to
   some depth.  Layouts of at least ``min_votes`` + 2 pages are groups of their own;
   pages of smaller ones belong to the host's largest, or, if all are small,
   the host is one group.  Each group has a reference page: of its complete
   pages of at most twice the median length (else of all), the one with the
   smallest hash of its id.
2. Every page of the group is aligned with it by simple tree matching (the
   largest order-preserving matching of the two DOM trees with equal labels).
   An aligned text block with the reference's text votes "constant", another
   text votes "varying".  Copies of the reference cast no vote: pages whose
   blocks that differ from the reference's share most of their words with
   them, or whose blocks all align and are nearly all equal.  Votes are summed per group and block in Spark, map-side
   combined, over all pages.
3. Blocks that are constant in ``constant_share`` of at least ``min_votes``
   votes are template; varying slots and unaligned blocks are content.  Pages
   of a group with fewer voters (copies of one another) use the wrapper of the
   host's group with the most.
4. Varying slots that are marked as menus, headers, footers, sidebars,
   notices, adverts, forms, scripts, styles or reader comments by their
   element, class, id or role are no article text, so they are dropped as well
   (but no class, id or role drops an element that holds the main element, the
   only article or most of the page's text);
   if the larger part of the page's content text (of its main element, if that
   holds the articles) is in article elements, only their blocks are content,
   else those of its main element, if it has one.
   Alignment alone cannot tell these from the article: their texts vary from
   page to page just as the article's do.

Defined results: a null or empty page gives the empty text; a page without a
host in its URL (or a null URL) belongs to the host ""; repeated rows and ids
are extracted row by row; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.base import record_batch, write_scratch

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form menu dialog iframe object embed svg canvas "
    "button select option textarea input audio video map".split())
WHOLE = frozenset("html body main".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg"
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# words in class, id or role that mark page furniture
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar "
    "sidenav menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent notice notices alert "
    "newsletter subscribe subscription popup modal share sharing social related recommended comment comments "
    "reply replies disqus footer masthead topbar toolbar pagination pager login signup search "
    "contentinfo complementary".split())
# regions that may well hold articles of their own or outgrow the article
REGIONS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored related recommended comment comments "
    "reply replies disqus".split())
# lists that outgrow a short article
LISTS = frozenset("menu nav navbar navigation sidenav footer breadcrumb breadcrumbs cookie cookies consent".split())
# "has-sidebar", "comments-open", "search-results" tell of furniture elsewhere, or of none
NOT_AFTER = frozenset("has have no not without with w hide show enable use uses supports".split())
NOT_BEFORE = frozenset(
    "open opened closed enabled disabled on off active inactive visible supported free none result results page "
    "template layout".split())
INVISIBLE = frozenset("hidden is-hidden visually-hidden".split())

# a quote opens a value behind "=" only; possessive, so a broken tag costs one pass
_ATTRS = r"""(?:[^>"'=]++|=\s*+"[^"]*"|=\s*+'[^']*'|[="'])*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b{_ATTRS}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRS})>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S | re.I)
_CONTAINER = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b{_ATTRS}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)(div|section|main|article|aside|header|footer|nav|form|table)(?![^\s/>])({_ATTRS})>"
    r"|<[a-zA-Z][^>]*\Z", re.S | re.I)
_ATTR = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NO_DISPLAY = re.compile(r"(?<![-\w])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_PART = re.compile(r"[a-z0-9]+")
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")
LAYOUT_DEPTH = 3                # the body's containers and two levels in these
COPY_WORDS, COPY_EQUAL = 0.8, 0.95   # of the words that differ, of all words of an aligned page
MAX_DEPTH = 10_000_000        # trees are walked recursively, however deep a page nests


class Node:
    """An element (label, children) or, with ``block`` set, a text block."""
    __slots__ = ("label", "children", "block")

    def __init__(self, label: str, block: int = -1):
        self.label, self.children, self.block = label, [], block


class Mark:
    """An element that is page furniture for sure (``hard``) or by its class,
    id or role, inside the marked element ``up``.  ``inside``: it is part of
    an article or main element."""
    __slots__ = ("up", "hard", "region", "lists", "inside", "main", "article", "size", "sure", "drop")

    def __init__(self, up, hard: bool, words, inside: bool):
        self.up, self.hard, self.inside, self.main, self.article, self.size = up, hard, inside, False, False, 0
        self.region, self.lists = not REGIONS.isdisjoint(words), not LISTS.isdisjoint(words)
        self.sure = hard or up is not None and up.sure


def furniture_words(value: str) -> set[str]:
    """The furniture that the names of a class, id or role attribute mark."""
    found = set()
    for name in value.split():
        parts = _PART.findall(name)
        if parts and NOT_AFTER.isdisjoint(parts[:-1]) and parts[-1] not in NOT_BEFORE:
            found.update(FURNITURE.intersection(parts))
        if name in INVISIBLE:
            found.add(name)
    return found


def dropped(texts: list[str], marks: list[Mark | None], opened: list[Mark], outside: bool) -> list[bool]:
    """Per block, whether it is furniture.  ``opened``: the marked elements in
    page order; ``outside``: an article or main element is in none of them."""
    total = 0
    for text, mark in zip(texts, marks):
        if mark is None or not mark.sure:
            total += len(text)
            if mark is not None:
                mark.size += len(text)
    for mark in reversed(opened):
        if mark.up is not None and not mark.sure:
            mark.up.size += mark.size
    for regions in (True, False):            # regions hold the article only if nothing else is left
        for mark in opened:
            most = (mark.article and not outside
                    or 2 * mark.size > total and not mark.lists and (mark.inside or not outside))
            kept = mark.main or most and not (mark.region and (regions or not mark.article))
            mark.drop = mark.hard or not kept or mark.up is not None and mark.up.drop
        if any(m is None or not m.drop for m in marks):
            break
    return [m is not None and m.drop for m in marks]


class Page:
    """DOM tree of the body with its text blocks in page order."""
    __slots__ = ("root", "texts", "furniture", "article", "main")

    def __init__(self):
        self.root = Node("html")
        self.texts: list[str] = []
        self.furniture: list[bool] = []
        self.article: list[bool] = []
        self.main: list[bool] = []


def parse(html: str) -> Page:
    """The page's tree.  Inline elements belong to the text of their block."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), MAX_DEPTH))
    page = Page()
    # open elements: tag, node, innermost mark, inside article, inside main
    stack = [("html", page.root, None, False, False)]
    marks_of, opened, outside = [], [], False
    is_open: Counter = Counter()
    buffer: list[str] = []

    def pop_from(i):
        for x in stack[i:]:
            is_open[x[0]] -= 1
        del stack[i:]

    def flush():
        if not buffer:
            return
        text = _SPACE.sub(" ", unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            _, node, mark, article, main = stack[-1]
            node.children.append(Node("#", len(page.texts)))
            page.texts.append(text)
            marks_of.append(mark)
            page.article.append(article)
            page.main.append(main)

    def close(tag):
        if is_open[tag]:
            i = len(stack) - 1
            while stack[i][0] != tag:
                i -= 1
            pop_from(i)

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            buffer.append(html[at:m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:                       # comment, raw-text element, declaration
            if m.group(1):
                flush()
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        flush()
        if m.group(2):                        # closing tag
            close(tag)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            close("p")
        ends = CLOSED_BY_SAME.get(tag)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    pop_from(i)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "article", "section", "div"):
                    break
        _, parent, mark, article, main = stack[-1]
        attrs = m.group(4)
        named = [(k.lower(), v.strip("\"'").lower()) for k, v in _ATTR.findall(attrs)] if attrs else []
        marks = [x for x in named if x[0] in ("class", "id", "role")]
        is_main = tag == "main" or ("role", "main") in marks
        # marks of the whole page's containers ("has-sidebar") say nothing about its text
        whole = tag in WHOLE
        words = {w for _, v in marks for w in furniture_words(v)} if marks and not whole else ()
        hard = (tag in DROPPED or tag == "header" and not article or not whole and any(
            k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and _NO_DISPLAY.search(v)
            for k, v in named))
        if hard or words:
            mark = Mark(mark, hard, words, article or main)
            opened.append(mark)
        if is_main or tag == "article" and not words:
            outside = outside or mark is None
            up = mark
            while up is not None and not (up.main if is_main else up.article):
                up.main, up.article = up.main or is_main, up.article or not is_main
                up = up.up
        label = tag + "".join("." + v for k, v in marks if k == "class")
        node = Node(label)
        parent.children.append(node)
        is_open[tag] += 1
        stack.append((tag, node, mark, article or tag == "article", main or is_main))
    if at < len(html):
        buffer.append(html[at:])
    flush()
    page.furniture = dropped(page.texts, marks_of, opened, outside)
    fold(page.root)
    return page


def fold(node: Node) -> None:
    """An element that holds only one text becomes that text's leaf."""
    for child in node.children:
        if child.block < 0:
            fold(child)
    if len(node.children) == 1 and node.children[0].block >= 0 and not node.children[0].children:
        node.block, node.children = node.children[0].block, []


def leaves_match(x: Node, y: Node) -> bool:
    return x.label == y.label and not x.children and not y.children


def trim(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
    """Equal leaves at the front and at the back; they match one another in
    some largest matching."""
    most, k, e = min(len(xs), len(ys)), 0, 0
    while k < most and leaves_match(xs[k], ys[k]):
        k += 1
    while e < most - k and leaves_match(xs[-1 - e], ys[-1 - e]):
        e += 1
    return k, e


def tree_match(a: Node, b: Node, memo: dict) -> int:
    """Size of the largest matching of two trees, 0 for unequal root labels."""
    if a.label != b.label:
        return 0
    if not a.children or not b.children:
        return 1
    key = (id(a), id(b))
    if key not in memo:
        k, e = trim(a.children, b.children)
        inner = last_row(a.children[k:len(a.children) - e], b.children[k:len(b.children) - e], memo)
        memo[key] = 1 + k + e + inner[-1]
    return memo[key]


def next_row(x: Node, ys, above: list[int], memo: dict) -> list[int]:
    row, leaf, label = [0], not x.children, x.label
    for j, y in enumerate(ys):
        best = above[j + 1] if above[j + 1] >= row[j] else row[j]
        if y.label == label:
            w = above[j] + (1 if leaf or not y.children else tree_match(x, y, memo))
            if w > best:
                best = w
        row.append(best)
    return row


def last_row(xs, ys, memo: dict) -> list[int]:
    """Largest matchings of ``xs`` with every front part of ``ys``."""
    row = [0] * (len(ys) + 1)
    for x in xs:
        row = next_row(x, ys, row, memo)
    return row


TABLE_CELLS = 1 << 20


def matched(xs: list[Node], ys: list[Node], memo: dict) -> list[tuple[Node, Node]]:
    """The node pairs of a largest matching of two child lists, in order.
    Beyond ``TABLE_CELLS`` the first list is halved where the best matchings
    of both halves meet, so memory stays linear."""
    k, e = trim(xs, ys)
    front, back = list(zip(xs[:k], ys[:k])), list(zip(xs[len(xs) - e:], ys[len(ys) - e:]))
    xs, ys = xs[k:len(xs) - e], ys[k:len(ys) - e]
    found = []
    if xs and ys and len(xs) > 1 and len(xs) * len(ys) > TABLE_CELLS:
        half = len(xs) // 2
        ahead, behind = last_row(xs[:half], ys, memo), last_row(xs[:half - 1:-1], ys[::-1], memo)
        cut = max(range(len(ys) + 1), key=lambda j: ahead[j] + behind[len(ys) - j])
        found = matched(xs[:half], ys[:cut], memo) + matched(xs[half:], ys[cut:], memo)
    elif xs and ys:
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            rows.append(next_row(x, ys, rows[-1], memo))
        i, j = len(xs), len(ys)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((xs[i], ys[j]))
        found.reverse()
    return front + found + back


def align(a: Node, b: Node, pairs: list, memo: dict) -> None:
    """Append the (block of a, block of b) pairs of the largest matching."""
    if a.block >= 0 and b.block >= 0:
        pairs.append((a.block, b.block))
    if a.children and b.children:
        for x, y in matched(a.children, b.children, memo):
            align(x, y, pairs, memo)


def aligned_blocks(page: Page, reference: Page) -> list[tuple[int, int]]:
    pairs: list[tuple[int, int]] = []
    align(page.root, reference.root, pairs, {})
    return pairs


def is_copy(page: Page, reference: Page, pairs: list[tuple[int, int]]) -> bool:
    """Whether a page repeats the reference's content: what differs, without
    page furniture, is at most a few edited words."""
    same = [(i, j) for i, j in pairs if page.texts[i] == reference.texts[j]]
    sides = [(page, {i for i, _ in same}, {i for i, _ in pairs}),
             (reference, {j for _, j in same}, {j for _, j in pairs})]
    differ, total, aligned = [], 0, True
    for p, equal, paired in sides:
        words: Counter = Counter()
        for i, text in enumerate(p.texts):
            if not p.furniture[i]:
                total += text.count(" ") + 1
                aligned = aligned and i in paired
                if i not in equal:
                    words.update(text.split())
        differ.append(words)
    a, b = differ
    return (aligned and a.total() + b.total() <= (1 - COPY_EQUAL) * total
            or (a & b).total() >= COPY_WORDS * max(a.total(), b.total()))


def main_text(page: Page, template: set[int]) -> str:
    """The content blocks joined by one space; ``template``: blocks of the
    page that the wrapper found constant."""
    blocks = [i for i in range(len(page.texts)) if not page.furniture[i] and i not in template]
    main = [i for i in blocks if page.main[i]]
    articles = [i for i in blocks if page.article[i]]
    bound = main if main and all(page.main[i] for i in articles) else blocks
    most = 2 * sum(len(page.texts[i]) for i in articles) >= sum(len(page.texts[i]) for i in bound)
    inside = articles if articles and most else main or blocks
    return " ".join(page.texts[i] for i in inside)


def shape(html: str) -> str:
    """Distinct paths of the page's containers to ``LAYOUT_DEPTH``, labels
    without numbers.  Scans the container tags only, which costs a fraction of
    parsing the page."""
    stack, is_open, paths = [], Counter(), {}
    for m in _CONTAINER.finditer(html):
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            if is_open[tag]:
                while True:
                    top = stack.pop()[0]
                    is_open[top] -= 1
                    if top == tag:
                        break
            continue
        path = ""
        if len(stack) < LAYOUT_DEPTH:
            names = (v.strip("\"'").lower() for k, v in _ATTR.findall(m.group(4)) if k.lower() == "class")
            path = f"{stack[-1][1] if stack else ''}/{tag}{_DIGITS.sub('', ''.join('.' + v for v in names))}"
            paths[path] = None
        stack.append((tag, path))
        is_open[tag] += 1
    return " ".join(paths)


def with_layout(pages: DataFrame, html: str) -> DataFrame:
    """``pages`` with ``__layout``, the hash of the page's shape."""
    at = pages.columns.index(html)

    def run(batches):
        for batch in batches:
            shapes = (shape(t or "") for t in batch.column(at).to_pylist())
            yield batch.append_column("__layout", pa.array(
                [int.from_bytes(blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
                 for x in shapes], pa.int64()))

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("__layout", T.LongType())]))


def host_of(url):
    """Lower-case host of a URL column, "" if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


VOTERS = -1      # the block number under which a group's voting pages are counted


class References:
    """Parsed reference pages of a task, the last few kept."""

    def __init__(self, most: int = 64):
        self.pages, self.most = {}, most

    def get(self, host: str, html: str | None) -> Page:
        key = (host, html)
        if key not in self.pages:
            if len(self.pages) >= self.most:
                self.pages.pop(next(iter(self.pages)))
            self.pages[key] = parse(html or "")
        return self.pages[key]


def references(pages: DataFrame, laid_out: DataFrame, *, id_col: str, html: str, min_pages: int) -> tuple[DataFrame, DataFrame]:
    """Group of each layout of a host (``__host``, ``__layout``, ``__group``)
    and the reference page of each group (``__host``, ``__group``, ``__ref``)."""
    incomplete = ~F.lower(F.right(F.rtrim(F.col(f"`{html}`")), F.lit(7))).eqNullSafe(F.lit("</html>"))
    page, size, digest = F.col(f"`{id_col}`"), F.length(F.col(f"`{html}`")), F.xxhash64(F.col(f"`{html}`"))
    narrow = write_scratch(laid_out.where(size > 0).select("__host", "__layout", page.alias("__page"), incomplete.alias("c"),
                                       size.alias("n"), digest.alias("h")), "page_shapes")
    counts = write_scratch(narrow.groupBy("__host", "__layout").agg(F.count("*").alias("pages")), "layouts")
    tops = counts.groupBy("__host").agg(F.max(F.struct("pages", "__layout")).alias("top"))
    groups = write_scratch(counts.join(tops, "__host").select(
        "__host", "__layout", F.when(F.col("pages") >= min_pages, F.col("__layout"))
        .when(F.col("top.pages") >= min_pages, F.col("top.__layout")).otherwise(F.lit(0)).alias("__group")), "groups")
    # pages of small layouts are no references of another layout's group
    own = narrow.join(groups, ["__host", "__layout"]).where((F.col("__group") == F.col("__layout")) | (F.col("__group") == 0))
    typical = write_scratch(own.groupBy("__host", "__group").agg(
        F.percentile_approx("n", 0.5).alias("__median")), "median_lengths")
    order = F.struct("c", (F.col("n") > 2 * F.col("__median")).alias("long"), F.xxhash64("__page").alias("x"),
                     F.col("__page").alias("id"), "n", "h")
    best = write_scratch(own.join(typical, ["__host", "__group"]).groupBy("__host", "__group").agg(
        F.min(order).alias("o")).select(F.col("__host").alias("__h"), "__group", F.col("o.n").alias("__n"),
                                        F.col("o.id").alias("__id"), F.col("o.h").alias("__digest")), "hosts")
    found = pages.where(size > 0).select("__host", page.alias("__page"), F.col(f"`{html}`").alias("__ref")).join(
        best, (F.col("__host") == F.col("__h")) & F.col("__page").eqNullSafe(F.col("__id"))
        & (F.length("__ref") == F.col("__n")) & (F.xxhash64("__ref") == F.col("__digest")))
    return groups, write_scratch(found.groupBy("__host", "__group").agg(F.min("__ref").alias("__ref")), "references")


def extract(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html",
            min_votes: int = 3, constant_share: float = 0.6) -> DataFrame:
    """Per page: id, url, ``text`` and ``n_template`` (template blocks found)."""
    src = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url}`"), F.col(f"`{html}`"),
                       host_of(F.col(f"`{url}`")).alias("__host"))
    laid_out = with_layout(src, html)
    groups, refs = references(src, laid_out, id_col=id_col, html=html, min_pages=min_votes + 2)

    def vote(batches):
        seen = References()
        for batch in batches:
            votes: Counter = Counter()
            equal: Counter = Counter()
            for host, group, text, ref in zip(*(batch.column(i).to_pylist() for i in range(4))):
                page, reference = parse(text or ""), seen.get(host, ref)
                pairs = aligned_blocks(page, reference)
                if is_copy(page, reference, pairs):
                    continue
                votes[host, group, VOTERS] += 1
                for i, j in pairs:
                    votes[host, group, j] += 1
                    equal[host, group, j] += page.texts[i] == reference.texts[j]
            keys = list(votes)
            yield record_batch(h=pa.array([k[0] for k in keys], pa.string()),
                               g=pa.array([k[1] for k in keys], pa.int64()),
                               b=pa.array([k[2] for k in keys], pa.int32()),
                               v=pa.array([votes[k] for k in keys], pa.int64()),
                               e=pa.array([equal[k] for k in keys], pa.int64()))

    votes = write_scratch(
        laid_out.join(groups, ["__host", "__layout"]).join(refs, ["__host", "__group"])
        .select("__host", "__group", F.col(f"`{html}`"), "__ref")
        .mapInArrow(vote, "__host string, __group long, block int, votes long, equal long")
        .groupBy("__host", "__group", "block").agg(F.sum("votes").alias("votes"), F.sum("equal").alias("equal"))
        .where(F.col("votes") >= min_votes), "votes")
    voters = votes.where(F.col("block") == VOTERS).select("__host", "__group", "votes")
    template = (votes.where((F.col("block") != VOTERS) & (F.col("equal") >= constant_share * F.col("votes")))
                .groupBy("__host", "__group").agg(F.sort_array(F.collect_list("block")).alias("__template")))
    wrappers = write_scratch(refs.join(template, ["__host", "__group"]), "wrappers")
    # groups without voters use the wrapper of the host's group with the most
    most = voters.groupBy("__host").agg(F.max(F.struct("votes", "__group")).alias("most"))
    used = write_scratch(
        groups.join(voters, ["__host", "__group"], "left").join(most, "__host", "left")
        .select("__host", "__layout", F.when(F.col("votes").isNotNull(), F.col("__group"))
                .otherwise(F.col("most.__group")).alias("__group")), "used_groups")

    def run(batches):
        seen = References()
        for batch in batches:
            texts, n = [], []
            for host, text, ref, blocks in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                page = parse(text or "")
                found = set()
                if blocks:
                    constant = set(blocks)
                    reference = seen.get(host, ref)
                    found = {i for i, j in aligned_blocks(page, reference)
                             if j in constant and page.texts[i] == reference.texts[j]}
                texts.append(main_text(page, found))
                n.append(len(found))
            yield record_batch(id=batch.column(0), url=batch.column(1), t=pa.array(texts, pa.string()),
                               n=pa.array(n, pa.int64()))

    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    return (laid_out.join(used, ["__host", "__layout"], "left").join(wrappers, ["__host", "__group"], "left")
            .select(F.col(f"`{id_col}`"), F.col(f"`{url}`"), "__host", F.col(f"`{html}`"), "__ref", "__template")
            .mapInArrow(run, f"`{id_col}` {types[id_col]}, `{url}` {types[url]}, text string, n_template long"))
