"""Substring deduplication by relative Lempel-Ziv parsing.

A document is cut into passages that meet the reference text they can match:
the smallest hash of ``GRAM`` consecutive words in a window of 20 words names
the window, and a run of windows of one name is one passage.  Equal windows have equal
names, so no pair of them is missed, and every window is in exactly one
passage.  A passage that equals an earlier one (128-bit digest) is a factor
as it stands; of equal passages the first goes on, and only where another
passage has its name (or it may repeat itself): the others match nothing.

Those meet in reference blocks: the passages of many names (``BLOCK_BYTES``).
A block's windows are indexed as sorted word-id keys with the earliest place each stands
at.  Every passage is parsed greedily
against the block: a word whose window stands earlier opens a factor, which is
extended as long as its source goes on; other words are literals.  Factors
have ``window`` words at least.  The windows across a factor's end, which the
factor says nothing about, are each looked up again, and may open the next,
overlapping factor.  So every window that stands earlier lies in a factor, and
every word of a factor lies in such a window.  Factors are the duplicate
spans.

Scale: texts are written once, as shard files in the shared scratch folder,
and never shuffled whole: names, digests and places travel (some 40 bytes a
passage), and of the words only the passages that share their name with a
different one.  Passages repeated inside a shard do not travel at all, and
equal passages stream past one another, so groups of copies cost their places
only.  More than ``HOT`` passages of one name, or more text than a block
(a frequent phrase in many contexts), are compared window by window: a shard
settles its own equal windows and sends one digest for each of the others, packed
by digest into a row for each of ``buckets``.  So a window that stands a million
times costs an entry for each shard, not one for each place, and rows are far
fewer than windows.  A task holds one block, one shard, or one bucket
(``BUCKET_BYTES``).

Defined results: null and empty texts and texts of under ``window`` words
lose nothing; a place is (document id, word), null ids first; a window is
removed if an equal one has a smaller place, so rows that repeat a document
with its id lose the same words each, and none to one another; further columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import read_file, record_batch, space_words, texts_of, write_file, write_scratch
from orderflow.session import scratch_dir

WINDOW = 20
GRAM = 6
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
PART_BYTES = 32 << 20            # passages of a partition, about
BUCKET_BYTES = 8 << 20           # windows of a bucket, about
BUCKETS = 256                    # at least
WORD_BYTES = 8                   # of a word and its blank, about
LONGEST = 4096                   # windows of a passage
HOT = 256                        # passages of one name that are parsed together
NO_ID = -(1 << 63)               # null ids stand first

PLACE = "shard long, at long, doc long, start long, n long"
PASSAGE = f"key long, {PLACE}, words binary"
SPAN = f"{PLACE}, large boolean"
PACK = "key long, shard long, windows binary, spans binary"
_WINDOW = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("at", "<i8")])
_OWN = np.dtype([("at", "<i8"), ("doc", "<i8"), ("start", "<i8"), ("n", "<i8")])
_P = np.uint64(0x9E3779B97F4A7C15)             # odd multipliers of the gram and name hashes
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * _P
    h = (h ^ (h >> np.uint64(29))) * _Q
    return h ^ (h >> np.uint64(32))


def grams_of(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` words from each word on."""
    n = len(hashes) - gram + 1
    out = np.zeros(n, np.uint64)
    for k in range(gram):
        out = out * _P + hashes[k:k + n]
    return mixed(out)


def smallest(grams: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` consecutive grams."""
    least, width = grams, 1
    while width < span:                        # widths double up to the wanted one
        step = min(width, span - width)
        least, width = np.minimum(least[:len(least) - step], least[step:]), width + step
    return least


def runs(name: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) windows of the runs of one name, cut where a document
    begins and after ``LONGEST`` windows."""
    new = begins.copy()
    new[1:] |= name[1:] != name[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(name)) - 1
    long = last - first >= LONGEST
    if long.any():
        parts = [np.arange(a, b + 1, LONGEST) for a, b in zip(first[long], last[long])]
        first = np.sort(np.concatenate([first[~long], *parts]))
        last = np.append(first[1:], len(name)) - 1
    return first, last


def may_repeat(grams, name, first, last, span):
    """Whether the gram that names a run stands in it twice (else no two of its
    windows are equal)."""
    twice = last - first >= span
    at = first.copy()
    for d in range(span - 1, -1, -1):
        hit = grams[first + d] == name
        at[hit] = first[hit] + d
    for d in range(1, 2 * span):
        there = np.minimum(at + d, len(grams) - 1)
        twice |= (grams[there] == name) & (at + d < last + span)
    return twice


class Cut(NamedTuple):
    """A shard's passages (columns), and per document the spans of passages
    that stand earlier in the shard."""
    columns: dict
    spans: list[list[tuple[int, int]]]


def cut(words: list[list[bytes]], docs: list[int], shard: int, window: int, gram: int) -> Cut:
    split = sorted((i for i, w in enumerate(words) if len(w) >= window), key=docs.__getitem__)
    columns: dict[str, list] = {c: [] for c in ("name", "digest", "at", "doc", "start", "n", "again")}
    spans: list[list[tuple[int, int]]] = [[] for _ in words]
    if not split:
        return Cut(columns, spans)
    flat = [x for i in split for x in words[i]]
    hashed: dict[bytes, int] = {}
    for w in flat:
        if w not in hashed:
            hashed[w] = xxhash.xxh64_intdigest(w, 11)
    grams = grams_of(np.fromiter(map(hashed.__getitem__, flat), np.uint64, len(flat)), gram)
    del hashed
    span = window - gram + 1
    least = smallest(grams, span)
    sizes = np.array([len(words[i]) for i in split])
    base = np.cumsum(sizes) - sizes
    # windows that lie in one document
    inside = np.repeat(base + sizes, sizes) - np.arange(len(flat)) >= window
    at = np.flatnonzero(inside[:len(least)])
    which = np.searchsorted(base, at, "right") - 1
    name = least[at]
    first, last = runs(name, np.append(True, which[1:] != which[:-1]))
    twice = may_repeat(grams, name[first], at[first], at[last], span)
    seen: dict[bytes, tuple[int, int]] = {}
    for f, z, d, k, r in zip(at[first].tolist(), at[last].tolist(), which[first].tolist(),
                             name[first].view(np.int64).tolist(), twice.tolist()):
        digest = xxhash.xxh3_128_digest(b" ".join(flat[f:z + window]))
        i = split[d]
        start = f - int(base[d])
        if seen.setdefault(digest, (docs[i], start)) < (docs[i], start):
            spans[i].append((start, z - f + window))
            continue
        for c, v in zip(columns.values(), (k, digest, i, docs[i], start, z - f + window, r)):
            c.append(v)
    return Cut(columns, spans)


# --- shards ---------------------------------------------------------------------------
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))


def shard_path(root: str, shard: int) -> str:
    return f"{root}/shard-{shard}.arrow"


def write_shard(path: str, ids: pa.Array, words: list[list[bytes]], spans: list[list[tuple[int, int]]]) -> None:
    table = pa.table({"id": ids, "words": pa.array([b" ".join(w) for w in words], pa.large_binary()),
                      "spans": pa.array([[dict(start=a, n=n) for a, n in x] for x in spans], _SPANS)})
    buf = io.BytesIO()
    with pa.ipc.new_stream(buf, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    write_file(path, lambda f: f.write(buf.getvalue()))


def read_shard(path: str) -> pa.Table:
    return pa.ipc.open_stream(io.BytesIO(read_file(path))).read_all()


def write_shards(docs: DataFrame, root: str, text: str, id_col: str, window: int) -> DataFrame:
    """Write the documents as shard files; their passages without words, and a
    row without a name for every shard."""
    kind = "name long, digest binary, shard long, at long, doc long, start long, n long, again boolean"

    def run(batches):
        attempt, made = TaskContext.get().taskAttemptId(), 0
        for b in batches:
            ids, ends = b.column(0), np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy())
            lo = 0
            while lo < len(ids):
                done = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, done + SHARD_BYTES, "right")))
                shard, made = (attempt << 24) + made, made + 1      # each attempt has shards of its own
                words = [space_words(t) for t in texts_of(b.column(1).slice(lo, hi - lo))]
                keys = [NO_ID if i is None else i for i in ids.slice(lo, hi - lo).to_pylist()]
                found = cut(words, keys, shard, window, GRAM)
                write_shard(shard_path(root, shard), ids.slice(lo, hi - lo), words, found.spans)
                c, n = found.columns, len(found.columns["name"])
                yield record_batch(
                    name=pa.array([*c["name"], None], pa.int64()), digest=pa.array([*c["digest"], None], pa.binary()),
                    shard=pa.array([shard] * (n + 1), pa.int64()),
                    **{k: pa.array([*c[k], None], pa.int64()) for k in ("at", "doc", "start", "n")},
                    again=pa.array([*c["again"], None], pa.bool_()))
                lo = hi

    src = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text}`").cast("binary"))
    return write_scratch(src.mapInArrow(run, kind), "passages")


def copies(passages: DataFrame, parts: int) -> DataFrame:
    """Places of passages that equal an earlier one (``name`` null), and of
    the first ones that go on to the blocks (``name`` set; ``hot`` where the
    name has more than ``HOT`` of them).

    The passages of a name come sorted by digest and place, so a task holds
    only the first ones, until it knows whether others follow and how many."""
    def run(batches):
        now = last = least = None
        again = sure = hot = False
        held: list[tuple] = []
        out: list[tuple] = []

        def release():
            out.extend((*row, hot) for row in held)
            held.clear()

        def close():
            """The name is complete: a lone passage matches nothing but itself."""
            if again or sure:
                release()
            held.clear()

        for b in batches:
            for name, digest, shard, at, doc, start, n, twice in zip(*(c.to_pylist() for c in b.filter(paired(b)).columns)):
                if name != now:
                    close()
                    now, last, least, again, sure, hot = name, None, None, False, False, False
                again |= twice
                if digest == last and (doc, start) != least:
                    out.append((None, shard, at, doc, start, n, False))
                    continue
                # another passage of the name, or (a repeated row) the same place again
                sure |= last is not None and digest != last
                last, least = digest, (doc, start)
                held.append((name, shard, at, doc, start, n))
                if hot or len(held) > HOT:
                    hot = sure = True
                    release()
            if out:
                yield places(out)
                out.clear()
        close()
        if out:
            yield places(out)

    def places(rows):
        *columns, hot = zip(*rows)
        return record_batch(**{c: pa.array(v, pa.int64()) for c, v in zip(
            ("name", "shard", "at", "doc", "start", "n"), columns)}, hot=pa.array(hot, pa.bool_()))

    rows = (passages.filter(F.col("name").isNotNull()).repartition(parts, "name")
            .sortWithinPartitions("name", "digest", "doc", "start")
            .select("name", "digest", "shard", "at", "doc", "start", "n", "again"))
    return write_scratch(rows.mapInArrow(run, f"name long, {PLACE}, hot boolean"), "copies")


def paired(b: pa.RecordBatch) -> pa.Array:
    """Rows that are not alone with their name (as far as the batch tells)."""
    key = b.column(0).to_numpy()
    same = key[1:] == key[:-1]
    keep = b.column(7).to_numpy(zero_copy_only=False).astype(bool)
    keep[1:] |= same
    keep[:-1] |= same
    keep[:1] = keep[-1:] = True                # the neighbours may be in the next batch
    return pa.array(keep)


def by_shard(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "shard").sortWithinPartitions("shard", "at", "start")


def read_passages(batches, root: str):
    """Per batch of places sorted by shard: its rows (name, shard, at, doc,
    start, n, words), off the shard files."""
    shard = table = None
    at = words = None
    for b in batches:
        out = []
        for name, s, i, doc, start, n in zip(*(c.to_pylist() for c in b.columns)):
            if s != shard:
                shard, table, at = s, read_shard(shard_path(root, s))["words"], None
            if i != at:
                at, words = i, table[i].as_py().split()
            out.append((name, s, i, doc, start, n, words[start:start + n]))
        yield out


def with_words(wanted: DataFrame, root: str, parts: int) -> DataFrame:
    """The wanted passages with their words, read off the shard files."""
    def run(batches):
        for rows in read_passages(batches, root):
            if rows:
                *place, words = zip(*rows)
                yield passage_batch(*place, [b" ".join(w) for w in words])

    return by_shard(wanted, parts).select("name", "shard", "at", "doc", "start", "n").mapInArrow(run, PASSAGE)


def passage_batch(key, shard, at, doc, start, n, words):
    return record_batch(**{c: pa.array(v, pa.int64()) for c, v in zip(
        ("key", "shard", "at", "doc", "start", "n"), (key, shard, at, doc, start, n))}, words=pa.array(words, pa.binary()))


# --- reference blocks ------------------------------------------------------------------
class Block:
    """Passages as one array of word ids, and the index of their windows."""

    def __init__(self, doc, start, words, window: int):
        split = [w.split() for w in words]
        sizes = np.array([len(w) for w in split], np.int64)
        vocabulary: dict[bytes, int] = {}
        self.ids = np.fromiter((vocabulary.setdefault(x, len(vocabulary)) for w in split for x in w),
                               np.uint32, int(sizes.sum()))
        self.ends = np.cumsum(sizes)
        self.first = self.ends - sizes
        self.window = window
        # places in the corpus of every word, as ranks: equal places are equal
        inside = np.arange(len(self.ids)) - np.repeat(self.first, sizes)
        where = np.repeat(np.asarray(start, np.int64), sizes) + inside
        whose = np.repeat(np.asarray(doc, np.int64), sizes)
        order = np.lexsort((where, whose))
        new = np.append(True, (np.diff(where[order]) != 0) | (np.diff(whose[order]) != 0))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new)
        # the index: windows in the order of their words, the earliest place first
        at = np.flatnonzero(np.repeat(self.ends, sizes) - np.arange(len(self.ids)) >= window)
        at = at[np.argsort(self.place[at], kind="stable")]
        keys = np.lib.stride_tricks.sliding_window_view(self.ids, window)[at] if len(at) else np.zeros((0, window))
        keys = np.ascontiguousarray(keys, dtype=">u4").view(f"S{4 * window}").ravel()
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        source = at[first][which]              # the earliest window with the same words
        self.source = np.full(len(self.ids), -1, np.int64)
        earlier = self.place[source] < self.place[at]
        self.source[at[earlier]] = source[earlier]

    def parse(self, passage: int) -> list[tuple[int, int]]:
        """Factors (first word, words) of a passage, from its first word on."""
        lo, hi = int(self.first[passage]), int(self.ends[passage])
        out = []
        opens = np.flatnonzero(self.source[lo:hi] >= 0) + lo
        p = lo
        while True:
            k = np.searchsorted(opens, p)      # words before it are literals
            if k == len(opens):
                return out
            p = int(opens[k])
            q = int(self.source[p])
            most = min(hi - p, len(self.ids) - q)
            differ = np.flatnonzero(self.ids[p + self.window:p + most] != self.ids[q + self.window:q + most])
            size = self.window + int(differ[0]) if len(differ) else most
            size = min(size, int(self.ends[np.searchsorted(self.ends, q, "right")]) - q)
            out.append((p - lo, size))
            p += size - self.window + 1        # the first window across the factor's end


def parse_block(passages: list[tuple], window: int):
    """Spans of a block's passages (shard, at, doc, start, n, words)."""
    shard, at, doc, start, _, words = zip(*passages)
    block = Block(doc, start, words, window)
    for i in range(len(doc)):
        for p, n in block.parse(i):
            yield shard[i], at[i], doc[i], start[i] + p, n, False


def spans_of(rows: DataFrame, window: int) -> DataFrame:
    """Spans of passages sorted by name; those of a name with more text than a
    block come back whole (``large``)."""
    def run(batches):
        out: list[tuple] = []
        block: list[tuple] = []                # passages of finished names
        group: list[tuple] = []
        size = group_size = 0
        now, over = None, False

        def close():
            nonlocal size, group_size, over
            block.extend(group)
            size += group_size
            if size >= BLOCK_BYTES:
                out.extend(parse_block(block, window))
                block.clear()
                size = 0
            group.clear()
            group_size, over = 0, False

        for b in batches:
            for key, *row in zip(*(c.to_pylist() for c in b.columns)):
                if key != now:
                    close()
                    now = key
                if not over and group_size + len(row[-1]) > BLOCK_BYTES:
                    over = True
                    out.extend((*g[:-1], True) for g in group)
                    group.clear()
                    group_size = 0
                if over:
                    out.append((*row[:-1], True))
                else:
                    group.append(tuple(row))
                    group_size += len(row[-1])
                if len(out) >= 5000:
                    yield span_batch(out)
                    out = []
        close()
        if block:
            out.extend(parse_block(block, window))
        if out:
            yield span_batch(out)

    return rows.mapInArrow(run, SPAN)


def span_batch(rows):
    *place, large = zip(*rows)
    return record_batch(**{c: pa.array(v, pa.int64()) for c, v in zip(("shard", "at", "doc", "start", "n"), place)},
                        large=pa.array(large, pa.bool_()))


def window_digests(words: list[bytes], window: int) -> list[bytes]:
    """128-bit digest of each window of a passage."""
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    begins = [0, *ends]
    return [xxhash.xxh3_128_digest(text[a:z - 1]) for a, z in zip(begins, ends[window - 1:])]


def first_of_equals(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of windows (``_WINDOW``) by digest and place, and which of them in
    that order stand at the earliest place of their digest."""
    order = np.lexsort((w["start"], w["doc"], w["low"], w["high"]))
    w = w[order]
    new = np.ones(len(w), bool)
    new[1:] = (w["high"][1:] != w["high"][:-1]) | (w["low"][1:] != w["low"][:-1])
    least = w[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(w) else w
    return order, (w["doc"] == least["doc"]) & (w["start"] == least["start"])


def window_packs(wanted: DataFrame, root: str, window: int, parts: int, buckets: int) -> DataFrame:
    """The windows of the wanted passages, a shard's in one row per bucket of
    digests.  Those that stand earlier in the shard do not travel: runs of them
    are spans already."""
    def shard_rows(shard, passages):
        sizes = np.array([len(d) for *_, d in passages])
        w = np.empty(int(sizes.sum()), _WINDOW)
        digests = np.frombuffer(b"".join(x for *_, d in passages for x in d), "<u8").reshape(-1, 2)
        w["high"], w["low"] = digests[:, 0], digests[:, 1]
        base = np.cumsum(sizes) - sizes
        at, doc, start = (np.array(c, np.int64) for c in list(zip(*passages))[:3])
        w["at"], w["doc"] = np.repeat(at, sizes), np.repeat(doc, sizes)
        w["start"] = np.repeat(start - base, sizes) + np.arange(len(w))
        order, first = first_of_equals(w)
        later = np.zeros(len(w), bool)
        later[order[~first]] = True
        # runs of later windows of one passage
        opens = later.copy()
        opens[1:] &= ~later[:-1]
        opens[base] = later[base]
        begin = np.flatnonzero(opens)
        run_of = np.cumsum(opens)[later] - 1
        own = np.empty(len(begin), _OWN)
        for c in ("at", "doc", "start"):
            own[c] = w[c][begin]
        own["n"] = np.bincount(run_of, minlength=len(begin)) + window - 1
        w = w[~later]
        key = (w["high"] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(key, kind="stable")
        w, key = w[by], key[by]
        keys, begin = np.unique(key, return_index=True)
        packs = [x.tobytes() for x in np.split(w, begin[1:])]
        keys, spans = keys.tolist(), [None] * len(packs)
        if len(own):
            keys, packs, spans = [*keys, shard % buckets], [*packs, None], [*spans, own.tobytes()]
        return record_batch(key=pa.array(keys, pa.int64()), shard=pa.array([shard] * len(keys), pa.int64()),
                            windows=pa.array(packs, pa.binary()), spans=pa.array(spans, pa.binary()))

    def run(batches):
        now, held = None, []
        for rows in read_passages(batches, root):
            for _, shard, at, doc, start, _, words in rows:
                if shard != now:
                    if held:
                        yield shard_rows(now, held)
                    now, held = shard, []
                held.append((at, doc, start, window_digests(words, window)))
        if held:
            yield shard_rows(now, held)

    return by_shard(wanted, parts).select("name", "shard", "at", "doc", "start", "n").mapInArrow(run, PACK)


def later_windows(packs: DataFrame, window: int) -> DataFrame:
    """Spans of packed windows that stand earlier; packs come sorted by bucket,
    which holds all equal windows."""
    def batch(shard, w, n):
        columns = (shard, w["at"], w["doc"], w["start"], n)
        return record_batch(**{c: pa.array(v, pa.int64()) for c, v in zip(("shard", "at", "doc", "start", "n"), columns)})

    def settle(held):
        w = np.concatenate([p for _, p in held])
        shard = np.repeat(np.array([s for s, _ in held], np.int64), [len(p) for _, p in held])
        order, first = first_of_equals(w)
        later = order[~first]
        return batch(shard[later], w[later], np.full(len(later), window))

    def run(batches):
        now, held = None, []
        for b in batches:
            for key, shard, windows, spans in zip(*(c.to_pylist() for c in b.columns)):
                if spans is not None:
                    own = np.frombuffer(spans, _OWN)
                    yield batch(np.full(len(own), shard), own, own["n"])
                    continue
                if key != now:
                    if held:
                        yield settle(held)
                    now, held = key, []
                held.append((shard, np.frombuffer(windows, _WINDOW)))
        if held:
            yield settle(held)

    return packs.mapInArrow(run, PLACE)


def routed(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "key").sortWithinPartitions("key", "words", "doc", "start")


class Parsed(NamedTuple):
    """Shard files below ``root``, their numbers, and the duplicate spans."""
    root: str
    shards: DataFrame
    spans: DataFrame
    parts: int


def parse(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> Parsed:
    """Spans (shard, at, start, n) of words covered by windows that stand
    earlier; those inside a shard are in its file."""
    spark = docs.sparkSession
    root = scratch_dir(spark, "shards")
    cores = spark.sparkContext.defaultParallelism
    passages = write_shards(docs, root, text, id_col, window)
    shards = passages.filter(F.col("name").isNull()).select("shard")
    n = passages.count()
    found = copies(passages, max(cores, -(-n * 40 // PART_BYTES)))
    wanted, copied = found.filter(F.col("name").isNotNull()), found.filter(F.col("name").isNull())
    held = wanted.agg(F.sum("n")).first()[0] or 0
    parts = max(cores, -(-held * WORD_BYTES // PART_BYTES))
    parsed = write_scratch(spans_of(routed(with_words(wanted.filter(~F.col("hot")), root, parts), parts), window), "spans")
    spans = copied.drop("name", "hot").union(parsed.filter(~F.col("large")).drop("large"))
    place = ("name", "shard", "at", "doc", "start", "n")
    frequent = wanted.filter("hot").select(*place).union(
        parsed.filter("large").select(F.lit(None).cast("long").alias("name"), *place[1:]))
    windows = frequent.agg(F.sum(F.col("n") - (window - 1))).first()[0]
    if windows:
        buckets = max(BUCKETS, -(-windows * _WINDOW.itemsize // BUCKET_BYTES))
        packs = window_packs(frequent, root, window, max(cores, parts), buckets).repartition(
            max(cores, -(-windows * _WINDOW.itemsize // PART_BYTES)), "key").sortWithinPartitions("key")
        spans = spans.union(write_scratch(later_windows(packs, window), "window_spans"))
    return Parsed(root, shards, spans.select("shard", "at", "start", "n"), max(cores, parts))


def without_spans(parsed: Parsed, id_col: str, id_type) -> DataFrame:
    """Per document: id, n_words, n_removed, ``spans`` and ``kept`` (its other
    words, joined by one space)."""
    kind = f"`{id_col}` long, n_words long, n_removed long, spans array<struct<start:long,n:long>>, kept binary"
    root = parsed.root

    def shard_rows(shard, spans):
        table = read_shard(shard_path(root, shard))
        per = defaultdict(list)
        for at, start, n in spans:
            per[at].append((start, n))
        for lo in range(0, table.num_rows, 1000):
            part = table.slice(lo, 1000)
            out = []
            for i, (text, own) in enumerate(zip(part["words"].to_pylist(), part["spans"].to_pylist()), lo):
                words = text.split()
                cuts = sorted({(s["start"], s["n"]) for s in own} | set(per.get(i, ())))
                left = words
                if cuts:
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, [a for a, _ in cuts], 1)
                    np.add.at(gone, [a + n for a, n in cuts], -1)
                    left = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
                out.append((len(words), len(words) - len(left), [dict(start=a, n=n) for a, n in cuts], b" ".join(left)))
            total, removed, cuts, kept = zip(*out)
            yield record_batch(id=part["id"].combine_chunks(), n=pa.array(total, pa.int64()), r=pa.array(removed, pa.int64()),
                               s=pa.array(cuts, _SPANS), k=pa.array(kept, pa.binary()))

    def run(batches):
        shard, spans = None, []
        for b in batches:
            for s, at, start, n in zip(*(c.to_pylist() for c in b.columns)):
                if s != shard:
                    if shard is not None:
                        yield from shard_rows(shard, spans)
                    shard, spans = s, []
                if at is not None:
                    spans.append((at, start, n))
        if shard is not None:
            yield from shard_rows(shard, spans)

    every = parsed.shards.select("shard", *[F.lit(None).cast("long").alias(c) for c in ("at", "start", "n")])
    rows = by_shard(every.union(parsed.spans), parsed.parts).select("shard", "at", "start", "n")
    return rows.mapInArrow(run, kind).select(F.col(f"`{id_col}`").cast(id_type), "n_words", "n_removed", "spans",
                                             F.col("kept").cast("string").alias("kept"))


def deduplicated(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Documents without the words of windows that stand earlier in the corpus."""
    parsed = parse(docs, text=text, id_col=id_col, window=window)
    return without_spans(parsed, id_col, docs.schema[id_col].dataType)
