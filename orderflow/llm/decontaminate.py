"""Benchmark decontamination with suffix arrays over the training documents.

A shard is a run of whole documents of one Arrow batch.  Its words become
ids of its own (0 for words that no benchmark item has and at document
ends), and its suffix array is the sorted order of the suffixes that can hold
a window, compared on their first ``window`` words.  It is built once and
serves every block of the benchmark: each window of a block
(each suffix of an item, cut to the window) whose words, and whose sum of
words, the shard has is binary-searched in it; the range found gives all its locations.  Windows that follow one another
on the same diagonal (document position minus item position) make the longest
verbatim match.  Documents never leave their task, so nothing is shuffled.

The benchmark is written as block files of bounded size in the shared scratch
folder, as arrays that are used as they are read: the vocabulary, the distinct
windows as word numbers, and where each stands.  A task holds one shard and
``KEPT_BYTES`` of blocks, however large the benchmark is.

Defined results: null or empty texts have no words (never hit, never a
window); an item with fewer words than the window is one window; repeated
items or ids count once per id, an item with a null id marks words but is not
listed; documents with repeated or null ids are judged row by row; empty
tables give no hits; further columns are not read.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import (as_bytes, claim, filter_rows, letter_words, read_file, record_batch, task_name, texts_of,
                                write_file)
from orderflow.session import scratch_dir

SHARD_BYTES = 4 << 20
BLOCK_BYTES = 2 << 20
KEPT_BYTES = 32 << 20
MATCH = "struct<item_id:bigint,item_start:bigint,doc_start:bigint,n_words:bigint>"


def benchmark_blocks(benchmark: DataFrame, *, window: int, text: str = "text", id_col: str = "item_id",
                     block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Write the benchmark as block files of about ``block_bytes`` of text
    (one longer item is a block of its own); their paths."""
    root = scratch_dir(benchmark.sparkSession, "benchmark")

    def run(batches):
        ids, texts, size, made = [], [], 0, 0

        def flush():
            nonlocal ids, texts, size, made
            path = f"{root}/block-{task_name()}-{made:06d}.arrow"
            data = block_data(ids, texts, window)
            write_file(path, lambda f: f.write(data))
            ids, texts, size, made = [], [], 0, made + 1
            return record_batch(path=pa.array([path], pa.string()))

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                if ids and size + len(t) > block_bytes:
                    yield flush()
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield flush()

    src = as_bytes(benchmark.withColumn("__id", F.col(f"`{id_col}`").cast("long")), text, "__id")
    return sorted(r["path"] for r in src.mapInArrow(run, "path string").collect())


def block_data(ids: list, texts: list[bytes], window: int) -> bytes:
    """A block: its items, its vocabulary, and per window length the distinct
    windows (rows of word numbers) with the (item, offset) pairs of each."""
    vocabulary: dict[bytes, int] = {}
    split = [letter_words(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    flat = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for words in split for w in words), np.uint32,
                       int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    tables = [pa.table({"id": pa.array(ids, pa.int64())}), pa.table({"word": pa.array(list(vocabulary), pa.binary())})]
    lengths = np.minimum(sizes, window)
    for size in np.unique(lengths[lengths > 0]).tolist():
        mine = np.flatnonzero(lengths == size)
        n = sizes[mine] - size + 1
        item = np.repeat(mine, n)
        offset = expand(np.zeros(len(mine), np.int64), n)
        rows = flat[(first[item] + offset)[:, None] + np.arange(size)]
        keys = np.ascontiguousarray(rows, ">u4").view(f"S{4 * size}").ravel()
        _, one, which = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(which, kind="stable")
        tables.append(pa.table({"word": rows[one].ravel()}))
        tables.append(pa.table({"n": np.bincount(which, minlength=len(one))}))
        tables.append(pa.table({"item": item[order], "offset": offset[order]}))
    buf = io.BytesIO()
    for table in tables:
        with pa.ipc.new_stream(buf, table.schema) as out:
            out.write_table(table)
    return buf.getvalue()


class Windows:
    """The benchmark block's vocabulary and its distinct windows by length."""

    def __init__(self, path: str):
        data = read_file(path)
        self.size = len(data)
        buf = io.BytesIO(data)
        tables = []
        while buf.tell() < self.size:
            tables.append(pa.ipc.open_stream(buf).read_all().combine_chunks())
        self.item_ids = tables[0]["id"].fill_null(0).to_numpy()
        self.valid = tables[0]["id"].is_valid().to_numpy()
        self.words = tables[1]["word"].combine_chunks()
        # per length: distinct windows (rows of words), the pairs of each as ranges
        self.lengths = []
        for rows, n, pairs in zip(tables[2::3], tables[3::3], tables[4::3]):
            n = n["n"].to_numpy()
            rows = rows["word"].to_numpy().reshape(len(n), -1)
            pairs = np.stack([pairs["item"].to_numpy(), pairs["offset"].to_numpy()], axis=1)
            self.lengths.append((rows.shape[1], rows, pairs, np.cumsum(n)))
        self.depth = max((x[0] for x in self.lengths), default=0)
        self.shortest = min((x[0] for x in self.lengths), default=1 << 30)


def load_windows(path: str) -> Windows:
    """Blocks that fit together stay from shard to shard."""
    kept: dict[str, Windows] = claim(__name__, "blocks", dict)
    if path not in kept:
        block = Windows(path)
        if sum(b.size for b in kept.values()) + block.size > KEPT_BYTES:
            kept.clear()
        kept[path] = block
    return kept[path]


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] times, for all i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def suffix_array(ids: np.ndarray, shortest: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes with ``shortest`` known words at least, in
    order of their first ``depth`` words, and those words as byte keys."""
    stops = np.flatnonzero(ids == 0)         # the array ends with a 0
    run = stops[np.searchsorted(stops, np.arange(len(ids)))] - np.arange(len(ids))
    at = np.flatnonzero(run >= max(1, shortest))
    padded = np.concatenate([ids, np.zeros(depth, ids.dtype)])
    keys = np.ascontiguousarray(padded[at[:, None] + np.arange(depth)].astype(">u4"))
    # words behind a document's end belong to the next one: blank them
    keys[np.arange(depth) >= run[at][:, None]] = 0
    keys = keys.view(f"S{4 * depth}").ravel()
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Sums(dict):
    """Per window length the sorted word sums of a shard's windows.  Equal
    windows have equal sums, so most windows of a block need no search."""

    def __init__(self, ids: np.ndarray):
        super().__init__()
        self.ids = ids

    def __missing__(self, size: int) -> np.ndarray:
        out = np.zeros(max(0, len(self.ids) - size + 1), np.uint64)
        for k in range(size):
            out = out * _MIX + self.ids[k:k + len(out)].astype(np.uint64)
        self[size] = np.sort(out)
        return self[size]


def search_block(at: np.ndarray, keys: np.ndarray, depth: int, block: Windows, known: np.ndarray, sums: Sums):
    """(document positions, window length, item, offset) of every occurrence of
    a block's windows; ``known`` turns its words into the shard's (0: none)."""
    out = []
    for size, rows, pairs, ends in block.lengths:
        here = np.flatnonzero(known[rows[:, 0]] > 0)
        total = np.zeros(len(here), np.uint64)
        for k in range(size):                    # word by word: the shard has all their words, and their sum
            word = known[rows[here, k]]
            stay = np.flatnonzero(word > 0)
            here, total = here[stay], total[stay] * _MIX + word[stay].astype(np.uint64)
        have = sums[size]
        found = np.searchsorted(have, total)
        here = here[have[np.minimum(found, len(have) - 1)] == total] if len(have) else here[:0]
        if not len(here):
            continue
        tests = np.ascontiguousarray(known[rows[here]], ">u4").view(f"S{4 * size}").ravel()
        cut = keys if size == depth else np.ascontiguousarray(
            keys.view("u1").reshape(len(keys), -1)[:, :4 * size]).view(f"S{4 * size}").ravel()
        lo = np.searchsorted(cut, tests, "left")
        n = np.searchsorted(cut, tests, "right") - lo
        found = np.flatnonzero(n)
        if not len(found):
            continue
        where = at[expand(lo[found], n[found])]
        which = here[np.repeat(found, n[found])]         # the window of each occurrence
        per = np.diff(ends, prepend=0)[which]
        rows_at = expand((ends - np.diff(ends, prepend=0))[which], per)
        out.append((np.repeat(where, per), size, pairs[rows_at, 0], pairs[rows_at, 1]))
    return out


def longest_matches(pos, size, item, offset, bounds):
    """Merge windows on one diagonal into maximal matches: (doc, item,
    item_start, doc_start, n_words)."""
    order = np.lexsort((pos, pos - offset, item))
    pos, item, offset = pos[order], item[order], offset[order]
    new = np.ones(len(pos), bool)
    new[1:] = ((np.diff(item) != 0) | (np.diff(pos - offset) != 0) | (np.diff(pos) != 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pos)) - 1
    doc = np.searchsorted(bounds, pos[first], "right") - 1
    return doc, item[first], offset[first], pos[first] - bounds[doc], pos[last] - pos[first] + size


def shard_hits(texts: list[bytes], paths: list[str]):
    """Per document: words, hit words, item ids and longest matches."""
    words = [letter_words(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    bounds = np.append(0, np.cumsum(n + 1))              # each document ends with a 0
    hit = np.zeros(int(bounds[-1]) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    matches: list[list] = [[] for _ in texts]
    local: dict[bytes, int] = {}
    ids = np.zeros(int(bounds[-1]), np.int64)
    for b, w in zip(bounds, words):
        ids[b:b + len(w)] = np.fromiter((local.setdefault(x, len(local) + 1) for x in w), np.int64, len(w))
    names = pa.array(list(local), pa.binary())
    del words, local

    def known(block):
        return (pc.fill_null(pc.index_in(block.words, value_set=names), -1).to_numpy(zero_copy_only=False) + 1).astype(np.int32)

    use, shortest, depth = np.zeros(len(names) + 1, bool), 1 << 30, 0
    for path in paths:
        block = load_windows(path)
        use[known(block)] = True
        shortest, depth = min(shortest, block.shortest), max(depth, block.depth)
    use[0] = False
    ids = np.where(use[ids], ids, 0).astype(np.int32)
    at, keys = suffix_array(ids, shortest, depth) if depth and len(ids) else (ids[:0], None)
    sums = Sums(ids)
    for path in paths if len(at) else []:
        win = load_windows(path)
        for pos, size, item, offset in search_block(at, keys, depth, win, known(win), sums):
            np.add.at(hit, pos, 1)
            np.add.at(hit, pos + size, -1)
            for d, k, o, p, m in zip(*(x.tolist() for x in longest_matches(pos, size, item, offset, bounds))):
                valid = bool(win.valid[k])
                if valid:
                    items[d].add(int(win.item_ids[k]))
                matches[d].append((int(win.item_ids[k]) if valid else None, o, p, m))
    covered = np.append(0, np.cumsum(np.cumsum(hit[:-1]) > 0))
    n_hit = covered[bounds[1:]] - covered[bounds[:-1]]
    return n, n_hit, [sorted(x) for x in items], matches


def shards(texts: list[bytes]):
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SHARD_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    yield lo, len(texts)


def contamination(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                  item_col: str = "item_id", window: int = 10) -> DataFrame:
    """Per document: n_words, n_hit, ``items`` (ids with a window in it) and
    ``matches`` (longest verbatim matches: item, item_start, doc_start, words)."""
    paths = benchmark_blocks(benchmark, window=window, id_col=item_col)
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("item_id", "item_start", "doc_start", "n_words")]))

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in shards(texts):
                n, n_hit, items, matches = shard_hits(texts[lo:hi], paths)
                rows = [[dict(zip(("item_id", "item_start", "doc_start", "n_words"), m)) for m in ms]
                        for ms in matches]
                yield record_batch(id=batch.column(0).slice(lo, hi - lo), n=pa.array(n, pa.int64()),
                                   h=pa.array(n_hit, pa.int64()), i=pa.array(items, pa.list_(pa.int64())),
                                   m=pa.array(rows, kind))

    id_type = docs.schema[id_col].dataType.simpleString()
    return as_bytes(docs, text, id_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_words long, n_hit long, items array<long>, matches array<{MATCH}>")


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", window: int = 10) -> DataFrame:
    """The documents without any benchmark window, all columns unchanged."""
    paths = benchmark_blocks(benchmark, window=window)
    return filter_rows(docs, text, lambda texts: [
        h == 0 for lo, hi in shards(texts) for h in shard_hits(texts[lo:hi], paths)[1].tolist()])
