"""Ranked lexical search by dense blocked matrix products.

The query items are dealt into tiles of bounded size.  A tile has a compact
vocabulary (only its items' words) and a weight matrix, words by items.  The
documents are read once: each is counted, and its counts of the words of every
tile are written as narrow postings, partitioned by tile.  Document
frequencies and lengths are plain aggregates of these postings.  Then every
tile's postings are multiplied: document impacts (documents by words, dense
float64) times weights (words by items), a block of documents and a block of
words at a time.  The words of a block are chosen so that no item's partial sum
can reach 2^53; so every product is an exact integer, and the partial
sums are added as 64-bit integers.

Each block of documents yields every item's k best and whatever ties with the
k-th, and a task keeps the k best by (score, smaller id); the last step is a
top-k over the tasks' lists.

Scale: one pass over the texts without a shuffle; a task holds one tile (of
``TILE_BYTES`` of item text at most, or one longer item), one shard of
documents, one dense block of ``DOC_ROWS`` x ``WORD_COLUMNS``.  The tiles are
files in the shared scratch folder, however large the query set is.

Defined results: null or empty texts have no terms; a document without a term
counts for no statistic and ranks for no item; every row of the items is an
item of its own, also where ids repeat or are null (those rank like others and
keep their null id); repeated document ids are documents of their own; ties go
to the smaller id, a null document id last; further columns are not read.
"""

from __future__ import annotations

import io
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.base import (_LETTERS, as_bytes, read_file, record_batch, task_name, texts_of, write_file,
                                write_scratch)
from orderflow.session import scratch_dir

TILE_BYTES = 1 << 20             # item text of a tile
TILE_ITEMS = 256
SHARD_BYTES = 8 << 20
CHUNK = 1 << 20                  # bytes of a text split at a time
DOC_ROWS = 1024
WORD_COLUMNS = 2048
EXACT = (1 << 53) - 1
IMPACT = 10 ** 6                 # every impact is below this
# FIXED VALUES of the score
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 8


def term_counts(text: bytes) -> tuple[Counter, int]:
    """Counts and number of the terms of a text, split in bounded chunks."""
    low, counts, n, at = text.translate(_LETTERS), Counter(), 0, 0
    while at < len(low):
        end = low.find(b" ", at + CHUNK) if at + CHUNK < len(low) else -1
        end = len(low) if end < 0 else end
        words = low[at:end].split()
        counts.update(words)
        n, at = n + len(words), end
    return counts, n


# --- item tiles --------------------------------------------------------------------
def item_tiles(items: DataFrame, text: str, id_col: str) -> list[str]:
    """Write the items as tile files (vocabulary and counts); their paths, in
    the order that numbers the tiles."""
    root = scratch_dir(items.sparkSession, "tiles")

    def write(ids, counted):
        vocabulary = sorted(set().union(*counted))
        at = dict(zip(vocabulary, range(len(vocabulary))))
        entries = sorted((at[w], k, c) for k, counts in enumerate(counted) for w, c in counts.items())
        word, item, count = (np.array(x, np.int64) for x in zip(*entries)) if entries else [np.zeros(0, np.int64)] * 3
        buf = io.BytesIO()
        for table in (pa.table({"id": pa.array(ids, pa.int64())}),
                      pa.table({"word": pa.array(vocabulary, pa.binary())}),
                      pa.table({"word": word, "item": item, "count": count})):
            with pa.ipc.new_stream(buf, table.schema) as out:
                out.write_table(table)
        path = f"{root}/tile-{task_name()}-{write.made:06d}.arrow"
        write.made += 1
        write_file(path, lambda f: f.write(buf.getvalue()))
        return record_batch(path=pa.array([path], pa.string()))

    def run(batches):
        write.made = 0
        ids, counted, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                if ids and (size + len(t) > TILE_BYTES or len(ids) >= TILE_ITEMS):
                    yield write(ids, counted)
                    ids, counted, size = [], [], 0
                ids.append(i)
                counted.append(term_counts(t)[0])
                size += len(t)
        if ids:
            yield write(ids, counted)

    src = as_bytes(items.withColumn("__id", F.col(f"`{id_col}`").cast("long")), text, "__id")
    return sorted(r["path"] for r in src.mapInArrow(run, "path string").collect())


def load_tile(path: str):
    buf = io.BytesIO(read_file(path))
    return [pa.ipc.open_stream(buf).read_all() for _ in range(3)]


# --- one pass over the documents -----------------------------------------------------
def postings(docs: DataFrame, paths: list[str], text: str, id_col: str) -> DataFrame:
    """Per document with terms a row of tile -1 with its number of terms, and
    per tile that it meets the counts of that tile's words."""
    kind = "tile int, doc long, n long, words array<int>, counts array<int>"

    def run(batches):
        loaded: dict[int, pa.Array] = {}       # the last tile's words
        for batch in batches:
            texts = texts_of(batch.column(1))
            ids = batch.column(0)
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SHARD_BYTES):
                    size += len(texts[hi])
                    hi += 1
                yield from shard(ids.slice(lo, hi - lo), texts[lo:hi], loaded)
                lo = hi

    def shard(ids, texts, loaded):
        counted = [term_counts(t) for t in texts]
        local: dict[bytes, int] = {}
        total = np.array([n for _, n in counted], np.int64)
        per = np.array([len(c) for c, _ in counted], np.int64)
        word = np.fromiter((local.setdefault(w, len(local)) for c, _ in counted for w in c), np.int64, int(per.sum()))
        count = np.fromiter((k for c, _ in counted for k in c.values()), np.int64, int(per.sum()))
        doc = np.repeat(np.arange(len(texts)), per)
        del counted
        have = np.flatnonzero(total)
        yield rows(-1, ids, have, total, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(have), np.int64))
        seen = pa.array(list(local), pa.binary())
        for tile, path in enumerate(paths):
            if tile not in loaded:
                loaded.clear()
                loaded[tile] = load_tile(path)[1]["word"].combine_chunks()
            place = pc.fill_null(pc.index_in(seen, value_set=loaded[tile]), -1).to_numpy(zero_copy_only=False)
            at = place[word] if len(word) else word
            hit = np.flatnonzero(at >= 0)
            found, n = np.unique(doc[hit], return_counts=True)
            if len(found):
                yield rows(tile, ids, found, total, at[hit], count[hit], n)

    def rows(tile, ids, which, total, words, counts, sizes):
        ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return record_batch(
            tile=pa.array(np.full(len(which), tile), pa.int32()), doc=ids.take(pa.array(which, pa.int64())),
            n=pa.array(total[which], pa.int64()),
            words=pa.ListArray.from_arrays(ends, pa.array(words.astype(np.int32))),
            counts=pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))))

    src = as_bytes(docs.withColumn("__id", F.col(f"`{id_col}`").cast("long")), text, "__id")
    return src.mapInArrow(run, kind)


# --- weights -----------------------------------------------------------------------
def tile_weights(posted: DataFrame, n_docs: int) -> DataFrame:
    """tile, word, weight of every word that a document holds."""
    found = (posted.filter("tile >= 0").select("tile", F.explode("words").alias("word"))
             .groupBy("tile", "word").agg(F.count(F.lit(1)).alias("df")))
    share = F.lit(2.0 * n_docs + 2.0) / (F.col("df") * 2 + 1)
    return found.select("tile", "word", F.floor(F.lit(1000.0) * F.log(share)).cast("long").alias("weight"))


def weight_files(weights: DataFrame) -> dict[int, str]:
    """A file of word weights for every tile; a tile's words are bounded by
    its text."""
    root = scratch_dir(weights.sparkSession, "weights")

    def run(batches):
        tile, words, values, out = None, [], [], []

        def write():
            table = pa.table({"word": np.concatenate(words), "weight": np.concatenate(values)})
            buf = io.BytesIO()
            with pa.ipc.new_stream(buf, table.schema) as sink:
                sink.write_table(table)
            path = f"{root}/weights-{tile:09d}-{task_name()}.arrow"
            write_file(path, lambda f: f.write(buf.getvalue()))
            return tile, path

        for batch in batches:
            tiles, word, weight = (c.to_numpy() for c in batch.columns)
            for t in np.unique(tiles).tolist():
                if t != tile and words:
                    out.append(write())
                    words, values = [], []
                tile = t
                words.append(word[tiles == t])
                values.append(weight[tiles == t])
        if words:
            out.append(write())
        yield record_batch(tile=pa.array([t for t, _ in out], pa.int32()), path=pa.array([p for _, p in out], pa.string()))

    made = (weights.repartition("tile").sortWithinPartitions("tile", "word")
            .select("tile", "word", "weight").mapInArrow(run, "tile int, path string"))
    return {r["tile"]: r["path"] for r in made.collect()}


class Tile:
    """Item ids and, per block of words, the dense weights (words by items)."""

    def __init__(self, path: str, weights: str):
        ids, words, entries = load_tile(path)
        self.ids = ids["id"].combine_chunks()
        n_items = len(self.ids)
        weight = np.zeros(words.num_rows, np.int64)
        known = pa.ipc.open_stream(io.BytesIO(read_file(weights))).read_all()
        weight[known["word"].to_numpy()] = known["weight"].to_numpy()
        word, item = entries["word"].to_numpy(), entries["item"].to_numpy()
        value = weight[word] * entries["count"].to_numpy()
        self.blocks = list(blocks(word, item, value, n_items, EXACT // IMPACT))


def blocks(word, item, value, n_items: int, limit: int):
    """(words, weights) blocks of at most ``WORD_COLUMNS`` words in which no
    item's weights exceed ``limit``; a weight above it is dealt over layers."""
    while len(word):
        layer = np.minimum(value, limit)
        used, at = np.unique(word, return_inverse=True)
        first = 0
        starts = np.append(np.searchsorted(word, used), len(word))      # entries are sorted by word
        sums = np.zeros(n_items, np.int64)
        for k in range(len(used)):
            mine = slice(starts[k], starts[k + 1])
            if k - first >= WORD_COLUMNS or (k > first and (sums[item[mine]] + layer[mine] > limit).any()):
                yield dense(used, at, item, layer, starts, first, k, n_items)
                first, sums[:] = k, 0
            np.add.at(sums, item[mine], layer[mine])
        yield dense(used, at, item, layer, starts, first, len(used), n_items)
        more = value > limit
        word, item, value = word[more], item[more], value[more] - limit


def dense(used, at, item, layer, starts, lo, hi, n_items):
    mine = slice(starts[lo], starts[hi])
    out = np.zeros((hi - lo, n_items))
    out[at[mine] - lo, item[mine]] = layer[mine]
    return used[lo:hi], out


# --- scoring -----------------------------------------------------------------------
def impacts(count: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of a word that stands ``count`` times in a document of ``n`` terms."""
    length = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms
    return (SCALE * count) // (1000 * count + SATURATION * length)


def scores(tile: Tile, sizes, words, impact) -> np.ndarray:
    """Exact scores, documents by items, of a block of documents."""
    total = np.zeros((len(sizes), len(tile.ids)), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    for columns, weights in tile.blocks:
        at = np.searchsorted(columns, words)
        at[at == len(columns)] = 0
        hit = np.flatnonzero(columns[at] == words)
        if len(hit):
            left = np.zeros((len(sizes), len(columns)))
            left[row[hit], at[hit]] = impact[hit]
            total += (left @ weights).astype(np.int64)
    return total


class Best:
    """The k best (score, smaller id) of every item of a tile."""

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.zeros(n_items, np.int64)
        self.item = self.doc = self.score = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def add(self, doc, known, score):
        if not len(doc):
            return
        kth = np.partition(score, len(doc) - self.k, axis=0)[len(doc) - self.k] if len(doc) > self.k else 0
        rows, items = np.nonzero((score >= np.maximum(kth, self.floor)) & (score > 0))       # all ties stay
        item = np.append(self.item, items)
        docs, knowns = np.append(self.doc, doc[rows]), np.append(self.known, known[rows])
        found = np.append(self.score, score[rows, items])
        order = np.lexsort((docs, ~knowns, -found, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[place < self.k]
        self.item, self.doc, self.known, self.score = item[place < self.k], docs[keep], knowns[keep], found[keep]
        full, last = np.unique(self.item, return_counts=True)
        ends = np.cumsum(last) - 1
        whole = last == self.k
        self.floor[full[whole]] = self.score[ends[whole]]


def top_documents(docs: DataFrame, items: DataFrame, *, k: int = 10, text: str = "text", id_col: str = "doc_id",
                  item_text: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    paths = item_tiles(items, item_text, item_col)
    folder = scratch_dir(spark, "postings")
    made = postings(docs, paths, text, id_col)
    made.write.partitionBy("tile").parquet(folder)
    posted = spark.read.schema(made.schema).option("recursiveFileLookup", "false").parquet(folder)
    n_docs, n_terms = posted.filter("tile = -1").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    files = weight_files(tile_weights(posted, n_docs))
    kind = "tile int, item int, item_id long, doc_id long, score long"

    def run(batches):
        now, tile, best = None, None, None

        def done():
            at = pa.array(best.item)
            return record_batch(tile=pa.array(np.full(len(best.item), now), pa.int32()),
                                item=at.cast(pa.int32()), item_id=tile.ids.take(at),
                                doc=pa.array(best.doc, mask=~best.known), score=pa.array(best.score))

        for batch in batches:
            tiles = batch.column(0).to_numpy()
            edges = np.append(np.flatnonzero(np.diff(tiles, prepend=tiles[0] - 1)), len(tiles)) if len(tiles) else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if tiles[lo] != now:
                    if best is not None:
                        yield done()
                    now = int(tiles[lo])
                    tile = Tile(paths[now], files[now])
                    best = Best(len(tile.ids), k)
                for at in range(lo, hi, DOC_ROWS):
                    part = batch.slice(at, min(DOC_ROWS, hi - at))
                    sizes = pc.list_value_length(part.column(3)).to_numpy()
                    words, counts = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (3, 4))
                    n = np.repeat(part.column(2).to_numpy(), sizes)
                    known = part.column(1).is_valid().to_numpy(zero_copy_only=False)
                    best.add(part.column(1).fill_null(0).to_numpy(), known,
                             scores(tile, sizes, words, impacts(counts, n, n_docs, n_terms)))
        if best is not None:
            yield done()

    hits = posted.filter("tile >= 0").select("tile", "doc", "n", "words", "counts").mapInArrow(run, kind)
    # each task's lists are short: at most k rows an item
    best = Window.partitionBy("tile", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
