"""SimHash near-duplicates by pivot distance tables.

1. Fingerprints: 64-bit SimHash of the whole text's word shingles.
2. Equal fingerprints are one class (map-side combined), so copies cost
   nothing further.
3. Candidates: two fingerprints that differ in at most ``max_bits`` bits agree
   on at least two of ``max_bits + 2`` bit blocks, so each class is dealt to
   one bucket per pair of blocks and meets every partner in one of them.
4. In a bucket the Hamming distances of its fingerprints to many reference
   fingerprints (pivots) are tabled.  By the triangle inequality two
   fingerprints within ``max_bits`` have pivot distances that differ by
   ``max_bits`` at most, so a pair whose largest coordinate difference is
   more is discarded; survivors are verified on the fingerprints themselves.
5. Components: links are merged by repeated hooking and shortcutting of
   minimum labels, as joins over tables in the shared scratch folder.

A bucket of more than ``bucket_rows`` classes is cut into blocks and each
pair of blocks is a group of its own: exact, and bounded per task.  Inside a
large group, pairs that are already connected are not compared again and only
links that join two components are emitted; no link between different
components is lost.

Defined results: a null or empty text has no words and the fingerprint zero,
which links like any other; repeated rows get equal results; a null id is
never a component id unless its whole component has none; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from orderflow.llm.base import as_bytes, claim, positional, record_batch, space_words, texts_of, write_scratch

SEED = 42
N_PIVOTS = 24
BUCKET_ROWS = 8192
SMALL = 32          # groups up to this size are compared by vectorised offsets


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the text's shingles (zero without words)."""
    w = space_words(text.lower())            # bytes.lower() changes A-Z only
    if not w:
        return 0
    if len(w) <= shingle:
        joined = [b" ".join(w)]
    else:
        joined = [b" ".join(s) for s in zip(*(w[i:] for i in range(shingle)))]
    h = np.fromiter(map(xxh64_intdigest, joined, repeat(SEED)), np.uint64, len(joined))
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(joined), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", shingle: int = 4) -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint as a signed long) of every row."""
    def run(batches):
        claim(__name__)
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch.column(1))], dtype=np.uint64)
            yield record_batch(id=batch.column(0), fp=pa.array(fps.view(np.int64), pa.int64()))

    id_type = docs.schema[id_col].dataType.simpleString()
    return as_bytes(docs, text, id_col).mapInArrow(run, f"`{id_col}` {id_type}, fp long")


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random 64-bit values."""
    return np.random.default_rng(SEED).integers(0, 2 ** 64, n, dtype=np.uint64)


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def near(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs (i, j) differ in ``max_bits`` bits at most: the pivot table
    discards, the fingerprints verify."""
    ok = np.ones(len(i), bool)
    for p in range(table.shape[1]):          # pivot by pivot: most pairs fall early
        left = np.flatnonzero(ok)
        if not len(left):
            return ok
        ok[left] = np.abs(table[i[left], p] - table[j[left], p]) <= max_bits
    left = np.flatnonzero(ok)
    ok[left] = np.bitwise_count(fps[i[left]] ^ fps[j[left]]) <= max_bits
    return ok


def link_small(fps, table, group, max_bits):
    """All links inside many small groups (rows ordered by group)."""
    out_i, out_j = [], []
    n, k = len(fps), 1
    at = np.arange(n)
    while True:
        at = at[at + k < n]
        at = at[group[at] == group[at + k]]
        if not len(at):
            break
        ok = near(fps, table, at, at + k, max_bits)
        out_i.append(at[ok])
        out_j.append(at[ok] + k)
        k += 1
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_i) if out_i else empty), (np.concatenate(out_j) if out_j else empty)


def link_large(fps, table, max_bits):
    """Links that span the components of one group.  Members outside the
    largest component are compared with all others; those left at the end are
    connected already."""
    n = len(fps)
    comp, size, done = np.arange(n), np.ones(n, np.int64), np.zeros(n, bool)
    everyone = np.arange(n)
    out_i, out_j = [], []
    while True:
        open_ = np.flatnonzero(~done & (comp != np.argmax(size)))
        if not len(open_):
            break
        i = open_[0]
        done[i] = True
        others = everyone[comp != comp[i]]
        hits = others[near(fps, table, np.full(len(others), i), others, max_bits)]
        if not len(hits):
            continue
        found, first = np.unique(comp[hits], return_index=True)
        out_i.append(np.full(len(found), i))
        out_j.append(hits[first])
        joined = np.isin(comp, found)
        size[comp[i]] += size[found].sum()
        size[found] = 0
        comp[joined] = comp[i]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_i) if out_i else empty), (np.concatenate(out_j) if out_j else empty)


def links_of_groups(keys: np.ndarray, fps: np.ndarray, refs: np.ndarray, max_bits: int):
    """Links within the groups of ``keys`` (rows ordered by key)."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    group = np.repeat(np.arange(len(starts)), sizes)
    some = np.isin(group, np.flatnonzero((sizes > 1) & (sizes <= SMALL)))
    pairs = []
    x, g = fps[some], group[some]
    i, j = link_small(x, pivot_table(x, refs), g, max_bits)
    pairs.append((x[i], x[j]))
    for k in np.flatnonzero(sizes > SMALL):
        x = fps[starts[k]:starts[k] + sizes[k]]
        i, j = link_large(x, pivot_table(x, refs), max_bits)
        pairs.append((x[i], x[j]))
    a, b = (np.concatenate(p).view(np.int64) for p in zip(*pairs))
    return np.minimum(a, b), np.maximum(a, b)


def bucket_columns(fp, max_bits: int):
    """One bucket number per pair of bit blocks."""
    parts = max_bits + 2
    cuts = [64 * i // parts for i in range(parts + 1)]
    widths = [b - a for a, b in zip(cuts, cuts[1:])]
    span = 1 << 2 * max(widths)

    def block(i):
        return F.shiftrightunsigned(fp, cuts[i]).bitwiseAND(F.lit((1 << widths[i]) - 1).cast("long"))

    return [F.lit(n * span).cast("long") + F.shiftleft(block(a), widths[b]) + block(b)
            for n, (a, b) in enumerate(combinations(range(parts), 2))]


def links(classes: DataFrame, *, max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b), a < b, between the distinct fingerprints of ``classes``
    (column ``fp``); within a large bucket only links that span components."""
    refs = pivots()
    rows = classes.select("fp", F.explode(F.array(*bucket_columns(F.col("fp"), max_bits))).alias("bucket"))
    large = write_scratch(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                          .where(F.col("n") > bucket_rows), "large_buckets")
    rows = rows.withColumn("part", F.lit(0).cast("long"))
    if large.head(1):
        # cut a large bucket into blocks; every pair of blocks is a group
        rows = rows.join(large, "bucket", "left")
        blocks = F.ceil(2 * F.col("n") / F.lit(bucket_rows)).cast("long")
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        rows = (rows.withColumn("blocks", F.coalesce(blocks, F.lit(1).cast("long")))
                .withColumn("mine", mine)
                .select("fp", "bucket", "blocks", "mine",
                        F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
                .select("fp", "bucket", (F.least("mine", "other") * F.col("blocks")
                                         + F.greatest("mine", "other")).alias("part")))

    def run(batches):
        key, fp = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            new = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1)
            key = np.concatenate([key, new])
            fp = np.concatenate([fp, batch.column(0).to_numpy().view(np.uint64)])
            if not len(fp):
                continue
            # the last group may go on in the next batch
            cut = len(fp) - int(np.argmax((key[::-1] != key[-1]).any(axis=1))) if (key != key[-1]).any() else 0
            if cut:
                yield emit(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(fp):
            yield emit(key, fp)

    def emit(key, fp):
        change = np.append(0, np.cumsum((key[1:] != key[:-1]).any(axis=1)))
        a, b = links_of_groups(change, fp, refs, max_bits)
        return record_batch(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))

    return (rows.select("fp", "bucket", "part").repartition("bucket", "part")
            .sortWithinPartitions("bucket", "part", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): the smallest node that
    can be reached.  Each round hooks nodes and their labels to the smallest
    label two steps away among the neighbours and shortcuts label chains, so
    rounds grow with the logarithm of a component's length."""
    both = write_scratch(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                         .union(edges.select("b", "a")), "edges")
    label = write_scratch(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("f")), "labels")
    total = None
    while True:
        now = label.agg(F.sum(F.col("f").cast("decimal(38,0)"))).first()[0]
        if now == total:                     # labels only fall, so an equal sum is a fixed point
            return label.select(F.col("u").alias("node"), F.col("f").alias("root"))
        total = now
        up = label.select(F.col("u").alias("f"), F.col("f").alias("g"))
        twice = write_scratch(label.join(up, "f").select("u", "f", "g"), "labels2")
        low = (both.join(twice.select(F.col("u").alias("v"), "g"), "v")
               .groupBy("u").agg(F.min("g").alias("m")))
        new = twice.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.least("g", "m").alias("f")),
            F.struct(F.col("f").alias("u"), F.col("m").alias("f")))).alias("x")).select("x.*")
        label = write_scratch(new.groupBy("u").agg(F.min("f").alias("f")), "labels")


def groups(docs: DataFrame, *, text: str, id_col: str, shingle: int, max_bits: int,
           bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every document, and (fp, root, component_id) of every
    distinct fingerprint."""
    docs_fp = write_scratch(fingerprints(docs, text=text, id_col=id_col, shingle=shingle), "fingerprints")
    classes = write_scratch(docs_fp.groupBy("fp").agg(F.min(F.col(f"`{id_col}`")).alias("first")), "classes")
    roots = components(write_scratch(links(classes, max_bits=max_bits, bucket_rows=bucket_rows), "links"))
    linked = write_scratch(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")
    firsts = linked.groupBy("root").agg(F.min("first").alias("component"))
    found = linked.join(firsts, "root").select("fp", "root", "component")
    return docs_fp, write_scratch(
        classes.join(found, "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "first").alias("component_id")),
        "class_ids")


def near_duplicates(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", shingle: int = 4,
                    max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document: id, ``fp`` and ``component_id`` (the smallest id of all
    documents that links lead to, itself included)."""
    docs_fp, class_ids = groups(docs, text=text, id_col=id_col, shingle=shingle, max_bits=max_bits,
                                bucket_rows=bucket_rows)
    return docs_fp.join(class_ids, "fp").select(F.col(f"`{id_col}`"), "fp", "component_id")


def one_per_group(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", shingle: int = 4,
                  max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One document of each near-duplicate group, all columns unchanged: the
    one with the group's smallest id (of rows that repeat this id in the group,
    the one with the smallest text).  A group without any id keeps the row with
    the smallest text.  Where rows of one id are in several groups, a row
    stands for its own group only."""
    columns = docs.columns
    at, docs = columns.index(text), positional(docs)
    names = docs.columns
    text, id_col = names[at], names[columns.index(id_col)]
    docs_fp, class_ids = groups(docs, text=text, id_col=id_col, shingle=shingle, max_bits=max_bits,
                                bucket_rows=bucket_rows)
    key, by_text = F.col(id_col), F.col(text).asc_nulls_first()

    def first_of(rows, group):
        rank = F.row_number().over(Window.partitionBy(group).orderBy(by_text))
        return rows.withColumn("__row", rank).where(F.col("__row") == 1).select(*names)

    firsts = class_ids.where(F.col("component_id").isNotNull()).select(F.col("component_id").alias("__first")).distinct()
    # ids whose rows have different fingerprints: the group is told by the row's own
    split = docs_fp.where(key.isNotNull()).groupBy(key.alias("__first")).agg(
        (F.min("fp") != F.max("fp")).alias("__split"))
    firsts = write_scratch(firsts.join(split, "__first"), "group_firsts")
    once = docs.join(firsts.where(~F.col("__split")).drop("__split"), key == F.col("__first"))
    named = first_of(once, "__first")

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch.column(at))], dtype=np.uint64)
            yield batch.append_column("__fp", pa.array(fps.view(np.int64), pa.int64()))

    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    rest = docs.where(key.isNull())
    if not firsts.where("__split").isEmpty():
        rest = docs.join(firsts.where("__split").select("__first"), key == F.col("__first"), "left_semi").unionByName(rest)
    rest = rest.mapInArrow(run, schema)
    ids = class_ids.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("component_id").alias("__id"))
    rest = rest.join(ids, "__fp").where(key.eqNullSafe(F.col("__id")))
    return named.union(first_of(rest, "__root")).toDF(*columns)
