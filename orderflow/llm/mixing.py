"""Mixing sources to target weights by iterative proportional fitting.

Every document has a source, a language, a topic and a number of tokens
(blank-separated words).  Token weights of the (source, language, topic)
cells are summed in Spark; raking scales them in turn to the source, language
and topic marginals until these agree with the targets.  Documents are then
sampled with the calibrated probability of their cell.

Raking is bounded: a document is drawn at most once, so a cell's probability is
min(1, source factor x language factor x topic factor).  A category whose
target is more than all its tokens is taken whole, and what it cannot give
is asked of the others of its marginal in proportion to their targets; a cell that
saturates stays at 1, and the other cells of its marginals are raked to what
is left.  So ``fraction`` of the tokens is drawn whatever the number of rare categories,
and every marginal that can be met is met.  ``mixture`` returns the probability of every cell
and the asked and achieved tokens of every category.

Sources are unbounded: a round over them needs their language-topic vectors
only, and sources with equal vectors and an equal share to give are one.
Up to ``LOCAL_CELLS`` entries of these vectors are raked on the driver; beyond
that each round is a Spark job on the written table.  Every language keeps its
own marginal; topics are bounded by ``n_topics``.  The driver holds one number
per language and topic a round, whatever the number of sources.  With
``max_langs`` given, the languages beyond the most frequent ones share one
category; languages with a given target always keep theirs.

Topics are a hash vote: each word of at least seven bytes votes for one of
``n_topics`` buckets, the largest wins, ties go to the smallest bucket; a text
without such words has topic 0.  A column of topics may be given instead.

Default targets flatten each marginal: share ** ``flatten``, normalised.  A
document is kept if a hash of its id and text, taken as a number in [0, 1), is below its
probability: repeatable, and equal for repeated rows.

Defined results: a null source or language counts as the empty name; null and
empty texts have 0 tokens, weigh nothing and keep the probability of their
cell; a target for a category without tokens is ignored and the others are
renormalised; raking goes on until every marginal is within ``tolerance``.  If
the marginals cannot all be met, it stops when the error has not fallen at all
for ``STALLED`` rounds, or after ``max_rounds``, and a warning tells the error
that is left; an empty table gives an empty result.
"""

from __future__ import annotations

import logging
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from orderflow.llm.base import claim, positional, record_batch, space_words, texts_of, write_scratch

TOPIC_WORD = 7
STALLED = 200
LOCAL_CELLS = 1 << 22
log = logging.getLogger(__name__)
RESULTS = ("__topic", "__tokens", "__probability", "__kept")


def topic_of(words: list[bytes], n_topics: int) -> int:
    votes = [0] * n_topics
    for w in words:
        if len(w) >= TOPIC_WORD:
            votes[crc32(w) % n_topics] += 1
    return votes.index(max(votes))


def with_topic(docs: DataFrame, *, text: str, n_topics: int, columns: list[str]) -> DataFrame:
    """The columns with ``__topic`` and ``__tokens`` of the whole text."""
    src = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("__text"))
    keep_text = text in columns
    width = len(columns)
    at = columns.index(text) if keep_text else width
    if keep_text:
        src = src.drop("__text")

    def run(batches):
        claim(__name__)
        for batch in batches:
            words = (space_words(t) for t in texts_of(batch.column(at)))
            topics = [(topic_of(w, n_topics), len(w)) for w in words]
            out = batch if keep_text else batch.select(list(range(width)))
            yield (out.append_column("__topic", pa.array([t for t, _ in topics], pa.int32()))
                   .append_column("__tokens", pa.array([n for _, n in topics], pa.int64())))

    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in columns]).schema.fields,
                           T.StructField("__topic", T.IntegerType()), T.StructField("__tokens", T.LongType())])
    return src.mapInArrow(run, schema)


def flattened(shares: dict, flatten: float) -> dict:
    powers = {k: v ** flatten for k, v in shares.items() if v > 0}
    total = sum(powers.values())
    return {k: v / total for k, v in powers.items()}


def _targets(observed: dict, wanted: dict | None, flatten: float) -> dict:
    if wanted is None:
        return flattened(observed, flatten)
    use = {k: wanted[k] for k in observed if observed[k] > 0 and wanted.get(k, 0) > 0}
    total = sum(use.values())
    return {k: v / total for k, v in use.items()}


def bounded(targets: dict, capacity: dict, amount: float) -> dict:
    """Tokens to draw per category: ``amount`` by the targets, but no category
    beyond its capacity; what that leaves over goes to the others."""
    rate, full = amount, set()
    while True:
        more = {k for k in targets if k not in full and rate * targets[k] >= capacity[k]}
        full |= more
        free = sum(targets[k] for k in targets if k not in full)
        if not more or free <= 0:
            return {k: capacity[k] if k in full else rate * targets[k] for k in targets}
        rate = (amount - sum(capacity[k] for k in full)) / free


def factors_of(share: np.ndarray, lengths: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Per source vector the factor a with sum(v * min(1, a * w)) = share (v
    sums to 1).  The entries that a factor saturates leave less to the others,
    which raises it: repeated until no further entry saturates.  A share that
    the entries cannot give saturates all of them."""
    if not len(share):
        return np.zeros(0)
    starts = np.cumsum(lengths) - lengths
    top = np.maximum.reduceat(w, starts)
    w = np.divide(w, np.repeat(top, lengths), out=np.zeros(len(w)), where=np.repeat(top, lengths) > 0)
    full = np.zeros(len(w), bool)
    while True:
        left = share - np.add.reduceat(np.where(full, v, 0.0), starts)
        rest = np.add.reduceat(np.where(full, 0.0, v * w), starts)
        a = np.divide(left, rest, out=np.full(len(share), np.inf), where=rest > 0)
        with np.errstate(invalid="ignore"):            # no share for a blocked entry
            more = ~full & (w > 0) & (np.repeat(a, lengths) * w > 1)
        if not more.any():
            break
        full |= more
    least = np.minimum.reduceat(np.where(w > 0, w, np.inf), starts)
    whole = np.divide(1.0, least, out=np.zeros(len(least)), where=np.isfinite(least))
    a = np.where(np.isfinite(a) & (share < 1 - 1e-12), np.maximum(a, 0.0), whole)
    return np.divide(a, top, out=np.zeros(len(a)), where=top > 0)


def vectors_of(batch) -> tuple[np.ndarray, ...]:
    tokens, share, at, v = (batch.column(c) for c in ("tokens", "share", "at", "v"))
    return (tokens.to_numpy(zero_copy_only=False), share.to_numpy(zero_copy_only=False),
            at.value_lengths().to_numpy(zero_copy_only=False),
            at.flatten().to_numpy(zero_copy_only=False), v.flatten().to_numpy(zero_copy_only=False))


def drawn(vectors: tuple[np.ndarray, ...], weights: np.ndarray) -> np.ndarray:
    """Tokens drawn by spot, the sources fitted."""
    tokens, share, lengths, at, v = vectors
    w = weights[at]
    a = np.repeat(factors_of(share, lengths, v, w), lengths)
    return np.bincount(at, np.repeat(tokens, lengths) * v * np.minimum(1.0, a * w), len(weights))


class Mixture(NamedTuple):
    """``cells``: source, lang, topic, tokens, probability; ``marginals``: axis,
    category, tokens, asked (share of the targets), target and drawn (tokens);
    with the factors that ``calibrated`` joins."""
    cells: DataFrame
    marginals: DataFrame
    sources: DataFrame
    langs: dict
    topics: dict


def local_table(spark, schema: str, **columns) -> DataFrame:
    """A small table of driver values (through Arrow: no Python workers)."""
    kinds = T.StructType.fromDDL(schema)
    arrays = [pa.array(columns[f.name], to_arrow_type(f.dataType)) for f in kinds]
    return spark.createDataFrame(pa.table(arrays, names=[f.name for f in kinds]), kinds)


def rake(cells: DataFrame, *, source_targets: DataFrame, lang_targets: dict, topic_targets: dict, fraction: float,
         tolerance: float = 1e-7, max_rounds: int = 10_000) -> Mixture:
    """Bounded raking of ``cells`` (source, lang, topic, tokens) to the shares
    ``source_targets`` (source, target) and the two dicts."""
    langs, topics = sorted(lang_targets), sorted(topic_targets)
    spark, size = cells.sparkSession, len(langs) * len(topics)
    lang_at = write_scratch(local_table(spark, "lang string, l int", lang=langs, l=range(len(langs))), "rake_langs")
    topic_at = (F.create_map(*[F.lit(x) for kv in zip(topics, range(len(topics))) for x in kv])[F.col("topic")]
                if topics else F.lit(None).cast("int"))
    rows = (cells.join(lang_at, "lang").withColumn("at", F.col("l") * len(topics) + topic_at)
            .where(F.col("at").isNotNull())
            .groupBy("source").agg(F.sort_array(F.collect_list(F.struct("at", "tokens"))).alias("cells"))
            .join(source_targets, "source"))
    # at most langs x topics entries a source: a bounded vector
    per_cell = F.col("cells.tokens").cast("array<double>")
    table = write_scratch(rows.select(
        "source", "target", F.col("cells.at").alias("at"), per_cell.alias("n"),
        F.aggregate(per_cell, F.lit(0.0), lambda s, x: s + x).alias("tokens")), "rake_sources")
    total, asked = table.agg(F.coalesce(F.sum("tokens"), F.lit(0.0)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    amount = fraction * total

    # sources that cannot give their target are taken whole
    rate = amount / asked if asked else 0.0
    while True:
        whole = F.col("target") * F.lit(rate) >= F.col("tokens")
        held, free = table.agg(F.coalesce(F.sum(F.when(whole, F.col("tokens"))), F.lit(0.0)),
                               F.coalesce(F.sum(F.when(~whole, F.col("target"))), F.lit(0.0))).first()
        higher = (amount - held) / free if free > 0 else rate
        if higher <= rate * (1 + 1e-15):
            break
        rate = higher
    table = table.withColumn("share", F.least(F.lit(1.0), F.col("target") * F.lit(rate) / F.col("tokens")))
    vectors = write_scratch(table.groupBy("at", F.transform("n", lambda x: x / F.col("tokens")).alias("v"), "share")
                            .agg(F.sum("tokens").alias("tokens")).select("tokens", "share", "at", "v"), "rake_vectors")
    held = np.zeros(size)
    for r in (table.select(F.explode(F.arrays_zip("at", "n")).alias("c")).groupBy("c.at")
              .agg(F.sum("c.n").alias("n")).collect()):               # langs x topics
        held[r["at"]] = r["n"]
    held = held.reshape(len(langs), len(topics))

    def run_with(weights):
        def run(batches):
            for batch in batches:
                x = drawn(vectors_of(batch), weights)
                spots = np.flatnonzero(x)
                yield record_batch(at=pa.array(spots, pa.int32()), x=pa.array(x[spots], pa.float64()))
        return run

    def in_spark(weights):
        got = vectors.mapInArrow(run_with(weights), "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(size)
        for r in got:
            out[r["at"]] = r["x"]
        return out

    if (vectors.agg(F.sum(F.size("at"))).first()[0] or 0) <= LOCAL_CELLS:
        whole = vectors.toArrow()
        local = vectors_of((whole.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], whole.schema)])[0])
        summed = lambda weights: drawn(local, weights)
    else:
        summed = in_spark

    def wanted(names, targets, capacity):
        # categories that share no cell with the others' targets are left out
        there = {k: targets[k] for k, n in zip(names, capacity) if n > 0}
        norm = sum(there.values()) or 1.0
        found = bounded({k: x / norm for k, x in there.items()}, dict(zip(names, capacity)), amount)
        return np.array([found.get(k, 0.0) for k in names])

    want_b, want_c = wanted(langs, lang_targets, held.sum(axis=1)), wanted(topics, topic_targets, held.sum(axis=0))
    b, c = (want_b > 0).astype(float), (want_c > 0).astype(float)
    off, best, idle, rounds = np.inf, np.inf, 0, 0
    joint = np.zeros((len(langs), len(topics)))
    while total:
        joint = summed(np.outer(b, c).ravel()).reshape(joint.shape)               # sources fitted
        now_b, now_c = joint.sum(axis=1), joint.sum(axis=0)
        off = max(np.abs(now_b - want_b).max(), np.abs(now_c - want_c).max()) / amount
        idle = idle + 1 if off >= best else 0
        best = min(best, off)
        if off < tolerance or idle >= STALLED or rounds >= max_rounds:
            break
        rounds += 1
        if rounds % 2:                        # a factor never overshoots: saturated cells do not follow it
            b = np.divide(want_b * b, now_b, out=np.zeros_like(b), where=now_b > 0)
        else:
            c = np.divide(want_c * c, now_c, out=np.zeros_like(c), where=now_c > 0)
        b, c = b / (b.max() or 1.0), c / (c.max() or 1.0)
    if total and off >= tolerance:
        log.warning("mixing: a marginal is still %.3g off its target after %d rounds", off, rounds)
    spots = np.outer(b, c).ravel()

    def scaled(batches):
        for batch in batches:
            tokens, share, lengths, at, v = vectors_of(batch.select(["tokens", "share", "at", "n"]).rename_columns(
                ["tokens", "share", "at", "v"]))
            v = v / np.repeat(tokens, lengths)
            yield record_batch(source=batch.column("source"), factor=pa.array(factors_of(share, lengths, v, spots[at])))

    factors = write_scratch(table.select("source", "tokens", "share", "at", "n").mapInArrow(
        scaled, "source string, factor double"), "rake_factors")
    found = (dict(zip(langs, b.tolist())), dict(zip(topics, c.tolist())))
    chances = cells.join(factors, "source", "left").withColumn(
        "probability", probability(F.col("factor"), lookup(found[0], F.col("lang")), lookup(found[1], F.col("topic"))))
    axes = []
    for axis, name, asks, wants in (("lang", langs, lang_targets, want_b), ("topic", topics, topic_targets, want_c)):
        axes.append(local_table(spark, "axis string, category string, asked double, target double", axis=[axis] * len(name),
                                category=[str(k) for k in name], asked=[asks[k] for k in name], target=wants.tolist()))
    axes.append(table.select(F.lit("source").alias("axis"), F.col("source").alias("category"),
                             (F.col("target") / F.lit(asked or 1.0)).alias("asked"),
                             (F.col("share") * F.col("tokens")).alias("target")))
    kept = None
    for axis in ("source", "lang", "topic"):
        per = chances.groupBy(F.lit(axis).alias("axis"), F.col(axis).cast("string").alias("category")).agg(
            F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("probability")).alias("drawn"))
        kept = per if kept is None else kept.union(per)
    marginals = kept.join(axes[0].union(axes[1]).union(axes[2]), ["axis", "category"], "left").select(
        "axis", "category", "tokens", F.coalesce("asked", F.lit(0.0)).alias("asked"),
        F.coalesce("target", F.lit(0.0)).alias("target"), "drawn")
    return Mixture(chances.select("source", "lang", "topic", "tokens", "probability"), marginals,
                   factors, *found)


def lookup(values: dict, col):
    if not values:
        return F.lit(0.0)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[col], F.lit(0.0))


def probability(source, lang, topic):
    return F.least(F.lit(1.0), F.coalesce(source, F.lit(0.0)) * F.coalesce(lang, F.lit(0.0)) * topic)


def mixture(docs: DataFrame, *, text: str = "text", source: str = "source", lang: str = "lang", n_topics: int = 8,
            max_langs: int | None = None, source_targets: dict | None = None, lang_targets: dict | None = None,
            topic_targets: dict | None = None, flatten: float = 0.7, fraction: float = 0.6) -> tuple[Mixture, dict]:
    """The raked mixture of a table of documents, and the category of each
    language (its own name unless ``max_langs`` is given)."""
    spark, names = docs.sparkSession, ["__source", "__lang"]
    src = docs.select(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("__source"),
                      F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("__lang"), F.col(f"`{text}`"))
    cells = write_scratch(
        with_topic(src, text=text, n_topics=n_topics, columns=names)
        .groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"))
        .agg(F.sum("__tokens").alias("tokens")), "mix_cells").where("tokens > 0")
    by_lang = cells.groupBy("lang").agg(F.sum("tokens").alias("n")).orderBy(F.desc("n"), "lang").collect()
    names_of = {r["lang"]: r["lang"] if max_langs is None or i < max_langs or r["lang"] in (lang_targets or ())
                else "\u0000other" for i, r in enumerate(by_lang)}
    if any(k != v for k, v in names_of.items()):     # the caller's bound: the rest shares one category
        named = local_table(spark, "lang string, name string", lang=list(names_of), name=list(names_of.values()))
        cells = (cells.join(write_scratch(named, "mix_names"), "lang")
                 .groupBy("source", F.col("name").alias("lang"), "topic").agg(F.sum("tokens").alias("tokens")))
    of_lang: dict = {}
    for r in by_lang:
        of_lang[names_of[r["lang"]]] = of_lang.get(names_of[r["lang"]], 0.0) + r["n"]
    of_topic = {r["topic"]: float(r["n"]) for r in cells.groupBy("topic").agg(F.sum("tokens").alias("n")).collect()}
    total = sum(of_lang.values()) or 1.0
    per_source = cells.groupBy("source").agg(F.sum("tokens").alias("n"))
    if source_targets is None:
        wanted = per_source.select("source", F.pow(F.col("n") / F.lit(total), F.lit(flatten)).alias("target"))
    else:
        given = local_table(spark, "source string, target double", source=list(source_targets),
                            target=[float(v) for v in source_targets.values()])
        wanted = per_source.join(given, "source").where("target > 0").select("source", "target")
    mixed_ = rake(cells, source_targets=wanted, fraction=fraction,
                  lang_targets=_targets({k: v / total for k, v in of_lang.items()}, lang_targets, flatten),
                  topic_targets=_targets({k: v / total for k, v in of_topic.items()}, topic_targets, flatten))
    return mixed_, names_of


def calibrated(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", source: str = "source",
               lang: str = "lang", columns: list[str] | None = None, n_topics: int = 8, seed: int = 42,
               **options) -> DataFrame:
    """The columns (all by default) with ``__topic``, ``__tokens``,
    ``__probability`` and ``__kept``, which replace input columns of these
    names; ``options`` as of ``mixture``."""
    keep = [c for c in columns or docs.columns if c not in RESULTS]
    columns, text, id_col, source, lang = ([f"c{docs.columns.index(c)}" for c in keep], *(
        f"c{docs.columns.index(c)}" for c in (text, id_col, source, lang)))
    docs = positional(docs)
    mix, names_of = mixture(docs, text=text, source=source, lang=lang, n_topics=n_topics, **options)
    src = docs.withColumns({
        "__source": F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")),
        "__lang": F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")),
        "__draw": F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text}`"), F.lit(seed)), 11)
        / F.lit(float(1 << 53))})
    rows = with_topic(src, text=text, n_topics=n_topics,
                      columns=[*columns, *[x for x in ("__source", "__lang", "__draw")]])
    of_lang = local_table(docs.sparkSession, "__lang string, lang_factor double", __lang=list(names_of),
                          lang_factor=[mix.langs.get(v, 0.0) for v in names_of.values()])
    rows = (rows.join(mix.sources.withColumnRenamed("source", "__source"), "__source", "left")
            .join(write_scratch(of_lang, "mix_lang_factors"), "__lang", "left"))
    p = probability(F.col("factor"), F.col("lang_factor"), lookup(mix.topics, F.col("__topic")))
    return rows.select(*columns, "__topic", "__tokens", p.alias("__probability"),
                       (F.col("__draw") < p).alias("__kept")).toDF(*keep, *RESULTS)


def mixed(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", source: str = "source",
          lang: str = "lang", **options) -> DataFrame:
    """The sampled documents, all columns unchanged."""
    at = {k: f"c{docs.columns.index(c)}" for k, c in dict(text=text, id_col=id_col, source=source, lang=lang).items()}
    return calibrated(positional(docs), **at, **options).where("__kept").drop(*RESULTS).toDF(*docs.columns)
