"""Language identification: multinomial naive Bayes over hashed character
n-grams.

The n-grams (1 to 3 code points) of the lower-cased whole text are hashed
into 2**15 features with vectorised arithmetic.  Training counts features per
language in each task and sums them in Spark; tasks make the log-probability
matrix (features x languages) in blocks of ``BLOCK_LANGS`` languages (8 MB).
While all blocks together are at most ``SHARED_BYTES`` they are broadcast; more
languages stay block files in the shared scratch folder.  Tasks score batches
of sparse rows with numpy gathers, a block at a time, and keep the best
language and the sum of the posteriors; so the number of languages is not
bounded, and the driver holds one row per language.

Defined results: a null text or one without any letter is ``und`` with score
0.0; rows with a null id or a null language are never learned from; ties go to
the first language in alphabetical order; without training rows everything is
``und``; repeated rows get equal results; an empty table gives an empty
result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.base import claim, read_file, record_batch, task_name, write_file, write_scratch
from orderflow.session import scratch_dir

BITS = 15
ORDERS = (1, 2, 3)
BLOCK_LANGS = 64                 # languages of a block of the matrix
SHARED_BYTES = 64 << 20          # of blocks that are broadcast, or kept in a task
GROUP_CHARS = 1 << 20            # of texts scored together
GATHER = 1 << 13
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def hashed_ngrams(text: str, bits: int = BITS) -> np.ndarray:
    """Feature numbers of all n-grams of the text."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], np.zeros(len(code), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(code) < n:
            break
        h = (h[:len(code) - n + 1] ^ code[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            out.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def fit(docs: DataFrame, *, text: str, id_col: str, lang: str, held, bits: int,
        smoothing: float) -> tuple[list[str], list[str]]:
    """Languages (sorted) and the files of their log-probabilities (features x
    languages of a block; the last row holds the log priors)."""
    size = 1 << bits

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def sums():
            for name, own in counts.items():
                at = np.flatnonzero(own)
                yield record_batch(lang=pa.array([name] * len(at), pa.string()), at=pa.array(at, pa.int32()),
                                   n=pa.array(own[at], pa.int64()))
            counts.clear()

        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name not in counts and len(counts) >= 4 * BLOCK_LANGS:     # bounded; Spark adds them up
                    yield from sums()
                own = counts.setdefault(name, np.zeros(size + 1, np.int64))
                own[size] += 1
                grams = hashed_ngrams(t, bits)
                if len(grams) > size // 8:
                    own[:size] += np.bincount(grams, minlength=size)
                else:
                    np.add.at(own, grams, 1)
        yield from sums()

    train = docs.where(~held & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    counts = write_scratch(
        train.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`"))
        .mapInArrow(run, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")), "langid_counts")
    n_docs = counts.where(F.col("at") == size).groupBy("lang").agg(F.sum("n").alias("n")).collect()
    of = {r["lang"]: r["n"] for r in n_docs}             # a row per language
    langs, total = sorted(of), sum(of.values())
    root = scratch_dir(docs.sparkSession, "langid")

    def blocks(batches):
        block, rows, out = None, [], []

        def write():
            own = langs[block * BLOCK_LANGS:(block + 1) * BLOCK_LANGS]
            where = dict(zip(own, range(len(own))))
            matrix = np.zeros((size + 1, len(own)))
            for name, at, n in rows:
                matrix[at, np.fromiter(map(where.__getitem__, name), np.int64, len(name))] = n
            grams = matrix[:size] + smoothing
            matrix[:size] = np.log(grams / grams.sum(axis=0))
            matrix[size] = np.log(matrix[size] / total)
            path = f"{root}/block-{block:06d}-{task_name()}"
            write_file(path, lambda f: f.write(matrix.astype("<f4").tobytes()))
            return block, path

        for batch in batches:
            here = batch.column(0).to_numpy()
            for k in np.unique(here).tolist():
                if k != block and rows:
                    out.append(write())
                    rows = []
                block = k
                part = batch.filter(pa.array(here == k))
                rows.append((part.column(1).to_pylist(), part.column(2).to_numpy(), part.column(3).to_numpy()))
        if rows:
            out.append(write())
        yield record_batch(block=pa.array([b for b, _ in out], pa.int32()), path=pa.array([p for _, p in out], pa.string()))

    kinds = T.StructType.fromDDL("lang string, block int")
    block_of = docs.sparkSession.createDataFrame(pa.table({
        "lang": pa.array(langs, pa.string()), "block": pa.array([i // BLOCK_LANGS for i in range(len(langs))], pa.int32())}),
        kinds)
    made = (counts.join(block_of, "lang").repartition("block").sortWithinPartitions("block", "lang", "at")
            .select("block", "lang", "at", "n").mapInArrow(blocks, "block int, path string"))
    paths = {r["block"]: r["path"] for r in made.collect()}
    return langs, [paths[b] for b in sorted(paths)]


def matrix_of(data: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(data, "<f4").reshape((1 << bits) + 1, -1)


def load_matrix(path: str, bits: int) -> np.ndarray:
    """Block files that fit together stay from batch to batch."""
    kept: dict[str, np.ndarray] = claim(__name__, "blocks", dict)
    if path not in kept:
        if (len(kept) + 1) * BLOCK_LANGS * 4 << bits > SHARED_BYTES:
            kept.clear()
        kept[path] = matrix_of(read_file(path), bits)
    return kept[path]


def held_out(id_col: str, folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == fold, F.lit(True))


def identify(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", lang: str = "lang",
             bits: int = BITS, smoothing: float = 0.5) -> DataFrame:
    """Per document: id, held_out, lang_pred and score (the posterior of the
    predicted language)."""
    held = held_out(id_col)
    langs, paths = fit(docs, text=text, id_col=id_col, lang=lang, held=held, bits=bits, smoothing=smoothing)
    fits = len(paths) * BLOCK_LANGS * 4 << bits <= SHARED_BYTES        # known before anything is broadcast
    shared = docs.sparkSession.sparkContext.broadcast([read_file(p) for p in paths]) if fits and paths else None

    def matrices():
        if shared is not None:
            yield from (matrix_of(data, bits) for data in shared.value)
        else:
            yield from (load_matrix(path, bits) for path in paths)

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if langs and t is not None and has_letter(t)]
            for lo, hi in groups([len(texts[i]) for i in todo], GROUP_CHARS):
                some = todo[lo:hi]
                grams = [hashed_ngrams(texts[i], bits) for i in some]
                best = np.full(len(some), -np.inf)
                mass, which = np.zeros(len(some)), np.zeros(len(some), np.int64)
                first = 0
                for table in matrices():
                    for k, g in enumerate(grams):
                        post = table[-1].astype(np.float64)
                        for i in range(0, len(g), GATHER):       # bounded gathers for very long texts
                            post += table.take(g[i:i + GATHER], axis=0).sum(axis=0, dtype=np.float64)
                        top = int(np.argmax(post))
                        if post[top] > best[k]:
                            mass[k] *= np.exp(best[k] - post[top])
                            best[k], which[k] = post[top], first + top
                        mass[k] += np.exp(post - best[k]).sum()
                    first += table.shape[1]
                for k, i in enumerate(some):
                    pred[i], score[i] = langs[which[k]], float(1 / mass[k])
            yield record_batch(id=batch.column(0), h=batch.column(1), p=pa.array(pred, pa.string()),
                               s=pa.array(score, pa.float64()))

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`"), held.alias("__held"), F.col(f"`{text}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double")


def groups(sizes: list[int], limit: int):
    """Ranges of about ``limit`` in sum."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if sizes:
        yield lo, len(sizes)
