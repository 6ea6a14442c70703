"""Quality classifier: regularised quadratic discriminant analysis over
transformed document statistics.

Statistics of the whole text are transformed (logarithms, square roots,
arcsine) so that each class is near a normal distribution, and standardised
with the pooled mean and deviation.  A class covariance is shrunk towards the
pooled one (``to_pooled``) and towards the unit matrix (``to_unit``).  The
score is the logistic of the log-density difference, computed from Mahalanobis
distances with the cached Cholesky factors, plus the log prior ratio.

Training is a Spark job over all labelled rows: each task sums counts, values
and products per class, and only these sums (two classes, d + d*d numbers)
reach the driver.

Defined results: a null or empty text has all statistics zero and is scored
like any other; a null id or label is never learned from; a document with
labels that disagree is learned as label 1; without rows of both classes the
score is 1.0 (only label 1), 0.0 (only label 0) or 0.5 (none); repeated rows
get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import islice
from math import asin, log1p, sqrt
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import (BLANKS, CONTINUATION, as_bytes, claim, filter_rows, record_batch, space_words,
                                texts_of, write_scratch)

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGITS, SYMBOLS, STOPS = b"0123456789", b"#*$%&|<>", b".,;:?"
HIGH = bytes(range(0x80, 0x100))

FEATURES = ("words", "word_length", "upper", "exclamations", "symbols", "digits", "adjacent_repeats",
            "distinct_words", "repeated_lines", "stops", "non_ascii", "words_per_line")


def features(text: bytes) -> list[float]:
    """The transformed statistics of one text."""
    words = space_words(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)

    def count(chars):
        return len(text) - len(text.translate(None, chars))

    chars = len(text.translate(None, BLANKS + CONTINUATION))
    upper, high = count(UPPER), count(HIGH) - count(CONTINUATION)
    letters = upper + count(LOWER) + high
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    return [
        log1p(n), log1p(chars / n), asin(sqrt(upper / letters)) if letters else 0.0,
        sqrt(min(1.0, count(b"!") / n)), sqrt(min(1.0, count(SYMBOLS) / n)), sqrt(count(DIGITS) / chars),
        sqrt(sum(map(eq, words, islice(words, 1, None))) / n), len(set(words)) / n,
        sqrt(1 - len(set(lines)) / len(lines)), sqrt(min(1.0, count(STOPS) / n)), sqrt(high / chars),
        log1p(n / len(lines)),
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))


class Discriminant:
    """The fitted model; ``score`` is P(label 1) for rows of statistics."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], *, to_pooled: float, to_unit: float):
        n = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
        self.constant = None
        if not (n[0] and n[1]):
            self.constant = 1.0 if n[1] else 0.0 if n[0] else 0.5
            return
        total = n[0] + n[1]
        self.shift = (sums[0][1] + sums[1][1]) / total
        within = {k: sums[k][2] / n[k] - np.outer(sums[k][1], sums[k][1]) / n[k] ** 2 for k in (0, 1)}
        pooled = (n[0] * within[0] + n[1] * within[1]) / total
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        pooled = pooled / np.outer(self.scale, self.scale)
        self.classes = []
        for k in (0, 1):
            own = within[k] / np.outer(self.scale, self.scale)
            cov = (1 - to_unit) * ((1 - to_pooled) * own + to_pooled * pooled) + to_unit * np.eye(len(self.scale))
            factor = np.linalg.cholesky(cov)
            self.classes.append(((sums[k][1] / n[k] - self.shift) / self.scale, np.linalg.inv(factor).T,
                                 2 * np.log(np.diag(factor)).sum()))
        self.prior = np.log(n[1] / n[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.shift) / self.scale
        density = [-0.5 * ((((z - mean) @ whiten) ** 2).sum(axis=1) + logdet)
                   for mean, whiten, logdet in self.classes]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.prior, -500, 500)))


def held_out(id_col, folds: int = 5, fold: int = 0):
    """Rows never learned from: crc32 of the id as text in the fold, or no id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == fold, F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, *, label: str = "quality", id_col: str = "doc_id",
        to_pooled: float = 0.1, to_unit: float = 0.05) -> Discriminant:
    """Fit on the rows of ``stats`` (``__id``, ``held_out``, ``x``) that are not
    held out and have a label."""
    marks = (labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
             .groupBy(F.col(f"`{id_col}`").alias("__id")).agg((F.max(F.col(f"`{label}`")) > 0).cast("int").alias("y")))
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            y = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            for k in (0, 1):
                rows = x[y == k]
                if len(rows):
                    values = np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
                    yield record_batch(y=pa.array(np.full(len(values), k), pa.int32()),
                                       at=pa.array(np.arange(len(values)), pa.int32()),
                                       value=pa.array(values, pa.float64()))

    parts = (stats.where(~F.col("held_out")).join(marks, "__id").select("y", "x")
             .mapInArrow(run, "y int, at int, value double")
             .groupBy("y", "at").agg(F.sum("value").alias("value")).collect())
    sums = {}
    for k in {r["y"] for r in parts}:
        v = np.zeros(1 + d + d * d)
        for r in parts:
            if r["y"] == k:
                v[r["at"]] = r["value"]
        sums[k] = (v[0], v[1:1 + d], v[1 + d:].reshape(d, d))
    return Discriminant(sums, to_pooled=to_pooled, to_unit=to_unit)


def document_features(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``__id``, ``held_out`` and the statistics ``x`` of every document."""
    def run(batches):
        claim(__name__)
        for batch in batches:
            x = pa.FixedSizeListArray.from_arrays(pa.array(matrix(texts_of(batch.column(2))).ravel(), pa.float64()),
                                                  len(FEATURES)).cast(pa.list_(pa.float64()))
            yield record_batch(id=batch.column(0), h=batch.column(1), x=x)

    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), held_out(id_col).alias("held_out"), F.col(f"`{text}`"))
    return as_bytes(src, text, "__id", "held_out").mapInArrow(
        run, f"__id {id_type}, held_out boolean, x array<double>")


def quality_scores(docs: DataFrame, labels: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                   threshold: float = 0.3) -> DataFrame:
    """Per document: id, held_out, score and predicted (score >= threshold)."""
    stats = write_scratch(document_features(docs, text=text, id_col=id_col), "quality_stats")
    model = fit(stats, labels)

    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(FEATURES))
            s = model.score(x)
            yield record_batch(id=batch.column(0), h=batch.column(1), s=pa.array(s, pa.float64()),
                               p=pa.array((s >= threshold).astype(np.int32), pa.int32()))

    id_type = docs.schema[id_col].dataType.simpleString()
    return stats.mapInArrow(run, f"`{id_col}` {id_type}, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                   threshold: float = 0.3) -> DataFrame:
    """The documents scored at least ``threshold``, all columns unchanged."""
    stats = write_scratch(document_features(docs, text=text, id_col=id_col), "quality_stats")
    model = fit(stats, labels)
    return filter_rows(docs, text, lambda texts: (model.score(matrix(texts)) >= threshold).tolist())
