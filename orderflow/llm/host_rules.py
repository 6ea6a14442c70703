"""Host-level quality rules: document rules, rule failures per host, and
failure rates shrunk with an empirical beta prior.

Document statistics are counted in one pass over the whole texts and written
as a narrow table.  Failures are summed per host (map-side combined, so a hot
host costs one row per task), the beta prior comes from the moments of the
host rates over all hosts, and each host's shrunk rate
``(failures + a) / (documents + a + b)`` decides its verdict, which is joined
back to the documents.  A host is judged against the corpus: it is rejected
if its rate, less ``z`` standard deviations of its beta posterior, is still
more than ``margin`` above the corpus rate; so a host whose documents fail far
more often than others goes, also where less than half of them fail, and a
host of few documents has to be worse to go.  A document stays if it passes the rules and its host
is not rejected.

Defined results: a null or empty text has no words and fails the length rule;
a null host counts as the host ""; repeated rows and null ids are judged row
by row; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import BLANKS, CONTINUATION, as_bytes, record_batch, space_words, texts_of, write_scratch

SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    mark = bytearray(len(words))
    for i, w in enumerate(windows):
        if count[w] > 1:
            mark[i:i + 3] = b"\x01\x01\x01"
    return sum(mark)


def text_stats(text: bytes) -> tuple[int, ...]:
    words = space_words(text)
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    return (len(words), len(text.translate(None, BLANKS + CONTINUATION)),
            len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def document_stats(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                   host: str = "source") -> DataFrame:
    """Id, ``__host`` and the counts of STATS, one row per document."""
    def run(batches):
        for batch in batches:
            rows = [text_stats(t) for t in texts_of(batch.column(2))]
            cols = zip(*rows) if rows else ([] for _ in STATS)
            yield record_batch(id=batch.column(0), host=batch.column(1),
                               **{n: pa.array(c, pa.int64()) for n, c in zip(STATS, cols)})

    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("__host"),
                      F.col(f"`{text}`"))
    return as_bytes(src, text, id_col, "__host").mapInArrow(
        run, f"`{id_col}` {id_type}, __host string, " + ", ".join(f"{n} long" for n in STATS))


def host_verdicts(stats: DataFrame, failed: str, margin: float, z: float) -> DataFrame:
    """Per host: documents, failures, shrunk failure rate and the verdict."""
    hosts = write_scratch(stats.groupBy("__host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(failed).cast("long")).alias("f")), "hosts")
    m = hosts.agg(F.sum("n"), F.sum("f"), F.sum(F.col("f") * F.col("f") / F.col("n")),
                  F.count(F.lit(1))).first()
    n, f, ff, h = (x or 0 for x in m)
    mean = f / n if n else 0.0
    noise = mean * (1 - mean) * h / n if n else 0.0
    spread = (ff / n - mean * mean if n else 0.0) - noise
    strength = mean * (1 - mean) / spread - 1 if spread > 0 else 1e6
    strength = min(1e6, max(1.0, strength))
    a, b = mean * strength, (1 - mean) * strength
    rate = (F.col("f") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    deviation = F.sqrt(rate * (F.lit(1.0) - rate) / (F.col("n") + F.lit(a + b + 1)))
    worse = rate - F.lit(z) * deviation > F.lit(mean + margin)
    return hosts.select("__host", rate.alias("host_rate"), worse.alias("host_rejected"))


def host_rules(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id", host: str = "source",
               min_words: int = 50, max_repeat_pct: int = 50, max_symbol_pct: int = 10,
               max_dup_line_pct: int = 50, word_chars: tuple[int, int] = (2, 15),
               margin: float = 0.15, z: float = 1.645) -> DataFrame:
    """Counts, rule results, the host's shrunk rate and verdict, and ``kept``."""
    n = F.col("n_words")
    base = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * n)
    soft = ((100 * F.col("n_symbols") > max_symbol_pct * n)
            | (100 * F.col("n_dup_lines") > max_dup_line_pct * F.col("n_lines"))
            | (F.col("word_chars") < word_chars[0] * n) | (F.col("word_chars") > word_chars[1] * n))
    stats = write_scratch(document_stats(docs, text=text, id_col=id_col, host=host)
                          .withColumns({"base_failed": base, "rule_failed": base | soft}), "host_stats")
    verdicts = write_scratch(host_verdicts(stats, "rule_failed", margin, z), "host_verdicts")
    return (stats.join(verdicts, "__host", "left")
            .withColumn("kept", ~F.col("rule_failed") & ~F.col("host_rejected")))
