"""Licence scan over whole texts with a positional rare-token index.

Every licence template has a located key phrase and may have further
mandatory phrases.  The index holds the postings (template, position) of the
key phrases' words.  A file's licence words are looked up from the highest
IDF down: the rarest word of a phrase proposes the phrase's possible starts,
each further word intersects them by relative position, and a start that
survives all words is a place of the phrase.  The further mandatory phrases
are then verified in the template's neighbourhood, and the template's
IDF-weighted share of words found at their aligned positions is the coverage.

IDFs are counted over all documents (one row per licence word reaches the
driver; their number is bounded by the templates).  No file, word or place is
capped.

Defined results: a null or empty text has no words and no match; repeated
rows and repeated or null ids are scanned row by row; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import as_bytes, letter_words, record_batch, texts_of


@dataclass(frozen=True)
class Template:
    label: str
    text: str                       # notice, as words
    phrases: tuple[str, ...]        # mandatory; the first one is located by the index
    base: bool = False              # the phrase alone decides


# Licence notices in common use (public texts), as lower-case words.
TEMPLATES = (
    Template("cc-by", "cc by", ("cc by",), base=True),
    Template("gpl", "general public license", ("general public license",), base=True),
    Template("reserved", "all rights reserved", ("all rights reserved",), base=True),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files", ("permission is hereby granted", "free of charge")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("apache", "licensed under the apache license", ("apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "with or without modification")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "creative commons cc0 1 0 universal public domain dedication",
             ("cc0 1 0", "public domain dedication")),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("general public license", "version 3")),
    Template("gpl-2.0", "under the terms of the gnu general public license version 2",
             ("general public license", "version 2")),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license", "subject to the terms")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or "
             "without fee is hereby granted", ("permission to use copy modify", "is hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
)

MATCH = "struct<label:string,base:boolean,start:bigint,n_words:bigint,coverage:double>"


class Index:
    """Postings of the templates' located phrases, words ranked by IDF."""

    def __init__(self, templates: tuple[Template, ...], df: dict[bytes, int], n_docs: int):
        words = {w for t in templates for w in t.text.encode().split()}
        words |= {w for t in templates for p in t.phrases for w in p.encode().split()}
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in words}
        rank = {w: i for i, w in enumerate(sorted(words, key=lambda w: (-self.idf[w], w)))}
        self.postings: dict[bytes, list[tuple[int, int, bool]]] = {}
        self.plans = []
        for t, tpl in enumerate(templates):
            key = tpl.phrases[0].encode().split()
            body = tpl.text.encode().split()
            shift = next((i for i in range(len(body)) if body[i:i + len(key)] == key), 0)
            first = min(range(len(key)), key=lambda i: (rank[key[i]], i))
            for i, w in enumerate(key):
                self.postings.setdefault(w, []).append((t, i, i == first))
            self.plans.append((tpl.label, tpl.base, len(key), body, shift,
                               [b" " + p.encode() + b" " for p in tpl.phrases[1:]],
                               sum(self.idf[w] for w in body)))
        # a posting that starts a phrase's intersection comes first within its word
        for p in self.postings.values():
            p.sort(key=lambda x: not x[2])
        self.rank = {w: rank[w] for w in self.postings}
        self.anchors = {w for w, p in self.postings.items() if any(x[2] for x in p)}
        self.needed = set(self.postings)

    def places(self, words: list[bytes]) -> list[tuple]:
        """(label, base, start, phrase words, coverage) of every verified place."""
        if self.anchors.isdisjoint(words):
            return []
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.needed:
                at.setdefault(w, []).append(i)
        starts: dict[int, set[int]] = {}
        seen: Counter = Counter()
        for w in sorted(at, key=self.rank.__getitem__):           # highest IDF first
            for t, rel, opens in self.postings[w]:
                if opens:
                    starts[t] = {p - rel for p in at[w] if p >= rel}
                elif t in starts:
                    starts[t] &= {p - rel for p in at[w]}
                seen[t] += 1
        out = []
        for t, found in starts.items():
            label, base, size, body, shift, more, weight = self.plans[t]
            if seen[t] < size:                                    # a word of the phrase is absent
                continue
            for s in sorted(found):
                lo = max(0, s - shift - len(body))
                if more:
                    near = b" " + b" ".join(words[lo:s - shift + 2 * len(body)]) + b" "
                    if not all(p in near for p in more):
                        continue
                first = s - shift
                hit = sum(self.idf[w] for i, w in enumerate(body, first)
                          if 0 <= i < len(words) and words[i] == w)
                out.append((label, base, s, size, min(1.0, hit / weight)))
        return out


def document_frequencies(docs: DataFrame, text: str, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents that hold each vocabulary word, and all documents."""
    def run(batches):
        df: Counter = Counter()
        n = 0
        for batch in batches:
            for t in texts_of(batch.column(0)):
                df.update(vocabulary.intersection(letter_words(t)))
                n += 1
        yield record_batch(word=pa.array([b"", *df], pa.binary()), n=pa.array([n, *df.values()], pa.int64()))

    rows = (as_bytes(docs, text).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    df = {bytes(r["word"]): r["n"] for r in rows}
    return df, df.pop(b"", 0)


def license_scan(docs: DataFrame, *, text: str = "text", id_col: str = "doc_id",
                 templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: id, n_words and the verified ``matches`` (label,
    base, start word, phrase words, coverage), by start within a template."""
    vocabulary = {w for t in templates for w in t.text.encode().split()}
    vocabulary |= {w for t in templates for p in t.phrases for w in p.encode().split()}
    index = Index(templates, *document_frequencies(docs, text, vocabulary))
    fields = [("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
              ("n_words", pa.int64()), ("coverage", pa.float64())]
    kind = pa.list_(pa.struct(fields))

    def run(batches):
        for batch in batches:
            n, found = [], []
            for t in texts_of(batch.column(1)):
                words = letter_words(t)
                n.append(len(words))
                found.append([dict(zip((f for f, _ in fields), p)) for p in index.places(words)])
            yield record_batch(id=batch.column(0), n=pa.array(n, pa.int64()), m=pa.array(found, kind))

    id_type = docs.schema[id_col].dataType.simpleString()
    return as_bytes(docs, text, id_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_words long, matches array<{MATCH}>")
