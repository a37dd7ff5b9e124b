"""Licence scan by a positional index of rare licence words.

Words are runs of digits, ``a-z`` and non-ASCII characters after lower-casing
A-Z.  One pass counts, for every word of the licence templates, the documents
that hold it; its IDF ranks the words of each template.  A template is indexed
under its highest-IDF words (one for a phrase, ``RARE_WORDS`` for a longer
notice) with their positions.  In the second pass each occurrence of an
indexed word proposes an alignment of the template, all its words are
compared at their relative positions, and the template counts when enough of
them agree and its key phrase stands there word for word.  A phrase is its own
key phrase, so every place of it is found.

Result per document: ``n_words``, ``score`` (the best share of a template's
words found at its places, 0 without any) and ``matches``: label, first word,
number of words, share, and whether the template is one of the base phrases.

Defined cases: a null or empty text has no words and no matches; a document
longer than one step is still searched as a whole; overlapping places all
count; with an empty table every IDF is the same; existing columns named like
the output are replaced, others kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from minekit.llm.frames import append_columns, steps
from minekit.llm.spans import span_hashes, words

RARE_WORDS, MIN_SHARE = 3, 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str = ""            # phrase that must stand word for word; empty: the whole text
    base: bool = False


#: The base phrases (fixed values).
BASE = [Template("gpl", "gnu general public license", base=True), Template("apache", "apache license", base=True),
        Template("cc-by", "cc by", base=True), Template("mit", "mit license", base=True)]
#: Notices and names that this scan adds.
ADDED = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files", key="permission is hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met", key="redistribution and use in source"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
                    "fee is hereby granted", key="permission to use copy modify"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation",
             key="free software foundation"),
    Template("lgpl", "gnu lesser general public license"), Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"), Template("bsd", "bsd license"), Template("isc", "isc license"),
    Template("cc-by-sa", "cc by sa"), Template("cc-by-nc", "cc by nc"), Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution"), Template("cc0", "cc0"),
    Template("reserved", "all rights reserved"), Template("public-domain", "public domain"),
]

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

MATCH = StructType([StructField("label", StringType()), StructField("first", LongType()),
                    StructField("words", IntegerType()), StructField("share", DoubleType()),
                    StructField("base", BooleanType())])


class _Index:
    def __init__(self, templates: list[Template], idf: dict[str, float]):
        self.templates = templates
        split = [t.text.split() for t in templates]
        self.lexicon = sorted({w for s in split for w in s})
        place = {w: i for i, w in enumerate(self.lexicon)}
        raw = "".join(self.lexicon).encode()
        ends = np.cumsum([len(w.encode()) for w in self.lexicon])
        keys = span_hashes(np.frombuffer(raw, dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.ids = [np.array([place[w] for w in s]) for s in split]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.key_at: list[tuple[int, int]] = []
        for t, (template, s) in enumerate(zip(templates, split, strict=True)):
            key = template.key.split() or s
            at = next(i for i in range(len(s)) if s[i:i + len(key)] == key)
            self.key_at.append((at, at + len(key)))
            # the rarest words of the template; a phrase needs one, as all its words must be there
            n = RARE_WORDS if len(key) < len(s) else 1
            for i in sorted(range(len(s)), key=lambda i: (-idf.get(s[i], math.inf), i))[:n]:
                self.postings.setdefault(place[s[i]], []).append((t, i))

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """The lexicon number of every word, -1 for other words."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        maybe = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, float]]]:
        """Words per text, best share per text, and (text, template, first word, share)."""
        buf, starts, ends, of = words(texts, _IS_WORD)
        ids = self.word_ids(span_hashes(buf, starts, ends))
        best = np.zeros(len(texts))
        found: list[tuple[int, int, int, float]] = []
        hits = np.flatnonzero(ids >= 0)
        hit_ids = ids[hits]
        tries: dict[int, list[np.ndarray]] = {}
        for word, postings in self.postings.items():
            at = hits[hit_ids == word]
            if len(at):
                for t, i in postings:
                    tries.setdefault(t, []).append(at - i)
        for t, starts_at in tries.items():
            want = self.ids[t]
            first = np.unique(np.concatenate(starts_at))
            # the aligned words must lie in the text of the indexed word
            doc = np.searchsorted(of, np.clip(first, 0, len(ids) - 1), side="right") - 1
            inside = (first >= 0) & (first + len(want) <= of[np.minimum(doc + 1, len(of) - 1)])
            first, doc = first[inside], doc[inside]
            if not len(first):
                continue
            same = ids[first[:, None] + np.arange(len(want))] == want
            share = same.mean(axis=1)
            np.maximum.at(best, doc, share)
            a, b = self.key_at[t]
            good = (share >= MIN_SHARE) & same[:, a:b].all(axis=1)
            found += zip(doc[good].tolist(), [t] * int(good.sum()), (first[good] - of[doc[good]]).tolist(),
                         share[good].tolist())
        return np.diff(of), best, sorted(found, key=lambda f: (f[0], f[2], f[1]))


def licence_idf(df: DataFrame, column: str = "text", templates: list[Template] | None = None) -> dict[str, float]:
    """IDF over all rows of every word of the templates (one number per word)."""
    index = _Index(templates or BASE + ADDED, {})
    n = len(index.lexicon)

    def count(batches):
        held, rows = np.zeros(n, dtype=np.int64), 0
        for batch in batches:
            for texts in steps(batch.column(0)):
                buf, starts, ends, of = words(texts, _IS_WORD)
                ids = index.word_ids(span_hashes(buf, starts, ends))
                at = np.flatnonzero(ids >= 0)
                doc = np.searchsorted(of, at, side="right") - 1
                held += np.bincount(np.unique(doc * n + ids[at]) % n, minlength=n)
                rows += len(texts)
        yield pa.RecordBatch.from_pydict({"word": np.arange(-1, n), "docs": np.concatenate([[rows], held])})

    got = {r.word: r.docs for r in df.select(F.col(f"`{column}`")).mapInArrow(count, "word long, docs long")
           .groupBy("word").agg(F.sum("docs").alias("docs")).collect()}
    rows = got.get(-1, 0)
    return {w: math.log((rows + 1) / (got.get(i, 0) + 1)) for i, w in enumerate(index.lexicon)}


def scan_licenses(df: DataFrame, column: str = "text", templates: list[Template] | None = None) -> DataFrame:
    """``df`` with ``n_words``, ``score`` and ``matches`` of its ``column``."""
    templates = templates or BASE + ADDED
    index = _Index(templates, licence_idf(df, column, templates))

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def work(texts: pa.Array) -> list[pa.Array]:
            n_words, best, found = index.find(texts)
            ends = np.searchsorted([f[0] for f in found], np.arange(len(texts) + 1)).astype(np.int32)
            cols = [pa.array([templates[f[1]].label for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([len(index.ids[f[1]]) for f in found], pa.int32()),
                    pa.array([f[3] for f in found], pa.float64()),
                    pa.array([templates[f[1]].base for f in found], pa.bool_())]
            rows = pa.StructArray.from_arrays(cols, names=MATCH.names)
            return [pa.array(n_words, pa.int64()), pa.array(best, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends), rows)]
        return work

    return append_columns(df, column, [("n_words", LongType()), ("score", DoubleType()),
                                       ("matches", ArrayType(MATCH))], make)
