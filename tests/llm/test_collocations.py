"""Collocations against counting all phrases in Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from minekit.llm import collocations, registry

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=10, longest=3, top=2000, share=50):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= min_count and len(p) > 1}
        rows = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in often.items()):
                continue
            cuts = [(10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def _rows(n, seed=1):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "Dd", "e", "ff", "\x00g", "\x85", "日本", "h"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
    return [("".join(rng.choice(words[:rng.randint(2, 10)]) + rng.choice(seps) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "en", "en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"longest": 4, "min_count": 7, "shards": 2}, {"min_count": 3, "share": 80, "top": 5},
                                     {"longest": 2, "shards": 1}, {"bits": 1 << 12}])
def test_equals_brute_force(spark, options):
    rows = _rows(120)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    want = brute(rows, **{k: v for k, v in options.items() if k not in ("shards", "bits")})
    assert want and _got(collocations.collocations(df, **options)) == want


def test_several_scans(spark):
    """A table of few bits: the candidates are counted in more than one scan."""
    rows = _rows(200, 3)
    df = spark.createDataFrame(rows, "text string, lang string")
    bits = 1 << 12
    assert sum(len(c) for c in [brute(rows, top=10 ** 6)]) > 0
    assert _got(collocations.collocations(df, bits=bits, top=10 ** 6)) == brute(rows, top=10 ** 6)


def test_long_text_is_cut_between_pieces(spark):
    rng = random.Random(4)
    text = "".join(rng.choice(["x", "yy", "é"]) + rng.choice([" ", "  ", ". ", "\n"]) for _ in range(4000))
    rows = [(text, "en"), ("word " * 3000, "en"), ("", "en"), ("q" * 9000, "de")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert _got(collocations.collocations(df, step=1000)) == brute(rows)


def test_cut_covers_the_text():
    for text in ("ab. cd, ef gh\nij", "no break at all", ".", "a..b..c"):
        parts = list(collocations._cut(pa.array([text]), 4))
        assert "".join(p[0].as_py() for p in parts) == text
        assert all(p[0].as_py()[-1] in ".,\n" for p in parts[:-1])


def test_equal_hashes_change_nothing(spark, monkeypatch):
    """Hashes only choose candidates: with three bits of them the counts are the same."""
    true_hash = collocations.span_hashes
    monkeypatch.setattr(collocations, "span_hashes", lambda *a: true_hash(*a) & np.uint64(7))
    texts = pa.array(["a b. c d e", "d e f"])
    step = collocations._Step(texts)
    assert len(np.unique(step.word)) < 8


def test_repeated_rows_empty_and_clashes(spark):
    rows = [("One two three. One two", "en")] * 12 + [(None, "en"), ("   ", None), ("One two", None)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns(
        {c: F.lit(1) for c in ("salt", "shard", "key", "n", "words", "phrase", "rank", "a", "l", "r", "score")})
    assert _got(collocations.collocations(df)) == brute(rows)
    assert collocations.collocations(df.limit(0)).count() == 0
    assert collocations.collocations(df.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("text", "lang").collect()]
    assert _got(registry.op11_collocations(spark, d)) == brute(rows)
