"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from minekit.llm import jaccard

SCHEMA = "doc_id long, text string, component long, id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def _direct(rows, num=80, den=100):
    sets = [_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] and (
                    rows[i][0] == rows[j][0] or den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), None if r[0] is None else least[find(i)]) for i, r in enumerate(rows)), key=repr)


def _corpus(seed, families, per_family, common):
    """Families of copies with more and more changed words, some sharing a passage."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for f in range(families):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 5, 9, 40, 120]))]
        for _ in range(rng.randint(1, per_family)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(10 ** 6)}"
            text = " ".join(copy)
            if rng.random() < common:
                text += "\n" + passage
            rows.append((rng.randrange(10 ** 9), text if rng.random() < 0.8 else text.upper(), 0, "x"))
    return rows


@pytest.mark.parametrize("seed,families,per_family,common", [(1, 40, 6, 0.3), (2, 4, 60, 0.0), (3, 120, 2, 1.0)])
def test_components(spark, monkeypatch, seed, families, per_family, common):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = _corpus(seed, families, per_family, common)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in jaccard.similar_documents(df).collect()), key=repr)
    assert got == _direct(rows)


def test_chain_across_blocks(spark, monkeypatch):
    """Neighbours link, distant ones do not, and pivots alone would miss links."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    rows = [(1000 - i, " ".join(words[6 * i:6 * i + 100]), 0, "x") for i in range(40)]
    got = sorted((tuple(r) for r in jaccard.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == _direct(rows)


def test_without_broadcast(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        rows = _corpus(5, 20, 5, 0.3)
        got = sorted((tuple(r) for r in jaccard.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    finally:
        spark.conf.set(threshold, before)
    assert got == _direct(rows)


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(5, None, 0, ""), (6, "", 0, ""), (7, " \t\n", 0, ""), (8, "one two", 0, ""), (4, "ONE  two", 0, ""),
            (4, "ONE  two", 0, ""), (None, "one two", 0, ""), (3, long, 0, ""), (9, long + " x", 0, ""),
            (2, "other text", 0, ""), (2, "one two", 0, ""), (1, "one two three", 0, ""), (None, None, 0, "")]
    got = sorted((tuple(r) for r in jaccard.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == _direct(rows)
    assert jaccard.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingles_do_not_span_texts():
    tokens, of = jaccard.shingle_sets(pa.array(["a b c", "d e f g h i", None, "", "a b c"]))
    assert np.diff(of).tolist() == [1, 2, 0, 0, 1]
    keys = jaccard.set_keys(tokens, of)
    assert keys[0] == keys[4] != keys[1] and keys[2] == keys[3] == 0


def test_small_sets_of_mixed_sizes(spark, monkeypatch):
    """A size between the smallest and the largest of a block may need fewer shared tokens than both."""
    monkeypatch.setattr(jaccard, "FREQUENT", 0)                          # tokens by hash alone
    by_hash = sorted((f"w{i}" for i in range(300)), key=lambda w: int(jaccard.shingle_sets(pa.array([w]), 1)[0][0]))
    u, common, rest = by_hash[100:103], by_hash[103:115], by_hash[:100]
    family = [common + u[:2], common + u, common[:11] + u[:2], common[:11] + u]
    for rare in rest:                            # the one that makes its set the first of all, so it asks
        sets = [common + [rare], *family]
        keys = jaccard.set_keys(*jaccard.shingle_sets(pa.array([" ".join(s) for s in sets]), 1))
        if keys.argmin() == 0 and keys[1] > keys[2:].min():
            break
    else:
        raise AssertionError("no such word")
    df = spark.createDataFrame([(i, " ".join(s), 0, "x") for i, s in enumerate(sets)], SCHEMA)
    assert len(set(sets[0]) & set(sets[1])) * 100 == 80 * len(set(sets[0]) | set(sets[1]))
    assert {r.component for r in jaccard.similar_documents(df, k=1).collect()} == {0}


@pytest.mark.parametrize("num,den", [(80, 100), (50, 100), (9, 10), (1, 10)])
def test_least_shared_holds_for_every_size_between(spark, num, den):
    rows = spark.sql("SELECT n, low, high FROM (SELECT id AS n FROM range(1, 40)) JOIN (SELECT id AS low FROM range(1, 50)) "
                     "JOIN (SELECT id AS high FROM range(1, 50)) WHERE low <= high")
    need = jaccard._least_shared_within(F.col("n"), F.col("low"), F.col("high"), num, den)
    exact = lambda n, m: -(-(n + m) * num // (num + den)) - max(-(-n * num // den), -(-m * num // den)) + 1
    for r in rows.withColumn("need", need).collect():
        least = min(exact(r.n, m) for m in range(r.low, r.high + 1))
        assert r.need == least if (num, den) != (1, 10) else r.need <= least
