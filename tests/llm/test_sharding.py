"""Sharding against a sequential walk around the ring."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from minekit.llm import registry, sharding
from tests.conftest import SF_SMALL


def _place(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:4], 16)


def walk(rows, shards, replicas, slack=0.0):
    """The shards of rows (key, text), key by key."""
    points = sorted((_place(f"shard {i // replicas} point {i % replicas}"), i) for i in range(shards * replicas))
    points = [(p, i // replicas) for p, i in points]
    n = len(rows)
    cap = [n // shards + (s < n % shards) for s in range(shards)]
    if slack:
        cap = [-int(-(1 + slack) * n // shards)] * shards
    turn = points[-1][0] + 1
    keys = []
    for key, text in rows:
        raw = (text or "").encode()
        p = (_place("no key" if key is None else f"key {key}") - turn) % sharding.RING
        keys.append((p, key is not None, key or 0, zlib.crc32(raw), len(raw) + 16))
    keys.sort()
    homes = [((p - turn) % sharding.RING, s) for p, s in points]
    held, out, queue, at = Counter(), [], [], 0
    arcs = []
    for p, s in homes:
        mine = []
        while at < len(keys) and keys[at][0] <= p:
            mine.append(keys[at])
            at += 1
        arcs.append((s, mine))
    late = []
    for s, mine in arcs:                                  # homes first
        room = max(0, cap[s] - held[s])
        out += [(*k[2:], s) for k in mine[:room]]
        held[s] += len(mine[:room])
        late.append(mine[room:])
    for again in (False, True):                           # then the queue, clockwise
        for (s, _), more in zip(arcs, late, strict=True):
            queue += [] if again else more
            while queue and held[s] < cap[s]:
                out.append((*queue.pop(0)[2:], s))
                held[s] += 1
    assert not queue
    return Counter(out)


def _got(df):
    return Counter((r.key or 0, r.checksum, r["size"], r.shard) for r in df.collect())


def _check(spark, rows, shards, replicas, slack=0.0):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard_rows(df, shards, replicas=replicas, slack=slack).cache()
    assert _got(out) == walk(rows, shards, replicas, slack)
    slots = out.groupBy("shard").agg(F.count("slot").alias("n"), F.countDistinct("slot").alias("d"),
                                     F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert all(r.n == r.d == r.hi + 1 and r.lo == 0 for r in slots)
    sizes = [r.n for r in slots] + [0] * (shards - len(slots))
    if not slack:
        assert max(sizes) - min(sizes) <= 1
    else:
        assert max(sizes) <= -int(-(1 + slack) * len(rows) // shards)


@pytest.mark.parametrize(("shards", "replicas", "slack"), [(7, 3, 0.0), (5, 8, 0.25), (1, 1, 0.0), (12, 1, 0.0), (4, 600, 0.0)])
def test_equals_the_walk(spark, shards, replicas, slack):
    _check(spark, [(i, f"text {i % 11}") for i in range(331)], shards, replicas, slack)


def test_hot_keys_nulls_and_repeats(spark):
    rows = [(1, "same")] * 120 + [(None, None)] * 40 + [(i, "é" * i) for i in range(90)] + [(5, "")] * 9
    _check(spark, rows, 8, 4)


def test_fewer_rows_than_shards_and_empty(spark):
    _check(spark, [(1, "a"), (2, None)], 9, 2)
    empty = spark.createDataFrame([], "doc_id long, text string, shard int, slot long")
    assert sharding.shard_rows(empty, 4).count() == 0


def test_clashing_columns_and_very_long_text(spark):
    df = spark.createDataFrame([(1, "x" * 3_000_000), (2, "y")], "doc_id long, text string").withColumns(
        {c: F.lit(7) for c in ("key", "size", "checksum", "place", "row", "number", "arc", "shard", "slot", "begin")})
    got = sharding.shard_rows(df, 2).orderBy("key").collect()
    assert [(r.key, r["size"], r.slot) for r in got] == [(1, 3_000_016, 0), (2, 17, 0)]
    assert got[0].checksum == zlib.crc32(b"x" * 3_000_000)


def test_growth_moves_little(spark):
    df = spark.createDataFrame([(i, "t") for i in range(4000)], "doc_id long, text string")
    before = {r.key: r.shard for r in sharding.shard_rows(df, 40).collect()}
    after = {r.key: r.shard for r in sharding.shard_rows(df, 41).collect()}
    new = sum(s == 40 for s in after.values())
    moved = sum(before[k] != after[k] for k in before)
    assert new in (97, 98) and moved < 3 * new


def test_query(spark):
    out = registry.op12_sharding(spark, SF_SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.text_crc32, r["size"], r.shard) for r in out) == walk(docs, 40, sharding.REPLICAS)
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}


def test_plan_has_no_python(spark):
    plan = registry.op12_sharding(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
