"""Packing: pieces against the library, places without gaps, bins near the bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from minekit.llm import packing, registry

SCHEMA = "doc_id long, text string, piece string, uid string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def _check(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= length
    return len(by)


def test_pieces(spark, library):
    texts = [None, "", "short", "it's a  test\n\n of 12 words" * 30, "<|endoftext|> in a text", "x" * 5000, "ab " * 40]
    df = spark.createDataFrame([(i, t, "p", "u") for i, t in enumerate(texts)], SCHEMA)
    got = {}
    for r in packing.pieces_of(df, length=16).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        rows = sorted(got[i], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(-(-len(ids) // 16)))
        assert all(r.length == 16 for r in rows[1:]) and rows[0].start == 0
        for r in rows:
            raw = np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes()
            assert raw == bytes(r.ids) and zlib.crc32(raw) == r.ids_crc32
        assert b"".join(bytes(r.ids) for r in rows) == np.array(ids, dtype="<u4").tobytes()


def test_places_and_islands(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.append(rng.integers(1, 100, size=2000), [100] * 50)
    df = spark.createDataFrame([(i % 700, int(s)) for i, s in enumerate(sizes)], "doc_id long, length long").repartition(4)
    out = packing.pack(df, length=100, shard=500, islands=3).collect()
    assert sorted((r.doc_id, r.length) for r in out) == sorted((i % 700, int(s)) for i, s in enumerate(sizes))
    bins = _check(out, 100)
    assert bins <= 1.02 * -(-sizes.sum() // 100) + 4


def test_crossing_keeps_every_piece_and_never_gets_worse():
    rng = np.random.default_rng(4)
    sizes = rng.integers(20, 60, size=400)
    first = packing.evolve(sizes, [], 100, 0, 4, np.random.default_rng(1))
    later = packing.evolve(sizes, first, 100, 10, 4, np.random.default_rng(2))
    for p in first + later:
        assert len(p) == 400 and np.bincount(p, weights=sizes).max() <= 100
        assert np.array_equal(np.unique(p), np.arange(p.max() + 1))
    assert packing.quality(sizes, later[0], 100) >= packing.quality(sizes, first[0], 100)


def test_best_fit_takes_the_fullest_bin():
    sizes = np.array([6, 5, 4, 3])
    assert packing.fit(sizes, np.full(4, -1), np.arange(4), 10).tolist() == [0, 1, 0, 1]


def test_defined_cases(spark):
    df = spark.createDataFrame([(None, None, "", ""), (1, "a", "", ""), (1, "a", "", "")], SCHEMA)
    out = packing.pack(packing.pieces_of(df)).select("doc_id", "piece", "start", "length", "sequence_id", "offset").collect()
    assert len(out) == 3 and _check(out, 1024) == 1
    assert packing.pack(packing.pieces_of(df.limit(0))).count() == 0
    full = packing.pack(spark.range(3).select(F.lit(4).cast("long").alias("length")), length=4)
    assert full.select("sequence_id").distinct().count() == 3


def test_packed_pieces_hold_their_ids(spark, library, monkeypatch):
    texts = ["it's a  test\n\n of words " * n for n in (1, 3, 400, 30)] + [None, "short"]
    df = spark.createDataFrame([(i, t, "p", "u") for i, t in enumerate(texts)], SCHEMA)
    out = corpus_pipeline.pack(spark, df, "").collect()
    assert _check(out, 1024) < len(out)
    for i, t in enumerate(texts):
        rows = sorted((r for r in out if r.doc_id == i), key=lambda r: r.piece)
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert b"".join(bytes(r.ids) for r in rows) == np.array(ids, dtype="<u4").tobytes()
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)

    packed, pack = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a: packed.append(pack(*a)) or packed[0])
    monkeypatch.setattr(registry, "table", lambda *a: df)
    query = registry.op5_bestfit_packing(spark, "")
    assert "ids" in packed[0].columns and sorted((r.doc_id, r.piece, r.ids_crc32) for r in query.collect()) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in out)
