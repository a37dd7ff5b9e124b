"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document becomes token ids plus an end id and, if longer than a sequence,
pieces of full length behind a first piece that may be shorter.  Full pieces
are sequences already.  The others are dealt by hash into shards of about
``SHARD`` pieces, and every shard is packed on ``ISLANDS`` islands at once: a
population of packings, the first by best-fit decreasing, crosses by injecting
the best-filled bins of one parent whole into the other, dropping the bins
that hold the same pieces and fitting the displaced ones again, the largest
first, each into the fullest bin with room.  After each epoch an island's best
packings travel to the next island of the shard (a Spark shuffle); after the
last the best packing of all islands is the shard's.

Defined cases: a null or empty text is its end id alone; pieces are numbered
and placed row by row, so repeated rows, equal ids and null ids each get
places of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from minekit.llm.bpe import PretokenEncoder, _Memo
from minekit.llm.frames import release_memory, steps
from minekit.session import materialize

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
LENGTH = 1024
SHARD, ISLANDS, EPOCHS = 8192, 2, 2
POPULATION, GENERATIONS, ELITE = 4, 4, 2
#: Share of a parent's bins, the best filled, from which a cross takes some whole.
WELL_FILLED = 0.5

_ENCODERS: dict[str, FileEncoder] = {}


class FileEncoder(PretokenEncoder):
    """Ids by the tokenizers library, which is asked once per distinct pre-token.

    A text that holds a special token's string goes to the library whole, as
    it cuts such strings out before it splits."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"           # Spark has one task per core already
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)     # it gets pre-tokens

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def learn(self, words: list[str], memo: _Memo) -> None:
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            memo.ids.extend(e.ids)
            memo.ends.append(len(memo.ids))

    def documents(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        whole = {i: t for i, t in enumerate(texts) if any(s in t for s in self.special)}
        rows = self.encode_batch([t if i not in whole else "" for i, t in enumerate(texts)])
        ids, ends = rows.values.to_numpy(), rows.offsets.to_numpy()
        return [ids[a:b] if i not in whole else np.array(
            self.whole.encode(whole[i], add_special_tokens=False).ids, dtype=np.int32)
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))]


def _encoder(path: str) -> FileEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = FileEncoder(path)
    return _ENCODERS[path]


def pieces_of(docs: DataFrame, column: str = "text", key: str = "doc_id", length: int = LENGTH,
              end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids, ids_crc32`` per piece, ``ids`` as
    little-endian unsigned 32-bit numbers."""
    path = path or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{column}`").alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            at = 0
            for texts in steps(batch.column(1)):
                keys = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                out: list[tuple] = []
                for doc, ids in zip(keys, encoder.documents([t or "" for t in texts.to_pylist()]), strict=True):
                    raw = ids.astype("<u4").tobytes() + end
                    n = len(raw) // 4
                    stop = n - (n - 1) // length * length        # of the first piece; the others are full
                    start = piece = 0
                    while start < n:
                        out.append((doc, piece, start, stop - start, raw[4 * start:4 * stop]))
                        start, stop, piece = stop, stop + length, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types)], names=names)
        release_memory()

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary").withColumn(
        "ids_crc32", F.crc32("ids"))


# ---- the algorithm on one shard: sizes, and packings as a bin number per piece --------

def fit(sizes: np.ndarray, bins: np.ndarray, loose: np.ndarray, length: int) -> np.ndarray:
    """``bins`` with the ``loose`` pieces placed best-fit decreasing, bins numbered from 0.

    ``room`` keeps the bins by free space, and the set bits of ``free`` say
    which spaces occur, so the fullest bin with room is one bit operation away."""
    bins = bins.copy()
    bins[loose] = -1
    old = np.unique(bins[bins >= 0])
    bins = np.where(bins >= 0, np.searchsorted(old, bins), -1)
    fill = np.bincount(bins[bins >= 0], weights=sizes[bins >= 0], minlength=len(old)).astype(np.int64)
    room: list[list[int]] = [[] for _ in range(length + 1)]
    free = 0
    for b, f in enumerate((length - fill).tolist()):
        room[f].append(b)
        free |= 1 << f
    n = len(old)
    order = loose[np.argsort(-sizes[loose], kind="stable")]
    placed = []
    for size in sizes[order].tolist():
        fits = free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            stack = room[space]
            b = stack.pop()
            if not stack:
                free ^= 1 << space
        else:
            space, b = length, n
            n += 1
        placed.append(b)
        space -= size
        room[space].append(b)
        free |= 1 << space
    bins[order] = placed
    return bins


def quality(sizes: np.ndarray, bins: np.ndarray, length: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones (mean squared fill)."""
    if not len(bins):
        return 0, 0.0
    fill = np.bincount(bins, weights=sizes) / length
    return -len(fill), float((fill ** 2).mean())


def cross(sizes: np.ndarray, one: np.ndarray, other: np.ndarray, length: int, rng: np.random.Generator) -> np.ndarray:
    """``one`` with some well-filled bins of ``other`` injected whole."""
    fill = np.bincount(other, weights=sizes)
    best = np.argsort(-fill, kind="stable")[:max(1, int(len(fill) * WELL_FILLED))]
    taken = rng.choice(best, size=max(1, len(best) // 2), replace=False)
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[taken] = True
    injected = chosen[other]
    broken = np.zeros(one.max() + 1, dtype=bool)
    broken[one[injected]] = True                             # bins that hold an injected piece go
    # and so do some of the worst filled of the rest, whose pieces are fitted anew
    full = np.bincount(one, weights=sizes)
    broken[np.argsort(full, kind="stable")[:max(1, len(full) // 50)]] = True
    child = np.where(injected, other + one.max() + 1, one)
    return fit(sizes, child, np.flatnonzero(~injected & broken[one]), length)


def evolve(sizes: np.ndarray, population: list[np.ndarray], length: int, generations: int, size: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """The population after some generations, best first."""
    everyone = np.arange(len(sizes))
    nothing = np.full(len(sizes), -1)
    if not population:
        population = [fit(sizes, nothing, everyone, length)]
    while len(population) < size:                            # others begin with some pieces placed first
        head = rng.random(len(sizes)) < 0.3
        start = fit(sizes, nothing, np.flatnonzero(head), length) if head.any() else nothing
        population.append(fit(sizes, np.where(head, start, -1), np.flatnonzero(~head), length))
    lower = -(-int(sizes.sum()) // length)
    ranked = sorted(population, key=lambda p: quality(sizes, p, length), reverse=True)
    for _ in range(generations):
        if quality(sizes, ranked[0], length)[0] >= -lower:
            break                                            # no packing has fewer bins
        i, j = rng.choice(len(ranked), size=2, replace=False)
        children = [cross(sizes, ranked[a], ranked[b], length, rng) for a, b in ((i, j), (j, i), (0, max(i, j)))]
        ranked = sorted(ranked + children, key=lambda p: quality(sizes, p, length), reverse=True)[:size]
    return ranked


# ---- islands on Spark ------------------------------------------------------------

_ELITE = "shard int, island int, bins binary, n_bins long, fill double"


def _sorted(pieces: pd.DataFrame) -> pd.DataFrame:
    return pieces.sort_values("uid", kind="stable", ignore_index=True)


def _epoch(parts: DataFrame, elite: DataFrame | None, epoch: int, length: int, islands: int) -> DataFrame:
    """An epoch on every island; ``elite`` are the packings that it begins with."""
    def work(shard: int, island: int, pieces: pd.DataFrame, packings: list[bytes]) -> pd.DataFrame:
        sizes = _sorted(pieces).length.to_numpy(np.int64)
        start = [np.frombuffer(b, "<i4").astype(np.int64) for b in packings]
        rng = np.random.default_rng([shard & 0xFFFFFFFF, island, epoch])
        best = evolve(sizes, start, length, GENERATIONS, POPULATION, rng)[:ELITE]
        rank = [quality(sizes, b, length) for b in best]
        return pd.DataFrame({"shard": shard, "island": island, "bins": [b.astype("<i4").tobytes() for b in best],
                             "n_bins": [-r[0] for r in rank], "fill": [r[1] for r in rank]})

    everywhere = parts.select("shard", "uid", "length").withColumn(
        "island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    if elite is None:
        return everywhere.groupBy("shard", "island").applyInPandas(
            lambda key, pieces: work(int(key[0]), int(key[1]), pieces, []), _ELITE)
    return everywhere.groupBy("shard", "island").cogroup(elite.groupBy("shard", "island")).applyInPandas(
        lambda key, pieces, packings: work(int(key[0]), int(key[1]), pieces, list(packings.bins)), _ELITE)


def _migrate(elite: DataFrame, islands: int) -> DataFrame:
    """An island's best packings stay and also go to the next island of the shard."""
    if islands == 1:
        return elite
    there = F.pmod(F.col("island") + 1, F.lit(islands)).cast("int")
    return elite.withColumn("island", F.explode(F.array("island", there)))


def pack(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (with a ``length`` of at most ``length``) with ``sequence_id``
    and ``offset``: every piece's place, gapless from 0 in each sequence.

    The pieces are written once; only their numbers and lengths go through the
    algorithm, and the places found are joined back to whole pieces."""
    uid: Column = F.monotonically_increasing_id()
    rows = materialize(pieces.withColumn("uid", uid), "pieces")
    full, open_ = rows.filter(F.col("length") >= length), rows.filter(F.col("length") < length)
    n = max(1, -(-open_.count() // shard))
    parts = open_.select("uid", "length").withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int"))
    elite = None
    for epoch in range(epochs):
        if elite is not None:
            elite = _migrate(elite, islands)
        elite = materialize(_epoch(parts, elite, epoch, length, islands), "elite")
    best = elite.groupBy("shard").agg(F.min(F.struct("n_bins", (-F.col("fill")).alias("f"), "bins")).alias("b"))
    best = best.select(F.col("shard").alias("shard"), F.col("b.bins").alias("bins"))

    def place(key, pieces: pd.DataFrame, packing: pd.DataFrame) -> pd.DataFrame:
        pieces = _sorted(pieces)
        bins = np.frombuffer(packing.bins[0], "<i4").astype(np.int64)
        sizes = pieces.length.to_numpy(np.int64)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        head = np.append(True, np.diff(bins[order]) > 0)
        begin = ends - sizes[order]
        offset = np.empty(len(bins), np.int64)
        offset[order] = begin - np.repeat(begin[head], np.diff(np.append(np.flatnonzero(head), len(bins))))
        return pd.DataFrame({"uid": pieces.uid, "sequence_id": (int(key[0]) + 1) << 32 | bins, "offset": offset})

    columns = [c for c in rows.columns if c != "uid"]
    places = parts.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(
        place, "uid long, sequence_id long, offset long")
    placed = open_.join(places, "uid").select(*columns, "sequence_id", "offset")
    # a full piece is a sequence of its own, with a negative number
    alone = full.select(*columns, (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(placed)
