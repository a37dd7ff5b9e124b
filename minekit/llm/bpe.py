"""Byte-level BPE encoding and decoding against a public rank file.

Each match of the split pattern (a pre-token) is encoded on its own, by two
tiers.  A minimal perfect hash over the vocabulary resolves a pre-token that
is itself a token: hash, slot, compare the bytes.  Any other pre-token starts
as single bytes in a linked list, and a heap of (rank, place) yields the next
merge until no adjacent pair is in the vocabulary.

A worker remembers the pre-tokens it has met, and their ids, in a table that is
emptied at the step after it passes ``MEMO_WORDS`` entries; it only saves
repeating a lookup.

Defined cases: a null text is encoded like an empty one, to no ids; special
tokens do not exist, so their strings are ordinary text; null ids decode to
no bytes; existing columns named like the output are replaced, others kept.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from minekit.llm.frames import append_columns
from minekit.llm.pretokens import distinct, split
from minekit.llm.spans import mix, span_hashes

#: Entries of a worker's table of known pre-tokens.
MEMO_WORDS = 600_000
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _hashes(tokens: list[bytes]) -> np.ndarray:
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)))
    buf = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    return span_hashes(buf, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)


class PerfectHash:
    """A minimal perfect hash: levels of bits, each key resting in the first
    level where no other remaining key has its place; the key's slot is the
    number of bits before it."""

    GAMMA, LEVELS = 2.0, 64

    def __init__(self, keys: np.ndarray):
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two tokens share a 64-bit hash")
        self.sizes, bits, left = [], [], keys
        while len(left) and len(self.sizes) < self.LEVELS:
            size = max(1, int(self.GAMMA * len(left)))
            place = self._place(left, len(self.sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            self.sizes.append(size)
            bits.append(alone)
            left = left[~alone[place]]
        if len(left):
            raise ValueError("no perfect hash found")
        self.bits = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
        self.before = np.cumsum(self.bits) - self.bits

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(keys ^ salt) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key; a key that is not of the set gets any slot or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        rest, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            at = self._place(keys[rest], level, size) + base
            hit = self.bits[at]
            out[rest[hit]] = self.before[at[hit]]
            rest, base = rest[~hit], base + size
        return out


class _Memo(dict):
    """Pre-token -> row of the pool of ids; an unknown one gets the next row and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.ids, self.ends = array("i"), array("i", [0])

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def pool(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.array(self.ends, np.int32)), pa.array(np.array(self.ids, np.int32)))


class PretokenEncoder:
    """Encodes texts pre-token by pre-token; ``learn`` says what an unknown one becomes."""

    def __init__(self):
        self.memo = _Memo()

    def learn(self, words: list[str], memo: _Memo) -> None:
        raise NotImplementedError

    def encode_batch(self, texts: list[str]) -> pa.ListArray:
        """The ids of every text."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = _Memo()
        memo = self.memo
        joined, _, at, of = split(texts)
        which, words = distinct(joined, at)
        rows = np.fromiter(map(memo.__getitem__, words), dtype=np.int32, count=len(words))
        if memo.new:
            self.learn(memo.new, memo)
            memo.new = []
        ids = memo.pool().take(pa.array(rows[which]))
        return pa.ListArray.from_arrays(ids.offsets.take(pa.array(of)), ids.values)


class Encoder(PretokenEncoder):
    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        tokens = list(ranks)
        keys = _hashes(tokens)
        self.table = PerfectHash(keys)
        order = np.argsort(self.table.slots(keys))
        self.token_of = [tokens[i] for i in order]
        self.id_of = [ranks[t] for t in self.token_of]
        # ids of adjacent tokens -> id of what they merge to, which is also the merge's rank
        self.merges = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items()
                       for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.byte_id = [ranks[bytes([b])] for b in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        """BPE of one pre-token: a heap of merges over linked bytes."""
        rank, n = self.merges.get, len(piece)
        ids = [self.byte_id[b] for b in piece]
        after, ahead = list(range(1, n + 1)), list(range(-1, n))
        pair = [rank(a << 32 | b, -1) for a, b in pairwise(ids)]
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if pair[i] != r:
                continue                                    # merged away or superseded
            j = after[i]
            ids[i], ids[j], pair[j] = r, -1, -1
            j = after[i] = after[j]
            if j < n:
                ahead[j] = i
                s = pair[i] = rank(r << 32 | ids[j], -1)
                if s >= 0:
                    heappush(heap, s << 32 | i)
            else:
                pair[i] = -1
            if i:
                i = ahead[i]
                s = pair[i] = rank(ids[i] << 32 | r, -1)
                if s >= 0:
                    heappush(heap, s << 32 | i)
        return [x for x in ids if x >= 0]

    def learn(self, words: list[str], memo: _Memo) -> None:
        """Appends the ids of ``words``: the vocabulary's by perfect hash, the others merged."""
        raw = [w.encode() for w in words]
        slots = self.table.slots(_hashes(raw)).tolist()
        ids, ends, token_of, id_of, merge = memo.ids, memo.ends, self.token_of, self.id_of, self.merge
        for piece, slot in zip(raw, slots, strict=True):
            if slot >= 0 and token_of[slot] == piece:
                ids.append(id_of[slot])
            else:
                ids.extend(merge(piece))
            ends.append(len(ids))

def load_ranks(path: str) -> dict[bytes, int]:
    """``{token bytes: rank}`` of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(load_ranks(path))


def token_bytes(path: str) -> pa.BinaryArray:
    """The bytes of every id."""
    by_id = {r: t for t, r in load_ranks(path).items()}
    return pa.array([by_id.get(i) for i in range(max(by_id, default=-1) + 1)], type=pa.binary())


def _decoder(path: str) -> Callable[[pa.ListArray], pa.Array]:
    tokens = token_bytes(path)

    def work(rows: pa.ListArray) -> pa.Array:
        at = rows.offsets
        # the tokens' bytes lie one after the other; a row's end is its last token's
        parts = tokens.take(rows.values.slice(at[0].as_py(), at[-1].as_py() - at[0].as_py()))
        ends = pc.subtract(at, at[0]).to_numpy()
        size = np.zeros(len(at), np.int32)
        if len(parts):
            size = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset:parts.offset + len(parts) + 1][ends]
        return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(size), parts.buffers()[2]])
    return work


_IDS = ArrayType(IntegerType(), True)


def encode(df: DataFrame, column: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``column`` as ``array<int>``.

    ``path`` is a rank file that every worker can open (it comes with the
    installed package, like the package itself)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        enc = encoder(path)
        return lambda texts: [enc.encode_batch([t or "" for t in texts.to_pylist()])]

    return append_columns(df, column, [(ids, _IDS)], make)


def decode(df: DataFrame, column: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the bytes that the ids in ``column`` stand for."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        work = _decoder(path)
        return lambda rows: [work(rows)]

    return append_columns(df, column, [(decoded, BinaryType())], make)


def round_trip(df: DataFrame, column: str = "text", ids: str = "ids", decoded: str = "decoded",
               path: str | None = None) -> DataFrame:
    """``encode`` and, from its ids, ``decode`` in one pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        enc, work = encoder(path), _decoder(path)

        def both(texts: pa.Array) -> list[pa.Array]:
            rows = enc.encode_batch([t or "" for t in texts.to_pylist()])
            return [rows, work(rows)]
        return both

    return append_columns(df, column, [(ids, _IDS), (decoded, BinaryType())], make)
