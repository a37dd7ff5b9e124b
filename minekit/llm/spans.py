"""Vectorised words and 64-bit hashes over a buffer of UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_PRIME = (1 << 31) - 1
#: Two places at which a word's polynomial is evaluated modulo ``_PRIME``.
_BASES = (1_403_580_533, 798_417_029)


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo the prime for i below ``n``, by doubling."""
    out, have = np.ones(max(n, 1), dtype=_U), 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * _U(pow(base, have, _PRIME)) % _U(_PRIME)
        have += more
    return out


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of every ``buf[start:end]`` among the different ones, told
    apart by their bytes, and those (large binary).  Spans are in order and do
    not overlap."""
    size = (ends - starts).astype(np.int64)
    some = size > 0
    mark = np.zeros(len(buf) + 1, dtype=np.int8)
    mark[starts[some]] += 1
    mark[ends[some]] -= 1
    held = buf[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
    offsets = np.concatenate([[0], np.cumsum(size)])
    spans = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    found = spans.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


#: Spans of more bytes than this are hashed as polynomials, all others eight bytes at a time.
LONG = 256


def _long_hashes(buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes are the coefficients of a polynomial, evaluated at two places
    modulo a prime: two spans of n bytes share both values only where their
    difference, a polynomial of degree n - 1, has a root at both."""
    ends = np.cumsum(size)
    first = ends - size
    place = np.arange(ends[-1]) - np.repeat(first, size)
    raw = buf[place + np.repeat(starts, size)].astype(_U) + _U(1)
    both = [np.add.reduceat(raw * _powers(base, int(size.max()))[place] % _U(_PRIME), first) % _U(_PRIME)
            for base in _BASES]
    return mix(mix(size.astype(_U)) ^ (both[0] << _U(31) | both[1]))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``buf[start:end]``; equal bytes hash alike.

    Eight bytes at a time are added to a state that is mixed in between, so no
    two orders or exchanges of bytes cancel out as they do in a rolling hash
    modulo 2^64."""
    if len(starts) == 0:
        return np.zeros(0, dtype=_U)
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(_U) + _U(0x9E3779B97F4A7C15))
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))      # the eight bytes from each place
    at = np.flatnonzero((size > 0) & (size <= LONG))
    done = 0
    while len(at):
        left = np.minimum(size[at] - done, 8).astype(_U)
        chunk = eight[starts[at] + done] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * left))
        out[at] = mix(out[at] + chunk * _U(0xC2B2AE3D27D4EB4F))
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = _long_hashes(buf, starts[i:i + 1], size[i:i + 1])[0]
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (null: empty) and the n+1 offsets."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = int(offsets[0]) if len(offsets) else 0
    hi = int(offsets[-1]) if len(offsets) else 0
    return raw[lo:hi], offsets - lo


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(texts: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text after lower-casing A-Z.

    ``is_word`` marks the byte values that words consist of.  Returns the
    lower-cased buffer, word starts, word ends and, per text, the n+1 offsets
    into the words.  A word never spans two texts.
    """
    raw, offsets = text_bytes(texts)
    buf = _LOWER[raw]
    inside = is_word[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[:-1][offsets[:-1] < len(buf)]       # a text's first byte starts anew
    first[cut] = inside[cut]
    cut = offsets[1:][offsets[1:] > 0] - 1
    last[cut] = inside[cut]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return buf, starts, ends, np.searchsorted(starts, offsets)
