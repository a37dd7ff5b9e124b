"""The byte-level BPE split pattern as array operations.

``public_tokenizers.PATTERN`` cuts a text into contractions, runs of letters,
of numbers, of other characters (each with one space in front, if there is
one) and white space, whose last character stays apart before a word.  Here
the same cuts are found for a whole batch from the character classes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

SPACE, LETTER, NUMBER, OTHER = range(4)
_SURROGATES = (0xD800, 0xE000)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    lo, hi = _SURROGATES
    for base, end in ((0, lo), (hi, 0x110000)):
        text = "".join(map(chr, range(base, end)))
        for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, text):
                out[base + m.start():base + m.end()] = kind
    return out


def split(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All texts joined, the start of every pre-token and the end of the last
    one, the start of each in UTF-8, and per text the n+1 offsets into them."""
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n, of = len(code), np.cumsum([0, *map(len, texts)])
    if not n:
        return joined, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(len(of), np.int64)
    kind = _classes()[code]
    begin = np.zeros(n + 1, dtype=bool)                    # a text begins here (or all ends)
    begin[of] = True
    start = begin.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # before a run that is not white space: its space belongs to it, other white space stands alone
    run = np.flatnonzero(start[1:n] & ~begin[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
    start[run - 1] = True
    start[run[code[run - 1] == 32]] = False
    # contractions: an apostrophe alone between what is no space and certain letters
    mark = np.flatnonzero((code == 39) & start[:n])
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~begin[mark + 1]]
    one, two = code[mark + 1], code[np.minimum(mark + 2, n - 1)]
    pair_ok = (mark + 2 < n) & ~begin[np.minimum(mark + 2, n)]
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(
        pair_ok & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))),
        2, 0))
    mark, size = mark[size > 0], size[size > 0]
    start[mark + 1] = False
    rest = mark + 1 + size
    rest = rest[rest < n]
    start[rest] = True
    at = np.flatnonzero(start)                             # the last entry is n
    wide = (code >= 0x80).astype(np.uint8) + (code >= 0x800) + (code >= 0x10000)
    before = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)])
    return joined, at, at + before[at], np.searchsorted(at, of)


def distinct(joined: str, at: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """The number of every pre-token among the different ones, and those; ``at``
    holds where each begins in UTF-8."""
    raw = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(joined.encode())])
    found = raw.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
