"""Document quality from a linear-chain conditional random field over lines.

Every non-blank line of a text is a place in the chain, labelled good or bad.
Its features are shares of character kinds (damped on short lines), the share
of words that repeat the word before, word length, line length and whether the
line stood earlier in the text, raw and as steps, of the line
itself and of its two neighbours.  The forward-backward marginals of "good",
weighted by line length, average to a document's raw quality, and a logistic
curve fitted on the training documents turns it into the score.

Only documents are labelled, so the line labels are found in two steps: a
logistic regression of the document label on single lines, then each line of
a bad document is bad if that model says so (at least its worst line is), and
every line of a good document is good.  The field is fitted to these chains.

Fitting takes at most ``DOCS_PER_CLASS`` documents of each label and
``LINES_PER_CLASS`` of their lines, chosen by a hash of the id; scoring sees
every row and every whole text.

Defined cases: a null, empty or blank text has no lines and raw quality 0;
without labelled rows of both kinds every score is 1; of several labels of
one document the lowest counts, null labels none; documents without a label
are not learned from; repeated rows score alike; existing columns named like
the output are replaced, others kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from minekit.llm.frames import append_columns, steps
from minekit.llm.spans import span_hashes, text_bytes

DOCS_PER_CLASS, LINES_PER_CLASS = 1500, 30_000
ITERATIONS, L2 = 80, 1e-3

# byte kinds: 0 line end and control, 1 space, 2 a-z, 3 A-Z, 4 digit, 5 sentence marks, 6 ! and ?,
# 7 bar, 8 other ASCII symbols, 9 first byte of a non-ASCII character, 10 its other bytes
_KIND = np.full(256, 8, dtype=np.int64)
_KIND[:32] = _KIND[127] = 0
_KIND[[9, 32]] = 1
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 2, 3, 4
_KIND[[ord(c) for c in ".,;:'\"-()"]] = 5
_KIND[[ord(c) for c in "!?"]] = 6
_KIND[ord("|")] = 7
_KIND[128:192], _KIND[192:] = 10, 9
_KINDS = 11
BASE, DAMP = 12, 8
STEPS = np.array([0.01, 0.05, 0.15, 0.35], dtype=np.float32)
SHARES = 7                                     # the first features, cut into steps too


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base features of every non-blank line, line lengths, and per text the n+1 offsets."""
    raw, offsets = text_bytes(texts)
    if not len(raw):
        return np.zeros((0, BASE), np.float32), np.zeros(0), np.zeros(len(texts) + 1, np.int64)
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(raw == 10) + 1]))
    starts = starts[starts < len(raw)]
    ends = np.append(starts[1:], len(raw))
    n = len(starts)
    line = np.repeat(np.arange(n), ends - starts)
    kind = _KIND[raw]
    c = np.bincount(line * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS).astype(np.float32)
    solid = kind > 1
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[starts] = solid[starts]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[ends - 1] = solid[ends - 1]
    word_at, word_line = np.flatnonzero(first), line[first]
    word = span_hashes(raw, word_at, np.flatnonzero(last) + 1)
    same = np.flatnonzero((word[1:] == word[:-1]) & (word_line[1:] == word_line[:-1])) + 1
    n_words = np.bincount(word_line, minlength=n)
    n_same = np.bincount(word_line[same], minlength=n)
    chars = c[:, 1:10].sum(axis=1)
    letters = c[:, 2] + c[:, 3] + c[:, 9] + DAMP
    size = chars + DAMP
    # a line that stood earlier in the same text (the line end is not part of it)
    trimmed = ends - (raw[ends - 1] == 10)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    key = span_hashes(raw, starts, trimmed) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    again = np.ones(n, dtype=bool)
    again[np.unique(key, return_index=True)[1]] = False
    x = np.stack([c[:, 3] / letters, c[:, 4] / size, c[:, 5] / size, c[:, 6] / size, c[:, 7] / size,
                  c[:, 8] / size, n_same / (n_words + 2), c[:, 9] / size,
                  c[:, 1] / size, np.minimum(size / np.maximum(n_words, 1) / 20, 1), np.log1p(chars) / 8, again], axis=1)
    keep = c[:, 2:].sum(axis=1) > 0
    return x[keep].astype(np.float32), chars[keep].astype(np.float64), np.searchsorted(np.flatnonzero(keep),
                                                                                       np.searchsorted(starts, offsets))


def expand(base: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of the line, of the one before and the one after (0 at the ends), and 1."""
    steps_ = (base[:, :SHARES, None] > STEPS).reshape(len(base), SHARES * len(STEPS))
    own = np.concatenate([base, steps_.astype(np.float32)], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    some = offsets[:-1] < offsets[1:]
    before[offsets[:-1][some]] = 0
    after[offsets[1:][some] - 1] = 0
    return np.concatenate([own, before, after, np.ones((len(own), 1), np.float32)], axis=1)


def forward_backward(good: np.ndarray, transitions: np.ndarray, offsets: np.ndarray):
    """Marginals of all chains at once, one place of every chain per round.

    ``good`` is the log potential of state 1 (good) against 0 at every line,
    ``transitions`` the 2 x 2 log potentials.  Returns the marginals P(good)
    and the scaled forward, potential and backward tables."""
    n, move = len(good), np.exp(transitions)
    psi = np.stack([np.exp(-np.maximum(good, 0)), np.exp(np.minimum(good, 0))], axis=1)
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    start, size = offsets[:-1][order], size[order]
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for p, m in enumerate(live):
        at = start[:m] + p
        a = psi[at] if p == 0 else (forward[at - 1] @ move) * psi[at]
        forward[at] = a / a.sum(axis=1, keepdims=True)
    for p in range(len(live) - 2, -1, -1):
        at = start[:live[p + 1]] + p
        b = (psi[at + 1] * backward[at + 1]) @ move.T
        backward[at] = b / b.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300), forward, psi, backward


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    transitions: np.ndarray
    curve: np.ndarray                # of 1, the raw quality and its log odds

    def raw(self, base: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        p = forward_backward(expand(base, offsets) @ self.weights, self.transitions, offsets)[0]
        total = np.concatenate([[0.0], np.cumsum(sizes)])
        part = np.concatenate([[0.0], np.cumsum(sizes * p)])
        return (part[offsets[1:]] - part[offsets[:-1]]) / np.maximum(total[offsets[1:]] - total[offsets[:-1]], 1)

    def score(self, texts: pa.Array) -> np.ndarray:
        return _sigmoid(_curve(self.raw(*lines_of(texts))) @ self.curve)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _curve(raw: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(raw)), raw, np.log((raw + 1e-3) / (1 - raw + 1e-3))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 25) -> np.ndarray:
    """Newton's method for weighted ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (y - p)) - l2 * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_field(x: np.ndarray, y: np.ndarray, weight: np.ndarray, offsets: np.ndarray, w: np.ndarray):
    """Weighted conditional log-likelihood by Adam, from the single-line weights."""
    t = np.zeros((2, 2))
    inner = np.ones(len(y), dtype=bool)
    inner[offsets[:-1][offsets[:-1] < offsets[1:]]] = False
    later = np.flatnonzero(inner)
    theta = np.concatenate([w, t.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = weight.sum()
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later - 1], y[later]), weight[later])
    for i in range(1, ITERATIONS + 1):
        w, t = theta[:-4], theta[-4:].reshape(2, 2)
        p, forward, psi, backward = forward_backward(x @ w, t, offsets)
        pair = forward[later - 1][:, :, None] * np.exp(t) * (psi[later] * backward[later])[:, None, :]
        pair *= (weight[later] / pair.sum(axis=(1, 2)))[:, None, None]
        grad = np.concatenate([x.T @ (weight * (y - p)), (seen - pair.sum(axis=0)).ravel()]) / total - L2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _fit(docs: list[tuple[int, np.ndarray, np.ndarray]], share_good: float) -> QualityModel:
    label = np.array([d[0] for d in docs])
    offsets = np.concatenate([[0], np.cumsum([len(d[2]) for d in docs])])
    base, sizes = np.concatenate([d[1] for d in docs]), np.concatenate([d[2] for d in docs])
    x, of_doc = expand(base, offsets).astype(np.float64), np.repeat(label, np.diff(offsets))
    # documents of either label weigh as much as they do in the labelled rows
    doc_weight = np.where(label == 1, share_good / max((label == 1).sum(), 1),
                          (1 - share_good) / max((label == 0).sum(), 1)) * len(docs)
    even = np.where(of_doc == 1, 0.5 / max((of_doc == 1).sum(), 1), 0.5 / max((of_doc == 0).sum(), 1)) * len(of_doc)
    p = _sigmoid(x @ _logistic(x, of_doc, even, 1.0))
    y = np.where(of_doc == 1, 1, (p > 0.5).astype(int))
    for a, b, k in zip(offsets[:-1], offsets[1:], label, strict=True):
        if k == 0 and b > a:
            y[a + int(p[a:b].argmin())] = 0
    weight = np.repeat(doc_weight, np.diff(offsets))
    weights, transitions = _fit_field(x, y, weight, offsets, _logistic(x, y, weight, 1.0))
    raw = QualityModel(weights, transitions, np.zeros(3)).raw(base, sizes, offsets)
    return QualityModel(weights, transitions, _logistic(_curve(raw), label, doc_weight, 0.1))


def fit_quality(docs: DataFrame, labels: DataFrame, column: str = "text", key: str = "doc_id",
                label: str = "quality", docs_per_class: int = DOCS_PER_CLASS,
                lines_per_class: int = LINES_PER_CLASS) -> QualityModel | None:
    """The model learned from a bounded sample of ``docs`` labelled in ``labels``
    (``key``, ``label`` 0 or 1); None unless both labels occur."""
    known = (labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
             .filter(F.col("k").isNotNull() & F.col("y").isin(0, 1)).groupBy("k").agg(F.min("y").alias("y")))
    # labels of documents with a line, the only ones that can be learned from
    known = known.join(docs.filter(F.col(f"`{column}`").rlike(r"[^\x00-\x20\x7f]")).select(F.col(f"`{key}`").alias("k")),
                       "k", "left_semi")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    space = 1 << 30
    rates = F.create_map(*[F.lit(v) for y, n in counts.items()
                           for v in (y, min(space, 20 + int(1.5 * space * docs_per_class / n)))])
    picked = known.withColumn("h", F.pmod(F.xxhash64("k"), F.lit(space))).filter(F.col("h") < rates[F.col("y")])
    picked = F.broadcast(picked.limit(4 * docs_per_class + 1000))        # the sample's bound, so the broadcast's
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{column}`").alias("text")).join(picked, "k")

    def features(batches):
        seen: set[int] = set()                       # a document's rows are learned from once
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("y", "h")}
            at = 0
            for texts in steps(batch.column("text")):
                base, sizes, of = lines_of(texts)
                for i in range(len(texts)):
                    h = columns["h"][at + i]
                    if h not in seen and len(base[of[i]:of[i + 1]]):
                        seen.add(h)
                        yield pa.RecordBatch.from_pydict({
                            "y": pa.array([columns["y"][at + i]], pa.int32()), "h": pa.array([h], pa.int64()),
                            "base": [base[of[i]:of[i + 1]].tobytes()], "sizes": [sizes[of[i]:of[i + 1]].tobytes()]})
                at += len(texts)

    found = {(r.y, r.h): (bytes(r.base), bytes(r.sizes)) for r in rows.mapInArrow(
        features, "y int, h long, base binary, sizes binary").toLocalIterator()}
    sample, lines, taken = [], {0: 0, 1: 0}, {0: 0, 1: 0}
    for y, h in sorted(found):
        base, sizes = (np.frombuffer(found[y, h][0], np.float32).reshape(-1, BASE),
                       np.frombuffer(found[y, h][1], np.float64))
        if taken[y] < docs_per_class and lines[y] + len(base) <= lines_per_class:
            taken[y] += 1
            lines[y] += len(base)
            sample.append((y, base, sizes))
    if not taken[0] or not taken[1]:
        return None
    return _fit(sample, counts[1] / (counts[0] + counts[1]))


def score_quality(df: DataFrame, model: QualityModel | None, column: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the quality ``score`` of ``column`` (0 to 1, higher: better)."""
    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def work(texts: pa.Array) -> list[pa.Array]:
            return [pa.array(np.ones(len(texts)) if model is None else model.score(texts))]
        return work

    return append_columns(df, column, [(score, DoubleType())], make)
