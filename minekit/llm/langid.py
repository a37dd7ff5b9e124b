"""Language identification by a string kernel.

The kernel of two texts is the number of byte n-grams (2 to 4 bytes, blended)
that occur in both, whatever how often, over the geometric mean of their
numbers of distinct n-grams.  N-grams are hashed into ``BINS`` bins, so a text
is a 0/1 row.  Landmark texts span the Nystroem feature space; one-versus-rest
kernel ridge regression is fitted on the sampled rows in that space, and a
batch of texts is scored by one product of its 0/1 matrix with the landmark
matrix times the regression's coefficients (that product is formed once).

Fitting takes at most ``PER_LANGUAGE`` rows per language (rows chosen by a
hash, so the choice does not depend on partitions), of which
``LANDMARKS_PER_LANGUAGE`` are landmarks.  Everything else sees every row and
every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from; rows with a null
language or text are not learned from; equal margins go to the language first
in order; copies of a text in one language are learned from once; existing columns
named like the output are replaced, others kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from minekit.llm.frames import append_columns, steps
from minekit.llm.spans import text_bytes

BINS = 1 << 14
PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 400, 64
RIDGE = 1e-3
#: Rows of one dense 0/1 matrix.
ROWS = 64
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _bins(raw: np.ndarray) -> list[np.ndarray]:
    """For n = 2, 3, 4: the bin of the n-gram that begins at each byte."""
    code = _LOWER[raw]
    out, n = [], len(code)
    gram = code.copy()
    for size in (2, 3, 4):
        gram = gram[:max(0, n - size + 1)] | code[size - 1:] << np.uint32(8 * (size - 1))
        h = gram * np.uint32(2654435761) + np.uint32(size * 40503)
        h ^= h >> np.uint32(15)
        h *= np.uint32(2246822519)
        out.append(h >> np.uint32(32 - 14))
    return out


def presence(texts: pa.Array):
    """Yields (first row, 0/1 matrix) for at most ``ROWS`` texts at a time."""
    raw, offsets = text_bytes(texts)
    bins = _bins(raw)
    for lo in range(0, len(texts), ROWS):
        hi = min(len(texts), lo + ROWS)
        x = np.zeros((hi - lo, BINS), dtype=np.float32)
        for i in range(lo, hi):
            a, b = offsets[i], offsets[i + 1]
            for size, at in zip((2, 3, 4), bins, strict=True):
                x[i - lo, at[a:max(a, b - size + 1)]] = 1
        yield lo, x


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray              # BINS x languages: landmarks times coefficients

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Best language and its score for every text (letters are not checked)."""
        best, score = [], np.zeros(len(texts))
        for lo, x in presence(texts):
            margin = x @ self.weights / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
            top = margin.argmax(axis=1)
            best += [self.languages[i] for i in top]
            score[lo:lo + len(x)] = np.clip((margin[np.arange(len(x)), top] + 1) / 2, 0, 1)
        return best, score


def _fit(rows: list[tuple[str, bytes]], per_language: int, landmarks: int, ridge: float) -> LanguageModel | None:
    """Kernel ridge regression on (language, packed 0/1 row), in the given order."""
    by: dict[str, list[bytes]] = {}
    for language, bits in rows:
        by.setdefault(language, []).append(bits)
    languages = sorted(by)
    if not languages:
        return None

    def unpack(bits: list[bytes]) -> np.ndarray:
        x = np.unpackbits(np.frombuffer(b"".join(bits), dtype=np.uint8)).reshape(len(bits), BINS).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    marks = np.concatenate([unpack(by[k][:landmarks]) for k in languages])
    k_mm = (marks @ marks.T).astype(np.float64)
    a, y_k, n = np.zeros_like(k_mm), np.zeros((len(marks), len(languages))), 0
    for c, language in enumerate(languages):
        sample = by[language][:per_language]
        target = np.full(len(languages), -1.0)
        target[c] = 1.0
        for lo in range(0, len(sample), ROWS):
            k = (unpack(sample[lo:lo + ROWS]) @ marks.T).astype(np.float64)
            w = 1.0 / len(sample)                     # languages weigh alike
            a += w * k.T @ k
            y_k += w * k.sum(axis=0)[:, None] * target
            n += len(k)
    # minimise sum w (K alpha - y)^2 + ridge alpha' K_mm alpha
    alpha = np.linalg.solve(a + ridge * k_mm + 1e-6 * np.eye(len(marks)), y_k)
    return LanguageModel(languages, (marks.T @ alpha.astype(np.float32)).astype(np.float32))


def fit_languages(train: DataFrame, column: str = "text", language: str = "lang",
                  per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE,
                  ridge: float = RIDGE) -> LanguageModel | None:
    """The model learned from a bounded sample of ``train``; None without rows.

    ``per_language`` bounds the rows learned from, for each language."""
    rows = train.select(F.col(f"`{column}`").alias("text"), F.col(f"`{language}`").alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    # copies are learned from once, so they count once
    counts = {r.lang: r.n for r in rows.select("lang", F.xxhash64("text").alias("h")).distinct()
              .groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # a row's hash decides; half as many again as wanted pass, the smallest hashes are kept
    space = 1 << 30
    rates = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(space, 20 + int(1.5 * space * per_language / n)))])
    picked = (rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(space)))
              .filter(F.col("h") < rates[F.col("lang")]).select("lang", "h", "text"))

    def features(batches):
        seen: set[tuple[str, int]] = set()            # copies of a text are learned from once
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            new = [k not in seen and not seen.add(k) for k in keys]
            batch = batch.filter(pa.array(new, pa.bool_()))
            for texts, at in _with_rows(batch.column(2)):
                bits = [b.tobytes() for _, x in presence(texts) for b in np.packbits(x > 0, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)),
                     pa.array(bits, pa.binary())], names=["lang", "h", "bits"])

    got: dict[str, dict[int, bytes]] = {}
    for r in picked.mapInArrow(features, "lang string, h long, bits binary").toLocalIterator():
        kept = got.setdefault(r.lang, {})
        kept[r.h] = bytes(r.bits)
        if len(kept) >= 2 * per_language:
            for h in sorted(kept)[per_language:]:
                del kept[h]
    return _fit([(k, got[k][h]) for k in sorted(got) for h in sorted(got[k])], per_language, landmarks, ridge)


def _with_rows(texts: pa.Array):
    at = 0
    for part in steps(texts):
        yield part, at
        at += len(part)


def identify_languages(df: DataFrame, model: LanguageModel | None, column: str = "text",
                       prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the ``prediction`` and its ``score`` (0 to 1)."""
    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def work(texts: pa.Array) -> list[pa.Array]:
            if model is None:
                return [pa.array([UNKNOWN] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))]
            best, value = model.predict(texts)
            known = pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
            return [pa.array([b if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                    pa.array(np.where(known, value, 0.0))]
        return work

    return append_columns(df, column, [(prediction, StringType()), (score, DoubleType())], make)
