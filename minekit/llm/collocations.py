"""Phrase collocations by SON partitioning.

The corpus is dealt by a hash of the text into ``shards`` logical shards, each
spread over as many tasks as it needs.

1.  Every shard is mined completely at its share of the support: a phrase that
    occurs ``min_count`` times occurs at least ``ceil(min_count / shards)`` times
    in some shard.  Words and pairs are counted first; a longer phrase is counted
    in a shard only where both phrases one word shorter are frequent there.
2.  The union of the locally frequent phrases are the candidates, less those that
    cannot reach ``min_count`` with what a shard can hold of a phrase that is not
    frequent there.
3.  All candidates are counted over the whole corpus, exactly.

Mining counts 64-bit hashes, and sets of phrases travel to the tasks as a
table of ``bits`` bits: both may take a phrase for frequent that is not, never
the reverse.  The last count is of the words themselves, told apart by their
bytes, so nothing of this reaches the result.  Where there are more candidates
than ``bits / 8`` they are counted in as many scans as keep the table sparse.

Cutting a phrase in two gives ``l`` and ``r``, the occurrences of its parts; its
score is ``floor(1000000 * a * a / (l * r))`` at the lowest-scoring cut (ties: the
first).  Phrases of which a longer one holds ``share`` per cent of the
occurrences are dropped.

Defined cases: a null text is empty; a null language is ``und``, together with
rows of that name; repeated rows count as often as they stand there; words and
texts may be of any length (a long text is cut at the ends of its pieces); an
empty table, or one without frequent phrases, gives no rows; other columns are
ignored.  Counts up to 10^16 are exact, more raise an overflow error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.llm.frames import release_memory, steps
from minekit.llm.spans import distinct_spans, mix, span_hashes, text_bytes, words
from minekit.operators.numbering import number_rows
from minekit.session import materialize

#: Logical shards of the corpus, a power of two.
SHARDS = 4
#: Bits of the table of phrases that the tasks get (a power of two; 16 MB).
BITS = 1 << 27
#: Text bytes of one step.
STEP_BYTES = 4 << 20
#: Occurrences that a task sorts and counts at once.
HELD_KEYS = 2_000_000
#: Rows of a batch that a task hands on.
BATCH = 1 << 16

_BLOCKS = 64
_U = np.uint64
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_IS_WORD = ~_BREAK
_IS_WORD[[9, 32]] = False


def _cut(text: pa.Array, step: int) -> Iterator[pa.Array]:
    """A single long text in parts that end where pieces end."""
    raw, _ = text_bytes(text)
    if len(raw) <= step:
        yield text
        return
    ends = np.flatnonzero(_BREAK[raw]) + 1
    at = ends[np.searchsorted(ends, np.arange(step, len(raw), step)).clip(max=max(len(ends) - 1, 0))] if len(ends) else []
    offsets = np.unique(np.concatenate([[0], at, [len(raw)]]).astype(np.int64))
    parts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(raw))])
    for i in range(len(parts)):
        yield parts.slice(i, 1)


class _Step:
    """The words of some texts; ``of`` holds the n+1 offsets of the texts into them."""

    def __init__(self, texts: pa.Array):
        self.buf, self.starts, self.ends, of = words(texts, _IS_WORD)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(of))
        # both counts only grow, so their sum is the same for words of one piece
        self.piece = np.searchsorted(np.flatnonzero(_BREAK[self.buf]), self.starts) + self.doc
        self.word = span_hashes(self.buf, self.starts, self.ends)

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length n: n, the first words of all phrases, and the hash of what begins at every word."""
        h = self.word
        for n in range(1, longest + 1):
            if n > 1:
                h = mix(h[:-1] * _U(0x9E3779B97F4A7C15) + self.word[n - 1:])
            if not len(h):
                return
            yield n, np.flatnonzero(self.piece[:len(h)] == self.piece[n - 1:]), h


def _each(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[tuple[_Step, list[pa.Array]]]:
    """Steps over the first column, with the other columns of their rows."""
    for batch in batches:
        at = 0
        for texts in steps(batch.column(0), step):
            others = [batch.column(i).slice(at, len(texts)) for i in range(1, batch.num_columns)]
            at += len(texts)
            for part in _cut(texts, step) if len(texts) == 1 else [texts]:
                found = _Step(part)
                if len(found.word):
                    yield found, others


def _batches(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, BATCH):
        yield rows.slice(at, BATCH)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(_U)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(keys).view(np.int64))


class _Keys:
    """64-bit keys of phrases: a hash with the language, and below it the shard's number."""

    def __init__(self, shards: int):
        self.low = _U(shards.bit_length() - 1)
        self.mask = _U((1 << 64 - int(self.low)) - 1)

    def whole(self, h: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return mix(h ^ salt) & self.mask

    def local(self, whole: np.ndarray, shard: np.ndarray) -> np.ndarray:
        return whole << self.low | shard


class _Bits:
    """A table of bits in ``_BLOCKS`` parts: the low six bits of a key choose the part."""

    def __init__(self, parts: list[tuple[int, bytes]], bits: int):
        self.size = bits // _BLOCKS
        self.table = np.zeros(bits // 8, dtype=np.uint8)
        for block, data in parts:
            at = block * self.size // 8
            self.table[at:at + self.size // 8] = np.frombuffer(data, np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = (keys & _U(_BLOCKS - 1)) * _U(self.size) + (keys >> _U(6) & _U(self.size - 1))
        return (self.table[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)


def _table(keys: DataFrame, bits: int) -> list[tuple[int, bytes]]:
    """The parts of the bit table of a long column ``key``: its size is ``bits``, however many keys."""
    size = bits // _BLOCKS
    place = F.shiftrightunsigned("key", 6).bitwiseAND(F.lit(size - 1))
    longs = keys.groupBy(F.col("key").bitwiseAND(F.lit(_BLOCKS - 1)).cast("int").alias("block"),
                         F.shiftright(place, 6).cast("int").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(((key >>> 6) & 63) as int)))").alias("x"))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        out = np.zeros(size // 64, dtype="<i8")
        out[rows["at"].to_numpy()] = rows["x"].to_numpy()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([out.tobytes()], pa.binary())})

    return [(r.block, bytes(r.data)) for r in longs.groupBy("block").applyInArrow(
        pack, "block int, data binary").collect()]


def _mine(docs: DataFrame, support: int, lengths: range, shorter: _Bits | None, keys: _Keys, step: int) -> DataFrame:
    """``key, n`` of the phrases of some lengths that are frequent in their shard."""
    known = docs.sparkSession.sparkContext.broadcast(shorter) if shorter else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([_signed(key), pa.array(n)], names=["key", "n"])

        for found, (salts, shards) in _each(batches, step):
            salt, shard = _numbers(salts)[found.doc], _numbers(shards)[found.doc]
            last = None
            for n, first, h in found.phrases(lengths[-1]):
                if n < lengths[0] - 1:
                    continue
                local = keys.local(keys.whole(h, salt[:len(h)]), shard[:len(h)])
                if n >= lengths[0]:
                    if last is not None:
                        first = first[last[first] & last[first + 1]]
                    held.append(local[first])
                    size += len(first)
                last = known.value.holds(local) if known else None
            if size >= HELD_KEYS:
                yield from _batches(counts())
                held, size = [], 0
        if held:
            yield from _batches(counts())
        held = []
        release_memory()

    # the tasks have added up what repeats near by, so rows go to their keys' tasks as they are
    return (docs.select("text", "salt", "shard").mapInArrow(run, "key long, n long").repartition("key")
            .groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= support))


def _count(docs: DataFrame, parts: list[tuple[int, bytes]], bits: int, longest: int, this: int, rounds: int,
           keys: _Keys, step: int) -> DataFrame:
    """(lang, words, phrase, n) of the candidates of one scan, and with no words the number of all words."""
    known = docs.sparkSession.sparkContext.broadcast(_Bits(parts, bits))

    def rows(lang: pa.Array, n: int, phrase: pa.Array, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [lang.cast(pa.string()), pa.array(np.full(len(count), n, np.int32)), phrase.cast(pa.string()),
             pa.array(count.astype(np.int64))], names=["lang", "words", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, (salts, langs) in _each(batches, step):
            salt, coded = _numbers(salts)[found.doc], langs.dictionary_encode()
            lang = coded.indices.to_numpy().astype(np.int64)[found.doc]
            which, values = distinct_spans(found.buf, found.starts, found.ends)
            which, values = which.astype(np.int64), values.cast(pa.large_string())
            if this == 0:
                total = np.bincount(lang, minlength=len(coded.dictionary))
                yield rows(coded.dictionary, 0, pa.array([""] * len(total)), total)
            for n, first, h in found.phrases(longest):
                key = keys.whole(h[first], salt[first])
                first = first[known.value.holds(key) & (key % _U(rounds) == _U(this))]
                # a number for the language and each word, kept small by counting those that occur
                code, room = lang[first], len(coded.dictionary)
                heads: list[np.ndarray] = []
                for i in range(n):
                    if room > 2 ** 62 // max(len(values), 1):
                        some, code = np.unique(code, return_inverse=True)
                        heads.append(some)
                        room = len(some)
                    else:
                        heads.append(np.zeros(0, np.int64))
                    code = code * len(values) + which[first + i]
                    room *= len(values)
                code, count = np.unique(code, return_counts=True)
                if not len(code):
                    continue
                split = []
                for some in reversed(heads):
                    code, w = np.divmod(code, len(values))
                    split.append(values.take(pa.array(w)))
                    code = some[code] if len(some) else code
                phrase = pc.binary_join_element_wise(*reversed(split), pa.scalar(" ", pa.large_string()))
                yield from _batches(rows(coded.dictionary.take(pa.array(code)), n, phrase, count))
        release_memory()

    return docs.select("text", "salt", "lang").mapInArrow(run, "lang string, words int, phrase string, n long")


def frequent_phrases(docs: DataFrame, column: str = "text", lang: str = "lang", min_count: int = 10, longest: int = 3,
                     shards: int = SHARDS, bits: int = BITS, step: int = STEP_BYTES) -> DataFrame:
    """``lang, words, phrase, n``: every phrase of up to ``longest`` words that occurs at
    least ``min_count`` times in its language, and with ``words`` 0 the number of all words."""
    if shards < 1 or shards & shards - 1:
        raise ValueError("shards must be a power of two")
    docs = docs.select(F.col(f"`{column}`").alias("text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    docs = docs.filter(F.col("text").isNotNull()).withColumn("salt", F.xxhash64("lang")).withColumn(
        "shard", F.pmod(F.xxhash64("text"), F.lit(shards)))
    keys, support = _Keys(shards), -(-min_count // shards)
    mined = [materialize(_mine(docs, support, range(1, min(longest, 2) + 1), None, keys, step), "mined")]
    for n in range(3, longest + 1):
        shorter = _Bits(_table(mined[-1], bits), bits)
        mined.append(materialize(_mine(docs, support, range(n, n + 1), shorter, keys, step), "mined"))
    union = mined[0]
    for more in mined[1:]:
        union = union.unionByName(more)
    # the shards that do not list a phrase have at most support - 1 of it each
    union = union.groupBy(F.shiftrightunsigned("key", int(keys.low)).alias("key")).agg(
        (F.sum("n") + (shards - F.count(F.lit(1))) * (support - 1)).alias("most"))
    union = materialize(union.filter(F.col("most") >= min_count).select("key"), "candidates")
    rounds = max(1, -(-union.count() // (bits // 8)))
    counted = None
    for this in range(rounds):
        parts = _table(union.filter(F.pmod("key", F.lit(rounds)) == this) if rounds > 1 else union, bits)
        got = _count(docs, parts, bits, longest, this, rounds, keys, step)
        counted = got if counted is None else counted.unionByName(got)
    counted = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return materialize(counted.filter((F.col("words") == 0) | (F.col("n") >= min_count)), "phrases")


def collocations(docs: DataFrame, column: str = "text", lang: str = "lang", min_count: int = 10, longest: int = 3,
                 top: int = 2000, share: int = 50, shards: int = SHARDS, bits: int = BITS,
                 step: int = STEP_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language."""
    found = frequent_phrases(docs, column, lang, min_count, longest, shards, bits, step)
    totals = found.filter("words = 0").select("lang", F.col("n").alias("total"))       # a row per language
    known = found.filter("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    phrases = found.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"),
                                               F.split("phrase", " ").alias("w"))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
                       part(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) "
                   "as decimal(31,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # phrases of two or more words within longer ones
    inside = phrases.filter("words > 2").select("lang", "w", "words", "a", F.explode(
        F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inside = inside.select("lang", "w", "a", "size", F.explode(
        F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("first"))
    inside = inside.groupBy("lang", part(F.col("first"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = (scored.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))

    # numbers in the order of all languages; a language's ranks begin at its first
    order = [F.asc("lang"), F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = number_rows(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), order)
    heads = ranked.groupBy("lang").agg(F.min("number").alias("head")).join(totals, "lang")
    rank = (F.col("number") - F.col("head") + 1).alias("rank")
    ranked = ranked.join(heads, "lang").filter(F.col("number") < F.col("head") + top)
    return ranked.select("lang", rank, "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
