"""N-gram Jaccard self-join by a token-group matrix.

A document's set holds the 64-bit hashes of its distinct word shingles.
Equal sets are one class, keyed by a 64-bit hash of the set, and only classes
are compared.  All tokens have one global order, rare ones first: two sets
that are similar enough share a token among the first few of both.

1.  Tokens that a task meets often are counted over all documents; the
    ``FREQUENT`` most frequent go last in the order, by count.  (The order
    changes the work, never the result.)
2.  Each class posts the tokens of its prefix.  Among the classes that post a
    token the smallest is its pivot; a class joins the group of the pivot that
    it meets most often, and is compared with that pivot if they share enough
    tokens to be linked.
3.  Groups are cut into blocks of about ``BLOCK`` classes.  A class is set
    against a block only where it holds members of other components, and the
    places and the number of shared tokens and the set sizes leave room for
    enough overlap.  The block's row of the matrix is the union of its members'
    tokens, with postings: the row bounds the overlap of the class with any
    member, and only blocks that pass are opened and their members counted.

Links between different sets thus all reach the components, though links
inside a group that is connected already are not looked for.

Defined cases: texts without words, and null texts, have an empty set and link
with nothing; a text of fewer words than a shingle is one token; rows without
an id are not linked and have no component; rows that repeat an id count as
rows of one document, which joins what each of them links to; an empty table
gives no rows; other columns are ignored.  Words and sets are told apart by
64-bit hashes whose state is mixed after every eight bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minekit.llm.components import components
from minekit.llm.frames import release_memory, steps
from minekit.llm.spans import mix, span_hashes, words
from minekit.session import materialize

#: Tokens kept in the table of frequent tokens (its bound, 12 bytes each).
FREQUENT = 100_000
#: Occurrences in one task from which a token is counted over all tasks.
FREQUENT_IN_TASK = 4
#: Tokens that a task holds between two counts, and different ones that it keeps counts of.
SURVEY_TOKENS = 1_000_000
#: Classes of a block, the unit that is opened or not.
BLOCK = 256

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
            0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def shingle_sets(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, one after the other, and the n+1 offsets."""
    buf, starts, ends, of = words(texts, _IS_WORD)
    word = span_hashes(buf, starts, ends)
    n = np.diff(of)
    total = np.zeros(max(0, len(word) - k + 1), dtype=np.uint64)
    for i in range(k):
        total += word[i:i + len(total)] * np.uint64(_FACTORS[i])
    total = mix(total)
    parts, sizes = [], np.zeros(len(n) + 1, dtype=np.int64)
    for i, (a, m) in enumerate(zip(of[:-1].tolist(), n.tolist(), strict=True)):
        if m >= k:
            got = np.unique(total[a:a + m - k + 1])
        elif m:
            whole = sum(int(w) * f for w, f in zip(word[a:a + m], _FACTORS)) + m
            got = mix(np.array([whole & (1 << 64) - 1], dtype=np.uint64))
        else:
            continue
        parts.append(got)
        sizes[i + 1] = len(got)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(sizes)


def set_keys(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of every set (0 for empty ones)."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    keys = mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)
    return np.where(np.diff(offsets) > 0, keys, 0)


def _int64(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


class _Frequent:
    """The table of frequent tokens, looked up behind a bit table."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(tokens & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def count(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros(len(tokens), dtype=np.int64)
        if len(self.tokens):
            maybe = np.flatnonzero(self.bits[(tokens & np.uint64(0xFFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
            hit = self.tokens[at] == tokens[maybe]
            out[maybe[hit]] = self.counts[at[hit]]
        return out


def _survey(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """One pass: (id, n, set) of every row, and counts of the tokens that tasks meet often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: dict[int, int] = {}
        held: list[np.ndarray] = []
        room = 0

        def count() -> None:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            for t, m in zip(tokens[n > 1].view(np.int64).tolist(), n[n > 1].tolist()):
                often[t] = often.get(t, 0) + m

        for batch in batches:
            at = 0
            for texts in steps(batch.column(1)):
                tokens, of = shingle_sets(texts, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(texts), np.int32)), batch.column(0).slice(at, len(texts)),
                     _int64(np.diff(of)), _int64(set_keys(tokens, of))], names=["kind", "x", "n", "y"])
                at += len(texts)
                held.append(tokens)
                room += len(tokens)
                if room > SURVEY_TOKENS:
                    count()
                    held, room = [], 0
                    if len(often) > SURVEY_TOKENS:                   # rare ones so far make room
                        often = {t: n for t, n in often.items() if n >= FREQUENT_IN_TASK}
        if held:
            count()
        held = []
        kept = {t: n for t, n in often.items() if n >= FREQUENT_IN_TASK}
        if kept:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(kept), np.int32)), pa.array(list(kept), pa.int64()),
                 pa.array(list(kept.values()), pa.int64()), pa.array(np.zeros(len(kept), np.int64))],
                names=["kind", "x", "n", "y"])
        often = {}
        release_memory()

    both = materialize(docs.mapInArrow(run, "kind int, x long, n long, y long"), "survey")
    sets = both.filter("kind = 0").select(F.col("x").alias("id"), "n", F.col("y").alias("set"))
    often = both.filter("kind = 1").groupBy(F.col("x").alias("token")).agg(F.sum("n").alias("n"))
    return sets, often


def _postings(docs: DataFrame, frequent: _Frequent, k: int, num: int, den: int) -> DataFrame:
    """(token, set, n, pos) of the prefix of every class, about once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for texts in steps(batch.column(0)):
                tokens, of = shingle_sets(texts, k)
                keys, count = set_keys(tokens, of).tolist(), frequent.count(tokens)
                some = np.concatenate([[0], np.cumsum(count > 0)])
                out, sets, sizes = [], [], []
                for key, a, b in zip(keys, of[:-1].tolist(), of[1:].tolist(), strict=True):
                    if a == b or key in seen:
                        continue
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    n = b - a
                    first = n - -(-n * num // den) + 1
                    mine = tokens[a:b]
                    if some[b] > some[a]:
                        mine = mine[np.argsort(count[a:b], kind="stable")]     # hashes are in order already
                    out.append(mine[:first])
                    sets.append(key)
                    sizes.append((n, len(out[-1])))
                if out:
                    lens = np.array([m for _, m in sizes])
                    ends = np.cumsum(lens)
                    yield pa.RecordBatch.from_arrays(
                        [_int64(np.concatenate(out)), pa.array(np.repeat(np.array(sets, np.int64), lens)),
                         pa.array(np.repeat(np.array([n for n, _ in sizes], np.int32), lens)),
                         pa.array((np.arange(ends[-1]) - np.repeat(ends - lens, lens)).astype(np.int32))],
                        names=["token", "set", "n", "pos"])
        release_memory()

    return docs.select("text").mapInArrow(run, "token long, set long, n int, pos int")


def _token_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(group, part, asks, comp, set, tokens) for every place in ``wanted``: (id of a
    document, its set, places: array of (group, part, asks, comp))."""
    # sort-merge at every size: the places grow with the documents, so they are never broadcast
    rows = docs.join(wanted.hint("merge"), "id").select("text", "set", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in steps(batch.column(0)):
                tokens, of = shingle_sets(texts, k)
                raw, out = tokens.astype("<u8").tobytes(), []
                want = batch.column(1).slice(at, len(texts)).to_pylist()
                places = batch.column(2).slice(at, len(texts)).to_pylist()
                at += len(texts)
                for key, w, to, a, b in zip(set_keys(tokens, of).tolist(), want, places, of[:-1], of[1:], strict=True):
                    if key == w:                             # else another text under a repeated id
                        out += [(p["group"], p["part"], p["asks"], p["comp"], key, raw[8 * a:8 * b]) for p in to]
                if out:
                    cols = zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols],
                                                     names=["group", "part", "asks", "comp", "set", "tokens"])
        release_memory()

    return rows.mapInArrow(run, "group long, part int, asks boolean, comp long, set long, tokens binary")


def _tokens(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u8")


class _Block:
    """The members of a block: their tokens' union, and who holds each token."""

    def __init__(self, members: dict[int, tuple[int, np.ndarray]]):
        self.sets = np.array(list(members), dtype=np.int64)
        self.comps = np.array([c for c, _ in members.values()], dtype=np.int64)
        self.sizes = np.array([len(t) for _, t in members.values()])
        tokens = np.concatenate([t for _, t in members.values()])
        order = np.argsort(tokens, kind="stable")
        self.row, first = np.unique(tokens[order], return_index=True)
        self.ends = np.append(first, len(tokens))
        self.holders = np.repeat(np.arange(len(members)), self.sizes)[order]

    def linked(self, mine: np.ndarray, num: int, den: int) -> np.ndarray:
        """The members linked with the set ``mine``; none if the union rules it out."""
        at = np.minimum(np.searchsorted(self.row, mine), len(self.row) - 1)
        at = at[self.row[at] == mine]
        if den * len(at) < num * len(mine):
            return np.zeros(0, dtype=np.int64)
        n = self.ends[at + 1] - self.ends[at]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.ends[at], n)
        common = np.bincount(self.holders[place], minlength=len(self.sets))
        return np.flatnonzero(den * common >= num * (len(mine) + self.sizes - common))


def _open_groups(docs: DataFrame, places: DataFrame, ids: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between classes that ask and members of their group's part,
    as many as join the components that the part meets.

    ``places`` are rows (set, group, part, asks, comp); a part has a bounded
    number of members."""
    wanted = places.groupBy("set").agg(F.collect_set(F.struct("group", "part", "asks", "comp")).alias("places")).join(
        ids, "set")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        links, parent = [], {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        sides: tuple[dict, dict] = ({}, {})
        for key, comp, tokens, asks in zip(rows["set"], rows.comp, rows.tokens, rows.asks, strict=True):
            sides[bool(asks)][key] = (comp, _tokens(tokens))
        if sides[0] and sides[1]:
            block = _Block(sides[0])
            for key, (comp, mine) in sides[1].items():
                for i in block.linked(mine, num, den).tolist():
                    a, b = find(comp), find(int(block.comps[i]))
                    if a != b:
                        parent[a] = b
                        links.append((key, int(block.sets[i])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return _token_sets(docs, wanted.select("id", "set", "places"), k).groupBy("group", "part").applyInPandas(
        run, "a long, b long")


def _least_shared(n: Column, m: Column, num: int, den: int) -> Column:
    """The least number of shared prefix tokens that linked sets of sizes ``n`` and ``m`` have.

    What follows the prefix of the set whose prefix ends first can add at most
    its own length to the overlap that is needed."""
    def rest(size: Column) -> Column:
        return F.ceil(size * num / den) - 1

    return F.ceil((n + m) * num / (num + den)) - F.greatest(rest(n), rest(m))


def _least_shared_within(n: Column, low: Column, high: Column, num: int, den: int) -> Column:
    """The least of ``_least_shared(n, m)`` over all sizes ``m`` from ``low`` to ``high``.

    Up to ``n`` it grows with ``m``.  From ``n`` on it is above g(m) and at most
    two above floor(g(m)), where g(m) = (n + m) * num / (num + den) - m * num / den
    falls: sizes so far below ``high`` that g is greater by 1 need no fewer than
    ``high``, so those nearer to it are tried, or floor(g(high)) + 1 stands for
    them if they are many."""
    near = -(-den * (num + den) // num ** 2)
    if near > 16:
        tail = [F.floor((n * den - high * num) * num / (den * (num + den))) + 1]
    else:
        tail = [_least_shared(n, F.greatest(low, high - j), num, den) for j in range(near)]
    return F.least(_least_shared(n, low, num, den), *tail)


def similar_documents(docs: DataFrame, column: str = "text", key: str = "doc_id", k: int = 5,
                      num: int = 80, den: int = 100) -> DataFrame:
    """``id, n_shingles, component`` per row: documents whose sets of ``k``-word
    shingles have Jaccard similarity of at least ``num / den`` are linked, and
    ``component`` is the smallest id reachable by links."""
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").alias("text"))
    sets, often = _survey(docs, k)
    table = often.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    frequent = _Frequent(table.token.to_numpy(np.int64).view(np.uint64), table.n.to_numpy(np.int64))

    by_token = Window.partitionBy("token")
    posted = (_postings(docs, frequent, k, num, den)
              .withColumn("pivot", F.min("set").over(by_token)).withColumn("top", F.max("set").over(by_token))
              .filter(F.col("pivot") != F.col("top")).drop("top"))
    posted = materialize(posted, "postings")                             # tokens of at least two classes
    sizes = materialize(posted.select("set", "n").distinct(), "nodes")
    ids = materialize(sets.filter(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("set").agg(
        F.min("id").alias("id")), "ids")

    # one pivot per class, that of most of its tokens: its group, and compared if those are enough
    meets = posted.filter(F.col("set") != F.col("pivot")).groupBy("set", "n", "pivot").agg(
        F.countDistinct("token").alias("c"))
    pivots = meets.groupBy("set", "n").agg(F.max(F.struct("c", "pivot")).alias("p")).select("set", "n", "p.pivot", "p.c")
    pivots = materialize(pivots.join(sizes.select(F.col("set").alias("pivot"), F.col("n").alias("m")), "pivot"), "pivots")
    asking = pivots.filter(F.col("c") >= _least_shared(F.col("n"), F.col("m"), num, den))
    parts = asking.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    places = (asking.join(parts, "pivot").select(
        "set", F.col("pivot").alias("group"), F.pmod(F.xxhash64("set"), F.col("parts")).cast("int").alias("part"),
        F.lit(True).alias("asks"), F.col("set").alias("comp"))
        .unionByName(parts.select(F.col("pivot").alias("set"), F.col("pivot").alias("group"), F.explode(
            F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asks"),
            F.col("pivot").alias("comp"))))
    near = materialize(_open_groups(docs, places, ids, k, num, den), "links")

    # the groups in blocks, and the components so far
    comp = components(near).withColumnRenamed("node", "set")
    group = (sizes.select("set").join(pivots.select("set", "pivot"), "set", "left").join(comp, "set", "left")
             .select("set", F.coalesce("pivot", "set").alias("group"), F.coalesce("component", "set").alias("comp")))
    blocks = group.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    group = materialize(group.join(blocks, "group").select(
        "set", "comp", "group", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int").alias("part")), "groups")
    cross = (posted.drop("pivot").join(group, "set")
             .withColumn("lo", F.min("comp").over(by_token)).withColumn("hi", F.max("comp").over(by_token))
             .filter(F.col("lo") != F.col("hi")).drop("lo", "hi"))
    matrix = cross.groupBy("token", "group", "part").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max(F.col("n") - F.col("pos")).alias("room"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("set").alias("last"))
    q = cross.select("token", "set", "comp", "n", (F.col("n") - F.col("pos")).alias("left"))
    # sizes that a partner in the block may have
    low = F.greatest(F.col("n_min"), F.ceil(F.col("n") * num / den))
    high = F.least(F.col("n_max"), F.floor(F.col("n") * den / num))
    # the first shared token leaves the most room; every shared token counts
    fits = F.least("left", "room") * (num + den) >= (F.col("n") + low) * num
    need = _least_shared_within(F.col("n"), low, high, num, den)
    # of a pair the smaller class asks, and only where another component is met
    others = (F.col("set") < F.col("last")) & ((F.col("comp") != F.col("lo")) | (F.col("comp") != F.col("hi")))
    opens = (q.join(matrix, "token").filter(others & (low <= high))
             .groupBy("set", "comp", "group", "part")
             .agg(F.countDistinct("token").alias("c"), F.min(need).alias("need"), F.max(fits).alias("fits"))
             .filter(F.col("fits") & (F.col("c") >= F.col("need"))).select("set", "comp", "group", "part"))
    opens = materialize(opens, "opens")
    members = group.join(opens.select("group", "part").distinct(), ["group", "part"], "left_semi")
    more = _open_groups(docs, opens.withColumn("asks", F.lit(True)).unionByName(
        members.withColumn("asks", F.lit(False))), ids, k, num, den)

    # back to documents: classes by their smallest id, documents with several sets join them
    ids = ids.withColumnRenamed("id", "rep")
    links = (near.unionByName(more).join(ids.select(F.col("set").alias("a"), F.col("rep").alias("x")), "a")
             .join(ids.select(F.col("set").alias("b"), F.col("rep").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    repeated = sets.filter("id IS NOT NULL AND n > 0").groupBy("id").agg(
        F.min("set").alias("s"), F.max("set").alias("t")).filter("s != t").select("id")
    same = (sets.filter("n > 0").join(repeated, "id").join(ids, "set")
            .select(F.col("id").alias("a"), F.col("rep").alias("b")))
    final = components(links.unionByName(same))
    rep = ids.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set", F.coalesce("component", "rep").alias("component"))
    # an empty set links with nothing, so its row is a document of its own
    out = sets.join(rep, "set", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(
        F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.col("id")).alias("component"))
