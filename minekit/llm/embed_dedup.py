"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors become one class, and every class is scaled to length 1.  The
scatter matrix of all classes gives principal axes; in their order the first
coordinates carry most of every product.  Classes are dealt by the first
coordinate into tiles, and a tile meets only those whose first coordinates are
near enough for the threshold.  For a pair of tiles one matrix product over
the leading coordinates, with each vector's suffix norm as one coordinate
more, is an upper bound of the cosine (Cauchy-Schwarz on the rest).  Pairs
that cannot reach the threshold are done; the others take in the next
coordinates, and those that survive all of them are computed in full, in
double precision, on the scaled vectors themselves.

A pair of tiles returns link counts per class and a spanning forest of its
links, never the links, so a dense group costs no more output than a sparse
one.

Defined cases: null, empty or zero vectors, and those with null or non-finite
components, link with nothing and are components of their own; rows without
an id take no part and have no component; vectors of different length never
link; rows that repeat an id are vectors of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.llm.components import components
from minekit.llm.vectors import packed, stack
from minekit.session import materialize

#: Numbers of leading coordinates after which pairs are judged, classes of a tile, rows of one product.
LEVELS, TILE, ROWS = (16, 32), 4096, 512
#: Share of surviving pairs from which a whole product is cheaper than single pairs.
DENSE = 0.02
#: Slack of all bounds, for rounding.
SLACK = 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without over- or underflow on the way; zero rows stay."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length: the scatter matrix's axes as columns, largest spread first.

    Tasks add up their matrices, Spark adds the cells; d x d numbers return."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            by: dict[int, list[bytes]] = {}
            for v in batch.column(0).to_pylist():
                by.setdefault(len(v) // 8, []).append(v)
            for d, rows in by.items():
                x = unit(stack(rows))
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_pydict({"d": np.full(d * d, d), "cell": np.arange(d * d), "s": s.ravel()})

    cells = classes.select("x").mapInArrow(run, "d long, cell long, s double").groupBy("d", "cell").agg(
        F.sum("s").alias("s")).toPandas()
    axes = {}
    for d, part in cells.groupby("d"):
        scatter = np.zeros(d * d)
        scatter[part.cell] = part.s
        axes[int(d)] = np.ascontiguousarray(np.linalg.eigh(scatter.reshape(d, d))[1][:, ::-1])
    return axes


class _Side:
    """One tile's vectors, scaled, and rotated into the principal axes with suffix norms."""

    def __init__(self, rows, axes: dict[int, np.ndarray]):
        self.unit = unit(stack(rows))
        d = self.unit.shape[1]
        self.turned = (self.unit @ axes[d]).astype(np.float32)
        tail = np.cumsum((self.unit @ axes[d])[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.levels = [n for n in LEVELS if n < d]
        self.suffix = {n: np.sqrt(tail[:, n]).astype(np.float32) for n in self.levels}

    def lead(self, n: int) -> np.ndarray:
        return np.concatenate([self.turned[:, :n], self.suffix[n][:, None]], axis=1)


def _links(a: _Side, b: _Side, lo: int, hi: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs (row of a, row of b) for the rows lo..hi of a."""
    least, cells = threshold - SLACK, (hi - lo) * len(b.unit)
    i = j = None
    for n in a.levels:
        if i is None or len(i) > DENSE * cells:
            i, j = np.nonzero(a.lead(n)[lo:hi] @ b.lead(n).T >= least)
            i += lo
        elif len(i):
            part = np.einsum("ij,ij->i", a.turned[i, :n], b.turned[j, :n]) + a.suffix[n][i] * b.suffix[n][j]
            i, j = i[part >= least], j[part >= least]
    if i is None or len(i) > DENSE * cells:
        i, j = np.nonzero(a.unit[lo:hi] @ b.unit.T >= threshold)
        return i + lo, j
    keep = np.concatenate([np.zeros(0, bool), *(
        np.einsum("ij,ij->i", a.unit[i[s:s + 65536]], b.unit[j[s:s + 65536]]) >= threshold
        for s in range(0, len(i), 65536))])
    return i[keep], j[keep]


def compare_tiles(left: pd.DataFrame, right: pd.DataFrame, same: bool, axes: dict[int, np.ndarray],
                  threshold: float) -> pd.DataFrame:
    """``cls, links, root`` of every class of two tiles (one, if ``same``) with a link
    between them; sides have ``cls, x, m`` (rows of the class)."""
    a = _Side(left.x, axes)
    b = a if same else _Side(right.x, axes)
    n_a, size = len(left), len(left) if same else len(left) + len(right)
    shift = 0 if same else n_a
    links, label = np.zeros(size, np.int64), np.arange(size)
    m_a, m_b = left.m.to_numpy(np.int64), right.m.to_numpy(np.int64)
    for lo in range(0, n_a, ROWS):
        i, j = _links(a, b, lo, min(n_a, lo + ROWS), threshold)
        if same:
            i, j = i[i != j], j[i != j]
        links += np.bincount(i, weights=m_b[j], minlength=size).astype(np.int64)
        if not same:
            links += np.bincount(j + shift, weights=m_a[i], minlength=size).astype(np.int64)
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        for s, e in zip(starts, np.append(starts, len(i))[1:], strict=True):
            met = np.unique(np.append(label[j[s:e] + shift], label[i[s]]))
            if len(met) > 1:
                label[np.isin(label, met[1:])] = met[0]
    cls = left.cls.to_numpy(np.int64) if same else np.concatenate([left.cls, right.cls]).astype(np.int64)
    some = links > 0
    return pd.DataFrame({"cls": cls[some], "links": links[some], "root": cls[label[some]]})


def near_duplicates(df: DataFrame, column: str = "embedding", key: str = "vec_id",
                    threshold: float = 0.9) -> DataFrame:
    """``id, n_links, component`` per row: vectors with a cosine of at least
    ``threshold`` are linked; ``component`` is the smallest id reachable."""
    rows = packed(df, key, column, zero=False).withColumn("x", F.when(F.col("id").isNotNull(), F.col("x")))
    rows = materialize(rows.withColumns({"h": F.xxhash64("x"), "g": F.xxhash64(F.lit(1), "x")}), "vectors")
    classes = rows.filter(F.col("x").isNotNull()).groupBy("h", "g").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"), F.first("x").alias("x"))
    classes = materialize(classes, "classes")
    axes = principal_axes(classes)
    return _join(rows, classes, axes, threshold)


def _join(rows: DataFrame, classes: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.frombuffer(v, "<f8") for v in batch.column("x").to_pylist()]
            p = [float(unit(v[None])[0] @ axes[len(v)][:, 0]) for v in x]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(v) for v in x], pa.int32()),
                                              pa.array(p, pa.float64())], names=[*batch.schema.names, "d", "p"])

    placed = classes.mapInArrow(first, "h long, g long, rep long, m long, x binary, d int, p double")
    count = classes.count()
    # tile bounds: quantiles of the first coordinate; a tile that holds ties beyond its size is cut by hash
    n = max(1, -(-count // TILE))
    bounds = sorted(set(placed.approxQuantile("p", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    bound = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    placed = placed.withColumn("band", F.size(F.filter(bound, lambda b: b <= F.col("p"))))
    placed = materialize(placed, "placed")
    bands = placed.groupBy("d", "band").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("lo"),
                                            F.max("p").alias("hi")).orderBy("d", "band").collect()
    # a band of more than two tiles' size becomes several tiles; tiles are numbered in order
    tiles, base = [], {}
    for t in bands:
        parts = 1 if t.n <= 2 * TILE else -(-t.n // TILE)
        base[t.d, t.band] = (len(tiles), parts)
        tiles += [(t.d, t.lo, t.hi)] * parts
    # |x - y|^2 = 2 - 2 cos bounds the distance of any coordinate
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    # the tiles that a tile meets are neighbours in order: up to the last that begins within reach
    spark, last, first = rows.sparkSession, [], []
    for i, (d, _, hi) in enumerate(tiles):
        j = max(i, last[-1]) if last else i
        while j + 1 < len(tiles) and tiles[j + 1][0] == d and tiles[j + 1][1] <= hi + reach:
            j += 1
        last.append(j)
        k = first[-1] if first else 0
        while last[k] < i or tiles[k][0] != d:
            k += 1
        first.append(k)
    place = spark.createDataFrame([(d, b, k, parts) for (d, b), (k, parts) in base.items()],
                                  "d int, band int, first int, parts int")
    pairs = spark.createDataFrame(list(zip(range(len(tiles)), first, last, strict=True)),
                                  "tile int, low int, high int")
    placed = (placed.join(F.broadcast(place), ["d", "band"])             # one row per tile of 4096 classes
              .withColumn("tile", (F.col("first") + F.pmod("h", F.col("parts"))).cast("int"))
              .withColumn("cls", F.monotonically_increasing_id()))
    placed = materialize(placed.select("cls", "tile", "h", "g", "rep", "m", "x"), "tiles")
    dealt = placed.select("cls", "tile", "m", "x").join(F.broadcast(pairs), "tile")
    left = dealt.select(F.col("tile").alias("t"), F.explode(F.sequence("tile", "high")).alias("u"), "cls", "m", "x")
    right = dealt.select(F.explode(F.sequence("low", "tile")).alias("t"), F.col("tile").alias("u"), "cls", "m", "x").filter("t != u")

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        same = key[0] == key[1]
        if not len(left) or not (same or len(right)):
            return pd.DataFrame({"cls": [], "links": [], "root": []}, dtype="int64")
        return compare_tiles(left, left if same else right, same, axes, threshold)

    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    found = materialize(left.groupBy("t", "u").cogroup(right.groupBy("t", "u")).applyInPandas(
        run, "cls long, links long, root long"), "found")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    known = placed.select("cls", "h", "g", "rep", "m").join(links, "cls", "left").join(comp, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    least = known.groupBy("component").agg(F.min("rep").alias("least"))
    known = known.join(least, "component").select(
        "h", "g", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least")
    some = rows.filter(F.col("x").isNotNull()).select("id", "h", "g").join(known, ["h", "g"]).select(
        "id", "n_links", F.col("least").alias("component"))
    alone = rows.filter(F.col("x").isNull()).select("id", F.lit(0).cast("long").alias("n_links"),
                                                    F.col("id").alias("component"))
    return some.unionByName(alone)
