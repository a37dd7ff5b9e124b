"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``replicas`` points on a ring of ``RING`` places; the keys on
the places up to and including a point (from the point before) are that
point's arc, and its shard is their home.  Every shard has a capacity.  Keys
that overflow a full shard continue clockwise to the next point whose shard
has room.

- A shard's arcs fill it in ring order, each by (place, key, checksum, size),
  so the keys that overflow are the last of its last arcs.
- Overflowing keys queue in ring order.  Every point that the queue passes
  takes as many from its head as its shard has room for; after two turns of
  the ring all are placed.

With ``slack`` 0 the capacities add up to the number of rows and differ by at
most one, and so do the shards.  Otherwise a shard holds at most ``1 + slack``
times the average.  Another shard moves the keys of the arcs that its points
cut off, and of the queue: shards with room keep all keys of their own.

Only the numbers of keys per arc meet in one place (shards x replicas rows at
most).  Rows are numbered by a range partitioned sort, whose order all rows of
one key split by checksum, size and a number of their own.

Defined cases: a null text has no bytes and the checksum 0; a null key has a
place like any other; rows that repeat a key, or are wholly equal, are rows of
their own, which one shard need not hold together; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from minekit.session import materialize

#: Places of the ring.
RING = 1 << 16
#: Points of a shard.
REPLICAS = 64
#: Bytes that a row takes besides its text.
OVERHEAD = 16


def _all() -> WindowSpec:
    """Over all rows, for tables of a bounded number of rows."""
    return Window.partitionBy(F.lit(0))


def ring_place(text: Column) -> Column:
    """The place of a string on the ring: the first 16 bits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("long")


def _points(spark: SparkSession, shards: int, replicas: int) -> DataFrame:
    """``arc, shard, place`` of every point in ring order; a point on the place of another has an empty arc."""
    shard, replica = F.floor(F.col("id") / replicas).cast("int"), F.col("id") % replicas
    points = spark.range(shards * replicas).select(shard.alias("shard"), ring_place(F.concat(
        F.lit("shard "), shard.cast("string"), F.lit(" point "), replica.cast("string"))).alias("place"), "id")
    return points.select("shard", "place", (F.row_number().over(_all().orderBy("place", "id")) - 1).alias("arc"))


def _capacities(n: int, shards: int, slack: float) -> tuple[int, int]:
    """(least capacity, number of shards that have one more)."""
    if slack:
        return -int(-(1 + slack) * n // shards), 0
    return n // shards, n % shards


def _moves(arcs: DataFrame) -> DataFrame:
    """``arc, head, tail, shard``: which of its keys, by number within the arc, an arc has in which shard.

    ``arcs`` are rows (arc, shard, n, capacity), one per point; all windows here run over those."""
    ring = _all().orderBy("arc")
    own = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    arcs = arcs.withColumn("kept", F.greatest(F.lit(0), F.least(
        F.col("n"), F.col("capacity") - F.coalesce(F.sum("n").over(own), F.lit(0)))))
    arcs = arcs.withColumn("over", F.col("n") - F.col("kept"))
    arcs = arcs.withColumn("room", F.col("capacity") - F.sum("kept").over(Window.partitionBy("shard")))
    arcs = arcs.withColumn("queued", F.sum("over").over(ring) - F.col("over"))       # keys ahead in the queue

    # two turns of the ring: each point takes from the queue what its shard has room for
    turns = arcs.select(F.array_sort(F.collect_list(F.struct("arc", "shard", "over", "room"))).alias("points")).select(
        F.concat("points", F.transform("points", lambda p: p.withField("over", F.lit(0).cast("long")))).alias("points"),
        F.transform(F.array_sort(F.array_distinct(F.transform("points", lambda p: F.struct(p["shard"], p["room"])))),
                    lambda s: s["room"]).alias("rooms"))
    state = "struct<waits:bigint,gone:bigint,rooms:array<bigint>,taken:array<struct<shard:int,begin:bigint,n:bigint>>>"

    def step(s: Column, p: Column) -> Column:
        take = F.least(s["waits"] + p["over"], F.element_at(s["rooms"], p["shard"] + 1))
        after = F.struct(
            (s["waits"] + p["over"] - take).alias("waits"), (s["gone"] + take).alias("gone"),
            F.transform(s["rooms"], lambda x, i: F.when(i == p["shard"], x - take).otherwise(x)).alias("rooms"),
            F.concat(s["taken"], F.array(F.struct(p["shard"].alias("shard"), s["gone"].alias("begin"), take.alias("n"))))
            .alias("taken"))
        return F.when(take > 0, after.cast(state)).otherwise(
            F.struct((s["waits"] + p["over"]).alias("waits"), s["gone"], s["rooms"], s["taken"]).cast(state))

    start = F.struct(F.lit(0).alias("waits"), F.lit(0).alias("gone"), F.col("rooms"), F.array().alias("taken")).cast(state)
    taken = turns.select(F.explode(F.aggregate("points", start, step, lambda s: s["taken"])).alias("t")).select(
        F.col("t.begin").alias("at"), F.col("t.shard").alias("to"), F.lit(None).cast("int").alias("arc"),
        F.lit(None).cast("long").alias("queued"), F.lit(None).cast("long").alias("kept"))
    # the queue cut where an arc's keys begin and where a point's begin
    begun = arcs.filter("over > 0").select(F.col("queued").alias("at"), F.lit(None).cast("int").alias("to"), "arc",
                                           "queued", "kept")
    cuts = begun.unionByName(taken).groupBy("at").agg(*[F.max(c).alias(c) for c in ("to", "arc", "queued", "kept")])
    along = _all().orderBy("at")
    cuts = cuts.select("at", F.lead("at").over(along).alias("next"),
                       *[F.last(c, ignorenulls=True).over(along).alias(c) for c in ("to", "arc", "queued", "kept")])
    end = arcs.agg(F.sum("over").alias("end"))
    cuts = cuts.join(F.broadcast(end)).withColumn("next", F.coalesce("next", "end"))       # one row
    there = cuts.select("arc", (F.col("at") - F.col("queued") + F.col("kept")).alias("head"),
                        (F.col("next") - F.col("queued") + F.col("kept")).alias("tail"), F.col("to").alias("shard"))
    here = arcs.filter("kept > 0").select("arc", F.lit(0).cast("long").alias("head"), F.col("kept").alias("tail"), "shard")
    return here.unionByName(there)


def numbered(rows: DataFrame, order: list[str], number: str) -> DataFrame:
    """``rows`` with their numbers from 0 in the order of some columns.

    A range partitioned sort gives every row a number in its partition, and the
    sizes of the partitions (one row each) where each begins."""
    mark = F.monotonically_increasing_id()
    ranged = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("mark", mark), "ranged")
    part = F.shiftright("mark", 33).alias("part")
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("size"))
    before = _all().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return ranged.withColumn("part", part).join(F.broadcast(sizes), "part").withColumn(
        number, F.col("before") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "mark", "before")


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", column: str = "text", replicas: int = REPLICAS,
               slack: float = 0.0, overhead: int = OVERHEAD) -> DataFrame:
    """``key, size, checksum, shard, slot`` of every row; slots are gapless from 0 in each shard."""
    if shards < 1 or replicas < 1 or slack < 0:
        raise ValueError("shards and replicas must be positive, and slack not negative")
    spark = docs.sparkSession
    points = materialize(_points(spark, shards, replicas), "ring")
    # places count from behind the last point, so that every arc is an interval of them
    turn = points.agg(F.max("place")).first()[0] + 1
    points = points.withColumn("place", F.pmod(F.col("place") - turn, F.lit(RING)))
    text, name = F.coalesce(F.col(f"`{column}`"), F.lit("")), F.col(f"`{key}`")
    place = ring_place(F.coalesce(F.concat(F.lit("key "), name.cast("string")), F.lit("no key")))
    rows = materialize(docs.select(
        name.alias("key"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("checksum"), F.pmod(place - turn, F.lit(RING)).alias("place"),
        F.monotonically_increasing_id().alias("row")), "rows")
    rows = numbered(rows, ["place", "key", "checksum", "size", "row"], "number")

    # at most RING rows from here on: the keys of every place, its arc, and where they begin among all rows
    counts = rows.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    n = spark.range(RING).withColumnRenamed("id", "place").join(counts, "place", "left").join(
        points.groupBy("place").agg(F.min("arc").alias("arc")), "place", "left")
    ring = _all().orderBy("place")
    places = materialize(n.select(
        "place", F.coalesce("n", F.lit(0)).alias("n"),
        F.last("arc", ignorenulls=True).over(_all().orderBy(F.desc("place"))).alias("arc"),       # the next point's
        F.coalesce(F.sum("n").over(ring.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin")), "places")
    total = places.agg(F.sum("n")).first()[0]
    least, more = _capacities(total, shards, slack)
    arcs = points.select("arc", "shard").join(
        places.groupBy("arc").agg(F.sum("n").alias("n"), F.min("begin").alias("begin")), "arc", "left")
    arcs = materialize(arcs.select("arc", "shard", F.coalesce("n", F.lit(0)).alias("n"), "begin", (
        F.lit(least) + (F.col("shard") < more).cast("int")).cast("long").alias("capacity")), "arcs")
    moves = _moves(arcs).join(arcs.select("arc", "begin"), "arc").select(
        "arc", "shard", (F.col("begin") + F.col("head")).alias("begin"), (F.col("begin") + F.col("tail")).alias("end"))
    filled = Window.partitionBy("shard").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    moves = moves.withColumn("slots", F.coalesce(F.sum(F.col("end") - F.col("begin")).over(filled), F.lit(0)))
    where = places.select("place", "arc", F.col("begin").alias("b"), (F.col("begin") + F.col("n")).alias("e")).join(
        moves, "arc").filter((F.col("b") < F.col("end")) & (F.col("begin") < F.col("e"))).drop("arc", "b", "e")
    where = materialize(where, "moves")
    # a place lies in one part of its arc but for those that a cut divides: RING rows and the cuts
    inside = (F.col("number") >= F.col("begin")) & (F.col("number") < F.col("end"))
    return rows.join(F.broadcast(where), "place").filter(inside).select(
        "key", "size", "checksum", "shard", (F.col("slots") + F.col("number") - F.col("begin")).alias("slot"))
