"""Consecutive numbers for the rows of a table of any size.

A range-partitioned sort puts the rows in order; a row's number is its place in
its partition plus the sizes of the partitions before.  Only those sizes (one
number per partition) meet in one place, so no window runs over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minekit.functions.casting import quoted
from minekit.session import materialize

#: Rows that a partition can hold (Spark's monotonic ids keep 33 bits for the place in it).
_PLACES = 33


def number_rows(df: DataFrame, order: list[Column | str], number: str = "number") -> DataFrame:
    """``df`` with ``number``: 0 to n - 1 in the order of some columns.

    Rows that are equal in ``order`` are numbered in any order, but only once:
    the sorted rows are written before their numbers are used."""
    mark = "_mark"
    while mark in df.columns:
        mark += "_"
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn(mark, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(mark, _PLACES)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.col(mark).bitwiseAND(F.lit((1 << _PLACES) - 1))
    # one row per partition
    return ranged.join(F.broadcast(sizes), part == F.col("_part")).select(
        *[F.col(quoted(c)) for c in df.columns], (F.col("_before") + place).alias(number))


def dense_ids(df: DataFrame, key: str, number: str = "idx", limit: int | None = None) -> DataFrame:
    """``key, number``: every distinct non-null value of a column with a number of its own,
    0 to n - 1 in ascending order; written once.  More than ``limit`` values raise."""
    keys = df.select(F.col(quoted(key)).alias(key)).where(F.col(quoted(key)).isNotNull()).distinct()
    table = materialize(number_rows(keys, [F.col(quoted(key))], number), "ids")
    if limit is not None:
        top = table.agg(F.max(number).alias("top")).first()["top"]
        if top is not None and top >= limit:
            raise ValueError(f"{top + 1} distinct values of {key}: at most {limit} fit")
    return table
