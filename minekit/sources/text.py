"""Text files: line sources and the ``(line,prediction)`` result sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (splits follow the file blocks)."""
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str, col: str = "value") -> None:
    """Write one string column as text; the target must not exist yet."""
    lines.select(F.col(col).alias("value")).write.mode("errorifexists").text(path)


def scored_line(line: Column, prediction: Column) -> Column:
    """``(line,prediction)``: how the reference prints a scored input line."""
    return F.concat(F.lit("("), line, F.lit(","), prediction.cast("double").cast("string"), F.lit(")"))
