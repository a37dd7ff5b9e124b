"""Strict numeric conversion of configured columns.

The reference turns every cell into text and parses it, so a NULL, an
empty string or ``'abc'`` fails the whole job.  These helpers keep that
contract with column expressions only (no UDF), independent of the ANSI
setting: the value is parsed with ``try_cast`` and ``raise_error`` fires
on anything that does not parse.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = {"int": (-(2 ** 31), 2 ** 31 - 1), "bigint": (-(2 ** 63), 2 ** 63 - 1)}
Types = dict[str, T.DataType]


def column_types(df: DataFrame | Types) -> Types:
    """Column name -> type, looked up once for a whole projection."""
    return df if isinstance(df, dict) else {f.name: f.dataType for f in df.schema.fields}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _null_guard(c: Column, name: str, value: Column) -> Column:
    return F.when(c.isNull(), F.raise_error(F.lit(f"NULL in column {name}"))).otherwise(value)


def strict_double(df: DataFrame | Types, name: str, alias: str | None = None) -> Column:
    """``name`` as double; NULL or text that is not a number raises."""
    dtype = column_types(df)[name]
    c = F.col(quoted(name))
    if isinstance(dtype, T.NumericType):
        # one parsed expression: wide tables build thousands of these on the driver
        message = f"NULL in column {name}".replace("\\", "\\\\").replace("'", "\\'")
        q = quoted(name)
        return F.expr(f"CASE WHEN {q} IS NULL THEN raise_error('{message}') ELSE CAST({q} AS DOUBLE) END"
                      f" AS {quoted(alias or name)}")
    else:
        parsed = F.trim(c.cast("string")).try_cast("double")
        value = F.when(parsed.isNull(), F.raise_error(
            F.concat(F.lit(f"not a number in column {name}: '"), c.cast("string"), F.lit("'")))
        ).otherwise(parsed)
    return _null_guard(c, name, value).alias(alias or name)


def strict_int(df: DataFrame | Types, name: str, alias: str | None = None, to: str = "int") -> Column:
    """``name`` as a 32-bit int, or with ``to="bigint"`` as a 64-bit one.

    Raises on NULL, on text that is not an integer, on a fractional value
    (``1.5``) and outside the range.  Integral decimals and doubles
    (``1.0`` as an unsized database NUMBER) are accepted.
    """
    dtype = column_types(df)[name]
    c = F.col(quoted(name))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)) or to == "bigint" and isinstance(dtype, T.LongType):
        return _null_guard(c, name, c.cast(to)).alias(alias or name)
    if isinstance(dtype, T.LongType):
        wide = c
    elif isinstance(dtype, (T.DecimalType, T.FloatType, T.DoubleType)):
        wide = F.when(c != F.floor(c), F.raise_error(
            F.concat(F.lit(f"not an integer in column {name}: "), c.cast("string")))
        ).otherwise(F.floor(c))
    else:
        parsed = F.trim(c.cast("string")).try_cast("bigint")
        wide = F.when(parsed.isNull(), F.raise_error(
            F.concat(F.lit(f"not an integer in column {name}: '"), c.cast("string"), F.lit("'")))
        ).otherwise(parsed)
    low, high = RANGES[to]
    ranged = F.when((wide < low) | (wide > high), F.raise_error(
        F.concat(F.lit(f"out of {to} range in column {name}: "), c.cast("string")))
    ).otherwise(wide.cast(to))
    return _null_guard(c, name, ranged).alias(alias or name)


def non_negative(c: Column, name: str) -> Column:
    """Pass ``c`` through, raising on a negative value (naive Bayes input)."""
    return F.when(c < 0, F.raise_error(
        F.concat(F.lit(f"negative value in column {name}: "), c.cast("string")))
    ).otherwise(c).alias(name)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Pack numeric columns into one dense ``spark.ml`` vector column."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)
