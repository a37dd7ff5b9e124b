"""Shared table plumbing for the model operators: configured projections,
labelled training frames, flat result rows, preview and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.casting import column_types, quoted, strict_double, strict_int

# Internal column names, reserved: a table's own columns must not use them.
ID = "_id"
LABEL = "_label"
FEATURES = "_features"
PREDICTION = "_prediction"


def check_counts(train_features: list[str], test_features: list[str] | None,
                 result_features: list[str] | None) -> None:
    """Features match by position, so the three lists must be equally long."""
    n = len(train_features)
    for what, cols in (("test", test_features), ("result", result_features)):
        if cols is not None and len(cols) != n:
            raise ValueError(f"{n} train feature columns but {len(cols)} {what} feature columns")
    if n == 0:
        raise ValueError("no feature columns configured")


def project_configured(df: DataFrame, feature_cols: list[str], id_col: str | None = "id",
                       label_col: str | None = None, id_alias: str = "id",
                       id_type: str = "int") -> DataFrame:
    """Select id / label / features from a table, each strictly numeric.

    Only the configured columns are selected, so the scan reads nothing
    else (parquet ``ReadSchema``, JDBC column list).  Ids are 32-bit as in
    the reference's result tables, or 64-bit with ``id_type="bigint"``.
    """
    types = column_types(df)
    cols: list[Column] = []
    if id_col is not None:
        cols.append(strict_int(types, id_col, id_alias, id_type))
    if label_col is not None:
        cols.append(strict_double(types, label_col, LABEL))
    cols += [strict_double(types, c) for c in feature_cols]
    return df.select(*cols)


def flat_result(scored: DataFrame, prediction: Column, feature_cols: list[str],
                result_label: str, result_features: list[str], id_col: str | None = "id") -> DataFrame:
    """``id, <label> double, <feature_i> double...`` named from the spec; the id
    keeps the type that ``project_configured`` gave it."""
    cols: list[Column] = []
    if id_col is not None:
        cols.append(F.col(id_col).alias("id"))
    cols.append(prediction.cast("double").alias(result_label))
    cols += [F.col(quoted(src)).cast("double").alias(dst) for src, dst in zip(feature_cols, result_features)]
    return scored.select(*cols)


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """First ``n`` rows by ``key``: a top-n, planned as TakeOrderedAndProject."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def split_flag(key: Column, train_fraction_tenths: int = 7) -> Column:
    """Deterministic train/test flag from an integer key: ``key % 10 < 7``.

    Reproducible in SQL, unlike ``randomSplit``; every row gets a side.
    """
    return F.when(F.pmod(key, F.lit(10)) < train_fraction_tenths, F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, key: str | None = None, seed: int | None = None,
                     weights: tuple[float, float] = (0.7, 0.3)) -> tuple[DataFrame, DataFrame]:
    """Split a table in two: by key rule (default) or ``randomSplit(seed)``."""
    if key is not None:
        flag = split_flag(F.col(key))
        return df.where(flag == "train"), df.where(flag == "test")
    parts = df.randomSplit(list(weights), seed if seed is not None else 11)
    return parts[0], parts[1]
