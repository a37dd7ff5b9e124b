"""Text columns: splitting, line parsing and result formatting.

All of it is column expressions, so parsing a text source runs inside the
scan's codegen stage.  ``java_split`` keeps the reference's tokenising
rules: inner empty tokens stay, trailing empty tokens go, and the empty
string itself splits to ``['']``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def java_split(c: Column, delim: str) -> Column:
    """Split on a literal one-character delimiter, dropping trailing empties."""
    if len(delim) != 1:
        raise ValueError("java_split takes a one-character delimiter")
    esc = re.escape(delim)
    trimmed = F.regexp_replace(c, f"(?:{esc})+$", "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, esc)))


def strict_parse_double(token: Column, what: str) -> Column:
    """Parse one text token as double; junk, empty or missing tokens raise."""
    parsed = token.try_cast("double")
    return F.when(token.isNull() | parsed.isNull(), F.raise_error(
        F.concat(F.lit(f"bad {what}: '"), F.coalesce(token, F.lit("<missing>")), F.lit("'")))
    ).otherwise(parsed)


def parse_values(tokens: Column, n: int, pad: bool, what: str) -> list[Column]:
    """Turn an array of tokens into ``n`` double columns.

    ``pad=False`` (scoring files): fewer than ``n`` tokens raise, extra
    tokens are ignored.  ``pad=True`` (the k-means text file): missing
    tokens become 0 and more than ``n`` tokens raise.
    """
    size = F.size(tokens)
    guard = (F.when(size > n, F.raise_error(F.lit(f"more than {n} values in {what}")))
             if pad else
             F.when(size < n, F.raise_error(F.lit(f"fewer than {n} values in {what}"))))
    cols = []
    for i in range(n):
        tok = F.try_element_at(tokens, F.lit(i + 1))
        value = strict_parse_double(tok, what)
        if pad:
            value = F.when(size <= i, F.lit(0.0)).otherwise(value)
        # The guard is attached to the first column so every row is checked.
        cols.append(F.coalesce(guard, value) if i == 0 else value)
    return cols


def vector_literal_text(cols: list[Column]) -> Column:
    """``[a,b,c]`` with each double printed like Java's ``Double.toString``."""
    return F.concat(F.lit("["), F.concat_ws(",", *[c.cast("double").cast("string") for c in cols]), F.lit("]"))


def java_list_text(items: Column) -> Column:
    """An array of strings printed as a Java list, ``[a, b]``, sorted."""
    return F.concat(F.lit("["), F.concat_ws(", ", F.array_sort(items)), F.lit("]"))


def parse_labeled_lines(lines: DataFrame, col: str = "value", n: int = 3) -> DataFrame:
    """``label,f1 f2 f3`` -> ``label, f1..fn`` doubles.

    Fewer than ``n`` feature values raise; extra values are ignored.
    """
    parts = java_split(F.col(col), ",")
    label = strict_parse_double(F.try_element_at(parts, F.lit(1)), "label")
    feats = java_split(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), " ")
    vals = parse_values(feats, n, pad=False, what="labelled line")
    return lines.select(label.alias("label"), *[v.alias(f"f{i + 1}") for i, v in enumerate(vals)])
