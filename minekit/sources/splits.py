"""Predicates that cut a table's rows into parts, for parallel JDBC reads.

Spark's own range read needs a numeric column and cuts its range evenly, so
skewed ids all land in one task, and a table without ids is read in one.  Here
the parts are a list of WHERE conditions, each row satisfying exactly one:

- ``depth``: the database finds the values that cut its rows into equally
  many (one query, a row per part comes back); any column that it can sort,
  NULLs in the first part.  A value that repeats is never cut, so a value with
  a third of the rows makes one large part and fewer others.
- ``hash``: a hash of one or several columns, of any type, modulo the number of
  parts; no query beforehand, and equal rows in one part.  The database reads
  the table once per part, unless it has an index on the hash.
"""

from __future__ import annotations

import datetime
import decimal
import math
import re

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]*(\.[A-Za-z_][A-Za-z0-9_$#]*)*")

#: Number of the part from 0 that a row's columns hash to, by SQL dialect (n: number of parts).
_HASHES = {
    "oracle": lambda cols, n: f"ORA_HASH({_joined(cols, ' || ', 'TO_CHAR({})')}, {n - 1})",
    "mysql": lambda cols, n: f"MOD(CRC32(CONCAT_WS('|', {', '.join(cols)})), {n})",
    "postgresql": lambda cols, n: f"MOD(ABS(CAST(HASHTEXT(CONCAT_WS('|', {', '.join(cols)})) AS BIGINT)), {n})",
    "sqlserver": lambda cols, n: f"(ABS(CAST(CHECKSUM({', '.join(cols)}) AS BIGINT)) % {n})",
    "spark": lambda cols, n: f"pmod(hash({', '.join(cols)}), {n})",
}
_PREFIXES = {"jdbc:oracle:": "oracle", "jdbc:mysql:": "mysql", "jdbc:mariadb:": "mysql",
             "jdbc:postgresql:": "postgresql", "jdbc:sqlserver:": "sqlserver"}


def _joined(cols: list[str], by: str, each: str) -> str:
    return f"{by}'|'{by}".join(each.format(c) for c in cols)


def dialect_of(url: str) -> str | None:
    """The SQL dialect behind a JDBC URL, if it is one that rows can be hashed in."""
    return next((d for prefix, d in _PREFIXES.items() if url.lower().startswith(prefix)), None)


def plain_name(column: str) -> str:
    """A column name as it may stand in SQL text; any other raises."""
    if not _NAME.fullmatch(column):
        raise ValueError(f"cannot split by column {column!r}: give 'predicates' for names that need quotes")
    return column


def literal(value, dialect: str | None = None) -> str:
    """A value of the database as SQL text."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"cannot split at {value!r}")
    if isinstance(value, int | decimal.Decimal):
        return f"{value:f}" if isinstance(value, decimal.Decimal) else str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"cannot split at {value!r}")
        return repr(value) + ("D" if dialect == "spark" else "" if "e" in repr(value) else "e0")
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        if dialect in ("mysql", "spark"):
            value = value.replace("\\", "\\\\")
            return "'" + value.replace("'", "\\'" if dialect == "spark" else "''") + "'"
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"cannot split at a value of type {type(value).__name__}")


def cut_query(table: str, column: str, parts: int) -> str:
    """A query for the least value of each of ``parts`` runs of equally many rows, in order of the column."""
    c = plain_name(column)
    return (f"SELECT MIN(v) AS cut FROM (SELECT {c} AS v, NTILE({parts}) OVER (ORDER BY {c}) AS tile "
            f"FROM {table} WHERE {c} IS NOT NULL) tiles GROUP BY tile")


def depth_predicates(column: str, cuts: list, dialect: str | None = None) -> list[str]:
    """Parts between the values of ``cuts``; what lies below the second smallest, and NULL, is the first."""
    c = plain_name(column)
    at = [literal(v, dialect) for v in sorted(set(cuts))][1:]
    if not at:
        return ["1 = 1"]
    between = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(at, at[1:])]
    return [f"{c} < {at[0]} OR {c} IS NULL", *between, f"{c} >= {at[-1]}"]


def hash_predicates(columns: list[str], parts: int, dialect: str) -> list[str]:
    """Parts by hash; a hash that is NULL is the first."""
    if dialect not in _HASHES:
        raise ValueError(f"no hash known in SQL dialect {dialect!r}: give 'predicates'")
    if parts <= 1:
        return ["1 = 1"]
    h = _HASHES[dialect]([plain_name(c) for c in columns], parts)
    return [f"{h} = 0 OR {h} IS NULL", *(f"{h} = {i}" for i in range(1, parts))]
