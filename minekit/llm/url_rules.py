"""URL allow / block rules as a sort-merge range join.

A host's labels are reversed and each followed by ``\\x01``
(``a.example.org`` -> ``org\\x01example\\x01a\\x01``), so a rule's host and all
its subdomains are the interval of keys that begin with the rule's key.  URL
keys (reversed host, path, page id) are dealt into key ranges by boundaries
taken from a sample of the keys; the sample decides only where ranges end,
never which rows are judged.  The page id in the key, and a hash of the key
behind its first ``BOUND_CHARS`` characters, let a range end inside a host, or
a long URL, that holds a third of all rows.  A rule goes to every range its
interval touches.  In each range one sorted sweep over both sides keeps the
stack of rules whose interval holds the current URL.

The rule with the longest host wins, then the one with the longest path; of
rules with equal host and path, ``block`` wins.  URLs without a rule get the
default verdict.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and gets the default; null page ids and repeated rows are judged row by row;
rules with a null host count as no rule, a null path is empty; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEP, TOP = "\x01", "\U0010ffff"
#: Sampled keys per range when boundaries are chosen, and characters kept of each; keys alike in
#: these are told apart by a hash of the whole key.
SAMPLES_PER_RANGE, BOUND_CHARS = 40, 200
ROWS_PER_RANGE = 100_000


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), SEP), F.lit(SEP))


def _boundaries(keyed: DataFrame, ranges: int, rows: int) -> list[tuple[str, int]]:
    share = min(1.0, SAMPLES_PER_RANGE * ranges / max(rows, 1))
    sample = (keyed.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
              .select(F.substr("key", F.lit(1), F.lit(BOUND_CHARS)).alias("k"), F.hash("key").alias("h")))
    keys = sorted((r.k, r.h) for r in sample.toLocalIterator())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


class _Node:
    """All rules of one host: paths in order, each with its nearest enclosing path."""

    def __init__(self, host: str, key: str, rules: dict[str, str]):
        self.host, self.key = host, key
        self.paths = sorted(rules)
        self.verdicts = [rules[p] for p in self.paths]
        self.parent, stack = [], []
        for i, p in enumerate(self.paths):
            while stack and not p.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.parent.append(stack[-1] if stack else -1)
            stack.append(i)

    def match(self, host: str, path: str) -> int:
        if host != self.host and not host.endswith("." + self.host):
            return -1
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.parent[i]
        return i


def sweep(urls: Iterator[tuple[str, str, str]], nodes: list[_Node]) -> Iterator[tuple[str | None, str | None]]:
    """(rule, verdict) per (key, host, path); both sides in key order."""
    stack: list[_Node] = []
    i = 0
    for key, host, path in urls:
        while i < len(nodes) and nodes[i].key <= key:
            while stack and not nodes[i].key.startswith(stack[-1].key):
                stack.pop()
            stack.append(nodes[i])
            i += 1
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        for node in reversed(stack):
            at = node.match(host, path)
            if at >= 0:
                yield node.host + node.paths[at], node.verdicts[at]
                break
        else:
            yield None, None


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               ranges: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``; ``ranges`` is the number of key
    ranges (default: one per ``ROWS_PER_RANGE`` rows, at least the shuffle
    partitions of the session).
    """
    spark: SparkSession = pages.sparkSession
    keyed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    keyed = keyed.withColumn("key", F.concat(host_key(F.col("host")), F.col("path"), F.lit("\x00"),
                                             F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    rows = pages.count()
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
    bounds = _boundaries(keyed, n, rows)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (k[:BOUND_CHARS], h)) for k, h in zip(key, tie.tolist())], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_right(bounds, (k[:BOUND_CHARS], -1 << 31)),
                                     bisect_right(bounds, ((k + TOP)[:BOUND_CHARS], 1 << 31)) + 1)) for k in key])

    right = (rules.filter(F.col("host").isNotNull())
             .select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("key", host_key(F.col("host")))
             .withColumn("rng", F.explode(ranges_of("key"))))

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("key", kind="stable")
        by: dict[tuple[str, str], dict[str, str]] = {}
        for key, host, path, verdict in zip(right.key, right.host, right.path, right.verdict, strict=True):
            by.setdefault((key, host), {})[path] = verdict
        nodes = [_Node(host, key, by[key, host]) for key, host in sorted(by)]
        found = list(sweep(zip(left.key, left.host, left.path, strict=True), nodes))
        return pd.DataFrame({"page_id": left.page_id.astype("Int64"), "host": left.host, "path": left.path,
                             "rule": pd.Series([f[0] for f in found], index=left.index, dtype=object),
                             "verdict": pd.Series([f[1] or default for f in found], index=left.index, dtype=object)})

    return (keyed.withColumn("rng", range_of("key", F.hash("key"))).groupBy("rng")
            .cogroup(right.groupBy("rng"))
            .applyInPandas(join, "page_id long, host string, path string, rule string, verdict string"))
