"""Conditions that cut a table into parts: every row once, as SQL text on views."""

import datetime
import decimal
import random

import duckdb
import pytest
from pyspark.sql import DataFrameReader

from minekit.plans import jobs
from minekit.sources import splits, tables


def _parts(spark, view, predicates):
    return [spark.table(view).where(p).collect() for p in predicates]


def _each_once(spark, view, predicates):
    parts = _parts(spark, view, predicates)
    assert sorted(map(repr, sum(parts, []))) == sorted(map(repr, spark.table(view).collect()))
    return [len(p) for p in parts]


D = datetime.datetime(2024, 2, 29, 23, 59, 59, 123456)
COLUMNS = {
    "bigint": [None, 0, -5, 2 ** 62, 7, 7, 7] + list(range(50)),
    "double": [None, 0.0, -0.1, 1e-300, 1e300, float("nan"), 0.1 + 0.2] + [i / 7 for i in range(50)],
    "decimal(20,4)": [None, decimal.Decimal("-0.0001")] + [decimal.Decimal(i) / 8 for i in range(50)],
    "string": [None, "", "a'b", "a\\", "\\'", "é", "日本", "%"] + [f"k{i}" for i in range(50)],
    "date": [None] + [D.date() + datetime.timedelta(i) for i in range(50)],
    "timestamp_ntz": [None] + [D + datetime.timedelta(seconds=i * 7919) for i in range(50)],
}


@pytest.mark.parametrize("kind", COLUMNS)
def test_every_row_once(spark, kind):
    values = COLUMNS[kind]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, c {kind}")
    df.createOrReplaceTempView("split_rows")
    cuts = [r["cut"] for r in spark.sql(splits.cut_query("split_rows", "c", 6)).collect()]
    sizes = _each_once(spark, "split_rows", splits.depth_predicates("c", cuts, "spark"))
    assert len(sizes) == 6 and max(sizes) <= len(values) // 6 + 4
    for columns in (["c"], ["c", "n"]):
        _each_once(spark, "split_rows", splits.hash_predicates(columns, 5, "spark"))


def test_hot_value_is_one_part_and_none_is_one_read(spark):
    rng = random.Random(1)
    rows = [(7,)] * 300 + [(rng.randint(0, 10 ** 6),) for _ in range(600)] + [(None,)] * 5
    spark.createDataFrame(rows, "c long").createOrReplaceTempView("split_hot")
    cuts = [r["cut"] for r in spark.sql(splits.cut_query("split_hot", "c", 9)).collect()]
    sizes = _each_once(spark, "split_hot", splits.depth_predicates("c", cuts, "spark"))
    assert sorted(sizes)[-1] <= 320 and sorted(sizes)[-2] <= 110
    for cuts in ([], [3], [3, 3]):
        assert splits.depth_predicates("c", cuts) == ["1 = 1"]
    assert splits.hash_predicates(["c"], 1, "oracle") == ["1 = 1"]


def test_texts_run_elsewhere_too():
    """The ranges' SQL in another engine, on text with quotes and on NULLs."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 9 > 0 THEN 'it''s ' || (i * 7 % 100) END AS c FROM range(500) r(i)")
    cuts = [r[0] for r in con.execute(splits.cut_query("t", "c", 7)).fetchall()]
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in splits.depth_predicates("c", cuts)]
    assert sum(counts) == 500 and len(counts) == 7


def test_hash_of_every_dialect():
    for dialect in splits._HASHES:
        parts = splits.hash_predicates(["a", "b"], 4, dialect)
        assert len(parts) == 4 and parts[0].endswith("IS NULL") and parts[3].endswith("= 3")
    assert splits.hash_predicates(["a"], 2, "oracle")[1] == "ORA_HASH(TO_CHAR(a), 1) = 1"
    with pytest.raises(ValueError, match="no hash known"):
        splits.hash_predicates(["a"], 4, "other")
    for bad in ("a b", "x;DROP", "", "1a", 'q"'):
        with pytest.raises(ValueError, match="needs? quotes|need quotes"):
            splits.hash_predicates([bad], 4, "mysql")


@pytest.fixture
def reads(monkeypatch):
    """What JDBC reads are asked for."""
    seen = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, predicates=None, properties=None: seen.append(
        (url, table, predicates, properties)) or (_ for _ in ()).throw(KeyError("no database")))
    return seen


def _src(**more):
    return {"database_address": "db", "port": 1, "database": "x", "tablename": "t", "account": "u", "password": "p"} | more


def test_training_tables_are_read_in_parts(spark, reads):
    spec = {"datasource": {"train_table": _src(num_partitions=3), "test_table": _src()},
            "operational_param": {"train_label_col": "y", "train_feture_col": "a b", "test_feture_col": "a b",
                                  "result_label_col": "y", "result_feture_col": "a b"}}
    with pytest.raises(KeyError):
        jobs.naive_bayes(spark, spec, write=False)
    url, table, predicates, properties = reads[0]
    assert (url, table) == ("jdbc:oracle:thin:@db:1:x", "t") and len(predicates) == 3
    assert predicates[2] == "ORA_HASH(TO_CHAR(y) || '|' || TO_CHAR(a) || '|' || TO_CHAR(b), 2) = 2"
    assert properties["user"] == "u" and "numPartitions" not in properties and "dbtable" not in properties


def test_what_a_source_says_counts(spark, reads):
    with pytest.raises(KeyError):
        tables.read_table(spark, _src(predicates=["x < 1", "x >= 1"]), split_columns=["a"])
    assert reads[-1][2] == ["x < 1", "x >= 1"]
    with pytest.raises(KeyError):
        tables.read_table(spark, _src(split="hash", split_columns="k l", num_partitions=2), partition_column="id")
    assert reads[-1][2][1] == "ORA_HASH(TO_CHAR(k) || '|' || TO_CHAR(l), 1) = 1"
    assert tables.jdbc_predicates(spark, _src(split="none"), ["a"]) is None
    assert tables.jdbc_predicates(spark, _src(partition_column="k"), ["a"]) is None
    assert tables.jdbc_predicates(spark, {"url": "jdbc:unknown:x", "tablename": "t"}, ["a"]) is None
    assert len(tables.jdbc_predicates(spark, _src(), ["a"])) == spark.sparkContext.defaultParallelism
    with pytest.raises(ValueError, match="split 'depth' of 2 columns"):
        tables.jdbc_predicates(spark, _src(split="depth", split_columns="a b"))


def test_depth_asks_the_database_for_its_cuts(spark, monkeypatch):
    spark.createDataFrame([(i % 10,) for i in range(100)], "c int").createOrReplaceTempView("split_db")
    asked = []

    class Reader:
        def format(self, name):
            return self

        def options(self, **opts):
            asked.append(opts["dbtable"])
            return self

        def load(self):
            return spark.sql(f"SELECT * FROM {asked[-1]}")

    class Session:
        read, sparkContext = Reader(), spark.sparkContext

    got = tables.jdbc_predicates(Session(), _src(tablename="split_db", split="depth", split_columns="c", num_partitions=5))
    assert got == ["c < 2 OR c IS NULL", "c >= 2 AND c < 4", "c >= 4 AND c < 6", "c >= 6 AND c < 8", "c >= 8"]
    assert "NTILE(5)" in asked[0] and asked[0].endswith("minekit_cuts")
