"""Every registered query against its DuckDB oracle (the driver's check)."""

import duckdb
import pytest

import __spark_entry__ as entry
SF_SMALL = "/root/testdata/sf0.001"

DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean", "FLOAT": "float"}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in res.description}
    assert spark_types == duck_types
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(cols, want)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "label", "hour", "k", "value"]
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_every_query_has_a_callable():
    q = entry.queries()
    assert len(q) >= 30
    assert set(entry.oracle_sql()) <= set(q)
