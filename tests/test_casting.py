"""Strict conversion: bad cells fail the job (fixtures C7, C8, C12)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from minekit.functions.casting import strict_double, strict_int
from minekit.functions.text import java_split, parse_labeled_lines, parse_values


def _one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_strict_double_parses_text_and_numbers(spark):
    df = spark.createDataFrame([("1.5", 2), (" 3 ", 4)], "a string, b int")
    assert _one(df, strict_double(df, "a")) == [1.5, 3.0]
    assert _one(df, strict_double(df, "b")) == [2.0, 4.0]


@pytest.mark.parametrize("bad", [None, "abc", ""])
def test_strict_double_rejects(spark, bad):
    df = spark.createDataFrame([(bad,)], "a string")
    with pytest.raises(Exception):
        df.select(strict_double(df, "a")).collect()


def test_strict_int_accepts_integral_decimal(spark):
    df = spark.createDataFrame([(Decimal("7.0000000000"),)], "a decimal(38,10)")
    assert _one(df, strict_int(df, "a")) == [7]


@pytest.mark.parametrize("value,ddl", [(1.5, "double"), (Decimal("1.5"), "decimal(10,2)"),
                                       ("1.0", "string"), (2 ** 40, "bigint"), (None, "bigint")])
def test_strict_int_rejects(spark, value, ddl):
    df = spark.createDataFrame([(value,)], f"a {ddl}")
    with pytest.raises(Exception):
        df.select(strict_int(df, "a")).collect()


@pytest.mark.parametrize("text,expected", [("a  b ", ["a", "", "b"]), ("", [""]), (" ", []),
                                           ("a", ["a"]), (" a", ["", "a"]), ("a b  ", ["a", "b"])])
def test_java_split(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert _one(df, java_split(F.col("s"), " ")) == [expected]


def test_vector_parser_pads_and_scoring_parser_raises(spark):
    df = spark.createDataFrame([("1 2",)], "value string")
    tokens = java_split(F.col("value"), " ")
    padded = df.select(*parse_values(tokens, 3, pad=True, what="line")).first()
    assert tuple(padded) == (1.0, 2.0, 0.0)
    with pytest.raises(Exception):
        df.select(*parse_values(tokens, 3, pad=False, what="line")).collect()
    too_long = spark.createDataFrame([("1 2 3 4",)], "value string")
    with pytest.raises(Exception):
        too_long.select(*parse_values(java_split(F.col("value"), " "), 3, pad=True, what="l")).collect()


def test_labeled_lines(spark):
    df = spark.createDataFrame([("1,0 2.5 3 9",)], "value string")
    assert tuple(parse_labeled_lines(df).first()) == (1.0, 0.0, 2.5, 3.0)
    bad = spark.createDataFrame([("1,0 2.5",)], "value string")
    with pytest.raises(Exception):
        parse_labeled_lines(bad).collect()
    junk = spark.createDataFrame([("x,1 2 3",)], "value string")
    with pytest.raises(Exception):
        parse_labeled_lines(junk).collect()


def test_wall_clock_hour_ignores_session_zone(spark):
    import datetime as dt
    from minekit.plans.catalog import wall_clock_hour
    ntz = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 30),)], "ts timestamp_ntz")
    assert ntz.select(wall_clock_hour(ntz, "ts")).first()[0] == 5
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ltz = spark.sql("SELECT TIMESTAMP'2024-01-01 05:30:00' AS ts")
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert ltz.select(wall_clock_hour(ltz, "ts")).first()[0] == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bigint_ids_on_request(spark):
    from minekit.operators.frames import project_configured
    df = spark.createDataFrame([(2 ** 40, 1.0)], "id long, x double")
    with pytest.raises(Exception, match="out of int range"):
        project_configured(df, ["x"]).collect()
    assert project_configured(df, ["x"], id_type="bigint").first()["id"] == 2 ** 40
    text = spark.createDataFrame([("9223372036854775808", 1.0)], "id string, x double")
    with pytest.raises(Exception):
        project_configured(text, ["x"], id_type="bigint").collect()


def test_column_names_with_quotes_and_ticks(spark):
    from minekit.operators.frames import project_configured
    df = spark.createDataFrame([(1, None)], "id int, `it's a ``x\\` double")
    with pytest.raises(Exception, match="NULL in column it's a"):
        project_configured(df, [df.columns[1]]).collect()


def test_malformed_job_spec_raises(spark):
    from minekit.functions import specs
    for text in ('{"datasource" oops', '{"datasource": {"train_table": ', "not json"):
        df = spark.createDataFrame([(text,)], "t string").select(specs.encode_spec(F.col("t")).alias("s"))
        with pytest.raises(Exception):
            df.select(specs.require_spec(specs.decode_spec(F.col("s")))).collect()
    null = spark.createDataFrame([(None,)], "s string")
    with pytest.raises(Exception, match="not valid JSON"):
        null.select(specs.require_spec(specs.decode_spec(F.col("s")))).collect()
