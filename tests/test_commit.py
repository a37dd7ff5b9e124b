"""Appending once per run, with failures at every step."""

import pytest
from pyspark.sql import functions as F

from minekit.plans import jobs
from minekit.sources import commit
from minekit.sources.tables import read_table, write_table


def _rows(spark, n=40):
    return spark.range(n).select("id", (F.col("id") * 2).alias("x")).repartition(4)


def _ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_once_per_run(spark, tmp_dir):
    rows = _rows(spark)
    assert commit.append_once(rows, tmp_dir, "a") and not commit.append_once(rows, tmp_dir, "a")
    assert commit.append_once(rows, tmp_dir, "b")
    assert _ids(spark, tmp_dir) == sorted([*range(40)] * 2)
    assert commit.run_state(spark, tmp_dir, "a") == "done" and commit.run_state(spark, tmp_dir, "c") == "new"
    rows.write.mode("append").parquet(tmp_dir)                                   # plain appends go on as ever
    assert len(_ids(spark, tmp_dir)) == 120


def test_failure_while_staging(spark, tmp_dir):
    bad = _rows(spark).withColumn("x", F.when(F.col("id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        commit.append_once(bad, tmp_dir, "a")
    assert commit.run_state(spark, tmp_dir, "a") == "new"
    commit.append_once(_rows(spark), tmp_dir, "a")
    assert _ids(spark, tmp_dir) == [*range(40)]


@pytest.mark.parametrize("after", range(7))
def test_failure_at_every_move(spark, tmp_dir, monkeypatch, after):
    """Four files, the plan and its end: the run dies after some of the renames, also twice."""
    move, left = commit._Folder.move, [after]

    def failing(self, old, new):
        if not left[0]:
            raise OSError("died")
        left[0] -= 1
        move(self, old, new)

    monkeypatch.setattr(commit._Folder, "move", failing)
    for _ in range(2):
        try:
            commit.append_once(_rows(spark), tmp_dir, "a")
            break
        except OSError:
            pass
        left[0] = 1
    monkeypatch.setattr(commit._Folder, "move", move)
    commit.append_once(_rows(spark), tmp_dir, "a")
    assert _ids(spark, tmp_dir) == [*range(40)]
    assert commit.unfinished(spark, tmp_dir) == [] and commit.run_state(spark, tmp_dir, "a") == "done"


def test_decided_run_is_not_computed_again(spark, tmp_dir):
    commit.stage(_rows(spark), tmp_dir, "a")
    assert commit.unfinished(spark, tmp_dir) == ["a"]
    commit.append_once(_rows(spark, 7), tmp_dir, "a")                            # the decided rows count
    assert _ids(spark, tmp_dir) == [*range(40)]


def test_empty_result_and_bad_ids(spark, tmp_dir):
    commit.append_once(_rows(spark, 0), tmp_dir, "none")
    assert commit.run_state(spark, tmp_dir, "none") == "done"
    for bad in ("", "../x", "a/b", "_a", "a b"):
        with pytest.raises(ValueError, match="run id"):
            commit.append_once(_rows(spark), tmp_dir, bad)


def test_catalogue_table(spark):
    name = "append_once_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        for run in ("a", "a", "b"):
            write_table(_rows(spark), {"table": name, "run_id": run}, "append")
        assert spark.table(name).count() == 80
        with pytest.raises(ValueError, match="has the columns"):
            write_table(_rows(spark).select("x"), {"table": name, "run_id": "c"}, "append")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_jdbc_is_refused(spark):
    with pytest.raises(ValueError, match="not a JDBC table"):
        write_table(_rows(spark), {"url": "jdbc:x", "format": "jdbc", "tablename": "t", "run_id": "a"}, "append")


def test_job_run_twice(spark, tmp_dir):
    _rows(spark).select((F.col("id") % 2).alias("y"), "x").write.parquet(f"{tmp_dir}/train")
    _rows(spark).write.parquet(f"{tmp_dir}/test")
    spec = {"datasource": {"train_table": {"path": f"{tmp_dir}/train"}, "test_table": {"path": f"{tmp_dir}/test"}},
            "output": {"result_table": {"path": f"{tmp_dir}/result", "run_id": "2024-01-01"}},
            "operational_param": {"train_label_col": "y", "train_feture_col": "x", "test_feture_col": "x",
                                  "result_label_col": "label", "result_feture_col": "x"}}
    for _ in range(2):
        jobs.naive_bayes(spark, spec)
    assert read_table(spark, {"path": f"{tmp_dir}/result"}).count() == 40
