"""Scratch folders come from the session; no machine-local folder on a cluster."""

import pytest

from minekit import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.set_to = self.current = path


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session("yarn"))


def test_configured_dir_is_used_and_existing_one_kept():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert session.ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"
    kept = _Session("yarn", {"spark.checkpoint.dir": "hdfs://other"}, current="hdfs://nn/already")
    assert session.ensure_checkpoint_dir(kept) == "hdfs://nn/already" and kept.sparkContext.set_to is None


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_only_one_process_is_local():
    assert session.is_local(_Session("local[8]")) and session.is_local(_Session("local"))
    assert not session.is_local(_Session("local-cluster[3,2,1024]")) and not session.is_local(_Session("yarn"))


def test_scratch_is_released(spark, monkeypatch):
    import os
    monkeypatch.setattr(session, "_SCRATCH", [])
    spark.range(3).write.parquet(path := session.scratch_path(spark, "gone"))
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.release_scratch(spark)
    assert not os.path.exists(local)
