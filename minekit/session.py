"""Session settings and the shared scratch folder.

Everything the library writes between stages (saved models, text sinks in
the examples) goes under the cluster's shared checkpoint folder, read from
the session.  A folder of our own is only chosen when the setting is unset
and Spark runs in local mode (tests); on a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.  AQE re-plans joins and
# coalesces shuffle output at run time; skew-join splitting keeps a hot
# (user, item) or order key from landing in one task.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Scratch folders handed out and not released yet.
_SCRATCH: list[str] = []


def build_session(master: str | None = None, app_name: str = "minekit",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SQL_SETTINGS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.ansi.enabled"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is a cluster)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Order: the context's folder, then ``spark.checkpoint.dir`` from the
    session conf, then (local mode only) a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder every "
                "executor can reach (HDFS, S3, ...) before running minekit jobs")
        configured = tempfile.mkdtemp(prefix="minekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/minekit-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders that this process has asked for.

    For the end of a job, when no frame that reads one is in use any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back.

    Used where an iterative or multi-pass operator would otherwise
    recompute an expensive input (a join + aggregate) on every pass.  It
    also cuts the lineage: a lost executor re-reads the written table
    instead of recomputing from the original scans.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
