"""Appending to a file table exactly once per run.

``append_once(df, path, run_id)`` writes in two steps, so a job that is run again
after a failure, under the same run id, adds its rows once:

1.  *Stage*: Spark writes the rows to ``<path>/_runs/<run_id>/rows``, a folder that
    readers of the table skip.  A failed attempt leaves it without a plan; the
    next attempt deletes it and begins anew.
2.  *Commit*: the plan, the list of staged files and the names they get in the
    table, is written and renamed into place, which decides the run.  Then each
    file is moved, and last the plan is renamed to ``done``.

A run found without a plan is staged anew; one with a plan is finished from it,
file by file, whatever was moved already; one that is done is left alone.  The
file names hold the run id, so no two runs touch each other's files.  Until an
interrupted commit is finished a reader may see a part of its rows;
``unfinished`` names such runs.  Two attempts of one run must not overlap.

Files are listed and moved through Hadoop's file system, so the table can be
in any store that Spark writes to.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.=+@-]{0,127}")


class _Folder:
    """Hadoop's file system at one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self.fs = self.root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root.toString()}/{name}")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name))) if self.exists(name) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.at(old), self.at(new)):
            raise OSError(f"cannot move {self.at(old)} to {self.at(new)}")

    def write(self, name: str, text: str) -> None:
        """A whole small file, or none: written aside and renamed."""
        aside = f"{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self.at(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(aside, name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _run(run_id: str) -> str:
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id has letters, digits and . = + @ - only, at most 128: {run_id!r}")
    return f"_runs/{run_id}"


def run_state(spark: SparkSession, path: str, run_id: str) -> str:
    """``new`` (nothing decided), ``committing`` (to be finished) or ``done``."""
    folder, run = _Folder(spark, path), _run(run_id)
    return "done" if folder.exists(f"{run}/done") else "committing" if folder.exists(f"{run}/plan") else "new"


def unfinished(spark: SparkSession, path: str) -> list[str]:
    """Runs whose commit was interrupted: their rows may be there in part."""
    folder = _Folder(spark, path)
    return [r for r in folder.names("_runs") if run_state(spark, path, r) == "committing"]


def stage(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """The first step: the rows in the run's own folder, and the plan that decides the run."""
    spark, run = df.sparkSession, _run(run_id)
    folder = _Folder(spark, path)
    folder.delete(run)
    df.write.mode("errorifexists").format(fmt).save(f"{folder.root.toString()}/{run}/rows")
    files = [f for f in folder.names(f"{run}/rows") if not f.startswith(("_", "."))]
    folder.write(f"{run}/plan", json.dumps({f: f"part-{run_id}-{i:05d}-{f}" for i, f in enumerate(files)}))


def commit(spark: SparkSession, path: str, run_id: str) -> None:
    """The second step, or what is left of it."""
    folder, run = _Folder(spark, path), _run(run_id)
    for old, new in json.loads(folder.read(f"{run}/plan")).items():
        if not folder.exists(new):
            folder.move(f"{run}/rows/{old}", new)
    folder.move(f"{run}/plan", f"{run}/done")
    folder.delete(f"{run}/rows")


def append_once(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> bool:
    """Append ``df`` to the folder under ``run_id``; False if that run was done before.

    The rows are not computed again for a run that is decided."""
    spark = df.sparkSession
    state = run_state(spark, path, run_id)
    if state == "done":
        return False
    if state == "new":
        stage(df, path, run_id, fmt)
    commit(spark, path, run_id)
    return True
