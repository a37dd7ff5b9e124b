"""Reading and writing tables: parquet folders, catalogue tables, JDBC.

A *source* or *sink* is a dict, as it appears in a job spec:

``{"format": "parquet", "path": ...}``
    a parquet folder (the default format when ``path`` is given);
``{"table": name}``
    a catalogue table or temporary view;
``{"format": "jdbc", "url": ..., "tablename": ..., "account": ..., "password": ...}``
    a JDBC table.  Instead of ``url`` the reference's keys
    ``database_address``, ``port``, ``database`` build an Oracle thin URL
    (``"dialect": "mysql"`` builds a MySQL one).  ``partition_column``
    turns on Spark's parallel range read (bounds are looked up with one
    MIN/MAX query unless ``lower_bound`` / ``upper_bound`` are given;
    ``num_partitions`` defaults to the default parallelism);
    ``fetchsize`` / ``batchsize`` pass through.  ``split`` reads in parts that any
    table can be cut into instead (``minekit.sources.splits``): ``"depth"`` by equally
    many rows per range of the one column ``split_columns``, ``"hash"`` by a hash of
    its columns, ``"none"`` in one task; ``predicates`` gives the parts as WHERE
    conditions.

A sink with a ``run_id`` is appended to once per run, also if the job is run
again after a failure (``minekit.sources.commit``); it has to be a folder or a
catalogue table of files.

Column pruning and filters reach all three: parquet shows them as
``ReadSchema`` / ``PushedFilters``, JDBC puts them into its SELECT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from minekit.sources import splits
from minekit.sources.commit import append_once

_DRIVERS = {"oracle": "oracle.jdbc.driver.OracleDriver", "mysql": "com.mysql.cj.jdbc.Driver"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def jdbc_url(src: dict) -> str:
    if src.get("url"):
        return src["url"]
    dialect = src.get("dialect", "oracle")
    host, port, db = src["database_address"], src["port"], src["database"]
    if dialect == "oracle":
        return f"jdbc:oracle:thin:@{host}:{port}:{db}"
    if dialect == "mysql":
        return f"jdbc:mysql://{host}:{port}/{db}?useUnicode=true&characterEncoding=utf-8&useSSL=false"
    raise ValueError(f"unknown JDBC dialect {dialect!r}; pass 'url' instead")


def jdbc_options(src: dict) -> dict[str, str]:
    """Spark JDBC options from a source / sink dict (never logged: holds a password)."""
    opts = {"url": jdbc_url(src), "dbtable": src["tablename"]}
    if "account" in src or "user" in src:
        opts["user"] = str(src.get("account", src.get("user")))
    if "password" in src:
        opts["password"] = str(src["password"])
    driver = src.get("driver") or _DRIVERS.get(src.get("dialect", "oracle") if not src.get("url") else "")
    if driver:
        opts["driver"] = driver
    if src.get("partition_column"):
        for key in ("lower_bound", "upper_bound", "num_partitions"):
            if key not in src:
                raise ValueError(f"partitioned JDBC read needs {key} (read_table finds the bounds itself)")
        opts.update({"partitionColumn": src["partition_column"],
                     "lowerBound": str(src["lower_bound"]),
                     "upperBound": str(src["upper_bound"]),
                     "numPartitions": str(src["num_partitions"])})
    elif "num_partitions" in src:
        # On a sink this caps concurrent connections: Spark coalesces to it.
        opts["numPartitions"] = str(src["num_partitions"])
    for key in ("fetchsize", "batchsize", "isolationLevel", "createTableColumnTypes"):
        if key in src:
            opts[key] = str(src[key])
    return opts


def source_format(src: dict) -> str:
    if "format" in src:
        return src["format"]
    if "table" in src:
        return "table"
    if "path" in src:
        return "parquet"
    if "tablename" in src:
        return "jdbc"
    raise ValueError("source needs one of format / table / path / tablename")


def bounds_query(table: str, column: str) -> str:
    """Subquery that returns the range of a numeric partition column."""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) minekit_bounds"


def with_jdbc_bounds(spark: SparkSession, src: dict) -> dict:
    """Fill in ``lower_bound`` / ``upper_bound`` / ``num_partitions`` for a
    partitioned JDBC read that names only ``partition_column``.

    One aggregate query runs in the database (one row back); the partition
    count defaults to the cluster's default parallelism.
    """
    if not src.get("partition_column") or all(k in src for k in ("lower_bound", "upper_bound")):
        out = dict(src)
    else:
        probe = {k: v for k, v in src.items() if k not in ("partition_column", "num_partitions")}
        probe["tablename"] = bounds_query(src["tablename"], src["partition_column"])
        row = spark.read.format("jdbc").options(**jdbc_options(probe)).load().first()
        if row is None or row["lo"] is None:
            return {k: v for k, v in src.items() if k != "partition_column"}   # empty table
        out = dict(src, lower_bound=row["lo"], upper_bound=row["hi"])
    if out.get("partition_column"):
        out.setdefault("num_partitions", spark.sparkContext.defaultParallelism)
    return out


def jdbc_predicates(spark: SparkSession, src: dict, columns: list[str] | None = None) -> list[str] | None:
    """The parts in which a JDBC source is read, or None if it says nothing of parts.

    ``columns`` are what the rows of a source are hashed by that names neither
    parts nor a partition column."""
    if src.get("predicates"):
        return list(src["predicates"])
    how, dialect = src.get("split"), splits.dialect_of(jdbc_url(src))
    if how is None and columns and "partition_column" not in src and dialect:
        how = "hash"
    if how in (None, "none"):
        return None
    named = src.get("split_columns", columns)
    named = named.split(" ") if isinstance(named, str) else list(named or [])
    parts = int(src.get("num_partitions") or spark.sparkContext.defaultParallelism)
    if how == "hash" and named:
        return splits.hash_predicates(named, parts, dialect)
    if how == "depth" and len(named) == 1:
        probe = {k: v for k, v in src.items() if k not in ("partition_column", "num_partitions")}
        probe["tablename"] = f"({splits.cut_query(src['tablename'], named[0], parts)}) minekit_cuts"
        cuts = spark.read.format("jdbc").options(**jdbc_options(probe)).load().collect()      # a row per part
        return splits.depth_predicates(named[0], [r[0] for r in cuts], dialect)
    raise ValueError(f"split {how!r} of {len(named)} columns: it is 'hash' of some, 'depth' of one, or 'none'")


def _read_jdbc(spark: SparkSession, src: dict, columns: list[str] | None) -> DataFrame:
    parts = jdbc_predicates(spark, src, columns)
    if parts is None:
        return spark.read.format("jdbc").options(**jdbc_options(with_jdbc_bounds(spark, src))).load()
    opts = jdbc_options({k: v for k, v in src.items() if k not in ("partition_column", "num_partitions")})
    url, table = opts.pop("url"), opts.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=parts, properties=opts)


def read_table(spark: SparkSession, src: dict, partition_column: str | None = None,
               split_columns: list[str] | None = None) -> DataFrame:
    """Read a source; ``partition_column`` is the numeric key that a JDBC read is
    split by when the source names none (``""`` there reads in one task), and
    ``split_columns`` are columns to split it by hash where there is no such key."""
    fmt = source_format(src)
    if fmt == "jdbc" and partition_column and not {"partition_column", "split", "predicates"} & set(src):
        src = dict(src, partition_column=partition_column)
    if fmt == "table":
        return spark.table(src["table"])
    if fmt == "jdbc":
        return _read_jdbc(spark, src, split_columns)
    if fmt == "text":
        return spark.read.text(src["path"])
    return spark.read.format(fmt).load(src["path"])


def write_table(df: DataFrame, sink: dict, mode: str) -> None:
    """Write a result; ``mode`` is ``append`` (every job but k-means),
    ``overwrite`` (k-means) or ``errorifexists`` (text results).  An append to a
    sink with a ``run_id`` happens once for that run."""
    fmt = source_format(sink)
    if sink.get("run_id") and mode == "append":
        _append_run(df, sink, fmt)
        return
    writer = df.write.mode(mode)
    if fmt == "table":
        writer.saveAsTable(sink["table"])
    elif fmt == "jdbc":
        writer.format("jdbc").options(**jdbc_options(sink)).save()
    elif fmt == "text":
        writer.text(sink["path"])
    else:
        writer.format(fmt).save(sink["path"])


def _append_run(df: DataFrame, sink: dict, fmt: str) -> None:
    if fmt == "jdbc":
        raise ValueError("run_id needs a folder or a catalogue table of files, not a JDBC table")
    if fmt != "table":
        append_once(df, sink["path"], str(sink["run_id"]), fmt)
        return
    spark, name = df.sparkSession, sink["table"]
    if not spark.catalog.tableExists(name):
        df.limit(0).write.saveAsTable(name)
    have = spark.table(name).schema
    if [(f.name, f.dataType) for f in have] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{name} has the columns {have.simpleString()}, the rows {df.schema.simpleString()}")
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if detail.get("# Partition Information") is not None or "Location" not in detail:
        raise ValueError(f"run_id needs a table of files without partitions: {name}")
    append_once(df, detail["Location"], str(sink["run_id"]), detail["Provider"])
    spark.catalog.refreshTable(name)
