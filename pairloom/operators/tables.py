"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a session in one process may do without, which then uses one of its own."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pairloom-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - the session may be gone already at exit
        pass


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; what stands there goes when the driver ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a table of its own: later steps start from it, whatever becomes of the executors. It goes when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


#: About how many rows of a large table one task groups, joins or sorts. Pairs take some 130 bytes a row in each such step.
TASK_ROWS = 500_000


def tasks(spark: SparkSession, rows: int | None) -> int:
    """Partitions for a step over so many rows: the session's, or as many as keep a task's rows in bounds; the session's if the rows aren't known."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // TASK_ROWS))


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """df dealt out by keys to more partitions than the session's if its rows call for them, so that the memory of a task doesn't grow with the table.

    What then groups or joins by these keys takes the partitions as they are. Nothing is combined before this shuffle, as
    the partial groups of a large split would take as much memory again. `rows`: how many df has, or more.
    """
    n = tasks(df.sparkSession, rows)
    return df.repartition(n, *keys) if n > tasks(df.sparkSession, None) else df


def release(*frames: DataFrame) -> None:
    """Deletes written tables at once, for callers that have written everything that reads them."""
    for df in frames:
        if path := getattr(df, "_written", None):
            remove(df.sparkSession, path)
