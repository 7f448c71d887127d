"""Bounded incremental runs: work through new files once, and resume where an earlier run stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pairloom.operators.pairs import dedup, with_tier


def process_new(spark: SparkSession, folder: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out: str, state: str, once: list[str] | None = None) -> None:
    """Appends transform(new rows) of a Parquet folder to `out`; `state` remembers the files that are done.

    Keys in `once` that the output has already are left out. A batch that runs again finds its keys written, so with
    `once` a restart writes no row twice.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = transform(batch)
        if once:
            rows = rows.dropDuplicates(once)
            try:
                rows = rows.join(spark.read.parquet(out).select(*once), once, "left_anti")
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":  # nothing is written yet
                    raise
        rows.write.mode("append").parquet(out)

    query = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def dedup_new(spark: SparkSession, folder: str, schema: StructType, columns: tuple[str, str, str, str, str], sources: list[str], tags: list[str], out: str, state: str) -> None:
    """Merges a folder's new files into the deduplicated pairs: after each run `out` is what the batch gives for all files.

    `columns` are both endpoints, label, source and evidence. The state is Spark's own, a row for each pair: the labels'
    range and the masks of sources and tags, to which those of new rows are added. Runs go on where the last one stopped;
    one that is cut short is repeated from the same state. `out` is written as a whole, as a table of its own for each
    run, and the pointer file (`out`/current) names the one that is complete.
    """
    rows = spark.readStream.schema(schema).parquet(folder)

    def write(pairs: DataFrame, run: int) -> None:
        with_tier(pairs).write.mode("overwrite").parquet(f"{out}/run={run}")
        spark.createDataFrame([(f"run={run}",)], "name string").coalesce(1).write.mode("overwrite").text(f"{out}/current")

    found = dedup(rows, *columns, sources=sources, tags=tags)
    query = found.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The pairs after the last complete run of dedup_new()."""
    name = spark.read.text(f"{out}/current").first().value
    return spark.read.parquet(f"{out}/{name}")
