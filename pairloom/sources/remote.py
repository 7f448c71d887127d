"""Records from a remote service, fetched once in batches by tasks and kept: answers and negative answers alike."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import urlopen

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pairloom.operators.tables import release, written

#: Answers that a later try may better (fixed values); 400 and 404 are about the ids, all others end the job.
TRANSIENT, UNKNOWN = (408, 425, 429, 500, 502, 503, 504), (400, 404)

Fetch = Callable[[list[str]], dict[str, str]]


def by_http(url: str, ids_name: str, parse: Callable[[str], dict[str, str]], seconds: float = 120.0, **fixed: str | int) -> Fetch:
    """A fetch function that asks `url` for ids joined by commas; parse() makes (id, value) of the text that comes back."""

    def fetch(ids: list[str]) -> dict[str, str]:
        with urlopen(f"{url}?{urlencode({ids_name: ','.join(ids), **fixed})}", timeout=seconds) as answer:  # noqa: S310 - the caller's address
            return parse(answer.read().decode())

    return fetch


def fasta_values(text: str) -> dict[str, str]:
    """Sequences of a small FASTA answer by id (the second token between bars if there are three, else the first word)."""
    out = {}
    for record in ("\n" + text).split("\n>")[1:]:
        head, _, body = record.partition("\n")
        bars = head.split("|")
        out[bars[1] if len(bars) >= 3 else (head.split() or [""])[0]] = "".join(body.split())
    return out


def patient(fetch: Fetch, ids: list[str], tries: int, pause: float, between: Callable[[], None]) -> dict[str, str]:
    """What fetch() finds. Transient failures are tried again, each time after twice the pause, or when the service says.

    A batch that is refused for its ids is halved until the id that is refused stands alone: that one isn't found.
    """
    for k in range(tries):
        between()
        try:
            return fetch(ids)
        except HTTPError as e:
            if e.code in UNKNOWN:
                if len(ids) == 1:
                    return {}
                half = len(ids) // 2
                return patient(fetch, ids[:half], tries, pause, between) | patient(fetch, ids[half:], tries, pause, between)
            if e.code not in TRANSIENT or k + 1 == tries:
                raise
            said = e.headers.get("Retry-After", "") if e.headers else ""
            wait = float(said) if said.isdecimal() else 0.0
        except (URLError, TimeoutError, ConnectionError):
            if k + 1 == tries:
                raise
            wait = 0.0
        time.sleep(max(wait, pause * 2**k * random.uniform(0.5, 1.0)))
    raise ValueError("at least one try is needed")


class _File(InputPartition):
    """The ids of one file."""


def record_source(files: list[str], key: str, fetch: Fetch, batch: int, tries: int, pause: float, gap: float) -> type[DataSource]:
    """A data source with a partition for each file of ids, whose rows are (key, value); value is NULL for ids not found."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [_File(f) for f in files] or [_File("")]

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            if not partition.value:
                return
            last = [0.0]

            def between() -> None:
                time.sleep(max(0.0, last[0] + gap - time.monotonic()))
                last[0] = time.monotonic()

            store, path = fs.FileSystem.from_uri(partition.value)
            with store.open_input_file(path) as f:
                for part in pq.ParquetFile(f).iter_batches(batch, columns=[key]):
                    ids = part.column(0).to_pylist()
                    found = patient(fetch, ids, tries, pause, between)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array([found.get(i) for i in ids], pa.string())], names=[key, "value"])

    class Records(DataSource):
        @classmethod
        def name(cls) -> str:
            return "pairloom_records"

        def schema(self) -> str:
            return f"`{key}` string, value string"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001 - as the interface has it
            return Reader()

    return Records


def fetch_missing(ids: DataFrame, key: str, cache: str, fetch: Fetch, batch: int = 200, ask_again: bool = True, tasks: int = 8, rate: float | None = None, tries: int = 5, pause: float = 1.0) -> DataFrame:
    """(key, value) of all ids: those that the cache (a Parquet folder) lacks are fetched in batches and appended to it.

    fetch() gets a list of distinct ids and returns what it finds. An id that isn't found is asked for again the next
    time; without `ask_again` the cache keeps that answer too. At most `tasks` tasks ask at once, and with a `rate` all of
    them together start no more than so many requests a second. A task that is lost asks for its own ids again. Ids that
    are NULL or empty are left out.
    """
    spark = ids.sparkSession
    wanted = ids.select(F.col(key).cast("string").alias(key)).where(F.col(key) != "").distinct()
    schema = f"`{key}` string, value string"
    try:
        known = spark.read.schema(schema).parquet(cache)
        wanted = wanted.join(known.where("value is not null") if ask_again else known, key, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    listed = written(wanted, "wanted")
    if n := listed.count():
        parts = max(1, min(tasks, -(-n // batch)))
        asked = written(listed.repartition(parts), "asked")
        source = record_source(list(asked.inputFiles()), key, fetch, batch, tries, pause, parts / rate if rate else 0.0)
        spark.dataSource.register(source)
        told = spark.read.format(source.name()).load()
        (told.where("value is not null") if ask_again else told).write.mode("append").parquet(cache)
        release(asked)
    release(listed)
    try:
        found = spark.read.schema(schema).parquet(cache)
    except AnalysisException as e:  # there was nothing to ask for
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema)
    return found.where("value is not null").join(ids.select(F.col(key).cast("string").alias(key)).distinct(), key)
