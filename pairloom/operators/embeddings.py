"""Per-entity vectors: pooling, dense index export, batches, and model inference by registered extractors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.models import MAX_LENGTH, MODELS, POOLS, checked_pool, two_inputs
from pairloom.operators.entities import dense_numbers, ranked, with_base
from pairloom.operators.supervised import Guarded


def pool(df: DataFrame, key: str, pos: str, vector: str, how: str) -> DataFrame:
    """(key, vector): a matrix of rows (key, pos, vector) reduced over its rows; `cls` is the first row, `residue` all of them."""
    if how not in POOLS:
        raise ValueError(f"no pooling {how!r}; there are {', '.join(POOLS)}")
    if how == "cls":
        return df.groupBy(key).agg(F.min_by(vector, pos).alias(vector))
    if how == "residue":
        rows = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(vector).alias("v"))))
        return df.groupBy(key).agg(F.transform(rows, lambda x: x["v"]).alias(vector))
    cells = df.select(key, F.posexplode(vector).alias("i", "x"))
    cells = cells.groupBy(key, "i").agg((F.avg("x") if how == "mean" else F.max("x")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return cells.groupBy(key).agg(F.transform(ordered, lambda c: c["x"]).alias(vector))


def export(pairs: DataFrame, a: str, b: str, vectors: DataFrame, key: str, vector: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Index rows (number, key, vector, valid) of all endpoints in id order, missing vectors as zeros, and pairs of numbers."""
    ids = pairs.select(F.explode(F.array(a, b)).alias(key)).distinct()
    index = dense_numbers(ids, key)
    zero = F.array_repeat(F.lit(0.0).cast("float"), size)
    rows = index.join(vectors.select(key, vector), key, "left").select("number", key, F.coalesce(vector, zero).alias(vector), F.col(vector).isNotNull().alias("valid"))
    left = index.select(F.col(key).alias(a), F.col("number").alias("left"))
    right = index.select(F.col(key).alias(b), F.col("number").alias("right"))
    return rows, pairs.join(left, a).join(right, b).select(a, b, "left", "right")


def worker_buckets(df: DataFrame, workers: int, order: str) -> DataFrame:
    """Adds `worker`: an even split in order, the first ones one row longer if it doesn't divide."""
    parts, sizes = ranked(df, order)
    small, more = divmod(sum(sizes), workers)
    number = F.col("__base") + F.col("__at")
    edge = more * (small + 1)
    worker = F.when(number < edge, F.floor(number / (small + 1))).otherwise(more + F.floor((number - edge) / max(1, small)))
    return with_base(parts, list(accumulate(sizes, initial=0))[:-1]).select(*df.columns, worker.cast("int").alias("worker"))


def fixed_batches(df: DataFrame, size: int, order: str) -> DataFrame:
    """Adds `batch`: 0 for the first `size` rows in order, and so on."""
    return dense_numbers(df, order).withColumn("batch", F.floor(F.col("number") / size)).drop("number")


def budget_plan(sizes: list[tuple[int, int]], most_rows: int, most_units: int) -> list[tuple[int, int, int, int, int]]:
    """(size, first number, rows that still join the open batch, rows a batch, open batch) for (size, rows) from the largest down.

    Greedy batches of rows in descending size: a new one starts where a row would pass either limit. Rows of one size are
    handled together, so this takes a step for each size and not for each row.
    """
    out = []
    start = batch = rows = units = 0
    for size, n in sizes:
        full = max(1, min(most_rows, most_units // size if size > 0 else most_rows))
        room = min(most_rows - rows, (most_units - units) // size if size > 0 else most_rows) if units <= most_units else 0
        join = min(n, max(0, room)) if rows else 0
        if not rows and n:
            join = min(n, full)
        out.append((size, start, join, full, batch))
        left = n - join
        rows, units = rows + join, units + join * size
        if left:
            more = -(-left // full)
            batch += more
            rows = left - (more - 1) * full
            units = rows * size
        start += n
    return out


def budget_batches(df: DataFrame, size: str, order: str, most_rows: int, most_units: int) -> DataFrame:
    """Adds `batch`: greedy batches of the rows in descending size, a new one where a row would pass either limit.

    One order over all rows, so the batches don't depend on partitions. The driver sees the number of rows of each size.
    """
    counts = sorted(((x[0], x[1]) for x in df.groupBy(F.col(size).cast("long")).count().collect()), reverse=True)
    plan = df.sparkSession.createDataFrame(budget_plan(counts, most_rows, most_units) or [(0, 0, 0, 1, 0)], "__size long, __start long, __join long, __full long, __batch long")
    numbered = dense_numbers(df, F.col(size).desc(), F.col(order))
    x = numbered.join(F.broadcast(plan), F.col(size).cast("long") == F.col("__size"))  # a row for each size
    at = F.col("number") - F.col("__start")
    batch = F.when(at < F.col("__join"), F.col("__batch")).otherwise(F.col("__batch") + 1 + F.floor((at - F.col("__join")) / F.col("__full")))
    return x.select(*df.columns, batch.cast("long").alias("batch"))


#: Texts of one call of a model, and their characters: matrices of so many rows are held at a time.
MOST_ROWS, MOST_UNITS = 64, 1 << 16
#: name -> (vector length, factory of a function from texts to matrices); a worker calls the factory once.
EXTRACTORS: dict[str, tuple[int, Callable[[], Callable[[list[str]], list]]]] = {}


def register_extractor(name: str, size: int, factory: Callable[[], Callable[[list[str]], list]]) -> None:
    EXTRACTORS[name] = (size, factory)


def slices(sizes: list[int], most_rows: int = MOST_ROWS, most_units: int = MOST_UNITS) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive rows that stay within both limits; a row beyond the second one is alone."""
    lo = units = 0
    for k, size in enumerate(sizes):
        if k > lo and (k - lo == most_rows or units + size > most_units):
            yield lo, k - lo
            lo, units = k, 0
        units += size
    if sizes:
        yield lo, len(sizes) - lo


def embed(df: DataFrame, key: str, text: str, extractor: str, how: str = "mean", done: DataFrame | None = None, before: int = 0, after: int = 0, seconds: float | None = None) -> DataFrame:
    """(key, vector, error): pooled vectors of the texts by a registered extractor; `residue` gives (key, matrix, error).

    Ids that `done` has are left out. `before` and `after` rows of special tokens are cut off the matrix; `cls` is the
    first row of all. The model is called with few texts at a time, so a task holds few matrices. A batch that fails is halved until single rows are left, which then carry the error; the model is
    loaded anew after each. With `seconds` the model runs in a child process of the task: a batch that takes longer, or
    ends that process, has failed, and the process is killed with all that it has started.
    """
    if how not in POOLS:
        raise ValueError(f"no pooling {how!r}; there are {', '.join(POOLS)}")
    _, factory = EXTRACTORS[extractor]
    if done is not None:
        df = df.join(done.select(key).distinct(), key, "left_anti")
    column = "matrix" if how == "residue" else "vector"

    def pooled(matrix):
        if matrix.ndim != 2 or len(matrix) <= before + after:
            raise ValueError("a matrix with rows is needed")
        rows = matrix[before : len(matrix) - after].astype(float)
        if how == "residue":
            return rows.tolist()
        return (matrix[0].astype(float) if how == "cls" else rows.mean(axis=0) if how == "mean" else rows.max(axis=0)).tolist()

    kind = df.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, {column} {'array<array<double>>' if how == 'residue' else 'array<double>'}, error string"
    found_type = pa.list_(pa.list_(pa.float64())) if how == "residue" else pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Guarded(factory, seconds, pooled) as model:
            for whole in batches:
                for lo, n in slices(pc.fill_null(pc.utf8_length(whole.column(1)), 0).to_pylist()):
                    part = whole.slice(lo, n)
                    found = model([t if t is not None else "" for t in part.column(1).to_pylist()])
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v for v, _ in found], found_type), pa.array([e for _, e in found], pa.string())], names=[key, column, "error"])

    return df.select(key, text).mapInArrow(run, out)


def embed_by_model(df: DataFrame, key: str, sequence: str, model: str, pool: str | None = None, done: DataFrame | None = None, structure: DataFrame | None = None, seconds: float | None = None, **flags: bool) -> DataFrame:
    """embed() with a model's own rules: its letters and length, the tokens it adds, and the pooling that flags ask for.

    A model that takes a structure beside the residues gets both joined; ids without one are left out (two_inputs() in
    functions/models.py counts them).
    """
    rules = MODELS[model]
    if structure is None:
        texts = df.select(key, rules.text(F.col(sequence), MAX_LENGTH).alias("__text"))
    else:
        texts = two_inputs(model, df, structure, key, sequence)[0].withColumnRenamed("text", "__text")
    return embed(texts, key, "__text", model, checked_pool(model, pool, **flags), done, rules.before, rules.after, seconds)


def precomputed(ids: DataFrame, matrix: DataFrame, key: str, pos: str, vector: str) -> DataFrame:
    """(key, vector) of a matrix whose rows (pos, vector) belong to the ids (pos, key) in the same order; an error if their numbers differ."""
    n, m = ids.count(), matrix.count()
    if n != m:
        raise ValueError(f"{n} ids, but {m} rows")
    return ids.join(matrix, pos).select(key, vector)


def relational(pairs: DataFrame, a: str, b: str, label: str, vectors: DataFrame, key: str, vector: str, size: int) -> dict[str, DataFrame]:
    """The dense export as three tables: vectors with their numbers and a mask of valid ones, pairs of numbers with labels, and ids."""
    rows, numbered = export(pairs, a, b, vectors, key, vector, size)
    labels = pairs.select(a, b, label).distinct()
    return {"vectors": rows.select("number", vector, "valid"), "pairs": numbered.distinct().join(labels, [a, b]).select("left", "right", label), "ids": rows.select("number", key)}
