"""Shared helpers: tables, words, intermediate tables in the shared folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.tables import release, remove, shared_dir  # noqa: F401 - release is used by the operators
from pairloom.operators.tables import written as materialize

#: Words are runs of characters other than ASCII white space; bytes.split() cuts at exactly these.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_if_any(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """The table, or None where there is none of that name."""
    try:
        return table(spark, sf_dir, name)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null text has none."""
    return text.encode().split() if text else []


def new_dir(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared folder; removed when the driver ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def signed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, sig, text) of the rows that have both: sig, a hash of the text, tells rows apart that repeat a doc_id."""
    named = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    return named.select("doc_id", F.xxhash64("text").alias("sig"), "text")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it (whatever the case of its letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_values(pairs: DataFrame, values: DataFrame, a: list[str], b: list[str], key: list[str], value: str, fan: int = 256) -> DataFrame:
    """The pairs with the values of both sides as x and y.

    The right side (b) may be the hub of a large group: it is sent once for each `fan` of its partners, and these are
    dealt among its copies, so that no task gathers a group. (The counts are written: joined in one stage with the rows
    that they count, they would keep Spark from splitting a hub's partition.)
    """
    hubs = materialize(pairs.groupBy(*b).agg(F.expr(f"(count(*) - 1) div {fan} + 1").alias("__copies")), "hubs")
    dealt = pairs.join(hubs, b).withColumn("__copy", F.pmod(F.xxhash64(*a), F.col("__copies"))).drop("__copies")
    named = lambda side, name: values.select(*(F.col(k).alias(s) for k, s in zip(key, side, strict=True)), F.col(value).alias(name))
    right = hubs.join(named(b, "y"), b).withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1))).drop("__copies")
    return dealt.join(named(a, "x"), a).join(right, [*b, "__copy"]).drop("__copy")


def hash_sample(df: DataFrame, key: str, n: int, rows: int) -> list:
    """At most n rows with the smallest hashes of their key, for fitting an index or a classifier; the same on every run.

    `rows` (how many there are, about) first thins the hashes to some 4 n, so that what tasks send to the driver is
    bounded however many tasks there are.
    """
    share = min(1.0, 4 * n / max(1, rows))
    h = F.xxhash64(key, F.lit(1))
    thin = df.where(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40)))
    return thin.orderBy(h, key).limit(n).collect()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches (views, not copies), so that a worker holds few texts as Python objects at once."""
    for batch in batches:
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)


def hash_words(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    h = xxhash.xxh64_intdigest
    return np.fromiter([h(w) for w in words], dtype=np.uint64, count=len(words))


def sliding_min(a: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k consecutive values, by doubling."""
    size, out = 1, a
    while size * 2 <= k:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = k - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def mix(a: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; spreads weak hashes over all bits."""
    with np.errstate(over="ignore"):
        a = a ^ (a >> np.uint64(30))
        a = a * np.uint64(0xBF58476D1CE4E5B9)
        a = a ^ (a >> np.uint64(27))
        a = a * np.uint64(0x94D049BB133111EB)
        return a ^ (a >> np.uint64(31))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) long edges: rows (node, component), component the smallest node reachable.

    Alternates the large-star and small-star steps on written tables until nothing changes: few rounds even for
    long chains, and no group is collected: a hub's neighbours are replaced by links to its minimum, each in a row
    of its own. Nodes without an edge are not returned. Loops, repeated edges and nulls are ignored.
    """
    spark = edges.sparkSession
    both = edges.where("a is not null and b is not null and a <> b")
    now = materialize(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        # Large star: each node links its larger neighbours to the smallest of itself and its neighbours.
        ends = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(ends.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "low")
        large = ends.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large")
        release(now, low)
        # Small star: each node links itself and its smaller neighbours to the smallest of these.
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = materialize(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        release(large, low)
        state = now.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(a, b))"), F.lit(0))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    own = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
