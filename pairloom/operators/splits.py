"""Leakage-safe splits: holdouts, tainted clusters, the training remainder and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.pairs import exclude_endpoints, exclude_pairs, hash_rank, sample, undirected


def tainted_members(clusters: DataFrame, holdout_ids: DataFrame, member: str, cluster: str) -> DataFrame:
    """(member): everything in a cluster that a holdout id touches."""
    key = holdout_ids.columns[0]
    touched = clusters.join(holdout_ids.select(F.col(key).alias(member)).distinct(), member, "left_semi").select(cluster).distinct()
    return clusters.join(touched, cluster, "left_semi").select(member)


def cluster_flags(clusters: DataFrame, holdout_ids: DataFrame, member: str, cluster: str) -> DataFrame:
    """The cluster map with is_positive_holdout and is_tainted."""
    key = holdout_ids.columns[0]
    held = holdout_ids.select(F.col(key).alias(member), F.lit(True).alias("__held")).distinct()
    marked = clusters.join(held, member, "left").withColumn("is_positive_holdout", F.coalesce("__held", F.lit(False))).drop("__held")
    touched = marked.where("is_positive_holdout").select(cluster, F.lit(True).alias("__t")).distinct()
    return marked.join(touched, cluster, "left").withColumn("is_tainted", F.coalesce("__t", F.lit(False))).drop("__t")


def sample_holdout(positives: DataFrame, keys: list[str], n_val: int, n_test: int, seed: int) -> DataFrame:
    """(keys, part): the first n_val rows in seeded order are `val`, the next n_test `test`."""
    from pairloom.operators.entities import dense_numbers

    top = sample(positives, n_val + n_test, seed, *keys).withColumn("__h", hash_rank(seed, *keys))
    ranked = dense_numbers(top, "__h", *keys)
    return ranked.select(*keys, F.when(F.col("number") < n_val, "val").otherwise("test").alias("part"))


def training_rows(pairs: DataFrame, holdout: DataFrame, clusters: DataFrame, a: str, b: str, label: str, member: str, cluster: str) -> DataFrame:
    """Positive pairs that are no holdout pair and of which no endpoint lies in a cluster that a positive holdout touches."""
    ends = holdout.where(F.col(label) == 1).select(F.explode(F.array(a, b)).alias("id")).distinct()
    bad = tainted_members(clusters, ends, member, cluster)
    return exclude_pairs(exclude_endpoints(pairs.where(F.col(label) == 1), bad, a, b), undirected(holdout, a, b), [a, b])


def cascade_counts(pairs: DataFrame, holdout: DataFrame, clusters: DataFrame, a: str, b: str, label: str, member: str, cluster: str) -> DataFrame:
    """Rows in, positives, rows whose endpoints are clean, and rows that stay: one pass with flags."""
    ends = holdout.where(F.col(label) == 1).select(F.explode(F.array(a, b)).alias("id")).distinct()
    bad = tainted_members(clusters, ends, member, cluster).distinct()
    one = bad.select(F.col(member).alias(a), F.lit(1).alias("__a"))
    two = bad.select(F.col(member).alias(b), F.lit(1).alias("__b"))
    held = undirected(holdout, a, b).withColumn("__h", F.lit(1))
    flagged = pairs.join(one, a, "left").join(two, b, "left").join(held, [a, b], "left")
    positive = F.col(label) == 1
    clean = positive & F.col("__a").isNull() & F.col("__b").isNull()
    return flagged.agg(F.count("*").alias("rows_in"), F.count_if(positive).alias("positives"), F.count_if(clean).alias("after_taint"), F.count_if(clean & F.col("__h").isNull()).alias("rows_out"))


def overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Number of distinct keys that both sides have."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_semi").agg(F.count("*").alias("n_common"))
