"""Matching by priority: first alias with a match, fallback keys, content, cascades of manifests, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_alias(df: DataFrame, key: str, aliases: Column, targets: DataFrame, target: str, value: str) -> DataFrame:
    """(key, at, value): the first alias of each row's ordered list that the targets have."""
    named = df.select(key, F.posexplode(aliases).alias("at", target))
    hit = named.join(targets.select(target, value), target)
    return hit.groupBy(key).agg(F.min(F.struct("at", value)).alias("x")).select(key, "x.at", f"x.{value}")


def fallback(df: DataFrame, first: tuple[str, DataFrame], second: tuple[str, DataFrame], value: str) -> DataFrame:
    """Adds `value` by the first key, else by the second, and `matched_by` (first, second or NULL)."""
    (k1, t1), (k2, t2) = first, second
    one = t1.select(k1, F.col(value).alias("__1"))
    two = t2.select(k2, F.col(value).alias("__2"))
    out = df.join(one, k1, "left").join(two, k2, "left")
    by = F.when(F.col("__1").isNotNull(), "first").when(F.col("__2").isNotNull(), "second")
    return out.withColumn(value, F.coalesce("__1", "__2")).withColumn("matched_by", by).drop("__1", "__2")


def checked_lookup(df: DataFrame, key: str, table: DataFrame, value: str) -> DataFrame:
    """Inner lookup that must map every row: an error names up to five keys without a match."""
    missing = [x[0] for x in df.join(table, key, "left_anti").select(key).distinct().orderBy(key).limit(5).collect()]
    if missing:
        raise ValueError(f"no match for {missing}")
    return df.join(table.select(key, value), key)


def cascade(steps: list[tuple[Column, str]], rest: str | None = None) -> Column:
    """The name of the first condition that holds; NULL conditions don't."""
    out = F.lit(rest)
    for condition, name in reversed(steps):
        out = F.when(F.coalesce(condition, F.lit(False)), name).otherwise(out)
    return out


def coverage(needed: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Needed, present, missing, and the share that is there."""
    ids = needed.select(key).distinct()
    flagged = ids.join(present.select(key, F.lit(1).alias("__p")).distinct(), key, "left")
    there = F.col("__p").isNotNull()
    return flagged.agg(F.count("*").alias("n_needed"), F.count_if(there).alias("n_present"), F.count_if(~there).alias("n_missing"), (F.count_if(there) / F.count("*")).alias("ratio"))


def missing(needed: DataFrame, present: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first n missing keys."""
    return needed.select(key).distinct().join(present.select(key), key, "left_anti").orderBy(key).limit(n)


def best_hits(hits: DataFrame, target: str, least: float, identity: str = "identity", score: str = "score", *ties: str) -> DataFrame:
    """The best hit of each target by identity, then score, of those with at least the given identity."""
    columns = [identity, score, *ties]
    best = F.max(F.struct(*columns)).alias("x")
    return hits.where(F.col(identity) >= least).groupBy(target).agg(best).select(target, *(f"x.{c}" for c in columns))


def pending(tasks: DataFrame, done: DataFrame, key: str, status: str = "status", ok: str = "ok") -> DataFrame:
    """Tasks that no earlier run has finished."""
    return tasks.join(done.where(F.col(status) == ok).select(key).distinct(), key, "left_anti")


def two_phase(df: DataFrame, key: str, first: tuple[str, DataFrame], second: tuple[str, DataFrame], value: str) -> DataFrame:
    """(key, value, match_type): by the first key (`id`), and only what that leaves by the second (`sequence`)."""
    (k1, t1), (k2, t2) = first, second
    one = df.join(t1.select(k1, value), k1).select(key, value, F.lit("id").alias("match_type"))
    rest = df.join(one.select(key).distinct(), key, "left_anti")
    two = rest.join(t2.select(k2, value), k2).select(key, value, F.lit("sequence").alias("match_type"))
    return one.unionByName(two)


def distinct_targets(df: DataFrame, identifier: str, content: str, pos: str) -> tuple[DataFrame, DataFrame]:
    """Targets by id and content, the first of each; and by content alone, the first of each."""
    ids = df.groupBy(identifier, content).agg(F.min(pos).alias(pos))
    return ids, ids.groupBy(content).agg(F.min_by(identifier, pos).alias(identifier), F.min(pos).alias(pos))


def chosen_rows(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, column: str = "source") -> DataFrame:
    """Rows of the included sources (all without a list) that are not excluded."""
    x = df.where(F.col(column).isin(*include)) if include else df
    return x.where(~F.coalesce(F.col(column).isin(*exclude), F.lit(False))) if exclude else x


def of_length(df: DataFrame, sequence: str, least: int | None = None, most: int | None = None) -> DataFrame:
    """Rows whose sequence has a length within the bounds that are given."""
    n = F.length(sequence)
    x = df.where(n >= least) if least is not None else df
    return x.where(n <= most) if most is not None else x


def matched_rows(df: DataFrame, flag: str = "matched", accession: str = "uniprot_id") -> DataFrame:
    """Rows that are matched and have an accession."""
    return df.where((F.col(flag).cast("int") == 1) & (F.col(accession) != ""))


def containing(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column holds a text, literally."""
    return df.where(F.contains(F.coalesce(F.col(column), F.lit("")), F.lit(text)))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, an error if it lacks columns."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"no columns {missing} in {df.columns}")
    return df
