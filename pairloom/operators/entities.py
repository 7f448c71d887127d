"""Entity resolution: first and last wins, unique sequences, the id registry."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.sequences import public_id
from pairloom.operators.tables import tasks, written


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order (total, so the same on every run)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def last_value(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """(key, value): of repeated keys the last value, as when filling a dictionary. One aggregate, combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, pos).alias(value))


def first_value(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """(key, value): of repeated keys the first value."""
    return df.groupBy(key).agg(F.min_by(value, pos).alias(value))


def by_content(df: DataFrame, text: str, key: str, *aggregates: Column) -> DataFrame:
    """Aggregates of the groups of equal texts, and `__key`, a row of each: grouped by hash, so no text is shuffled."""
    return df.groupBy(F.md5(text).alias("__md5")).agg(F.min(key).alias("__key"), *aggregates).drop("__md5")


def with_text(groups: DataFrame, df: DataFrame, text: str, key: str) -> DataFrame:
    """The text of each of the groups that are left, by its row."""
    return groups.join(df.select(F.col(key).alias("__key"), text), "__key").drop("__key")


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def longest(df: DataFrame, group: str, size: str, pos: str, *columns: str) -> DataFrame:
    """Each group's row with the largest size, the first of equals."""
    best = F.max_by(F.struct(*columns, size, pos), F.struct(F.col(size), -F.col(pos))).alias("best")
    return df.groupBy(group).agg(best).select(group, *(f"best.{c}" for c in columns), f"best.{size}", f"best.{pos}")


def master_aliases(master: DataFrame, fpid: str, ids: str, pos: str) -> DataFrame:
    """(source_id, fpid): aliases of the master table, cut at commas and semicolons; a repeated alias means its last row."""
    alias = F.posexplode(F.split(F.regexp_replace(ids, ",", ";"), ";")).alias("at", "source_id")
    rows = master.select(fpid, pos, alias).select(F.col(fpid).alias("fpid"), pos, "at", F.trim("source_id").alias("source_id")).where("source_id <> ''")
    return rows.groupBy("source_id").agg(F.max_by("fpid", F.struct(pos, "at")).alias("fpid"))


def register(master: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolves incoming rows (source_id, md5, pos) against a master (fpid, md5, original_ids, pos), minting new ids.

    An id that is known, from the master or an earlier row, keeps its entity whatever its sequence now is; else equal
    content decides; else the content's first row mints the next number. Returns (source_id, fpid) for all ids and
    (fpid, md5, source_id, original_ids, is_new) for the entities that got new ids.
    """
    aliases = master_aliases(master, "fpid", "original_ids", "pos")
    named = written(rows.groupBy("source_id").agg(F.min(F.struct("pos", "md5")).alias("one")).select("source_id", "one.md5", "one.pos"), "incoming")
    fresh = named.join(aliases, "source_id", "left_anti")
    known = master.groupBy("md5").agg(F.max_by("fpid", "pos").alias("fpid"))
    minted = mint(fresh.join(known, "md5", "left_anti"), master)
    by_content = known.unionAll(minted.select("md5", "fpid"))
    resolved = fresh.join(by_content, "md5").select("source_id", "fpid", "pos")
    ids = aliases.unionAll(resolved.select("source_id", "fpid"))
    old = master.select("fpid", F.transform(F.split(F.regexp_replace("original_ids", ",", ";"), ";"), lambda x: F.trim(x)).alias("old"))
    added = resolved.groupBy("fpid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "source_id"))), lambda x: x["source_id"]).alias("new"))
    touched = added.join(old, "fpid", "left").join(minted.select("fpid", "md5", F.lit(True).alias("is_new")), "fpid", "left")
    names = F.array_distinct(F.concat(F.filter(F.coalesce("old", F.array().cast("array<string>")), lambda x: x != ""), "new"))
    return ids, touched.select("fpid", "md5", F.array_join(names, ";").alias("original_ids"), F.coalesce("is_new", F.lit(False)).alias("is_new"))


def mint(fresh: DataFrame, master: DataFrame) -> DataFrame:
    """(md5, fpid): numbers after the master's largest, by the contents' first positions."""
    last = master.agg(F.max(F.substring("fpid", 3, 20).cast("long")).alias("n")).first().n or 0
    firsts = fresh.groupBy("md5").agg(F.min("pos").alias("pos"))
    return dense_numbers(firsts, "pos").select("md5", public_id(F.col("number") + F.lit(last + 1)).alias("fpid"))


def ranked(df: DataFrame, *order: str | Column, rows: int | None = None) -> tuple[DataFrame, list[int]]:
    """df with `__part` and `__at`, a row's range and its place there in the given order, and the rows of each range.

    The rows are ranged, sorted and written once, and everything is read from that table: two plans that range the same
    rows may cut them at different places. rows: how many df has, if known; large tables get more ranges.
    """
    n = tasks(df.sparkSession, rows)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    table = written(numbered, "ranked")
    parts = table.select((F.shiftright("__id", 33)).cast("int").alias("__part"), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"), *df.columns)
    sizes = {x["__part"]: x.n for x in parts.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # a number for each range
    return parts, [sizes.get(k, 0) for k in range(max(sizes, default=-1) + 1)]


def with_base(parts: DataFrame, bases: list[int], name: str = "__base") -> DataFrame:
    """Adds each range's number; the table of them has a row for each range, so it may be broadcast."""
    table = parts.sparkSession.createDataFrame(list(enumerate(bases)) or [(0, 0)], f"__part int, `{name}` long")
    return parts.join(F.broadcast(table), "__part")


def dense_numbers(df: DataFrame, *order: str | Column) -> DataFrame:
    """Adds `number`: 0, 1, 2, ... in the order of columns that no two rows share: ranked per range, offset by the ranges before."""
    parts, sizes = ranked(df, *order)
    based = with_base(parts, list(accumulate(sizes, initial=0))[:-1])
    return based.select(*df.columns, (F.col("__base") + F.col("__at")).alias("number"))
