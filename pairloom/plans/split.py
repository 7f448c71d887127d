"""The leakage-safe split: given or sampled holdouts, tainted clusters, training pairs, sequences and counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.sequences import content_md5
from pairloom.operators import clusters as G
from pairloom.operators import pairs as P
from pairloom.operators import splits
from pairloom.operators.tables import written


@dataclass(frozen=True)
class Sizes:
    """How many positives and negatives to sample for each part."""

    val_pos: int = 0
    test_pos: int = 0
    val_neg: int = 0
    test_neg: int = 0

    def __post_init__(self) -> None:
        if min(self.val_pos, self.test_pos, self.val_neg, self.test_neg) < 0:
            raise ValueError("sizes can't be negative")


def mapped_pairs(interactions: DataFrame, proteins: DataFrame) -> DataFrame:
    """(ID_1, ID_2, label, PPI_Source) by content hash; rows with an unknown endpoint or another label than 0 or 1 go."""
    md5 = proteins.groupBy("fpid").agg(F.max("protein_md5").alias("md5"))
    label = F.col("label").cast("string").try_cast("double")
    x = interactions.where(label.isin(0.0, 1.0)).select("FPid_1", "FPid_2", label.cast("int").alias("label"), "PPI_Source")
    x = x.join(md5.select(F.col("fpid").alias("FPid_1"), F.col("md5").alias("ID_1")), "FPid_1")
    x = x.join(md5.select(F.col("fpid").alias("FPid_2"), F.col("md5").alias("ID_2")), "FPid_2")
    return x.select(F.least("ID_1", "ID_2").alias("ID_1"), F.greatest("ID_1", "ID_2").alias("ID_2"), "label", "PPI_Source")


def check_user_pairs(pairs: DataFrame, name: str) -> DataFrame:
    """A given part: exact columns, labels 0 or 1, no unordered pair twice."""
    if pairs.columns != ["ID_1", "ID_2", "label"]:
        raise ValueError(f"{name}: columns are {pairs.columns}")
    x = pairs.select(F.least("ID_1", "ID_2").alias("ID_1"), F.greatest("ID_1", "ID_2").alias("ID_2"), F.col("label").cast("int").alias("label"))
    if not x.where("label is null or label not in (0, 1)").isEmpty():
        raise ValueError(f"{name}: labels must be 0 or 1")
    again = [f"{r.ID_1}|{r.ID_2}" for r in x.groupBy("ID_1", "ID_2").count().where("count > 1").orderBy("ID_1", "ID_2").limit(5).collect()]
    if again:
        raise ValueError(f"{name}: duplicate pairs {again}")
    return x


def _some(ids: DataFrame) -> list[str]:
    """Up to five of the ids, in order."""
    return [r.id for r in ids.select("id").distinct().orderBy("id").limit(5).collect()]


def check_content_ids(pairs: DataFrame) -> None:
    """An error if an endpoint is no MD5."""
    if bad := _some(pairs.select(F.explode(F.array("ID_1", "ID_2")).alias("id")).where(~F.col("id").rlike("^[0-9a-f]{32}$"))):
        raise ValueError(f"no content ids: {bad}")


def check_proteins(proteins: DataFrame) -> None:
    """An error if a public id stands twice or a hash isn't its sequence's."""
    if again := [r.fpid for r in proteins.groupBy("fpid").count().where("count > 1").orderBy("fpid").limit(5).collect()]:
        raise ValueError(f"public ids that stand twice: {again}")
    wrong = proteins.where(F.coalesce(F.col("protein_md5") != content_md5(F.col("sequence")), F.lit(True)))
    if some := [r.fpid for r in wrong.orderBy("fpid").limit(5).collect()]:
        raise ValueError(f"hashes that aren't their sequences': {some}")


def _take(rows: DataFrame, n: int, seed: int | str, what: str, priority=None) -> DataFrame:
    out = P.sample_by_priority(rows, n, priority, seed, "ID_1", "ID_2") if priority is not None else P.sample(rows, n, seed, "ID_1", "ID_2")
    if n and out.count() < n:
        raise ValueError(f"fewer than {n} {what}")
    return out


def split(pairs: DataFrame, cluster_map: DataFrame | None, sequences: DataFrame, sizes: Sizes, seed: int, val: DataFrame | None = None, test: DataFrame | None = None, preferred: list[str] | None = None, clusters_at: str | None = None, content_ids: bool = False) -> dict[str, DataFrame]:
    """val, test, train (ID_1, ID_2, label), the flagged cluster map and the used sequences (id, sequence).

    pairs is mapped_pairs(); cluster_map (member, cluster) comes from an alignment tool, or is made by alignment (kept at
    clusters_at, if given, and read from there the next time). With content_ids every held endpoint must be an MD5.
    """
    keys = ["ID_1", "ID_2"]
    given = [check_user_pairs(x, n) if x is not None else None for x, n in ((val, "val"), (test, "test"))]
    if all(x is not None for x in given) and not given[0].join(given[1], keys, "left_semi").isEmpty():
        raise ValueError("val and test share pairs")
    if not any(x is not None for x in given) and not sizes.val_pos + sizes.test_pos:
        raise ValueError("a holdout or sizes to sample are needed")
    parts: dict[str, list[DataFrame]] = {"val": [x for x in given[:1] if x is not None], "test": [x for x in given[1:] if x is not None]}
    sources = F.split("PPI_Source", ";")
    rank = F.when(F.arrays_overlap(sources, F.array(*map(F.lit, preferred))), 0).otherwise(1) if preferred else None
    for label, wanted in ((1, (sizes.val_pos, sizes.test_pos)), (0, (sizes.val_neg, sizes.test_neg))):
        pool = pairs.where(F.col("label") == label)
        for used in (x for group in parts.values() for x in group):
            pool = pool.join(used, keys, "left_anti")
        if sum(wanted):
            top = _take(pool, sum(wanted), f"{seed}:{label}", "positives" if label else "negatives", None if label else rank).select(*keys, "label")
            ranked = splits.sample_holdout(top, keys, *wanted, f"{seed}:{label}:part")
            for name in parts:
                parts[name].append(ranked.where(F.col("part") == name).select(*keys, F.lit(label).alias("label")))
    empty = pairs.select(*keys, "label").limit(0)
    out = {}
    for name, group in parts.items():
        out[name] = empty
        for x in group:
            out[name] = out[name].unionByName(x)
    out |= {name: written(out[name], name) for name in parts}
    holdout = out["val"].unionByName(out["test"])
    ends = written(holdout.where("label = 1").select(F.explode(F.array(*keys)).alias("id")).distinct(), "ends")
    found = cluster_map if cluster_map is not None else G.cluster_for_holdout(sequences, "id", "sequence", ends, kept_at=clusters_at).select(F.col("id").alias("member"), "cluster")
    if content_ids:
        check_content_ids(holdout)
    if not found.isEmpty() and (lost := _some(ends.join(found.select(F.col("member").alias("id")), "id", "left_anti"))):
        raise ValueError(f"no cluster for {lost}")
    out["train"] = splits.training_rows(pairs.select(*keys, "label"), holdout, found, *keys, "label", "member", "cluster").distinct()
    out["train"] = written(out["train"], "train")
    if out["train"].isEmpty():
        raise ValueError("no training pair is left")
    out["clusters"] = splits.cluster_flags(found, ends, "member", "cluster")
    used = holdout.unionByName(out["train"]).select(F.explode(F.array(*keys)).alias("id")).distinct()
    if missing := _some(used.join(sequences, "id", "left_anti")):
        raise ValueError(f"no sequence for {missing}")
    out["sequences"] = sequences.join(used, "id", "left_semi")
    return out
