"""Training collections: their specs, remapping to content ids, checks and embedding coverage."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.sequences import no_space
from pairloom.operators.matching import checked_lookup
from pairloom.operators.tables import written


@dataclass(frozen=True)
class Collection:
    """A named set of pair files and the sequence sources that their ids come from."""

    name: str
    sequence_sources: tuple[str, ...]
    pair_files: dict[str, str]
    primary_test: str


def chosen(specs: list[Collection], names: str) -> list[Collection]:
    """`all`, or a comma-separated subset; an unknown name is an error."""
    known = {s.name: s for s in specs}
    wanted = list(known) if names.strip() == "all" else [x.strip() for x in names.split(",") if x.strip()]
    if unknown := [x for x in wanted if x not in known]:
        raise ValueError(f"no collections {unknown}; there are {list(known)}")
    return [known[x] for x in wanted]


def in_order(files: list[str]) -> list[str]:
    """Pair tables of a folder: train, val, test, then test_*, then the others but for maps and sequences."""
    rank = {"train.csv": 0, "val.csv": 1, "test.csv": 2}
    rest = [f for f in files if f.endswith(".csv") and not re.search(r"(map|sequences)\.csv$", f)]
    return sorted(rest, key=lambda f: (rank.get(f, 3 if f.startswith("test_") else 4), f))


def id_map(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, sequence_md5), an error if an id has two sequences; and the distinct (sequence_md5, sequence)."""
    x = sequences.select("id", no_space(F.col("sequence")).alias("sequence")).where("sequence <> ''").withColumn("sequence_md5", F.md5("sequence"))
    # The map is written: the check and each table's two sides read it, and not the sequences again.
    ids = written(x.select("id", "sequence_md5"), "id-map")
    bad = [r.id for r in ids.groupBy("id").agg(F.count_distinct("sequence_md5").alias("n")).where("n > 1").orderBy("id").limit(5).collect()]
    if bad:
        raise ValueError(f"more than one sequence for {bad}")
    return ids.distinct(), x.groupBy("sequence_md5").agg(F.first("sequence").alias("sequence"))


def remapped(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs by content id, the id columns and the label in front; an endpoint without a sequence is an error."""
    rest = [c for c in pairs.columns if c not in ("ID_1", "ID_2", "label")]
    x = pairs
    for side in ("ID_1", "ID_2"):
        x = checked_lookup(x, side, ids.select(F.col("id").alias(side), F.col("sequence_md5").alias(f"__{side}")), f"__{side}")
    return x.select(F.col("__ID_1").alias("ID_1"), F.col("__ID_2").alias("ID_2"), "label", *rest)


def sequence_violations(sequences: DataFrame) -> DataFrame:
    """(rule, n_bad): ids that are no MD5, repeated, or not the MD5 of their sequence."""
    x = sequences.agg(
        F.count_if(~F.coalesce(F.col("id").rlike("^[0-9a-f]{32}$"), F.lit(False))).alias("id_format"),
        F.count_if(~F.coalesce(F.col("id") == F.md5(no_space(F.col("sequence"))), F.lit(False))).alias("id_of_sequence"),
        (F.count("id") - F.count_distinct("id")).alias("id_unique"),
    )
    return x.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("n_bad")) for n in x.columns))).alias("x")).select("x.rule", "x.n_bad")


def pair_violations(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """(rule, n_bad): endpoint format, endpoints without a sequence, labels."""
    ids = sequences.select(F.col("id").alias("__id"), F.lit(True).alias("__ok")).distinct()
    x = pairs
    for side in ("ID_1", "ID_2"):
        x = x.join(ids.withColumnsRenamed({"__id": side, "__ok": f"__{side}"}), side, "left")
    hexes = F.col("ID_1").rlike("^[0-9a-f]{32}$") & F.col("ID_2").rlike("^[0-9a-f]{32}$")
    y = x.agg(
        F.count_if(~F.coalesce(hexes, F.lit(False))).alias("endpoint_format"),
        F.count_if(F.col("__ID_1").isNull() | F.col("__ID_2").isNull()).alias("endpoint_known"),
        F.count_if(~F.coalesce(F.col("label").cast("string").try_cast("double").isin(0.0, 1.0), F.lit(False))).alias("label_value"),
    )
    return y.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n in y.columns))).alias("x")).select("x.rule", "x.n_bad")


def embedding_coverage(sequences: DataFrame, vectors: dict[str, DataFrame], require: list[str]) -> dict[str, tuple[int, int]]:
    """Present and missing ids by model; required models with gaps are reported together as one error."""
    out = {}
    for model, v in vectors.items():
        x = sequences.select("id").distinct().join(v.select("id", F.lit(True).alias("has")).distinct(), "id", "left").agg(F.count_if("has").alias("n"), F.count("*").alias("all")).first()
        out[model] = (x.n, x.all - x.n)
    if gaps := [f"{m}: {out[m][1] if m in out else 'all'} missing" for m in require if m not in out or out[m][1]]:
        raise ValueError("; ".join(gaps))
    return out


def all_sequences(merged: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """(id, sequence) of the merged table and of another, the first sequence of each id; an error if an id has two."""
    x = merged.select("id", "sequence")
    x = x.unionByName(external.select("id", "sequence")) if external is not None else x
    counted = x.groupBy("id").agg(F.min("sequence").alias("sequence"), F.count_distinct(F.md5("sequence")).alias("n"))
    if bad := [r.id for r in counted.where("n > 1").orderBy("id").limit(5).collect()]:
        raise ValueError(f"more than one sequence for {bad}")
    return counted.select("id", "sequence")


def built(spec: Collection, sequences: dict[str, DataFrame], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A collection's tables by name: its pairs by content id, the primary test again as `test`, the id map and the sequences.

    sequences are tables (id, sequence) by source name, tables are pairs (ID_1, ID_2, label, ...) by the spec's names.
    """
    if missing := sorted(set(spec.sequence_sources) - set(sequences)) + sorted(set(spec.pair_files) - set(tables)):
        raise ValueError(f"{spec.name}: no tables {missing}")
    if spec.primary_test not in spec.pair_files:
        raise ValueError(f"{spec.name}: {spec.primary_test!r} is none of its tables")
    every = None
    for name in spec.sequence_sources:
        every = sequences[name].select("id", "sequence") if every is None else every.unionByName(sequences[name].select("id", "sequence"))
    ids, unique = id_map(every)
    out = {name: remapped(tables[name], ids) for name in spec.pair_files}
    return out | {"test": out[spec.primary_test], "id_map": ids, "sequences": unique.select(F.col("sequence_md5").alias("id"), "sequence")}


def kept_vectors(roots: dict[str, tuple[str, ...]], model: str, listing: DataFrame) -> DataFrame:
    """(name, path) of a model's vectors in folders of earlier runs: of a name in several folders that of the first."""
    order = F.coalesce(*(F.when(F.col("path").contains(f"{folder.rstrip('/')}/"), F.lit(k)) for k, folder in enumerate(roots[model])))
    return listing.withColumn("__at", order).where("__at is not null").groupBy("name").agg(F.min_by("path", "__at").alias("path"))


def missing_vectors(sequences: DataFrame, vectors: dict[str, DataFrame]) -> DataFrame:
    """(model, id, sequence) of the sequences that a model has no vector for."""
    out = None
    for model, v in vectors.items():
        x = sequences.join(v.select("id").distinct(), "id", "left_anti").select(F.lit(model).alias("model"), "id", "sequence")
        out = x if out is None else out.unionByName(x)
    return out
