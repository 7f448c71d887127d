"""Structure files and manifests: versions, candidates, sources by priority, copies with a status."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.matching import cascade


def file_parts(name: Column) -> Column:
    """(accession, fragment, version) of a predicted structure's file name."""
    part = lambda k: F.nullif(F.regexp_extract(name, r"(?i)AF-([A-Z0-9]+)-F(\d+)-model_v(\d+)", k), F.lit(""))
    return F.struct(F.upper(part(1)).alias("accession"), part(2).cast("int").alias("fragment"), part(3).cast("int").alias("version"))


def preferred_file(files: DataFrame, version: int) -> DataFrame:
    """(accession, name): first fragment of the version, else any fragment of it, else any version; by name among equals."""
    x = files.withColumn("p", file_parts(F.col("name"))).where("p.accession is not null")
    rank = F.when((F.col("p.version") == version) & (F.col("p.fragment") == 1), 0).when(F.col("p.version") == version, 1).otherwise(2)
    return x.groupBy(F.col("p.accession").alias("accession")).agg(F.min(F.struct(rank.alias("r"), "name")).alias("b")).select("accession", "b.name")


def closest_length(candidates: DataFrame, key: str, size: str, wanted: str, *columns: str) -> DataFrame:
    """Each key's candidate whose size is closest to the wanted one, the longer of equals."""
    best = F.min(F.struct(F.abs(F.col(size) - F.col(wanted)).alias("gap"), (-F.col(size)).alias("neg"), *columns)).alias("b")
    return candidates.groupBy(key).agg(best).select(key, (-F.col("b.neg")).alias(size), *(f"b.{c}" for c in columns))


def structure_sources(sequences: DataFrame, local: DataFrame, downloads: DataFrame, models: DataFrame, files: DataFrame) -> DataFrame:
    """(sequence_md5, source): local copy, downloaded (by manifest, else by file), modelled (by manifest, else by file), or pending.

    local, downloads and models are manifests (sequence_md5, status, ...), files lists (sequence_md5, kind) that exist.
    """
    flag = lambda df, name, ok: df.where(F.lower("status").isin(*ok)).select("sequence_md5", F.lit(True).alias(name)).distinct()
    there = lambda kind: files.where(F.col("kind") == kind).select("sequence_md5", F.lit(True).alias(f"file_{kind}")).distinct()
    x = sequences
    for part in (flag(local, "local", ["copied", "exists"]), flag(downloads, "downloaded", ["downloaded", "exists"]), flag(models, "modelled", ["ok", "exists"]), there("download"), there("model"), local.select("sequence_md5", F.lit(True).alias("known")).distinct()):
        x = x.join(part, "sequence_md5", "left")
    c = F.col
    steps = [(c("local"), "local"), (c("downloaded"), "download_manifest"), (c("file_download"), "download_file"), (c("modelled"), "model_manifest"), (c("file_model"), "model_file"), (c("known"), "download_pending")]
    return x.select("sequence_md5", cascade(steps, "model_pending").alias("source"))


def chain_pairs(queries: DataFrame, index: DataFrame) -> DataFrame:
    """Adds the two accessions of a structure's chain pair; trailing digits of chains don't count, nor does the order.

    queries: (pdb, chain_1, chain_2); index: (pdb, chain_R, chain_L, acc_R, acc_L, pos), the first of equals counts. The
    accessions keep the index's orientation.
    """
    letter = lambda c: F.regexp_replace(c, r"\d+$", "")
    key = lambda p, a, b: (F.lower(p).alias("k_pdb"), F.array_sort(F.array(letter(a), letter(b))).alias("k_chains"))
    first = index.select(*key("pdb", "chain_R", "chain_L"), "acc_R", "acc_L", "pos").groupBy("k_pdb", "k_chains").agg(F.min_by(F.struct("acc_R", "acc_L"), "pos").alias("x"))
    keyed = queries.select("*", *key("pdb", "chain_1", "chain_2"))
    return keyed.join(first, ["k_pdb", "k_chains"]).select(*queries.columns, "x.acc_R", "x.acc_L")


def with_files(df: DataFrame, name: str, listing: DataFrame) -> DataFrame:
    """Adds has_file and size by file name, from a listing (name, length)."""
    files = listing.groupBy(F.col("name").alias(name)).agg(F.max("length").alias("size"))
    return df.join(files, name, "left").withColumn("has_file", F.col("size").isNotNull())


def transfer(tasks: DataFrame, fetch: Callable[[str, str], str], dry: bool = False, kind: str = "copy") -> DataFrame:
    """(target, status, error) of tasks (source, target): fetch(source, target) does one and returns its status.

    `copy` tasks end as exists, copied, dry_run, missing_source or copy_error; `download` tasks as exists, downloaded,
    dry_run, missing_source, not_available (fetch raises FileNotFoundError) or download_error. A failed task is a row, not
    an error; dry runs only say what they would do.
    """
    if kind not in ("copy", "download"):
        raise ValueError(f"no kind {kind!r} of transfer")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for source, target in zip(frame["source"], frame["target"], strict=True):
                if source is None:
                    out.append((target, "missing_source", None))
                elif dry:
                    out.append((target, "dry_run", None))
                else:
                    try:
                        out.append((target, fetch(source, target), None))
                    except FileNotFoundError as e:
                        out.append((target, "not_available" if kind == "download" else "copy_error", str(e)))
                    except Exception as e:  # noqa: BLE001 - becomes the row's error
                        out.append((target, f"{kind}_error", str(e)))
            yield pd.DataFrame(out, columns=["target", "status", "error"])

    return tasks.orderBy(F.asc_nulls_last("source")).select("source", "target").mapInPandas(run, "target string, status string, error string")
