"""Queries by alignment. No SQL: tests compare alignments, clusters and hits with full dynamic programming over all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.alignment import cluster_by_alignment, residues_of, search
from pairloom.operators.tables import written
from pairloom.plans.registry import load, query


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as chains of residues, one for each three words by their hash: near copies are related chains."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    x = load(spark, sf_dir, "documents").select("doc_id", words.alias("w"))
    threes = F.transform("w", lambda w, k: F.xxhash64(w, F.get("w", k + 1), F.get("w", k + 2)))
    made = x.select("doc_id", residues_of(F.slice(threes, F.lit(1), F.greatest(F.size("w") - 2, F.lit(0)))).alias("sequence"))
    # Written, as a condition on the chains would else be pushed below and split the text once more for each of its words.
    return written(made, "chains")


@query()
def alignment_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy clusters of all documents' chains: identity 0.4, coverage 0.8 of both."""
    return cluster_by_alignment(chains(spark, sf_dir), "doc_id", "sequence")


@query()
def alignment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stated query set (every fiftieth document) against all: identity 0.6, any coverage."""
    x = chains(spark, sf_dir)
    return search(x.where("doc_id % 50 = 0"), x, "doc_id", "sequence")
