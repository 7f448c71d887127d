"""The corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.common import materialize, table, table_if_any
from pairloom.llm.decontam import decontaminate
from pairloom.llm.line_dedup import remove_shared_lines
from pairloom.llm.packing import pack
from pairloom.llm.quality import fit_bands, keep_quality
from pairloom.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the rules' limits are fitted to the labels."""
    return keep_quality(docs, fit_bands(docs, table_if_any(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common blocks of lines go from the later document; documents without a word left go."""
    return remove_shared_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: Compression ratios, SimHash and tokenisation can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of sf_dir, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
