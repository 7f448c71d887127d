"""Registration of queries with their SQL twins, and the stand-in views of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.evidence import EVIDENCE_TAGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) under its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as pairs from several sources: two endpoints, a label, a source and evidence tokens."""
    token = lambda c, names: F.expr("case " + " ".join(f"when {c} = '{k}' then '{v}'" for k, v in names.items()) + " end")
    return load(spark, sf_dir, "lineitem").select(
        F.format_string("FP%07d", "l_partkey").alias("a"),
        F.format_string("FP%07d", "l_suppkey").alias("b"),
        (F.col("l_discount") >= 0.05).cast("int").alias("label"),
        F.concat(F.lit("S"), F.col("l_linenumber")).alias("source"),
        F.concat_ws(";", token("l_returnflag", {"A": "HTP", "N": "LTP", "R": "no_exp"}), token("l_linestatus", {"O": "mixed", "F": "complex_curation"})).alias("evidence"),
        F.col("l_orderkey").alias("row"),
        F.col("l_linenumber").alias("line"),
    )


#: What `source` and `evidence` of that view are made of.
SOURCES = [f"S{k}" for k in range(1, 8)]
TAG_NAMES = list(EVIDENCE_TAGS)


#: The same view for DuckDB.
RAW_PAIRS = """raw as (
  select printf('FP%07d', l_partkey) as a, printf('FP%07d', l_suppkey) as b, (l_discount >= 0.05)::int as label, 'S' || l_linenumber as source,
    (case l_returnflag when 'A' then 'HTP' when 'N' then 'LTP' when 'R' then 'no_exp' end) || ';' || (case l_linestatus when 'O' then 'mixed' when 'F' then 'complex_curation' end) as evidence,
    l_orderkey as row, l_linenumber as line from lineitem
), canon as (select least(a, b) as a, greatest(a, b) as b, label, source, evidence, row, line from raw)"""

TAGS = "array_to_string(list_sort(list_distinct(flatten(list(string_split(evidence, ';'))))), ';')"
CLASS = """case when label = 0 then 'negative_synthetic' when list_contains(string_split(evidence_tags, ';'), 'structural') then 'structural'
  when list_contains(string_split(evidence_tags, ';'), 'HTP') and list_contains(string_split(evidence_tags, ';'), 'LTP') then 'HTP_LTP'
  when list_contains(string_split(evidence_tags, ';'), 'LTP') then 'LTP' when list_contains(string_split(evidence_tags, ';'), 'complex_curation') then 'complex_curation'
  when list_contains(string_split(evidence_tags, ';'), 'HTP') then 'HTP' when list_contains(string_split(evidence_tags, ';'), 'mixed') then 'mixed'
  when list_contains(string_split(evidence_tags, ';'), 'no_exp') then 'no_exp' when list_contains(string_split(evidence_tags, ';'), 'negative_synthetic') then 'negative_synthetic' else 'unknown' end"""
TIER = """case when label = 0 or evidence_type = 'negative_synthetic' then 'negative_synthetic' when evidence_type = 'structural' then 'diamond'
  when evidence_type in ('LTP', 'HTP_LTP') then case when n_sources >= 2 then 'diamond' else 'gold' end
  when evidence_type = 'HTP' then case when n_sources >= 2 then 'gold' else 'silver' end
  when evidence_type = 'mixed' then case when n_sources >= 3 then 'gold' when n_sources >= 2 then 'silver' else 'bronze' end
  when evidence_type = 'complex_curation' then case when n_sources >= 2 then 'silver' else 'bronze' end else 'bronze' end"""
