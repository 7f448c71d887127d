"""Host and pathogen pairs: one directed schema for all sources, sequence tables, benchmark subsets, training remainder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import names as T
from pairloom.functions import sequences as S
from pairloom.operators.entities import dense_numbers, first_per_key
from pairloom.operators.pairs import joined_distinct

#: Columns of the standardised pairs, and those of the light index (fixed values).
PAIRS = ("record_uid", "dataset", "source_table", "split", "source_database", "confidence", "label", "host_taxon", "pathogen_taxon", "host_id", "pathogen_id", "host_sequence", "pathogen_sequence", "host_len", "pathogen_len", "pathogen_family", "original_pair_id")
LONG = ("host_sequence", "pathogen_sequence")
#: Where a raw table has its pair's id and its label, in this order (fixed values).
ID_COLUMNS, LABEL_COLUMNS = ["id", "pair_key", "interaction_id", "ID"], ["label", "REG_LABEL"]


def sequence(s: Column) -> Column:
    """White space and closing stops off, upper case, blank to NULL."""
    return S.no_space_no_stop(s)


def standard(df: DataFrame, path: Column, host: tuple[str, str], pathogen: tuple[str, str], order: list[str], prefix: Column, kind: str, split: Column | None = None) -> DataFrame:
    """A source's rows in the standard columns; host and pathogen are (id column, sequence column).

    `kind` is `raw` (every row is evidence: label 1, confidence and database by the file's name where no column has them)
    or `split` (labels as given). Rows are numbered in the given order, which no two rows share.
    """
    null = F.lit(None).cast("string")
    raw = kind == "raw"
    joined = F.concat_ws("_", F.col(host[0]).cast("string"), F.col(pathogen[0]).cast("string"))
    numbered = dense_numbers(df, *order)
    x = numbered.select(
        F.concat(prefix, F.lit(":"), F.col("number").cast("string")).alias("record_uid"),
        F.lit("virus-host").alias("dataset"),
        path.alias("source_table"),
        (F.lit("raw") if raw else split if split is not None else T.split_of(path)).alias("split"),
        T.clean_text(T.first_column(df, ["Source Database", "source"], F.upper(T.source_of(path)))).alias("source_database"),
        T.clean_text(T.first_column(df, ["confidence"], T.confidence_of(path) if raw else null)).alias("confidence"),
        (F.lit(1) if raw else T.first_column(df, LABEL_COLUMNS, F.lit(1)).cast("int")).alias("label"),
        F.lit("Homo sapiens").alias("host_taxon"),
        F.lit("virus").alias("pathogen_taxon"),
        T.clean_text(F.col(host[0])).alias("host_id"),
        T.clean_text(F.col(pathogen[0])).alias("pathogen_id"),
        sequence(F.col(host[1])).alias("host_sequence"),
        sequence(F.col(pathogen[1])).alias("pathogen_sequence"),
        T.clean_text(T.first_column(df, ["family"], null)).alias("pathogen_family"),
        T.clean_text(T.first_column(df, ID_COLUMNS, joined if raw else null)).alias("original_pair_id"),
    )
    return x.withColumns({"host_len": F.length("host_sequence"), "pathogen_len": F.length("pathogen_sequence")}).select(*PAIRS)


def corpus(parts: list[DataFrame]) -> dict[str, DataFrame]:
    """pairs (with presence flags), with_sequences, index (no sequences), sequences and the summary's counts."""
    pairs = reduce(DataFrame.unionByName, parts).select(*PAIRS, *(F.col(f"{s}_sequence").isNotNull().alias(f"has_{s}_sequence") for s in ("host", "pathogen")))
    full = pairs.where("has_host_sequence and has_pathogen_sequence")
    return {"pairs": pairs, "with_sequences": full, "index": pairs.drop(*LONG), "sequences": role_sequences(full), "summary": summary(pairs)}


def sides(pairs: DataFrame) -> DataFrame:
    """(role, protein_id, sequence, dataset): a row for each side that has both."""
    both = F.array(*(F.struct(F.lit(s).alias("role"), F.col(f"{s}_id").alias("protein_id"), F.col(f"{s}_sequence").alias("sequence"), "dataset") for s in ("host", "pathogen")))
    return pairs.select(F.explode(both).alias("x")).select("x.*").where("protein_id is not null and sequence is not null")


def role_sequences(pairs: DataFrame) -> DataFrame:
    """(role, protein_id, sequence_md5, length, datasets, sequence): grouped by hash, so no text is a key of the shuffle."""
    x = sides(pairs).withColumn("sequence_md5", F.md5("sequence"))
    y = x.groupBy("role", "protein_id", "sequence_md5").agg(joined_distinct(F.col("dataset")).alias("datasets"), F.min("sequence").alias("sequence"))
    return y.select("role", "protein_id", "sequence_md5", F.length("sequence").alias("length"), "datasets", "sequence")


def summary(pairs: DataFrame) -> DataFrame:
    """Rows, rows with both sequences, rows that lack one, and distinct ids, in one pass."""
    miss = lambda s: F.count_if(~F.col(f"has_{s}_sequence")).alias(f"rows_missing_{s}_sequence")
    return pairs.agg(F.count("*").alias("rows_total"), F.count_if(F.col("has_host_sequence") & F.col("has_pathogen_sequence")).alias("rows_with_sequences"), miss("host"), miss("pathogen"), F.count_distinct("host_id").alias("unique_host_ids"), F.count_distinct("pathogen_id").alias("unique_pathogen_ids"))


def hashed_pairs(pairs: DataFrame, order: str = "record_uid") -> DataFrame:
    """Pairs by content id, directed: no self pairs, of equal pairs with one label the first."""
    x = pairs.select(S.short_id(F.col("host_sequence")).alias("ID_1"), S.short_id(F.col("pathogen_sequence")).alias("ID_2"), "label", "dataset", "split", "source_database", "host_id", "pathogen_id", "original_pair_id", F.col(order).alias("__order"))
    return first_per_key(x.where("ID_1 <> ID_2"), ["ID_1", "ID_2", "label"], "__order").drop("__order")


def hashed_sequences(pairs: DataFrame) -> DataFrame:
    """(id, sequence, sequence_md5, roles, original_ids, datasets) of all sides."""
    x = sides(pairs).withColumn("sequence", S.stripped_upper(F.col("sequence"))).withColumn("sequence_md5", F.md5("sequence"))
    names = {"roles": "role", "original_ids": "protein_id", "datasets": "dataset"}
    y = x.groupBy("sequence_md5").agg(F.min("sequence").alias("sequence"), *(joined_distinct(F.col(c)).alias(n) for n, c in names.items()))
    return y.select(S.short_id(F.col("sequence")).alias("id"), "sequence", "sequence_md5", *names)


def only(pairs: DataFrame, allowed: list[tuple[str, str]]) -> DataFrame:
    """Rows whose dataset and split are among the listed ones."""
    return pairs.where(F.struct("dataset", "split").isin(*(F.struct(F.lit(d), F.lit(s)) for d, s in allowed)))


def subset_counts(pairs: DataFrame) -> DataFrame:
    """(dataset, split, rows, positives, negatives, unique_proteins) of hashed pairs: one pass for all subsets."""
    counted = pairs.groupBy("dataset", "split").agg(F.count("*").alias("rows"), F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))
    ends = pairs.select("dataset", "split", F.explode(F.array("ID_1", "ID_2")).alias("id")).groupBy("dataset", "split").agg(F.count_distinct("id").alias("unique_proteins"))
    return counted.join(ends, ["dataset", "split"])


def training_remainder(candidates: DataFrame, holdouts: DataFrame, homologous: DataFrame) -> DataFrame:
    """Candidate pairs that are no holdout pair, whose pathogen no holdout has and none is alike (first column of homologous)."""
    key = homologous.columns[0]
    x = candidates.join(holdouts.select("ID_1", "ID_2").distinct(), ["ID_1", "ID_2"], "left_anti")
    for bad in (holdouts.select("ID_2").distinct(), homologous.select(F.col(key).alias("ID_2")).distinct()):
        x = x.join(bad, "ID_2", "left_anti")
    return x
