"""The merged tables' contract: each rule is a query for its violations; row rules of a table take one pass together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.evidence import EVIDENCE_TAGS, EVIDENCE_TYPES, TIER_NAMES
from pairloom.functions.sequences import content_md5, tokens

#: Column orders of the tables (fixed values of the contract).
PROTEINS = ("protein_md5", "fpid", "sequence", "length", "hydrophobicity", "is_canonical", "original_ids")
SEQUENCES = ("id", "sequence")
INTERACTIONS = ("FPid_1", "FPid_2", "original_id1", "original_id2", "PPI_Source", "Seq_Source", "label", "Experimental_Method", "Evidence_Type", "Evidence_Tags", "PPI_Tier", "PPI_Tier_ZH", "n_sources")
PAIRS = ("fpid_1", "fpid_2", "label")
PUBLIC_ID, MD5, RESIDUES = "^FP[0-9]{7}$", "^[0-9a-f]{32}$", "^[A-Z]+$"


class ContractError(ValueError):
    """A table breaks its contract."""


def number(text: Column) -> Column:
    """The number in a text, NULL if there is none."""
    return text.try_cast("double")


def _bad(good: Column) -> Column:
    """NULL never satisfies a rule."""
    return ~F.coalesce(good, F.lit(False))


def protein_rules() -> dict[str, Column]:
    c = F.col
    return {
        "fpid_format": _bad(c("fpid").rlike(PUBLIC_ID)),
        "md5_format": _bad(c("protein_md5").rlike(MD5)),
        "sequence_letters": _bad(c("sequence").rlike(RESIDUES)),
        "md5_of_sequence": _bad(c("protein_md5") == content_md5(c("sequence"))),
        "length_of_sequence": _bad(number(c("length").cast("string")) == F.length("sequence")),
        "hydrophobicity_number": c("hydrophobicity").isNotNull() & (c("hydrophobicity").cast("string") != "") & number(c("hydrophobicity").cast("string")).isNull(),
        "is_canonical_text": _bad(c("is_canonical").cast("string").isin("True", "False")),
        "original_ids_empty": _bad(F.length("original_ids") > 0),
    }


def interaction_rules(sources: list[str]) -> dict[str, Column]:
    """Rules of a row; sources are the tags that PPI_Source may have."""
    c = F.col
    labels = number(c("label").cast("string"))
    tier_name = F.create_map(*(F.lit(x) for pair in TIER_NAMES.items() for x in pair))
    rules = {
        "endpoint_format": _bad(c("FPid_1").rlike(PUBLIC_ID) & c("FPid_2").rlike(PUBLIC_ID)),
        "endpoint_order": _bad(c("FPid_1") < c("FPid_2")),
        "label_value": _bad(labels.isin(0.0, 1.0)),
        "n_sources_count": _bad((number(c("n_sources").cast("string")) >= 1) & (number(c("n_sources").cast("string")) == F.size(tokens(c("PPI_Source"))))),
        "evidence_type_enum": _bad(c("Evidence_Type").isin(*EVIDENCE_TYPES)),
        "tier_enum": _bad(c("PPI_Tier").isin(*TIER_NAMES)),
        "tier_name": _bad(c("PPI_Tier_ZH") == tier_name[c("PPI_Tier")]),
        "evidence_tags_enum": F.size(F.array_except(tokens(c("Evidence_Tags")), F.array(*map(F.lit, EVIDENCE_TAGS)))) > 0,
        "negative_class": F.coalesce(labels == 0, F.lit(False)) & _bad((c("Evidence_Type") == "negative_synthetic") & (c("PPI_Tier") == "negative_synthetic")),
    }
    rules["source_enum"] = F.size(F.array_except(tokens(c("PPI_Source")), F.array(*map(F.lit, sources)).cast("array<string>"))) > 0
    return rules


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n_bad) for all row rules, in one pass over the table."""
    counted = df.agg(*(F.count_if(bad).alias(name) for name, bad in rules.items()))
    return counted.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n in rules))).alias("x")).select("x.rule", "x.n_bad")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent: str) -> DataFrame:
    """Key values without a parent row, with the number of rows that have them."""
    ids = parents.select(F.col(parent).alias(key)).distinct()
    return df.groupBy(key).agg(F.count("*").alias("n")).join(ids, key, "left_anti")


def not_contiguous(df: DataFrame, number_of: Column) -> DataFrame:
    """One row if the numbers aren't 1 to n, each once."""
    x = df.select(number_of.alias("n")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("rows"), F.count_distinct("n").alias("distinct"))
    return x.where(_bad((F.col("low") == 1) & (F.col("high") == F.col("rows")) & (F.col("distinct") == F.col("rows"))))


def unequal_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with the side."""
    only = lambda x, y, name: x.exceptAll(y).withColumn("side", F.lit(name))
    return only(left, right, "left").unionAll(only(right, left, "right"))


def out_of_order(df: DataFrame, number_of: Column, pos: str) -> DataFrame:
    """Rows whose number isn't their place, counted from 1; pos is the row's position in the file, from 0 and without gaps."""
    return df.select(pos, number_of.alias("number")).where(_bad(F.col("number") == F.col(pos) + 1))


def unequal_places(left: DataFrame, right: DataFrame, pos: str) -> DataFrame:
    """Positions at which two projections of tables in one order differ, or that only one has."""
    names = [c for c in left.columns if c != pos]
    x = left.select(pos, F.struct(*names).alias("__l")).join(right.select(pos, F.struct(*names).alias("__r")), pos, "full")
    return x.where(~F.col("__l").eqNullSafe(F.col("__r"))).select(pos)


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(name, rows, sha256) of delimited files under a path: lines without the header, and the checksum of the bytes.

    Each file is read by one task as it is (under 2 GB); what is larger is checked as a table.
    """
    x = spark.read.format("binaryFile").load(path)
    lines = F.length(F.decode("content", "ISO-8859-1")) - F.length(F.replace(F.decode("content", "ISO-8859-1"), F.lit("\n"), F.lit("")))
    return x.select(F.element_at(F.split("path", "/"), -1).alias("name"), (lines - 1).cast("long").alias("rows"), F.sha2("content", 256).alias("sha256"))


def check_snapshot(facts: DataFrame, expected: dict[str, tuple[int, str]]) -> None:
    """Compares the files' rows and checksums with those of a snapshot; every difference is in the error."""
    found = {x.name: (x.rows, x.sha256) for x in facts.where(F.col("name").isin(*expected)).collect()}
    wrong = []
    for name, (rows, digest) in sorted(expected.items()):
        if name not in found:
            wrong.append(f"{name} is missing")
        elif found[name][0] != rows:
            wrong.append(f"{name}: {found[name][0]} rows, not {rows}")
        elif found[name][1] != digest:
            wrong.append(f"{name}: the checksum is {found[name][1]}, not {digest}")
    if wrong:
        raise ContractError("; ".join(wrong))


def check_header(df: DataFrame, columns: tuple[str, ...], name: str) -> None:
    if tuple(df.columns) != columns:
        raise ContractError(f"{name}: columns are {df.columns}, not {list(columns)}")


def validate(proteins: DataFrame, sequences: DataFrame, interactions: DataFrame, pairs: DataFrame, sources: list[str], quick: bool = False, pos: str | None = None) -> dict[str, int]:
    """Checks all tables; raises ContractError with every broken rule and its number of violations, else returns row counts.

    With `pos`, the rows' position in their files, numbers and projections are also checked in row order.
    """
    tables = {n: df.drop(pos) if pos else df for n, df in (("proteins", proteins), ("sequences", sequences), ("interactions", interactions), ("pairs", pairs))}
    for (name, df), columns in zip(tables.items(), (PROTEINS, SEQUENCES, INTERACTIONS, PAIRS), strict=True):
        check_header(df, columns, name)
    if quick:
        return {}
    bad = {x.rule: x.n_bad for x in count_violations(proteins, protein_rules()).unionAll(count_violations(interactions, interaction_rules(sources))).collect() if x.n_bad}
    for key in ("fpid", "protein_md5", "sequence"):
        bad[f"{key}_unique"] = duplicates(proteins, key).count()
    number = F.substring("fpid", 3, 20).try_cast("long")
    bad["fpid_contiguous"] = not_contiguous(proteins, number).count()
    bad["pair_unique"] = duplicates(interactions.select(F.least("FPid_1", "FPid_2").alias("a"), F.greatest("FPid_1", "FPid_2").alias("b")), "a", "b").count()
    as_sequences = proteins.select(F.col("fpid").alias("id"), "sequence", *([pos] if pos else []))
    as_pairs = interactions.select(F.col("FPid_1").alias("fpid_1"), F.col("FPid_2").alias("fpid_2"), "label", *([pos] if pos else []))
    bad["sequences_projection"] = (unequal_places(sequences, as_sequences, pos) if pos else unequal_rows(sequences, as_sequences)).count()
    bad["pairs_projection"] = (unequal_places(pairs, as_pairs, pos) if pos else unequal_rows(pairs, as_pairs)).count()
    if pos:
        bad["fpid_order"] = out_of_order(proteins, number, pos).count()
    for side in ("FPid_1", "FPid_2"):
        bad[f"{side}_known"] = orphans(interactions, side, proteins, "fpid").count()
    counts = {"proteins": proteins.count(), "interactions": interactions.count()}
    bad |= {f"{k}_empty": 1 for k, n in counts.items() if not n}
    if broken := {k: n for k, n in bad.items() if n}:
        raise ContractError("; ".join(f"{k}: {n}" for k, n in sorted(broken.items())))
    return counts | {"positives": interactions.where(F.col("label").cast("string").try_cast("double") == 1).count()}
