"""Readers of the formats that the tables come in; all schemas are explicit and all text stays text."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import sequences as S
from pairloom.sources.remote import fetch_missing  # noqa: F401 - one of the readers

#: Names that a pair's columns may have, tried in this order (fixed values).
PAIR_NAMES = (("ID_1", "ID_2"), ("fpid_1", "fpid_2"), ("FPid_1", "FPid_2"), ("id_1", "id_2"))


def header_of(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """Column names of a delimited file, trimmed."""
    return [c.strip() for c in spark.read.option("header", True).option("sep", separator).csv(path).columns]


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None, separator: str | None = None, header: bool = True) -> DataFrame:
    """All columns as text; only the empty field is NULL, so that texts like NA stay. .csv means comma, anything else tab."""
    sep = separator or ("," if path.endswith((".csv", ".csv.gz")) else "\t")
    names = columns if not header else header_of(spark, path, sep)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = spark.read.schema(schema).option("header", header).option("sep", sep).option("nullValue", "").option("enforceSchema", True).csv(path)
    return df.select(*columns) if columns and header else df


def read_table(spark: SparkSession, path: str, columns: list[str], separator: str = "\t") -> DataFrame:
    """A delimited file of known columns whose header may be missing: if the first line isn't it, the line is data."""
    return read_delimited(spark, path, columns, separator, header=header_of(spark, path, separator) == columns)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(pos, vector) of NumPy files (.npy, two dimensions, under 2 GB each): a row for each of the matrix, in file order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                matrix = np.load(io.BytesIO(raw), allow_pickle=False)
                if matrix.ndim != 2:
                    raise ValueError(f"a matrix has two dimensions, not {matrix.ndim}")
                for k in range(0, len(matrix), 10_000):
                    part = matrix[k : k + 10_000].astype(np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, k + len(part))), pa.array(list(part), pa.list_(pa.float32()))], names=["pos", "vector"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "pos long, vector array<float>")


def read_structure_letters(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence) of a FASTA file of structure letters: lower case, no white space; of repeated ids the last."""
    return fasta_map(read_fasta(spark, path, lambda s: F.lower(S.no_space(s))))


def landed(spark: SparkSession, source: str, path: str, *columns: str) -> DataFrame:
    """A remote Parquet table, copied once to `path` and read from there ever after."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        read_parquet(spark, source, *columns).write.parquet(path)
        return spark.read.parquet(path)


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_pair_text(spark: SparkSession, path: str, label: int) -> DataFrame:
    """(id_1, id_2, label) from lines of at least two fields between white space."""
    cut = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select(cut.alias("x")).where(F.size("x") >= 2).select(F.col("x")[0].alias("id_1"), F.col("x")[1].alias("id_2"), F.lit(label).alias("label"))


def read_pair_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(id_1, id_2, label) from tab-separated lines; a third field of 0 or 1 is the label, else it is 1."""
    x = spark.read.text(path).select(F.split("value", "\t").alias("x")).where(F.size("x") >= 2)
    third = F.try_element_at("x", F.lit(3))
    return x.select(F.trim(F.col("x")[0]).alias("id_1"), F.trim(F.col("x")[1]).alias("id_2"), F.when(third.isin("0", "1"), third.cast("int")).otherwise(1).alias("label"))


def place() -> Column:
    """Where a row of a file source stands: files by name, their blocks in order, however they are spread over tasks."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(member, cluster) from lines of representative and member; a member's first line counts."""
    x = spark.read.text(path).select(F.split("value", "\t").alias("x"), place().alias("place")).where(F.size("x") >= 2)
    return x.groupBy(F.col("x")[1].alias("member")).agg(F.min_by(F.col("x")[0], "place").alias("cluster"))


def read_fasta(spark: SparkSession, path: str, normal=S.letters_only) -> DataFrame:
    """(pos, header, sequence, place): a record of any length to a row; .gz is understood, and the header has no >.

    Files that aren't compressed are split between tasks at records. `pos` tells rows apart, `place` has their order.
    """
    x = spark.read.option("lineSep", "\n>").text(path).select(F.monotonically_increasing_id().alias("pos"), place().alias("place"), F.regexp_replace("value", "^>", "").alias("value"))
    head = F.substring_index("value", "\n", 1)
    body = F.when(F.instr("value", "\n") > 0, F.expr("substr(value, instr(value, '\n') + 1)")).otherwise("")
    return x.where(F.trim("value") != "").select("pos", F.trim(F.regexp_replace(head, "\r", "")).alias("header"), normal(body).alias("sequence"), "place")


def fasta_id(header: Column) -> Column:
    """Second token between bars if there are three or more, else the first word."""
    parts = F.split(header, r"\|")
    return F.when(F.size(parts) >= 3, parts[1]).otherwise(F.split(header, r"\s+")[0])


def fasta_map(records: DataFrame, last: bool = True) -> DataFrame:
    """(id, sequence): of repeated ids the last record (or the first)."""
    pick = F.max_by if last else F.min_by
    return records.groupBy(fasta_id(F.col("header")).alias("id")).agg(pick("sequence", "place").alias("sequence"))


def resolve(columns: list[str], wanted: str, position: int | None = None) -> str:
    """A column by name without regard to case, else by position."""
    found = next((c for c in columns if c.strip().lower() == wanted.lower()), None)
    if found is None and position is None:
        raise ValueError(f"no column {wanted!r} in {columns}")
    return found if found is not None else columns[position]


def pair_columns(df: DataFrame) -> DataFrame:
    """Renames a pair's columns to ID_1 and ID_2, by the known names in order; label is 1 where missing."""
    names = next((p for p in PAIR_NAMES if set(p) <= set(df.columns)), None)
    if names is None:
        raise ValueError(f"no pair columns in {df.columns}")
    out = df.withColumnsRenamed({names[0]: "ID_1", names[1]: "ID_2"})
    out = out.withColumn("label", F.coalesce(F.col("label").cast("int"), F.lit(1)) if "label" in out.columns else F.lit(1))
    return out.select("ID_1", "ID_2", "label", *(c for c in out.columns if c not in ("ID_1", "ID_2", "label")))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence) from FASTA, a table with id and sequence, a table of pairs with sequences, or any first two columns."""
    if path.removesuffix(".gz").endswith((".fasta", ".fa", ".faa", ".fna")):
        return fasta_map(read_fasta(spark, path))
    df = read_delimited(spark, path)
    low = {c.lower(): c for c in df.columns}
    if {"id", "sequence"} <= set(low):
        return df.select(F.col(low["id"]).alias("id"), F.col(low["sequence"]).alias("sequence"))
    if {"id_1", "sequence_1", "id_2", "sequence_2"} <= set(low):
        sides = [F.struct(F.col(low[f"id_{k}"]).alias("id"), F.col(low[f"sequence_{k}"]).alias("sequence")) for k in (1, 2)]
        return df.select(F.explode(F.array(*sides)).alias("x")).select("x.id", "x.sequence")
    return df.select(F.col(df.columns[0]).alias("id"), F.col(df.columns[1]).alias("sequence"))


def sequence_source(df: DataFrame, name: str, normal=S.no_space) -> DataFrame:
    """(id, sequence, sequence_md5, source) of rows that have both; the sequence normalised."""
    clean = df.dropna(subset=["id", "sequence"]).withColumn("sequence", normal(F.col("sequence"))).where("sequence <> '' and id <> ''")
    return clean.select("id", "sequence", F.md5("sequence").alias("sequence_md5"), F.lit(name).alias("source"))


def read_json_folds(spark: SparkSession, path: str) -> DataFrame:
    """(fold, item) of a JSON file whose `folds` maps names to lists."""
    x = spark.read.text(path, wholetext=True).select(F.from_json("value", "folds map<string, array<string>>").alias("x"))
    return x.select(F.explode("x.folds").alias("fold", "items")).select("fold", F.explode("items").alias("item"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, stem, length) of the files below a folder; contents aren't read."""
    x = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return x.select("path", name.alias("name"), S.structure_stem(name).alias("stem"), "length")


#: Three-letter residue names (fixed values).
RESIDUES = {"ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I", "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V"}


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """(path, chain, sequence) of PDB files: first model, standard residues, one letter each, in the order of the file."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.split("value", "\n").alias("lines"))
    stop = F.array_position(F.transform("lines", lambda x: F.substring(x, 1, 6)), "ENDMDL")
    first = F.when(stop > 0, F.slice("lines", 1, stop)).otherwise(F.col("lines"))
    atoms = lines.select("path", F.posexplode(first).alias("pos", "line")).where("substr(line, 1, 4) = 'ATOM'")
    letter = F.create_map(*(F.lit(x) for pair in RESIDUES.items() for x in pair))
    named = atoms.select("path", "pos", F.substring("line", 22, 1).alias("chain"), F.substring("line", 23, 5).alias("number"), letter[F.substring("line", 18, 3)].alias("residue")).where("residue is not null")
    residues = named.groupBy("path", "chain", "number").agg(F.min("pos").alias("pos"), F.min_by("residue", "pos").alias("residue"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "residue")))
    return residues.groupBy("path", "chain").agg(F.array_join(F.transform(ordered, lambda x: x["residue"]), "").alias("sequence"))
