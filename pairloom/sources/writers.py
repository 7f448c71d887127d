"""Sinks: contract tables, FASTA, reports, and swaps of finished folders."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.sequences import wrapped


def write_table(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, key: str | None = None) -> None:
    """Parquet in a fixed column order, ranged by a key if one is given."""
    out = df.select(*columns) if columns else df
    (out.orderBy(key) if key else out).write.mode("overwrite").parquet(path)


def write_delimited(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, separator: str = ",", key: str | None = None, append: bool = False) -> None:
    """CSV or TSV parts with headers; NULL is the empty field, and white space around a field stays."""
    out = df.select(*columns) if columns else df
    out = out.orderBy(key) if key else out
    out.write.mode("append" if append else "overwrite").option("header", True).option("sep", separator).option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_single(df: DataFrame, path: str, key: str, separator: str = ",") -> None:
    """One delimited file with a header, its rows in the order of a key, for tables that people read: a task writes it."""
    folder = f"{path}.{uuid.uuid4().hex}"
    write_delimited(df.orderBy(key).coalesce(1), folder, separator=separator)
    jvm = df.sparkSession.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path
    store = hadoop(path).getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    part = next(str(f.getPath().toString()) for f in store.listStatus(hadoop(folder)) if f.getPath().getName().startswith("part-"))
    store.delete(hadoop(path), False)
    if not store.rename(hadoop(part), hadoop(path)):
        raise OSError(f"{part} can't be renamed to {path}")
    store.delete(hadoop(folder), True)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends rows to a Parquet manifest, but for keys that it has: a step that runs again adds nothing twice."""
    try:
        df = df.join(df.sparkSession.read.parquet(path).select(key), key, "left_anti").select(*df.columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise  # else there is no manifest yet
    df.write.mode("append").parquet(path)


def write_each(df: DataFrame, folder: str, name: Column, content: Column) -> int:
    """A file for each row (text or bytes), written under another name and then renamed; returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        for batch in batches:
            for file, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = f"{top}/.{file}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw.encode() if isinstance(raw, str) else raw)
                store.move(part, f"{top}/{file}")
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)])], names=["n"])

    return df.select(name.alias("name"), content.alias("content")).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def npy_bytes(vector: str) -> Column:
    """A vector as the bytes of a NumPy file of 32-bit numbers."""

    @F.pandas_udf("binary")
    def made(vectors: pd.Series) -> pd.Series:
        def one(v) -> bytes:
            out = io.BytesIO()
            np.save(out, np.asarray(v, np.float32))
            return out.getvalue()

        return vectors.map(one)

    return made(vector)


def rekeyed(table: DataFrame, key: str, ids: DataFrame, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """A table under other ids (rows of `ids` map old to new), and the new ids that the table has nothing for."""
    known = ids.select(F.col(old).alias(key), F.col(new).alias("__new")).distinct()
    moved = table.join(known, key).drop(key).withColumnRenamed("__new", key)
    return moved.select(*table.columns), known.select(F.col("__new").alias(key)).distinct().join(moved.select(key), key, "left_anti")


def fasta_record(header: str | Column, sequence: str | Column, width: int | None = None) -> Column:
    """One record as text, its sequence on one line or wrapped."""
    header, sequence = (F.col(x) if isinstance(x, str) else x for x in (header, sequence))
    return F.concat(F.lit(">"), header, F.lit("\n"), wrapped(sequence, width) if width else sequence)


def write_fasta(df: DataFrame, path: str, header: str, sequence: str, width: int | None = None, append: bool = False) -> None:
    df.orderBy(header).select(fasta_record(header, sequence, width).alias("value")).write.mode("append" if append else "overwrite").text(path)


def move(spark, new: str, path: str) -> None:
    """Puts a finished folder in the place of another, which goes only when the new one is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{path}.{uuid.uuid4().hex}"
    had = store.exists(hadoop(path))
    if had:
        store.rename(hadoop(path), hadoop(old))
    if not store.rename(hadoop(new), hadoop(path)):
        if had:
            store.rename(hadoop(old), hadoop(path))
        raise OSError(f"{new} can't be renamed to {path}")
    if had:
        store.delete(hadoop(old), True)


def replace(df: DataFrame, path: str) -> None:
    """Replaces a Parquet folder that the frame itself may be read from: written beside it, then renamed."""
    new = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(new)
    move(df.sparkSession, new, path)


def report(parts: dict[str, DataFrame | int | str]) -> str:
    """A JSON report of small aggregates."""
    return json.dumps({k: [r.asDict(True) for r in v.collect()] if isinstance(v, DataFrame) else v for k, v in parts.items()}, default=str, ensure_ascii=False, sort_keys=True)
