"""Structures, collections, archives and the command line."""

import hashlib
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from pairloom import __main__ as cli
from pairloom.operators import structures
from pairloom.plans import collections as C
from pairloom.sources import archives

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()


def test_preferred_file(spark):
    names = ["AF-P1-F2-model_v4.pdb", "AF-P1-F1-model_v4.pdb", "AF-P2-F3-model_v4.cif", "AF-P2-F1-model_v3.pdb", "AF-P3-F1-model_v2.pdb", "other.pdb"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert dict(map(tuple, structures.preferred_file(df, 4).collect())) == {"P1": names[1], "P2": names[2], "P3": names[4]}


def test_transfer_statuses(spark):
    def fetch(source, target):
        if source == "bad":
            raise OSError("no")
        return "copied"

    df = spark.createDataFrame([("a", "x"), (None, "y"), ("bad", "z")], "source string, target string")
    assert {r.target: (r.status, r.error) for r in structures.transfer(df, fetch).collect()} == {"x": ("copied", None), "y": ("missing_source", None), "z": ("copy_error", "no")}
    assert {r.status for r in structures.transfer(df, fetch, dry=True).collect()} == {"dry_run", "missing_source"}


def test_collections(spark):
    specs = [C.Collection("a", (), {}, "test"), C.Collection("b", (), {}, "test")]
    assert [s.name for s in C.chosen(specs, "all")] == ["a", "b"] and [s.name for s in C.chosen(specs, "b,")] == ["b"]
    with pytest.raises(ValueError, match="no collections"):
        C.chosen(specs, "c")
    assert C.in_order(["z.csv", "test_2.csv", "val.csv", "id_map.csv", "train.csv", "test.csv", "x.txt", "sequences.csv"]) == ["train.csv", "val.csv", "test.csv", "test_2.csv", "z.csv"]
    ids, unique = C.id_map(spark.createDataFrame([("p", "mk"), ("q", "M K"), ("p", "MK")], "id string, sequence string"))
    assert {r.id: r.sequence_md5 for r in ids.collect()} == {"p": md5("MK"), "q": md5("MK")} and unique.count() == 1
    pairs = spark.createDataFrame([("x", "q", "p", 1)], "extra string, ID_1 string, ID_2 string, label int")
    got = C.remapped(pairs, ids)
    assert got.columns == ["ID_1", "ID_2", "label", "extra"] and tuple(got.first()) == (md5("MK"), md5("MK"), 1, "x")
    with pytest.raises(ValueError, match="no match"):
        C.remapped(pairs.withColumn("ID_1", F.lit("gone")), ids)
    with pytest.raises(ValueError, match="more than one"):
        C.id_map(spark.createDataFrame([("p", "MK"), ("p", "ML")], "id string, sequence string"))
    have = spark.createDataFrame([("p",)], "id string")
    assert C.embedding_coverage(ids, {"m": have}, []) == {"m": (1, 1)}
    with pytest.raises(ValueError, match="m: 1 missing; n: all missing"):
        C.embedding_coverage(ids, {"m": have}, ["m", "n"])


def test_archives_stay_inside(tmp_path):
    with tarfile.open(tmp_path / "bad.tar", "w") as t:
        info = tarfile.TarInfo("../out.txt")
        info.size = 1
        t.addfile(info, io.BytesIO(b"x"))
    with pytest.raises(ValueError, match="leaves"):
        archives.extract(str(tmp_path / "bad.tar"), str(tmp_path / "to"))
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("d/a.txt", "hi")
    archives.extract(str(tmp_path / "ok.zip"), str(tmp_path / "to"))
    assert (tmp_path / "to/d/a.txt").read_text() == "hi"
    assert archives.sha256_of(str(tmp_path / "to/d/a.txt")) == hashlib.sha256(b"hi").hexdigest()
    assert archives.web_address("gs://b/a b") == "https://storage.googleapis.com/b/a%20b"
    url = (tmp_path / "ok.zip").as_uri()
    with pytest.raises(ValueError, match="checksum"):
        archives.download(url, str(tmp_path / "c.zip"), "00")
    archives.download(url, str(tmp_path / "c.zip"))
    with pytest.raises(FileExistsError):
        archives.download(url, str(tmp_path / "c.zip"))


def test_command_line(spark, tmp_path):
    assert cli.main(["query", "status_counts", "/root/testdata/sf0.001", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() > 0
    with pytest.raises(SystemExit) as e:
        cli.main(["nothing"])
    assert e.value.code == 2
