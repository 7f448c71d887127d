"""Readers and writers over files that the tests write."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import names
from pairloom.plans import build, collections, split
from pairloom.sources import readers, writers


def test_headers_may_be_missing(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("query\ttarget\nq\tt\n")
    (tmp_path / "b.tsv").write_text("q1\tt1\nq\tt\n")
    get = lambda n: sorted(map(tuple, readers.read_table(spark, f"{tmp_path}/{n}.tsv", ["query", "target"]).collect()))
    assert get("a") == [("q", "t")] and get("b") == [("q", "t"), ("q1", "t1")]


def test_matrices_and_structure_letters(spark, tmp_path):
    m = np.arange(12, dtype=np.float16).reshape(4, 3)
    np.save(tmp_path / "m.npy", m)
    got = sorted((r.pos, r.vector) for r in readers.read_matrix(spark, f"{tmp_path}/m.npy").collect())
    assert got == [(k, row.tolist()) for k, row in enumerate(m)]
    (tmp_path / "s.fasta").write_text(">a x\nDV\nqp\n>b\nAA\n>a\nCC\n")
    assert {r.id: r.sequence for r in readers.read_structure_letters(spark, f"{tmp_path}/s.fasta").collect()} == {"a": "cc", "b": "aa"}


def test_missing_values_are_fetched_once(spark, tmp_path):
    calls = f"{tmp_path}/calls"

    def fetch(ids):
        import uuid
        from pathlib import Path

        Path(calls).mkdir(exist_ok=True)
        (Path(calls) / uuid.uuid4().hex).write_text(str(len(ids)))
        return {i: i.lower() for i in ids if i != "X"}

    ids = spark.createDataFrame([(i,) for i in ("A", "B", "X", "A", "", None, "C")], "id string")
    for _ in range(2):
        assert {r.id: r.value for r in readers.fetch_missing(ids, "id", f"{tmp_path}/cache", fetch, batch=2).collect()} == {"A": "a", "B": "b", "C": "c"}
    sizes = [int(p.read_text()) for p in (tmp_path / "calls").iterdir()]
    assert sum(sizes) == 5 and max(sizes) <= 2  # the second time only X is asked for


def test_single_files_manifests_and_files_for_rows(spark, tmp_path):
    df = spark.createDataFrame([("b", "2", [1.0, 2.0]), ("a", None, [3.0])], "id string, x string, v array<float>")
    writers.write_single(df.select("id", "x").repartition(3), f"{tmp_path}/one.csv", "id")
    assert (tmp_path / "one.csv").read_text() == "id,x\na,\nb,2\n"
    for _ in range(2):
        writers.append_new(df.select("id", "x"), f"{tmp_path}/manifest", "id")
    assert spark.read.parquet(f"{tmp_path}/manifest").count() == 2
    assert writers.write_each(df, f"file://{tmp_path}/each", F.concat("id", F.lit(".fasta")), writers.fasta_record("id", F.lit("MK"))) == 2
    assert (tmp_path / "each" / "a.fasta").read_text() == ">a\nMK"
    assert writers.write_each(df, f"file://{tmp_path}/npy", F.concat("id", F.lit(".npy")), writers.npy_bytes("v")) == 2
    assert np.load(tmp_path / "npy" / "b.npy").tolist() == [1.0, 2.0]
    ids = spark.createDataFrame([("a", "n1"), ("a", "n2"), ("z", "n3")], "old string, new string")
    moved, missing = writers.rekeyed(df.select("id", "x"), "id", ids, "old", "new")
    assert {r.id for r in moved.collect()} == {"n1", "n2"} and [r.id for r in missing.collect()] == ["n3"]


def test_names_of_targets(spark):
    df = spark.createDataFrame([("a b", "P1", "m", "x/y.cif.gz"), ("c", "P2", "n", "x/y.pdb")], "id string, acc string, md5 string, src string")
    get = lambda mode, unpacked=False: [r[0] for r in df.select(names.target_name(mode, *map(F.col, df.columns), unpacked)).collect()]
    assert get("id") == ["a_b.cif.gz", "c.pdb"] and get("accession", True) == ["P1.cif", "P2.cif"] and get("sequence_md5") == ["m.cif.gz", "n.pdb"]
    with pytest.raises(ValueError):
        get("name")
    r = spark.range(1).select(names.clean_text(F.lit("  x ")).alias("a"), names.clean_text(F.lit(" ")).alias("b"), names.confidence_of(F.lit("d/Mint_MediumConfidence.parquet")).alias("c"), names.split_of(F.lit("s/highconfidence_data/val.parquet")).alias("d"), names.web_address(F.lit("P1"), 4).alias("e"), names.header_candidates(F.lit("d/x.cif y")).alias("f")).first()
    assert (r.a, r.b, r.c, r.d, r.f) == ("x", None, "medium", "highconfidence_val", ["d/x.cif", "x"]) and r.e.endswith("AF-P1-F1-model_v4.cif")


def test_build_repairs_the_primary_source(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    master = spark.createDataFrame([(md5(s), f"FP{k:07}", s, len(s), None, "True", f"m{k}", k) for k, s in enumerate(("AAA", "CCC", "DDD"), 1)], "protein_md5 string, fpid string, sequence string, length int, hydrophobicity double, is_canonical string, original_ids string, pos long")
    none = spark.createDataFrame([], "id string, sequence string, pos long")
    pairs = spark.createDataFrame([("m1", "m2"), ("m1", "m3"), ("m2", "m3")], "id_1 string, id_2 string")
    other = spark.createDataFrame([("m1", "m3")], "id_1 string, id_2 string")
    rows = spark.createDataFrame([("aaa", "ccc", "both", "x"), ("ddd", "aaa", "LTP", "by complex curation"), ("ccc", "ddd", "odd", None)], "sequence_1 string, sequence_2 string, throughput string, method string")
    t = build.build(master, [build.Source("OWN", none, pairs), build.Source("O", none, other)], build.Primary("OWN", ("O",), rows))
    got = {(r.FPid_1[-1], r.FPid_2[-1]): (r.Evidence_Tags, r.Evidence_Type, r.PPI_Tier) for r in t["interactions"].collect()}
    assert got == {("1", "2"): ("HTP;LTP", "HTP_LTP", "gold"), ("1", "3"): ("LTP;complex_curation;mixed", "LTP", "diamond"), ("2", "3"): ("unknown", "unknown", "bronze")}


def test_split_checks(spark):
    with pytest.raises(ValueError, match="content ids"):
        split.check_content_ids(spark.createDataFrame([("x", "y")], "ID_1 string, ID_2 string"))
    with pytest.raises(ValueError, match="twice"):
        split.check_proteins(spark.createDataFrame([("FP1", "a", "A"), ("FP1", "a", "A")], "fpid string, protein_md5 string, sequence string"))
    with pytest.raises(ValueError, match="hashes"):
        split.check_proteins(spark.createDataFrame([("FP1", "a", "A")], "fpid string, protein_md5 string, sequence string"))
    assert collections.in_order(["x.csv", "test_b.csv", "val.csv", "train.csv", "id_map.csv", "test.csv"]) == ["train.csv", "val.csv", "test.csv", "test_b.csv", "x.csv"]


def test_commands_run_on_files(spark, tmp_path, capsys):
    from pairloom.__main__ import COMMANDS, main, parser

    (tmp_path / "pos.csv").write_text("ID_1,ID_2,label\n" + "".join(f"a{k},b{k},1\n" for k in range(12)))
    assert main(["negatives", f"{tmp_path}/pos.csv", f"{tmp_path}/neg", "--per-positive", "2", "--no-positives"]) == 0
    got = readers.read_delimited(spark, f"{tmp_path}/neg", ["ID_1", "ID_2", "label", "category"], ",")
    assert got.count() == 24 and {r.label for r in got.collect()} == {"0"}
    assert main(["fill-negatives", f"{tmp_path}/pos.csv", f"{tmp_path}/fill", "--per-positive", "3"]) == 0
    assert readers.read_delimited(spark, f"{tmp_path}/fill", ["ID_1", "ID_2", "label", "category"], ",").count() == 48
    (tmp_path / "s.fasta").write_text(">x\nMKTAYIAKQRQISFVKSHFSRQ\n>y\nMKTAYIAKQRQISFVKSHFSRA\n")
    assert main(["cluster-map", f"{tmp_path}/s.fasta", f"{tmp_path}/map"]) == 0
    assert {r.cluster for r in readers.read_delimited(spark, f"{tmp_path}/map", ["id", "cluster"], ",").collect()} == {"x"}
    assert main(["snapshot", f"{tmp_path}/pos.csv"]) == 0 and '"rows": 12' in capsys.readouterr().out
    with pytest.raises(SystemExit) as e:
        main(["no-such-command"])
    assert e.value.code == 2
    with pytest.raises(SystemExit):
        parser().parse_args(["evidence", "f", "r", "--primary", "S", "--output", "x", "--in-place"])
    assert parser().parse_args(["split-c3", "f", "o"]).run is COMMANDS["split"][1]


def test_external_programs_on_batches(spark):
    from pairloom.operators import external

    df = spark.createDataFrame([("a", "MK"), ("b", "BAD"), ("c", None), ("d", "LL")], "id string, s string").coalesce(1)
    command = ["sh", "-c", "! grep -q BAD {in} && tr 'MKL' 'mkl' < {in} > {out}"]
    got = {r.id: (r.value, r.error) for r in external.run_program(df, "id", "s", command, lambda p: external.fasta_rows(p.read_text()), batch=3).collect()}
    assert got["a"] == ("mk", None) and got["d"] == ("ll", None) and got["c"] == ("", None) and got["b"][0] is None and "status 1" in got["b"][1]
    slow = external.run_program(df.limit(1), "id", "s", ["sleep", "5"], lambda p: {}, seconds=0.5).first()
    assert slow.value is None and "timed out" in slow.error
    files = spark.createDataFrame([("x/1", "ATOM A"), ("x/2", "ATOM B")], "id string, body string").coalesce(1)
    import os
    import stat
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".sh", delete=False) as f:
        f.write('#!/bin/sh\nwhile read p || [ -n "$p" ]; do n=$(basename $p .pdb); echo ">$n"; cut -c6 $p; echo; done < $1 > $2\n')
    os.chmod(f.name, os.stat(f.name).st_mode | stat.S_IXUSR)
    assert {r.id: r.value for r in external.structure_letters(files, "id", "body", f.name).collect()} == {"x/1": "a", "x/2": "b"}


def test_collections_are_built_from_their_specs(spark):
    spec = collections.Collection("c", ("one", "two"), {"train": "train.csv", "test_b": "test_b.csv"}, "test_b")
    seqs = {"one": spark.createDataFrame([("a", "MK"), ("b", "LL")], "id string, sequence string"), "two": spark.createDataFrame([("a", "M K"), ("c", "mk")], "id string, sequence string")}
    pairs = {n: spark.createDataFrame([("a", "b", 1), ("c", "b", 0)], "ID_1 string, ID_2 string, label int") for n in spec.pair_files}
    out = collections.built(spec, seqs, pairs)
    assert set(out) == {"train", "test_b", "test", "id_map", "sequences"} and out["sequences"].count() == 2 and out["id_map"].count() == 3
    assert len({r.ID_1 for r in out["test"].collect()}) == 1
    with pytest.raises(ValueError, match="two"):
        collections.built(spec, {"one": seqs["one"]}, pairs)
    with pytest.raises(ValueError, match="more than one"):
        collections.all_sequences(seqs["one"], spark.createDataFrame([("a", "XX")], "id string, sequence string"))
    vectors = spark.createDataFrame([(r.id,) for r in out["sequences"].limit(1).collect()], "id string")
    assert collections.missing_vectors(out["sequences"], {"m": vectors}).count() == 1
    listing = spark.createDataFrame([("x.npy", "/r/two/x.npy"), ("x.npy", "/r/one/x.npy"), ("y.npy", "/r/two/y.npy"), ("z.npy", "/q/z.npy")], "name string, path string")
    assert {r.name: r.path for r in collections.kept_vectors({"m": ("/r/one", "/r/two")}, "m", listing).collect()} == {"x.npy": "/r/one/x.npy", "y.npy": "/r/two/y.npy"}


def test_transfers_pairs_and_landings(spark, tmp_path):
    from pairloom.functions import models
    from pairloom.operators import structures

    def fetch(source, target):
        if source == "gone":
            raise FileNotFoundError("404")
        if source == "bad":
            raise OSError("broken")
        return "downloaded"

    tasks = spark.createDataFrame([("ok", "a"), ("gone", "b"), ("bad", "c"), (None, "d")], "source string, target string")
    assert {r.target: r.status for r in structures.transfer(tasks, fetch, kind="download").collect()} == {"a": "downloaded", "b": "not_available", "c": "download_error", "d": "missing_source"}
    files = spark.createDataFrame([("a", 10)], "name string, length long")
    assert {r.target: (r.has_file, r.size) for r in structures.with_files(tasks, "target", files).where("target < 'c'").collect()} == {"a": (True, 10), "b": (False, None)}
    aa, tdi = spark.createDataFrame([("1", "MKL"), ("2", "A")], "id string, sequence string"), spark.createDataFrame([("1", "dv")], "id string, sequence string")
    both, missing = models.paired(aa, tdi)
    assert [tuple(r) for r in both.collect()] == [("1", "MdKv", False)] and [r.id for r in missing.collect()] == ["2"]
    aa.write.parquet(f"{tmp_path}/far")
    for _ in range(2):
        assert readers.landed(spark, f"{tmp_path}/far", f"{tmp_path}/near").count() == 2
    distinct = spark.createDataFrame([("i", "x", 3), ("i", "x", 1), ("j", "x", 2), ("j", "y", 0)], "id string, md5 string, pos int")
    from pairloom.operators.matching import distinct_targets

    ids, content = distinct_targets(distinct, "id", "md5", "pos")
    assert ids.count() == 3 and {r.md5: r.id for r in content.collect()} == {"x": "i", "y": "j"}
