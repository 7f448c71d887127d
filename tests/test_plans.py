"""The database build, the split and incremental runs from end to end."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pairloom.operators import contract
from pairloom.plans import build, split
from pairloom.streaming.incremental import process_new

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()


def test_build_satisfies_the_contract(spark):
    master = spark.createDataFrame([(md5("AAA"), "FP0000001", "AAA", 3, None, "True", "m1;m2", 0)], "protein_md5 string, fpid string, sequence string, length int, hydrophobicity double, is_canonical string, original_ids string, pos long")
    prot = lambda *rows: spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "id string, sequence string, pos long")
    one = build.Source("S1", prot(("m1", "ignored"), ("x", "cc c*"), ("y", "AAA"), ("e", "")), spark.createDataFrame([("x", "m1", 1, "two hybrid", "both"), ("x", "x", 1, "", "LTP"), ("x", "gone", 1, "", "LTP")], "id_1 string, id_2 string, label int, detection_methods string, throughput string"), "default", "mixed")
    two = build.Source("S2", prot(("z", "CCC"), ("w", "DDD")), spark.createDataFrame([("y", "z", 0), ("w", "z", 0)], "id_1 string, id_2 string, label int"), "shuffle", "negative_synthetic")
    t = build.build(master, [one, two])
    counts = contract.validate(t["proteins"], t["sequences"], t["interactions"], t["pairs"], ["S1", "S2"])
    assert counts == {"proteins": 3, "interactions": 2, "positives": 1}
    ids = {r.fpid: r.original_ids for r in t["proteins"].collect()}
    assert ids == {"FP0000001": "m1;m2;y", "FP0000002": "x;z", "FP0000003": "w"}
    rows = {(r.FPid_1, r.FPid_2): r for r in t["interactions"].collect()}
    a = rows["FP0000001", "FP0000002"]
    assert (a.label, a.n_sources, a.PPI_Source, a.Evidence_Tags, a.Evidence_Type, a.PPI_Tier) == (1, 2, "S1;S2", "HTP;LTP;negative_synthetic", "HTP_LTP", "diamond")
    assert (a.original_id1, a.original_id2, a.Experimental_Method) == ("m1;y", "x;z", "shuffle;two hybrid")


@pytest.fixture
def tables(spark):
    n = 60
    pairs = spark.range(300).select(F.format_string("p%02d", F.col("id") * 7 % n).alias("x"), F.format_string("p%02d", F.col("id") * 13 % (n - 1)).alias("y"), (F.col("id") % 4 != 0).cast("int").alias("label"), F.when(F.col("id") % 8 == 0, "good").otherwise("S").alias("PPI_Source"))
    pairs = pairs.select(F.least("x", "y").alias("ID_1"), F.greatest("x", "y").alias("ID_2"), "label", "PPI_Source").where("ID_1 < ID_2").groupBy("ID_1", "ID_2").agg(F.max("label").alias("label"), F.max("PPI_Source").alias("PPI_Source"))
    ids = spark.range(n).select(F.format_string("p%02d", "id").alias("id"))
    return pairs, ids.select(F.col("id").alias("member"), F.substring("id", 1, 3).alias("cluster")), ids.withColumn("sequence", F.lit("MK"))


def test_split_leaks_nothing(tables):
    pairs, clusters, seqs = tables
    out = split.split(pairs, clusters, seqs, split.Sizes(3, 4, 5, 6), 1, preferred=["good"])
    got = {k: {(r.ID_1, r.ID_2): r.label for r in out[k].collect()} for k in ("val", "test", "train")}
    assert [sorted(got[k].values()) for k in ("val", "test")] == [[0] * 5 + [1] * 3, [0] * 6 + [1] * 4]
    assert not set(got["val"]) & set(got["test"]) and got["train"] and set(got["train"].values()) == {1}
    held = {x for k in ("val", "test") for p, label in got[k].items() if label for x in p}
    assert not held & {x for p in got["train"] for x in p}
    assert {r.member for r in out["clusters"].where("is_tainted").collect()} == held
    again = split.split(pairs, clusters, seqs, split.Sizes(3, 4, 5, 6), 1, preferred=["good"])
    assert {(r.ID_1, r.ID_2) for r in again["val"].collect()} == set(got["val"])


def test_split_rejects_bad_requests(spark, tables):
    pairs, clusters, seqs = tables
    twice = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "ID_1 string, ID_2 string, label int")
    with pytest.raises(ValueError, match="duplicate"):
        split.split(pairs, clusters, seqs, split.Sizes(), 1, val=twice)
    with pytest.raises(ValueError, match="share pairs"):
        split.split(pairs, clusters, seqs, split.Sizes(), 1, val=twice.limit(1), test=twice.limit(1))
    with pytest.raises(ValueError, match="needed"):
        split.split(pairs, clusters, seqs, split.Sizes(), 1)
    with pytest.raises(ValueError, match="fewer than"):
        split.split(pairs, clusters, seqs, split.Sizes(10**6, 0), 1)


def test_new_files_are_processed_once(spark, tmp_path):
    put = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long").write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: process_new(spark, f"{tmp_path}/in", spark.range(0).schema, lambda df: df.withColumn("x", F.col("id") * 2), f"{tmp_path}/out", f"{tmp_path}/state", ["id"])
    put(1, 2)
    run()
    run()
    put(2, 3)
    run()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [(1, 2), (2, 4), (3, 6)]


def test_pairs_fed_file_by_file_are_the_batch(spark, tmp_path):
    from pairloom import catalog
    from pairloom.operators.pairs import dedup, with_tier
    from pairloom.plans.registry import SOURCES, TAG_NAMES, raw_pairs
    from pairloom.streaming import incremental

    rows = raw_pairs(spark, "/root/testdata/sf0.001").select("a", "b", "label", "source", "evidence", "line").cache()
    columns = ("a", "b", "label", "source", "evidence")
    for k in range(3):
        rows.where(F.col("line") % 3 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for _ in range(2 if k == 1 else 1):  # a run without new files changes nothing
            incremental.dedup_new(spark, f"{tmp_path}/in", rows.schema, columns, SOURCES, TAG_NAMES, f"{tmp_path}/out", f"{tmp_path}/state")
        want = with_tier(dedup(rows.where(F.col("line") % 3 <= k), *columns, sources=SOURCES, tags=TAG_NAMES))
        got = incremental.current(spark, f"{tmp_path}/out")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.select("a", "b").exceptAll(catalog.QUERIES["pair_dedup_tiered"](spark, "/root/testdata/sf0.001").select("a", "b")).isEmpty()


def test_steps_of_a_split_read_what_was_made_once(spark):
    from pairloom.plans import format_queries

    out = format_queries._split(spark, "/root/testdata/sf0.001")
    assert all(hasattr(out[n], "_written") for n in ("val", "test", "train"))
    plan = out["clusters"]._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "Scan parquet" in plan


def test_id_map_is_read_and_not_made_again(spark, monkeypatch):
    from pairloom.plans import collections

    wrote = []
    monkeypatch.setattr(collections, "written", lambda df, what, keep=collections.written: wrote.append(what) or keep(df, what))
    ids, _ = collections.id_map(spark.createDataFrame([("a", "A C"), ("a", "AC"), ("b", " ")], "id string, sequence string"))
    assert wrote == ["id-map"] and [r.id for r in ids.collect()] == ["a"]
    assert "md5" not in ids._jdf.queryExecution().optimizedPlan().toString().replace("sequence_md5", "")


def test_no_more_than_the_models_length_is_woven(spark):
    from pyspark.sql import functions as F

    from pairloom.functions import models

    df = spark.createDataFrame([("A" * 5000, "b" * 4000), ("ACG", "XY"), ("", "x")], "r string, s string")
    assert [x.t for x in df.select(models.woven(F.col("r"), F.col("s")).alias("t")).collect()] == ["Ab" * 1024, "AxCy", ""]
    assert "substring(upper(" in df.select(models.woven(F.col("r"), F.col("s")))._jdf.queryExecution().analyzed().toString()


def test_merging_by_masks_is_merging_by_sets(spark):
    from pairloom.plans import build

    rows = [("b", "a", "x", "y", "S1", "S1", 1, "m", "HTP;LTP"), ("a", "b", "y", "x", "S2", "S2", 0, "n", "mixed"), ("a", "c", "x", "z", None, None, 0, None, None), ("a", "a", "x", "x", "S1", "S1", 1, "m", "HTP"), ("a", "d", "x", "z", "S2", "S2", 1, "m", "")]
    df = spark.createDataFrame(rows, "FPid_1 string, FPid_2 string, original_id1 string, original_id2 string, PPI_Source string, Seq_Source string, label int, Experimental_Method string, Evidence_Tags string")
    one, two = build.merged(df), build.merged(df, sources=["S1", "S2"], tags=["HTP", "LTP", "mixed"])
    assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    kept = two.select("FPid_1", "Evidence_Tags", "PPI_Tier")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in kept


def test_conflicts_are_counted_in_one_aggregate_of_the_pairs(spark):
    from pairloom.catalog import QUERIES

    plan = QUERIES["pair_dedup_conflicts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate(keys=[a") == 2  # before and after its shuffle; distinct labels would need two more


@pytest.mark.parametrize("name", ["holdout_pair_exclude", "evidence_repair", "evidence_normalise"])
def test_tasks_take_no_more_rows_as_tables_grow(spark, monkeypatch, name):
    from pairloom.catalog import QUERIES
    from pairloom.operators import tables

    made = lambda: QUERIES[name](spark, "/root/testdata/sf0.001")
    want = sorted(map(tuple, made().collect()))
    monkeypatch.setattr(tables, "TASK_ROWS", 500)
    plan = made()._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [a" in plan and ", 12" in plan  # 6,000 rows; the session has 4 partitions
    assert sorted(map(tuple, made().collect())) == want


def test_filling_up_negatives_takes_no_more_rows_a_task_as_tables_grow(spark, monkeypatch):
    from pairloom.catalog import QUERIES
    from pairloom.operators import entities, pairs, tables

    fill, made = QUERIES["negatives_filled_up"], []
    want = sorted(map(tuple, fill(spark, "/root/testdata/sf0.001").collect()))

    def spy(df, what):
        made.append((what, df._jdf.queryExecution().optimizedPlan().toString()))
        return tables.written(df, what)

    for module in (entities, pairs):
        monkeypatch.setattr(module, "written", spy)
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    assert sorted(map(tuple, fill(spark, "/root/testdata/sf0.001").collect())) == want
    assert [what for what, _ in made] == ["given", "ranked", "negatives", "ranked", "ranked"]
    dealt = [re.findall(r"RepartitionByExpression \[([a-z]+)#.*\], (\d+)", plan) for _, plan in made]
    assert dealt[0] == [("a", "60")]  # 6,000 rows
    assert {key for key, n in dealt[2] if int(n) > 4} == {"a", "cell"}
    assert int(dealt[3][0][1]) > 4 and int(dealt[4][0][1]) > 4  # the ranges of new pairs and of all
