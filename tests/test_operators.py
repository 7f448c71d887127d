import random
"""Small cases of the rules that are easy to get wrong."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom import catalog
from pairloom.functions import evidence as E
from pairloom.functions import sequences as S
from pairloom.operators import clusters, contract, embeddings, entities, matching, pairs, splits
from pairloom.sources import readers, writers


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_dedup_positive_wins_and_counts_sources(spark):
    df = spark.createDataFrame([("FP2", "FP1", "A", 0, "HTP;LTP"), ("FP1", "FP2", "B", 1, "LTP")], "a string, b string, s string, label int, e string")
    got = pairs.dedup(df, "a", "b", "label", "s", "e").collect()
    assert [tuple(r) for r in got] == [("FP1", "FP2", 1, 2, 2, "A;B", "HTP;LTP")]


def test_dedup_by_masks_refuses_other_labels(spark):
    df = spark.createDataFrame([("a", "b", k, "S", "LTP") for k in (0, 1, 2)], "a string, b string, label int, source string, evidence string")
    assert pairs.dedup(df.where("label < 2"), "a", "b", "label", "source", "evidence", sources=["S"], tags=["LTP"]).first().n_labels == 2
    with pytest.raises(Exception, match="labels are 0 and 1"):
        pairs.dedup(df, "a", "b", "label", "source", "evidence", sources=["S"], tags=["LTP"]).collect()


def test_sources_count_null_as_a_value(spark):
    df = spark.createDataFrame([("x", "y", None, 1, "LTP"), ("x", "y", "A", 1, None)], "a string, b string, s string, label int, e string")
    row = pairs.dedup(df, "a", "b", "label", "s", "e").first()
    assert (row.n_sources, row.sources, row.evidence_tags) == (2, "A", "LTP")


def test_swap_takes_the_payload_along_and_keeps_null_pairs(spark):
    df = spark.createDataFrame([("b", "a", "x", "y"), (None, "a", "x", "y")], "a string, b string, p string, q string")
    assert sorted(map(tuple, pairs.canonical(df, "a", "b", [("p", "q")]).collect()), key=str) == sorted([("a", "b", "y", "x"), (None, "a", "x", "y")], key=str)


def test_registry_goes_by_id_before_content(spark):
    master = spark.createDataFrame([("FP0000001", "S", "u1", 0)], "fpid string, md5 string, original_ids string, pos long")
    rows = spark.createDataFrame([("u1", "T", 1), ("u2", "S", 2), ("u3", "T", 3)], "source_id string, md5 string, pos long")
    ids, made = entities.register(master, rows)
    assert dict(map(tuple, ids.collect())) == {"u1": "FP0000001", "u2": "FP0000001", "u3": "FP0000002"}
    assert {r.fpid: (r.original_ids, r.is_new) for r in made.collect()} == {"FP0000001": ("u1;u2", False), "FP0000002": ("u3", True)}


@pytest.mark.parametrize(
    ("tags", "label", "n", "kind", "tier"),
    [("HTP,LTP", 1, 1, "HTP_LTP", "gold"), ("HTP,LTP", 1, 2, "HTP_LTP", "diamond"), ("HTP,complex_curation", 1, 1, "complex_curation", "bronze"), ("structural,negative_synthetic", 1, 1, "structural", "diamond"), ("structural,negative_synthetic", 0, 1, "negative_synthetic", "negative_synthetic"), ("negative_synthetic", 1, 1, "negative_synthetic", "negative_synthetic"), ("odd", 1, 3, "unknown", "bronze"), ("mixed", 1, 3, "mixed", "gold")],
)
def test_class_and_tier(spark, tags, label, n, kind, tier):
    k = E.evidence_class(F.split(F.lit(tags), ","), F.lit(label))
    assert (one(spark, k), one(spark, E.tier(k, F.lit(label), F.lit(n)))) == (kind, tier)


def test_repair_keeps_mixed_only_with_support(spark):
    def fixed(sources):
        tags = E.repaired(F.array(F.lit("mixed")), F.array(F.lit("HTP"), F.lit("LTP")), F.split(F.lit(sources), ";"), "P", ["H"])
        return one(spark, S.ordered_tokens(tags, E.REPAIR_ORDER))

    assert (fixed("P"), fixed("P;H"), fixed("X")) == ("HTP;LTP", "HTP;LTP;mixed", "mixed")


def test_interface_tier(spark):
    df = spark.createDataFrame([("weak",), ("Large interface",), ("medium",)], "t string")
    assert [r[0] for r in df.select(E.interface_tier(F.col("t"))).collect()] == ["weak", "strong", "medium"]
    with pytest.raises(Exception, match="no interface tier"):
        spark.createDataFrame([("other",)], "t string").select(E.interface_tier(F.col("t"))).collect()


def test_only_positive_holdouts_taint(spark):
    p = spark.createDataFrame([("a", "z", 1), ("x", "z", 1), ("c", "z", 1), ("y", "z", 1), ("c", "d", 1), ("b", "z", 1)], "a string, b string, label int")
    held = spark.createDataFrame([("a", "b", 1), ("c", "d", 0)], "a string, b string, label int")
    c = spark.createDataFrame([("a", "1"), ("x", "1"), ("b", "2"), ("c", "3"), ("y", "3"), ("d", "4")], "m string, c string")
    got = splits.training_rows(p, held, c, "a", "b", "label", "m", "c").select("a", "b").collect()
    assert sorted(map(tuple, got)) == [("c", "z"), ("y", "z")]


def test_priority_is_used_up_first(spark):
    df = spark.range(8).select("id", F.when(F.col("id") < 3, 0).otherwise(1).alias("p"))
    got = [r.id for r in pairs.sample_by_priority(df, 5, F.col("p"), 1, "id").collect()]
    assert {0, 1, 2} < set(got) and len(got) == 5


def test_negatives_are_new_distinct_and_from_known_endpoints(spark):
    pos = spark.createDataFrame([(f"n{i:02}", f"n{(i * 7) % 40:02}") for i in range(40)], "a string, b string")
    got = [tuple(r) for r in pairs.sample_negatives(pos, "a", "b", 50, 3).collect()]
    known = {tuple(sorted(r)) for r in pos.collect()}
    assert len(set(got)) == 50 and all(a < b for a, b in got) and not known & set(got)
    with pytest.raises(ValueError, match="fewer than"):
        pairs.sample_negatives(spark.createDataFrame([("a", "b")], "a string, b string"), "a", "b", 1, 1, most_rounds=2)


def test_half_goes_to_even(spark):
    assert [one(spark, S.round_half_even(F.lit(x))) for x in (2.5, 3.5)] == [2.0, 4.0]


def test_longest_first_of_equals(spark):
    df = spark.createDataFrame([("g", 5, 0), ("g", 7, 1), ("g", 7, 2)], "g string, n int, pos int")
    assert entities.longest(df, "g", "n", "pos").first().pos == 1


def test_first_alias_in_list_order(spark):
    df = spark.createDataFrame([("k", ["z", "a"])], "k string, al array<string>")
    t = spark.createDataFrame([("a", 1), ("z", 2)], "alias string, v int")
    assert matching.first_alias(df, "k", F.col("al"), t, "alias", "v").first().v == 2


def test_checked_lookup_names_what_is_missing(spark):
    df = spark.createDataFrame([("a",), ("q",)], "k string")
    with pytest.raises(ValueError, match="q"):
        matching.checked_lookup(df, "k", spark.createDataFrame([("a", 1)], "k string, v int"), "v")


@pytest.mark.parametrize(("how", "want"), [("mean", [2.0, 3.0]), ("max", [3.0, 4.0]), ("cls", [1.0, 4.0]), ("residue", [[1.0, 4.0], [3.0, 2.0]])])
def test_pooling(spark, how, want):
    df = spark.createDataFrame([("p", 0, [1.0, 4.0]), ("p", 1, [3.0, 2.0])], "k string, pos int, v array<double>")
    assert embeddings.pool(df, "k", "pos", "v", how).first().v == want


def test_export_fills_missing_vectors(spark):
    p = spark.createDataFrame([("b", "a")], "x string, y string")
    v = spark.createDataFrame([("a", [1.0, 2.0])], "id string, v array<float>")
    rows, index = embeddings.export(p, "x", "y", v, "id", "v", 2)
    assert [tuple(r) for r in rows.orderBy("number").collect()] == [(0, "a", [1.0, 2.0], True), (1, "b", [0.0, 0.0], False)]
    assert tuple(index.first()) == ("b", "a", 1, 0)


def test_worker_buckets(spark):
    got = embeddings.worker_buckets(spark.range(23), 5, "id").groupBy("worker").count().orderBy("worker").collect()
    assert [r["count"] for r in got] == [5, 5, 5, 4, 4]


def test_embedding_errors_stay_in_their_rows(spark):
    def factory():
        def run(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            return [np.ones((2, 3)) for _ in texts]

        return run

    embeddings.register_extractor("picky", 3, factory)
    df = spark.createDataFrame([(1, "x"), (2, "bad"), (3, "y")], "id long, t string").coalesce(1)
    got = {r.id: (r.vector, r.error) for r in embeddings.embed(df, "id", "t", "picky").collect()}
    assert got == {1: ([1.0] * 3, None), 2: (None, "no"), 3: ([1.0] * 3, None)}


def test_normalisers_differ_on_purpose(spark):
    s = F.lit("aa*\n b")
    assert [one(spark, f(s)) for f in (S.letters_only, S.no_space, S.no_space_no_stop, S.stripped_upper, S.no_space_no_stops)] == ["AAB", "AA*B", "AA*B", "AA*\n B", "AAB"]
    assert one(spark, S.no_space_no_stop(F.lit(" ** "))) is None


def test_accessions(spark):
    cases = {">AF-P12345-F1-model_v4": "P12345", "x UA=q9y6k9-2 z": "Q9Y6K9", "sp|P0DTC2|SPIKE": "P0DTC2", "p12345-3": "P12345", "??": None}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r.h: r.a for r in df.select("h", S.accession(F.col("h")).alias("a")).collect()} == cases


def test_contract_finds_each_seeded_violation(spark):
    good = ("FP0000001", "FP0000002", "a", "b", "S1;S2", "s", 1, "m", "LTP", "LTP", "diamond", "钻石", 2)
    broken = {"endpoint_order": (0, "FP0000003"), "label_value": (6, 2), "n_sources_count": (12, 3), "evidence_type_enum": (8, "x"), "tier_enum": (10, "tin"), "tier_name": (11, "?"), "evidence_tags_enum": (9, "LTP;x"), "negative_class": (6, 0)}
    schema = "FPid_1 string, FPid_2 string, original_id1 string, original_id2 string, PPI_Source string, Seq_Source string, label int, Experimental_Method string, Evidence_Type string, Evidence_Tags string, PPI_Tier string, PPI_Tier_ZH string, n_sources int"
    for rule, (at, value) in broken.items():
        row = tuple(value if k == at else v for k, v in enumerate(good))
        bad = {r.rule: r.n_bad for r in contract.count_violations(spark.createDataFrame([good, row], schema), contract.interaction_rules(["S1", "S2"])).collect()}
        assert bad[rule] == 1, rule
        assert sum(bad.values()) == (2 if rule == "tier_enum" else 1), bad


def test_validate_tells_all_broken_rules(spark):
    seqs = ["AAA", "CCC"]
    import hashlib

    proteins = spark.createDataFrame([(hashlib.md5(s.encode()).hexdigest(), f"FP{i:07}", s, 3, None, "True", "u") for i, s in enumerate(seqs, 1)], "protein_md5 string, fpid string, sequence string, length int, hydrophobicity double, is_canonical string, original_ids string")
    inter = spark.createDataFrame([("FP0000001", "FP0000002", "a", "b", "S1", "s", 1, "m", "LTP", "LTP", "gold", "黄金", 1)], list(contract.INTERACTIONS))
    sequences = proteins.selectExpr("fpid as id", "sequence")
    pr = inter.selectExpr("FPid_1 as fpid_1", "FPid_2 as fpid_2", "label")
    assert contract.validate(proteins, sequences, inter, pr, ["S1"]) == {"proteins": 2, "interactions": 1, "positives": 1}
    with pytest.raises(contract.ContractError, match="^source_enum: 1$"):
        contract.validate(proteins, sequences, inter, pr, ["S2"])
    with pytest.raises(contract.ContractError, match="length_of_sequence: 2; .*sequences_projection"):
        contract.validate(proteins.withColumn("length", F.lit(9)), sequences.limit(1), inter, pr, ["S1"])
    place = lambda df: df.withColumn("pos", F.substring(df.columns[1] if "fpid" in df.columns else df.columns[0], 3, 9).cast("long") - 1)
    ordered = [place(df) for df in (proteins, sequences, inter, pr)]
    assert contract.validate(*ordered, ["S1"], pos="pos")["proteins"] == 2
    turned = [df.withColumn("pos", 1 - F.col("pos")) for df in ordered[:2]]
    with pytest.raises(contract.ContractError, match="fpid_order: 2"):
        contract.validate(*turned, *ordered[2:], ["S1"], pos="pos")


def test_snapshot_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    import hashlib

    digest = hashlib.sha256((tmp_path / "a.csv").read_bytes()).hexdigest()
    facts = contract.file_facts(spark, str(tmp_path))
    contract.check_snapshot(facts, {"a.csv": (2, digest)})
    for expected, said in (({"a.csv": (3, digest)}, "2 rows, not 3"), ({"a.csv": (2, "0")}, "checksum"), ({"b.csv": (2, digest)}, "missing")):
        with pytest.raises(contract.ContractError, match=said):
            contract.check_snapshot(facts, expected)


@pytest.mark.parametrize("n", [0, 1, 10_000])
def test_numbers_are_dense_with_other_columns(spark, n):
    """With columns that ride along and are used later; two ranged plans would cut such rows at different places."""
    df = spark.range(n).select((F.col("id") * 7919 % max(n, 1)).alias("k"), F.md5(F.col("id").cast("string")).alias("extra"), F.lit("x").alias("__part2"))
    got = entities.dense_numbers(df.repartition(5), "k").where("extra is not null").select("k", "number", "extra").collect()
    assert sorted(r.number for r in got) == list(range(n)) and all(r.k == r.number for r in got)
    if n:
        sizes = embeddings.worker_buckets(df, 7, "k").where("extra <> ''").groupBy("worker").count().collect()
        assert sorted(r["count"] for r in sizes) == sorted([n // 7 + (k < n % 7) for k in range(7) if n // 7 + (k < n % 7)])
        assert {r["count"] for r in embeddings.fixed_batches(df, 128, "k").where("extra <> ''").groupBy("batch").count().where(f"batch < {n // 128}").collect()} <= {128}


def test_a_registry_mints_each_number_once(spark):
    master = spark.createDataFrame([("FP0000041", "m", "u", 0)], "fpid string, md5 string, original_ids string, pos long")
    rows = spark.range(30_000).select(F.concat(F.lit("s"), "id").alias("source_id"), F.md5((F.col("id") % 20_000).cast("string")).alias("md5"), F.col("id").alias("pos"))
    ids, touched = entities.register(master, rows.repartition(6))
    got = ids.where("source_id <> 'u'").select("fpid").distinct().collect()
    assert sorted(r.fpid for r in got) == [f"FP{k:07}" for k in range(42, 20_042)]
    assert touched.where("is_new").count() == 20_000 and ids.count() == 30_001


def test_holdouts_have_the_sizes_asked_for(spark):
    from pairloom.operators import splits

    x = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("a"), F.md5((F.col("id") + 7).cast("string")).alias("b"), F.lit(1).alias("label"))
    got = {r.part: r["count"] for r in splits.sample_holdout(x, ["a", "b"], 4_000, 6_000, 3).groupBy("part").count().collect()}
    assert got == {"val": 4_000, "test": 6_000}


def test_budget_plan_equals_a_row_by_row_walk():
    for s in range(200):
        rng = random.Random(s)
        sizes = sorted((rng.choice([0, 1, 3, 7, 20, 50, 90]) for _ in range(rng.randint(0, 60))), reverse=True)
        most_rows, most_units = rng.randint(1, 9), rng.randint(1, 120)
        want, batch, rows, units = [], 0, 0, 0
        for n in sizes:
            if rows and (rows + 1 > most_rows or units + n > most_units):
                batch, rows, units = batch + 1, 0, 0
            rows, units = rows + 1, units + n
            want.append(batch)
        got = []
        counts = {n: sizes.count(n) for n in sizes}
        for size, start, join, full, at in embeddings.budget_plan(sorted(counts.items(), reverse=True), most_rows, most_units):
            assert start == len(got)
            got += [at if k < join else at + 1 + (k - join) // full for k in range(counts[size])]
        assert got == want


def test_enumerated_sets_equal_collected_ones_and_refuse_others(spark):
    rows = [("b", "a", 1, "S1", "HTP;LTP"), ("a", "b", 0, None, "mixed"), ("a", "b", None, "S2", None), ("c", "d", None, None, ";HTP;"), ("c", "c", 0, "S1", "")]
    df = spark.createDataFrame(rows, "a string, b string, label int, source string, evidence string")
    both = [sorted(map(tuple, pairs.dedup(df, "a", "b", "label", "source", "evidence", **kw).collect())) for kw in ({}, {"sources": ["S2", "S1"], "tags": ["mixed", "LTP", "HTP"]})]
    assert both[0] == both[1]
    for kw in ({"sources": ["S1"], "tags": ["mixed", "LTP", "HTP"]}, {"sources": ["S1", "S2"], "tags": ["mixed"]}):
        with pytest.raises(Exception, match="of the enumeration"):
            pairs.dedup(df, "a", "b", "label", "source", "evidence", **kw).collect()


def test_search_equals_all_shingles(spark):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choices("ACDE", k=rng.randint(0, 40)))) for k in range(60)]
    rows += [(101 + k, rows[k][1][3:] + "WW") for k in range(20)]
    df = spark.createDataFrame(rows, "id long, s string")
    cut = lambda s: {s[k : k + 5] for k in range(len(s) - 4)} or ({s} if s else set())
    sets = {i: cut(s) for i, s in rows}
    want = {(q, t): len(sets[q] & sets[t]) for q in sets if q % 5 == 0 for t in sets if t % 5 and sets[q] and sets[t] and len(sets[q] & sets[t]) >= 0.6 * min(len(sets[q]), len(sets[t]))}
    got = {(r.query, r.target): r.shared for r in clusters.alike(df.where("id % 5 = 0"), df.where("id % 5 <> 0"), "id", "s", 0.6).collect()}
    assert got == want and want


def test_models_rules_and_pooling(spark):
    from pairloom.functions import models

    assert [models.pool_mode(None, "mean"), models.pool_mode("per-residue", "mean"), models.pool_mode("max", "mean", per_residue=True), models.pool_mode("max", "mean", per_residue=True, mean_pool=True)] == ["mean", "residue", "residue", "mean"]
    with pytest.raises(ValueError):
        models.pool_mode("sum", "mean")
    with pytest.raises(ValueError):
        models.checked_pool("prott5", "cls")
    assert models.checked_pool("profam") == "residue"
    df = spark.createDataFrame([("mUzkAL-o.", "dvqp", [5, 6, 7, 8, 9])], "aa string, tdi string, q array<int>")
    r = df.select(models.spaced(F.col("aa")).alias("s"), models.structure_ids(F.col("tdi")).alias("ids"), models.woven(F.col("aa"), F.col("tdi")).alias("w"), models.quantised_ids(F.col("q"), F.lit(3)).alias("q"), models.MODELS["profam"].text(F.col("aa"), 4).alias("p")).first()
    assert (r.s, r.ids, r.w, r.q, r.p) == ("M X X K A L - X .", [148, 135, 131, 141, 138, 1], "MdUvZqKp", [1, 8, 9, 10, 2], "MCZK")


def test_special_tokens_are_cut_off_and_slow_batches_are_halved(spark):
    import numpy as np

    def factory():
        import time

        def run(texts):
            if "slow" in texts:
                time.sleep(3)
            return [np.array([[9.0, 9.0], *([float(ord(c)), 1.0] for c in t), [7.0, 7.0]]) for t in texts]

        return run

    embeddings.register_extractor("framed", 2, factory)
    df = spark.createDataFrame([(1, "AC"), (2, "slow"), (3, ""), (4, "B")], "id long, s string").coalesce(1)
    get = lambda **kw: {r[0]: (r[1], r[2]) for r in embeddings.embed(df, "id", "s", "framed", before=1, after=1, **kw).collect()}
    got = get(seconds=1.0)
    assert got[1] == ([66.0, 1.0], None) and got[4] == ([66.0, 1.0], None) and "seconds" in got[2][1] and "rows" in got[3][1]
    assert get(how="cls")[1][0] == [9.0, 9.0] and get(how="max")[1][0] == [67.0, 1.0] and get(how="residue")[1][0] == [[65.0, 1.0], [67.0, 1.0]]
    ids, m = (spark.createDataFrame([(k, f"v{k}") for k in range(3)], f"pos long, {c} string") for c in ("id", "vector"))
    assert embeddings.precomputed(ids, m, "id", "pos", "vector").count() == 3
    with pytest.raises(ValueError, match="3 ids, but 2 rows"):
        embeddings.precomputed(ids, m.limit(2), "id", "pos", "vector")


def test_clusters_join_alike_sequences(spark):
    base = "MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQAPILSRVGDGTQDNLSGAEKAVQVKVKALPDAQFEVVHSLAKWKRQTLGQHDFSAGEGLYTHMKALRPDEDRLSPLHSVYVDQWDWE"
    rows = [("a", base), ("b", base[:-2] + "AA"), ("c", base[::-1]), ("d", base), ("e", "MK")]
    got = dict(map(tuple, clusters.cluster(spark.createDataFrame(rows, "id string, s string"), "id", "s", 0.8).collect()))
    assert got == {"a": "a", "b": "a", "d": "a", "c": "c", "e": "e"}


def test_clusters_find_pairs_at_the_similarity_asked_for(spark):
    rng = random.Random(3)
    part = lambda n: "".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=n))
    rows = []
    for k in range(30):  # Jaccard similarity 0.42
        both = part(180)
        rows += [(f"{k}a", both + part(120)), (f"{k}b", both + part(120))]
    got = dict(map(tuple, clusters.cluster(spark.createDataFrame(rows, "id string, s string"), "id", "s").collect()))
    assert sum(got[f"{k}b"] == f"{k}a" for k in range(30)) >= 29
    assert len(set(got.values())) >= 30


def test_readers(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">sp|P1|A one\nMK\nta*\n>b two\nCC\n>b again\nGG\n")
    x = readers.read_fasta(spark, str(tmp_path / "x.fasta"))
    assert dict(map(tuple, readers.fasta_map(x).collect())) == {"P1": "MKTA", "b": "GG"}
    assert dict(map(tuple, readers.fasta_map(x, last=False).collect()))["b"] == "CC"
    (tmp_path / "p.txt").write_text("a  b\nlonely\nc d extra\n")
    assert sorted(map(tuple, readers.read_pair_text(spark, str(tmp_path / "p.txt"), 1).collect())) == [("a", "b", 1), ("c", "d", 1)]
    (tmp_path / "p.tsv").write_text("a\tb\t0\nc\td\te\nf\tg\n")
    assert sorted(map(tuple, readers.read_pair_tsv(spark, str(tmp_path / "p.tsv")).collect())) == [("a", "b", 0), ("c", "d", 1), ("f", "g", 1)]
    (tmp_path / "s.csv").write_text("id_1,sequence_1,id_2,sequence_2\na,NA,b,MK\n")
    assert sorted(map(tuple, readers.read_sequences(spark, str(tmp_path / "s.csv")).collect())) == [("a", "NA"), ("b", "MK")]
    (tmp_path / "f.json").write_text('{"folds": {"t": ["a", "b"]}}')
    assert sorted(map(tuple, readers.read_json_folds(spark, str(tmp_path / "f.json")).collect())) == [("t", "a"), ("t", "b")]
    (tmp_path / "c.tsv").write_text("r\tm\nq\tm\nr\tn\n")
    assert sorted(map(tuple, readers.read_clusters(spark, str(tmp_path / "c.tsv")).collect())) == [("m", "r"), ("n", "r")]
    atom = "ATOM      1  CA  {} {}{:4d}       0.0     0.0     0.0\n"
    (tmp_path / "m.pdb").write_text("MODEL        1\n" + atom.format("GLY", "A", 1) + atom.format("ALA", "A", 2) + atom.format("HOH", "A", 3) + "ENDMDL\n" + atom.format("TRP", "A", 9))
    assert [tuple(r)[1:] for r in readers.read_structures(spark, str(tmp_path / "m.pdb")).collect()] == [("A", "GA")]
    assert [tuple(r)[1:3] for r in readers.list_files(spark, str(tmp_path), "*.pdb").collect()] == [("m.pdb", "m")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", "MKTAY"), ("a", "CC")], "id string, s string")
    writers.write_fasta(df.coalesce(1), str(tmp_path / "o"), "id", "s", 3)
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")))
    assert text == ">a\nCC\n>b\nMKT\nAY\n"
    writers.write_table(df, str(tmp_path / "t"), ("s", "id"), "id")
    again = spark.read.parquet(str(tmp_path / "t"))
    writers.replace(again.where("id = 'a'"), str(tmp_path / "t"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [("CC", "a")]


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_large_samples_are_the_top_of_the_order(spark):
    """Equal to sorting all rows, for any number, with NULL priorities first, and without a limit in the plan."""
    rows = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("p"), F.lit("x").alias("rank"))
    h = pairs.hash_rank(9, "k")
    for n in (0, 1, 7, 999, 1000, 1001, 2500, 3000, 5000):
        want = [r.k for r in rows.orderBy(h, "k").limit(n).collect()]
        got = pairs.sample(rows, n, 9, "k")
        assert sorted(r.k for r in got.collect()) == sorted(want) and got.columns == rows.columns
        assert "Limit" not in got._jdf.queryExecution().toString()
    p = F.when(F.col("p") == 1, None).otherwise(F.col("p"))
    for n in (500, 1500, 2400):
        want = sorted(r.k for r in rows.orderBy(p.asc_nulls_first(), h, "k").limit(n).collect())
        assert sorted(r.k for r in pairs.sample_by_priority(rows, n, p, 9, "k").collect()) == want
        assert sorted(r.k for r in pairs.lowest(rows, n, F.desc("k")).collect()) == list(range(3000 - n, 3000))
    assert pairs.sample(rows.where("false"), 5, 1, "k").count() == pairs.lowest(rows.where("false"), 5, "k").count() == 0


def test_hanging_and_dying_models_cost_their_rows_only(spark):
    import time

    def factory():
        import os
        import time

        import numpy as np

        def model(texts):
            if any("hang" in t for t in texts):
                time.sleep(10**6)
            if any("die" in t for t in texts):
                os._exit(3)
            if any("bad" in t for t in texts):
                raise ValueError("no such letter")
            return [np.full((2, 3), float(len(t))) for t in texts]

        return model

    embeddings.register_extractor("unruly", 3, factory)
    rows = [(k, "x" * (k + 1)) for k in range(12)] + [(20, "hang"), (21, "die"), (22, "bad"), (23, "hang")]
    df = spark.createDataFrame(rows, "k long, t string").coalesce(1)
    began = time.monotonic()
    got = {r.k: r for r in embeddings.embed(df, "k", "t", "unruly", seconds=1.0).collect()}
    assert time.monotonic() - began < 60  # each of the few halves that hold a hanging text waits a second
    assert {k: r.error for k, r in got.items() if k < 20} == dict.fromkeys(range(12)) and list(got[4].vector) == [5.0] * 3
    assert "more than 1.0 seconds" in got[20].error and got[20].error == got[23].error
    assert "process ended" in got[21].error and "no such letter" in got[22].error and got[21].vector is None


def test_models_with_two_inputs(spark):
    import numpy as np

    from pairloom.functions import models

    said = lambda: lambda texts: [np.array([[0.0]] + [[float(ord(c))] for c in t] + [[0.0]]) for t in texts]
    residues = spark.createDataFrame([("a", "MKT"), ("b", "AC"), ("c", None), ("d", "W"), ("e", "A" * 2000)], "id string, sequence string")
    letters = spark.createDataFrame([("a", "DVp"), ("b", "ddd"), ("c", "v"), ("x", "v"), ("e", "d" * 1500)], "id string, sequence string")
    texts, counts = models.two_inputs("saprot", residues, letters)
    assert dict(map(tuple, texts.collect())) == {"a": "MdKvTp", "b": "AdCd", "e": "Ad" * 1024} and tuple(counts.first()) == (4, 1, 2, 1)
    tokens = spark.createDataFrame([("a", [5, 6, 7, 8]), ("d", [0])], "id string, sequence array<int>")
    texts, counts = models.two_inputs("prosst", residues, tokens)
    assert dict(map(tuple, texts.collect())) == {"a": "MKT\n1 8 9 10 2", "d": "W\n1 3 2"} and tuple(counts.first()) == (4, 2, 1, 0)
    embeddings.register_extractor("saprot", 1, said)
    try:
        got = {r.id: r.vector for r in embeddings.embed_by_model(residues, "id", "sequence", "saprot", structure=letters, seconds=30.0).collect()}
    finally:
        del embeddings.EXTRACTORS["saprot"]
    assert set(got) == {"a", "b", "e"} and abs(got["b"][0] - sum(map(ord, "AdCd")) / 4) < 1e-9


def test_structure_letters_handle_odd_matrices(spark):
    from pairloom.operators.convolution import structure_letters

    w = spark.createDataFrame([(0, 0, 0, 0, 1.0), (0, 1, 0, 1, 2.0), (0, 2, 1, 0, -1.0), (0, None, None, 1, 0.5), (1, 0, 0, 0, 1.0), (1, 0, 1, 1, 1.0)], "layer int, place int, input int, output int, value double")
    df = spark.createDataFrame([(1, [[1.0, 0.0], [5.0, 9.0], [0.0, 0.0]]), (2, []), (3, None), (4, [[1.0]]), (5, [[1.0, 2.0], None])], "k int, m array<array<double>>")
    got = dict(map(tuple, structure_letters(df, "k", "m", w, "ab").collect()))
    # Row 0: a = -9 -> 0, b = 2.5; row 1: a = 1, b = 10.5; row 2: a = 5, b = 0.5.
    assert got == {1: "bba", 2: "", 3: None, 4: None, 5: None}
    assert structure_letters(df.where("false"), "k", "m", w, "ab").count() == 0
    with pytest.raises(ValueError, match="each of 3 letters"):
        structure_letters(df, "k", "m", w, "abc")
    with pytest.raises(ValueError, match="odd number"):
        structure_letters(df, "k", "m", w.where("place is null or place < 2"), "ab")


def test_clusters_keep_no_more_than_the_texts(spark, tmp_path, monkeypatch):
    """What clustering writes is in proportion to the texts, not to their sets of shingles; copies and near copies still meet."""
    r = random.Random(3)
    own = ["".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=2000)) for _ in range(60)]
    rows = [(k, x) for k, x in enumerate([*own, own[0], own[1][:-20], "", None])]
    wrote = []
    monkeypatch.setattr(clusters, "written", lambda df, what, keep=clusters.written: wrote.append(keep(df, what)) or wrote[-1])
    got = dict(clusters.cluster(spark.createDataFrame(rows, "id long, s string").repartition(3), "id", "s", 0.8).collect())
    assert got == {k: {60: 0, 61: 1}.get(k, k) for k in range(64)}
    kept = sum(f.stat().st_size for x in wrote for f in Path(x._written.removeprefix("file:")).rglob("*.parquet"))
    assert kept < sum(map(len, own))


def test_models_are_called_with_few_texts(spark):
    """No call holds the matrices of many long texts; every row comes out once, whatever the limits."""

    def factory():
        def model(texts):
            if len(texts) > 1 and sum(map(len, texts)) > embeddings.MOST_UNITS or len(texts) > embeddings.MOST_ROWS:
                raise MemoryError("too many at once")
            return [np.full((len(t), 2), len(texts)) for t in texts]

        return model

    calls = embeddings.slices([1, 9, 1, 1, 1, 30, 2], 3, 10)
    assert list(calls) == [(0, 2), (2, 3), (5, 1), (6, 1)] and not list(embeddings.slices([]))
    embeddings.register_extractor("counts", 2, factory)
    sizes = [50_000] * 5 + [3] * 200 + [200_000]
    df = spark.range(len(sizes)).coalesce(1).withColumn("t", F.expr(f"repeat('x', array({', '.join(map(str, sizes))})[cast(id as int)])"))
    got = embeddings.embed(df, "id", "t", "counts").orderBy("id").collect()
    assert [r.error for r in got] == [None] * len(sizes)
    assert [r.vector[0] for r in got[:5]] == [1.0] * 4 + [64.0] and got[-1].vector == [1.0, 1.0]


def test_copies_are_searched_once(spark, monkeypatch):
    """Shingles of a sequence that many rows have are kept once, and every row of it is among the hits all the same."""
    texts = ["large ring and bolt", "large ring and bolts", "nothing of that kind"]
    rows = spark.createDataFrame([(k, texts[k % 3]) for k in range(300)], "id long, s string")
    wrote = []
    monkeypatch.setattr(clusters, "written", lambda df, what, keep=clusters.written: wrote.append(keep(df, what)) or wrote[-1])
    sides = rows.where("id % 10 = 0"), rows.where("id % 10 <> 0")
    got = {(r.query, r.target) for r in clusters.alike(*sides, "id", "s").collect()}
    like = lambda a, b: (a % 3 == 2) == (b % 3 == 2)
    assert got == {(a, b) for a in range(0, 300, 10) for b in range(300) if b % 10 and like(a, b)}
    assert sum(x.count() for x in wrote) < 120
    assert {r.target for r in clusters.alike_targets(*sides, "id", "s").collect()} == {b for _, b in got}


def test_runs_and_least_hashes_are_those_of_shingle_sets():
    """Sorted numbers stand for sets of shingles one to one; least hashes agree as often as sets overlap, whatever the letters."""
    r = random.Random(21)
    base = "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=1500))
    texts = [base, base[100:] + base[:100], base[:1000] + base[::-1][:500], "a\nb\0cd\nab" * 3, "é" * 9, "abcde", "abc", "\U0001f600b" * 20]
    runs = [clusters.runs_of(clusters.points(t)) for t in texts]
    sets = [clusters.shingle_set(t) for t in texts]
    assert [x is None for x in runs] == [False] * 5 + [True] * 3
    for x, a in zip(runs[:5], sets):
        assert len(x) == len(a) and all(len(np.intersect1d(x, y)) == len(a & b) for y, b in zip(runs[:5], sets))
    low = clusters.least_hashes([*texts, texts[3] + texts[3]], 400)
    assert (low[3] == low[8]).all() and (clusters.least_hashes(texts[6:7], 400) == low[6:7]).all()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert abs((low[i] == low[j]).mean() - len(a & b) / len(a | b)) < 0.1


def test_hits_are_named_from_short_lists(spark, monkeypatch):
    """Rows of a sequence that many have are joined as lists of bounded length and named last; a row without a key is named too."""
    rows = spark.createDataFrame([(k, "large ring and bolt") for k in range(3000)] + [(None, "large ring and bolt")], "id long, s string")
    wrote = []
    monkeypatch.setattr(clusters, "written", lambda df, what, keep=clusters.written: wrote.append((what, keep(df, what))) or wrote[-1][1])
    got = clusters.alike(rows.where("id < 100"), rows.where("id >= 100 or id is null"), "id", "s")
    assert got.count() == got.distinct().count() == 100 * 2901 and got.where("target is null").count() == 100
    assert got.columns == ["query", "target", "identity", "shared"]
    named = [df for what, df in wrote if what == "named"]
    assert len(named) == 1 and 10 <= named[0].count() < 40 and named[0].where(f"size(target) > 2 * {clusters.LISTED}").isEmpty()
