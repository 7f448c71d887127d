import random

import corpus_pipeline
from pairloom.llm import quality, simhash


def test_stages_and_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_end_to_end(spark, tmp_path):
    """Junk, copies, near copies and leaks go; each clean document stays and is packed once."""
    rng = random.Random(6)
    words = ["".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randint(2, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    clean = {k: "\n".join(prose(20) for _ in range(6)) for k in range(30)}
    item = prose(40)
    one_line = prose(150)
    near = one_line.split(" ")
    near[70] = "changed"
    rows = [*clean.items(), (100, clean[3]), (101, "spam again " * 100), (102, "short"), (103, f"{prose(80)} {item} {prose(60)}"), (104, one_line), (105, " ".join(near)), (106, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    schema, left = docs.schema, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == schema
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        left.append({r.doc_id for r in docs.collect()})
    assert left[0] == set(clean) | {100, 103, 104, 105}
    assert left[1] == set(clean) | {103, 104, 105}
    assert left[2] == set(clean) | {103, 104}
    assert left[3] == set(clean) | {104}
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} == left[3]
    assert quality.keep_quality(docs).count() == len(left[3])
    assert simhash.drop_near_duplicates(docs).count() == len(left[3])


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
