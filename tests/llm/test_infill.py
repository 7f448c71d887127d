import hashlib
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from pairloom.llm import infill, queries

SPACES = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("units", sorted(infill.UNITS))
def test_borders_cut_as_the_grammar_does(spark, units):
    r = random.Random(3)
    texts = [" ", "a", " a", "a ", "\n\n", "😀 a😀😀 \n b", "x\ny", "é b c\x1c d", "é    "]
    texts += ["".join(r.choice(SPACES + "ab😀é\x1c\x85 ") for _ in range(r.randint(1, 60))) for _ in range(400)]
    got = spark.createDataFrame(list(enumerate(texts)), "k long, t string").select("k", F.split("t", infill.border(units), -1).alias("u")).collect()
    grammar = re.compile(infill.UNITS[units][0])
    assert {x.k: x.u for x in got} == {k: grammar.findall(t) for k, t in enumerate(texts)}


def brute(doc, text):
    text = text or ""
    u = re.findall("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    lo, hi = sorted((a % (len(u) + 1), b % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return len(u), "plain", None, None, text
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if d % 100 < 80 else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_documents_equal_brute_force_and_come_back(spark, corpus, empty):
    odd = ["<P>", "a <S> b", "<", "<P <S <M >", "a<P", ">S> <", "\n" * 50, "😀 " * 400, "<M", " "]
    rows = [(10**6 + 97 * k + j, t) for j, t in enumerate(odd) for k in range(40)] + [(None, "a b c"), (None, None)]
    more = spark.createDataFrame(rows, "doc_id long, text string").withColumn("prefix", F.lit("clash")).withColumn("n", F.lit(-1))
    for docs in (corpus, more):
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = sorted((str(r.doc_id), *(b := brute(r.doc_id, r.text))[:4], sha(b[4]), sha(r.text or "")) for r in docs.collect())
        got = sorted((str(r.doc_id), *r[1:]) for r in infill.infill_report(docs).collect())
        assert list(map(str, got)) == list(map(str, want))
    assert {r.form for r in infill.fill_in_middle(more).collect()} == {"plain", "spm", "psm"}
    assert infill.infill_report(empty).count() == 0


def test_rates_and_marks_are_parameters(spark, corpus):
    own = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
    x = infill.fill_in_middle(corpus, units="line", seed=7, percent=100, spm_percent=0, marks=own)
    x = x.withColumn("back", infill.restored(F.col("output"), F.col("form"), own)).join(corpus.select("doc_id", "text").distinct(), "doc_id").collect()
    assert all(r.back == (r.text or "") and r.form == ("psm" if r.text else "plain") for r in x)
    for marks in (("<P>", "<P>", "<M>"), ("ab", "bc", "d"), ("aXa", "b", "c"), ("", "b", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError, match="run into"):
            infill.check_marks(marks)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{os.path.join(sf, 'documents.parquet')}'")
    want = con.sql(queries.ORACLE_SQL["op11_fill_in_middle"])
    got = queries.QUERIES["op11_fill_in_middle"](spark, sf)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall()) and sorted(got.columns) == sorted(want.columns)
