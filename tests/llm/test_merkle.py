import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pairloom.llm import merkle, queries

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def leaf(row, lower=False):
    text = row.text.translate({c: c + 32 for c in range(65, 91)}) if lower and row.text is not None else row.text
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def climb(digests, at=0):
    """The root, and the siblings of leaf `at` with its places."""
    path = []
    while len(digests) > 1:
        up = at // 8
        path.append((at % 8, [d for k, d in enumerate(digests) if k // 8 == up and k != at]))
        digests, at = [sha("".join(digests[k : k + 8])) for k in range(0, len(digests), 8)], up
    return digests[0], path


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id, leaf(r)))
    leaves = {g: [leaf(r) for r in groups[g]] for g in order}
    subroots = [climb(leaves[g])[0] for g in order]
    out = []
    for at, g in enumerate(order):
        root, upper = climb(subroots, at)
        for k, r in enumerate(groups[g]):
            path = climb(leaves[g], k)[1] + upper
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            own = leaf(r, bad)
            for place, others in path:
                own = sha("".join([*others[:place], own, *others[place:]]))
            out.append((str(r.doc_id), leaves[g][k], subroots[at], root, sha("".join(d for _, others in path for d in others)), own, own == root))
    return sorted(out)


@pytest.mark.parametrize("seed", range(30))
def test_mountains_of_any_stretches_make_the_tree(seed):
    r = random.Random(seed)
    fanout, n = r.choice([2, 3, 8]), r.choice([1, 2, 7, 8, 9, 64, 65, 200, 513])
    leaves = [sha(str(k)) for k in range(n)]
    cuts = sorted({0, n, *(r.randrange(n + 1) for _ in range(r.randint(0, 6)))})
    stretches = [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]
    r.shuffle(stretches)
    nodes = list(merkle.mountains((("g", k, leaves[k]) for s in stretches for k in s), fanout))
    want, level = {}, 0
    now = leaves
    while now:
        want |= {(level, k): d for k, d in enumerate(now)}
        now = [sha("".join(now[k : k + fanout])) for k in range(0, len(now) // fanout * fanout, fanout)]
        level += 1
    assert all(want[level, i] == d for _, level, i, d, _ in nodes) and len({(x[1], x[2]) for x in nodes}) == len(nodes)
    covered = sorted(k for _, level, i, _, open_ in nodes if open_ for k in range(i * fanout**level, (i + 1) * fanout**level))
    assert covered == list(range(n))  # the peaks cover each leaf once


def test_manifest_equals_brute_force(spark, corpus, empty):
    rows = [(k, f"Text {k} É", ["en", "de", None, "", "é", "z" + str(k % 7)][min(5, k % 40)], None if k % 9 == 0 else f"s{k % 3}", None if k % 5 == 0 else k) for k in range(2600)]
    rows += [(10**7 + k, "Big", "en", "s", 3) for k in range(700)] + [(5, "Twice", "en", "s", 1)] * 3 + [(5, None, "en", "s", 1), (None, "No id", "de", "s", 1), (None, "", "en", None, None)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("root", F.lit("clash")).withColumn("g", F.lit(1)).repartition(7)
    for docs in (corpus, more, more.where("lang = 'de'"), more.where("doc_id = 1"), more.where("lang is null or doc_id > 2590")):
        found = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
        got = sorted((str(r.doc_id), *r[1:]) for r in merkle.manifest_report(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())
        assert got == brute(found)
    assert merkle.manifest_report(empty).count() == 0
    assert 0 < sum(x[-1] for x in got) < len(got)


def test_nodes_are_all_there_and_fanout_is_a_parameter(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.col("id").cast("string").alias("text")).repartition(5)
    m = merkle.Manifest(docs, F.col("lang"), F.col("doc_id"), F.sha2("text", 256), fanout=3)
    nodes = {(r.level, r.i): r.digest for r in m.nodes.collect()}
    now, want, level = [sha(str(k)) for k in range(1000)], {}, 0
    while len(now) > 1:
        now, level = [sha("".join(now[k : k + 3])) for k in range(0, len(now), 3)], level + 1
        want |= {(level, k): d for k, d in enumerate(now)}
    assert nodes == want and m.root == now[0]
    back = m.proofs().select(merkle.folded(F.col("leaf.digest"), F.col("path")).alias("root")).distinct().collect()
    assert [r.root for r in back] == [m.root]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op12_merkle_manifest"])
    got = queries.QUERIES["op12_merkle_manifest"](spark, sf)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall()) and sorted(got.columns) == sorted(want.columns)
