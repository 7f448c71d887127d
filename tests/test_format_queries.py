"""Files read in many parts equal the same files read in one."""

import pytest

from pairloom.plans import format_queries
from pairloom.sources import readers, writers


@pytest.fixture
def small_parts(spark):
    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield set_to
    for k, v in was.items():
        spark.conf.set(k, v)


def test_records_are_the_same_in_one_part_and_in_many(spark, tmp_path, small_parts):
    rows = [(f"h{k // 2:04d} {k:05d}", "ACDEFGHIKL" * (k % 40) + "W" * (k % 7)) for k in range(600)]
    path = f"{tmp_path}/x.fasta"
    spark_rows = spark.createDataFrame(rows, "h string, s string")
    writers.write_fasta(spark_rows.coalesce(1), path, "h", "s", 60)
    small_parts(1 << 30)
    one = readers.read_fasta(spark, path)
    want = sorted((r.header, r.sequence) for r in one.collect())
    last = dict(map(tuple, readers.fasta_map(one).collect()))
    assert want == sorted(rows) and last == {h.split()[0]: s for h, s in rows}
    for size in (997, 8192, 20000):
        small_parts(size)
        x = readers.read_fasta(spark, path)
        assert x.rdd.getNumPartitions() >= (16 if size < 10000 else 5)
        assert sorted((r.header, r.sequence) for r in x.collect()) == want
        assert dict(map(tuple, readers.fasta_map(x).collect())) == last
        assert dict(map(tuple, readers.fasta_map(x, last=False).collect())) == {h.split()[0]: s for h, s in reversed(rows)}


def test_clusters_take_the_first_line_in_many_parts(spark, tmp_path, small_parts):
    (tmp_path / "c.tsv").write_text("".join(f"r{k}\tm{k % 50}\n" for k in range(3000)))
    want = {f"m{k}": f"r{k}" for k in range(50)}
    for size in (1 << 30, 1000):
        small_parts(size)
        assert dict(map(tuple, readers.read_clusters(spark, f"{tmp_path}/c.tsv").collect())) == want


def test_queries_read_what_they_write_in_many_parts(spark, small_parts):
    sf = "/root/testdata/sf0.001"
    for query in (format_queries.fasta_records, format_queries.cluster_lines):
        got = []
        for size in (1 << 30, 4000):
            small_parts(size)
            got.append(sorted(map(tuple, query(spark, sf).collect())))
        assert got[0] == got[1] and got[0]


def test_white_space_around_fields_stays(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None), ("", "b\\c"), ('q"', ' "x"')], "x string, y string")
    writers.write_delimited(df, f"{tmp_path}/t.csv")
    assert sorted(map(str, map(tuple, readers.read_delimited(spark, f"{tmp_path}/t.csv").collect()))) == sorted(map(str, [(" a ", None), (None, "b\\c"), ('q"', ' "x"')]))
