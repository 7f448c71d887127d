"""Readers, sinks, splits and collections over files that the queries write from the tables to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import sequences as S
from pairloom.operators.tables import scratch, written
from pairloom.plans import collections, split
from pairloom.plans.registry import RAW_PAIRS, load, query, raw_pairs
from pairloom.sources import readers, writers


def _letters(spark: SparkSession, sf_dir: str, table: str = "documents", key: str = "doc_id") -> DataFrame:
    return load(spark, sf_dir, table).select(F.col(key), S.letters_only(F.coalesce("text", F.lit(""))).alias("s"))


_LETTERS = "(select doc_id, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', '', 'g')) as s from documents)"


@query(f"""select 'D' || lpad((doc_id // 2)::varchar, 12, '0') as id, md5(arg_max(s, doc_id)) as last, md5(arg_min(s, doc_id)) as first, count(*) as n from {_LETTERS} group by 1""")
def fasta_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as wrapped FASTA, two records of an id; read back with the last, with the first, and all of them."""
    k = F.lpad(F.floor(F.col("doc_id") / 2).cast("string"), 12, "0")
    at = F.lpad(F.col("doc_id").cast("string"), 20, "0")
    header = F.when(k.substr(12, 1).isin(*"02468"), F.concat(F.lit("x|D"), k, F.lit("|"), at)).otherwise(F.concat(F.lit("D"), k, F.lit(" "), at))
    path = scratch(spark, "records") + ".fasta"
    writers.write_fasta(_letters(spark, sf_dir).select(header.alias("h"), "s"), path, "h", "s", 60)
    x = readers.read_fasta(spark, path)
    last, first = (readers.fasta_map(x, last=f).select("id", F.md5("sequence").alias(n)) for f, n in ((True, "last"), (False, "first")))
    return last.join(first, "id").join(x.groupBy(readers.fasta_id(F.col("header")).alias("id")).agg(F.count("*").alias("n")), "id")


@query("""select 'P' || l_partkey as id_1, 'S' || l_suppkey as id_2, (l_returnflag = 'A')::int as label, count(*) as n from lineitem where l_linenumber <> 2 group by 1, 2, 3""")
def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in lines between white space, a file for each label; lines of one field go."""
    a, b, k = F.concat(F.lit("P"), "l_partkey"), F.concat(F.lit("S"), "l_suppkey"), F.col("l_linenumber")
    line = F.when(k == 1, F.concat(a, F.lit("  "), b)).when(k == 2, a).when(k == 3, F.concat(F.lit(" "), a, F.lit("\t"), b, F.lit(" more "))).otherwise(F.concat_ws(" ", a, b))
    out = None
    for label, chosen in ((1, "l_returnflag = 'A'"), (0, "l_returnflag <> 'A'")):
        path = scratch(spark, "lines")
        load(spark, sf_dir, "lineitem").where(chosen).select(line.alias("value")).write.text(path)
        x = readers.read_pair_text(spark, path, label)
        out = x if out is None else out.unionByName(x)
    return out.groupBy("id_1", "id_2", "label").agg(F.count("*").alias("n"))


@query("""select 'P' || l_partkey as id_1, 'S' || l_suppkey as id_2, (l_linenumber <> 1)::int as label, count(*) as n from lineitem where l_linenumber <> 5 group by 1, 2, 3""")
def pair_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs between tabs without a header; only 0 and 1 in a third field are labels, and a line of one field is none."""
    k = F.col("l_linenumber")
    fields = F.array_compact(F.array(F.concat(F.lit("P"), "l_partkey"), F.when(k != 5, F.concat(F.lit("S"), "l_suppkey", F.lit(" "))), F.when(k == 1, "0").when(k == 2, "1").when(k == 3, "x")))
    path = scratch(spark, "fields")
    load(spark, sf_dir, "lineitem").select(F.array_join(fields, "\t").alias("value")).write.text(path)
    return readers.read_pair_tsv(spark, path).groupBy("id_1", "id_2", "label").agg(F.count("*").alias("n"))


@query("""select 'M' || (o_orderkey // 3) as member, 'C' || arg_min(o_custkey, o_orderkey) as cluster from orders where o_orderkey % 50 <> 0 group by 1""")
def cluster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster maps of several files: a member's first line in the order of files and lines counts."""
    k = F.col("o_orderkey")
    line = F.when(k % 50 == 0, "alone").otherwise(F.concat(F.lit("C"), "o_custkey", F.lit("\tM"), F.floor(k / 3)))
    path = scratch(spark, "clusters")
    load(spark, sf_dir, "orders").orderBy(k).select(line.alias("value")).write.text(path)
    return readers.read_clusters(spark, path)


_FIELDS = """select o_orderkey::varchar as a, case o_orderkey % 5 when 0 then 'NA' when 3 then 'say "x", y' when 4 then ' plain' end as b, o_orderstatus as c from orders"""


@query(f"""select 'csv' as format, b, a from ({_FIELDS}) union all select 'tsv', b, a from ({_FIELDS}) where c <> 'F'""")
def delimited_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in two appended parts and TSV, read back as text: NA stays, only the empty field is NULL; columns by name."""
    k = F.col("o_orderkey")
    b = F.when(k % 5 == 0, "NA").when(k % 5 == 1, "").when(k % 5 == 3, 'say "x", y').when(k % 5 == 4, " plain")
    x = load(spark, sf_dir, "orders").select(k.alias("a"), b.alias("b"), F.col("o_orderstatus").alias("c"))
    csv, tsv = scratch(spark, "fields") + ".csv", scratch(spark, "fields") + ".tsv"
    writers.write_delimited(x.where("c = 'F'"), csv, ("a", "b", "c"), key="a")
    writers.write_delimited(x.where("c <> 'F'"), csv, ("a", "b", "c"), append=True)
    writers.write_delimited(x.where("c <> 'F'"), tsv, ("c", "b", "a"), "\t")
    return readers.read_delimited(spark, csv, ["b", "a"]).select(F.lit("csv").alias("format"), "b", "a").unionByName(readers.read_delimited(spark, tsv, ["b", "a"]).select(F.lit("tsv").alias("format"), "b", "a"))


@query("""select o_orderkey, o_orderstatus, o_custkey + 1 as o_custkey, false as late from orders where o_orderkey % 2 = 0 union all select o_orderkey, o_orderstatus, o_custkey, true from orders where o_orderkey % 2 = 1""")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced by rows made of itself, then fed with rows of which it has some, twice."""
    path = scratch(spark, "table")
    x = load(spark, sf_dir, "orders").withColumn("late", F.lit(False))
    writers.write_table(x, path, ("o_orderkey", "o_orderstatus", "o_custkey", "late"), "o_orderkey")
    writers.replace(spark.read.parquet(path).where("o_orderkey % 2 = 0").withColumn("o_custkey", F.col("o_custkey") + 1), path)
    for _ in range(2):
        writers.append_new(x.select("o_orderkey", "o_orderstatus", "o_custkey", F.lit(True).alias("late")), path, "o_orderkey")
    return readers.read_parquet(spark, path, "o_orderkey", "o_orderstatus", "o_custkey", "late")


@query("""with w as (select item_id, list_filter(string_split(text, ' '), lambda x: x <> '') as w from benchmark where text is not null), x as (select 'words' as fold, unnest(w) as item from w union all select 'ends', unnest([w[1], w[-1]]) from w where len(w) > 0)
select fold, item, count(*) as n from x group by 1, 2""")
def json_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON file with lists by name for each item, written one by one, their lists read as rows."""
    w = F.filter(F.split("text", " "), lambda x: x != "")
    ends = F.when(F.size(w) > 0, F.array(F.element_at(w, 1), F.element_at(w, -1))).otherwise(F.array().cast("array<string>"))
    folder = scratch(spark, "folds")
    body = F.to_json(F.struct(F.create_map(F.lit("words"), w, F.lit("ends"), ends).alias("folds")))
    writers.write_each(load(spark, sf_dir, "benchmark").where("text is not null"), folder, F.concat("item_id", F.lit(".json")), body)
    return readers.read_json_folds(spark, folder).groupBy("fold", "item").agg(F.count("*").alias("n"))


_STANDARD = "".join(readers.RESIDUES.values())


@query(f"""with x as (select item_id, unnest(string_split(upper(regexp_replace(text, '[^A-Za-z]+', '', 'g')), '')) as c, unnest(range(length(upper(regexp_replace(text, '[^A-Za-z]+', '', 'g'))))) as p from benchmark where regexp_matches(text, '[A-Za-z]'))
select item_id || '.pdb' as name, chr((65 + p // 9999)::int) as chain, string_agg(c, '' order by p) as sequence from x where contains('{_STANDARD}', c) group by 1, 2""")
def structure_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A structure file for each item with a residue for each letter and a second model; chains of the first are read back."""
    known = F.create_map(*(F.lit(x) for name, letter in readers.RESIDUES.items() for x in (letter, name)))
    letters = F.filter(F.split("s", ""), lambda c: c != "")
    line = lambda c, k: F.format_string("ATOM  %5d  CA  %s %s%4d       0.0     0.0     0.0", k % 100000, F.coalesce(known[c], F.lit("UNK")), F.char(65 + F.floor(k / 9999)), k % 9999 + 1)
    last = F.array(F.lit("ENDMDL"), line(F.lit("W"), F.lit(0)))
    folder = scratch(spark, "structures")
    x = _letters(spark, sf_dir, "benchmark", "item_id").where("s <> ''")
    writers.write_each(x, folder, F.concat("item_id", F.lit(".pdb")), F.array_join(F.concat(F.transform(letters, line), last), "\n"))
    return readers.read_structures(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "chain", "sequence")


@query(f"""with x as (select doc_id, s from {_LETTERS} where s <> '')
select 'D' || doc_id as id, md5(s) as sequence_md5, 'one' as source from x where doc_id % 3 = 0 union all select 'D' || doc_id, md5(s), 'two' from x where doc_id % 3 = 1
union all select 'D' || doc_id, md5(s), 'three' from x where doc_id % 3 = 2 union all select 'E' || doc_id, md5(reverse(s)), 'three' from x where doc_id % 3 = 2""")
def sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences from FASTA, a table of them, and a table of pairs, each read by what its file is."""
    x = _letters(spark, sf_dir).where("s <> ''").select("doc_id", F.concat(F.lit("D"), "doc_id").alias("id"), F.col("s").alias("sequence"))
    one, two, three = scratch(spark, "s") + ".fasta", scratch(spark, "s") + ".csv", scratch(spark, "s") + ".csv"
    writers.write_fasta(x.where("doc_id % 3 = 0"), one, "id", "sequence", 80)
    writers.write_delimited(x.where("doc_id % 3 = 1").select("sequence", F.col("id").alias("ID")), two)
    writers.write_delimited(x.where("doc_id % 3 = 2").select(F.col("id").alias("id_1"), F.concat(F.lit("E"), "doc_id").alias("id_2"), F.col("sequence").alias("sequence_1"), F.reverse("sequence").alias("sequence_2")), three)
    out = None
    for path, name in ((one, "one"), (two, "two"), (three, "three")):
        y = readers.sequence_source(readers.read_sequences(spark, path), name).select("id", "sequence_md5", "source")
        out = y if out is None else out.unionByName(y)
    return out


@query("""select item_id || '.npy' as name, case when item_id % 3 = 0 then 'new' else 'old' end as folder, 128 + 4 * least(length(text), 40) as length from benchmark where text is not null""")
def vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NumPy file for each item, some in two folders: listed, and of a name in both the first folder's is kept."""
    top = scratch(spark, "vectors")
    numbers = F.transform(F.slice(F.filter(F.split("text", ""), lambda c: c != ""), 1, 40), lambda c: F.ascii(c).cast("float"))
    x = load(spark, sf_dir, "benchmark").where("text is not null").select("item_id", numbers.alias("v"))
    for folder, rows in (("new", x.where("item_id % 3 = 0")), ("old", x)):
        writers.write_each(rows, f"{top}/{folder}", F.concat("item_id", F.lit(".npy")), writers.npy_bytes("v"))
    listing = readers.list_files(spark, top, "*.npy")
    kept = collections.kept_vectors({"m": (f"{top}/new", f"{top}/old")}, "m", listing)
    return kept.join(listing.select("path", "length"), "path").select("name", F.element_at(F.split("path", "/"), -2).alias("folder"), "length")


_SPLIT = f"""with {RAW_PAIRS}, p as (select a, b, max(label) as label from canon where a <> b group by 1, 2),
n as (select a, b, label, substr(a, 3)::int as x, substr(b, 3)::int as y from p),
held as (select case when y % 97 = 0 then 'val' else 'test' end as part, a, b, label from n where x % 10 = 0 and y % 97 in (0, 1)),
ends as (select a as id from held where label = 1 union select b from held where label = 1),
ids as (select a as id from p union select b from p), bad as (select id from ids where substr(id, 3)::int // 4 in (select substr(id, 3)::int // 4 from ends))"""


def _split(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    x = raw_pairs(spark, sf_dir).where("a <> b").select(F.least("a", "b").alias("ID_1"), F.greatest("a", "b").alias("ID_2"), "label", "source")
    # Every step of the split reads the pairs again, so they are made once.
    pairs = written(x.groupBy("ID_1", "ID_2").agg(F.max("label").alias("label"), F.max("source").alias("PPI_Source")), "pairs")
    number = lambda c: F.substring(c, 3, 7).cast("int")
    val, test = (pairs.where((number("ID_1") % 10 == 0) & (number("ID_2") % 97 == k)).select("ID_1", "ID_2", "label") for k in (0, 1))
    ids = written(pairs.select(F.explode(F.array("ID_1", "ID_2")).alias("id")).distinct(), "ids")
    clusters = ids.select(F.col("id").alias("member"), F.floor(number("id") / 4).alias("cluster"))
    return split.split(pairs, clusters, ids.withColumn("sequence", F.col("id")), split.Sizes(), 1, val, test)


@query(f"""{_SPLIT} select part, a as ID_1, b as ID_2, label from held union all select 'train', a, b, label from p where label = 1 and a not in (select id from bad) and b not in (select id from bad) and (a, b) not in (select (a, b) from held)""")
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given holdouts and the training pairs that share no cluster with their positives."""
    out = _split(spark, sf_dir)
    x = [out[n].select(F.lit(n).alias("part"), "ID_1", "ID_2", "label") for n in ("val", "test", "train")]
    return x[0].unionByName(x[1]).unionByName(x[2])


@query(f"""{_SPLIT}, train as (select a, b from p where label = 1 and a not in (select id from bad) and b not in (select id from bad) and (a, b) not in (select (a, b) from held)),
used as (select a as id from held union select b from held union select a from train union select b from train)
select id as member, id in (select id from ends) as is_positive_holdout, id in (select id from bad) as is_tainted, id in (select id from used) as is_used from ids""")
def split_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged cluster map of that split, and which sequences it uses."""
    out = _split(spark, sf_dir)
    used = out["sequences"].select(F.col("id").alias("member"), F.lit(True).alias("u"))
    return out["clusters"].join(used, "member", "left").select("member", "is_positive_holdout", "is_tainted", F.coalesce("u", F.lit(False)).alias("is_used"))


@query(f"""with x as (select doc_id, md5(s) as m from {_LETTERS} where s <> ''), l as (select l.doc_id, l.quality::int as label, a.m as ID_1, b.m as ID_2 from labels l join x a on a.doc_id = l.doc_id join x b on b.doc_id = l.doc_id - l.doc_id % 10)
select 'train' as part, ID_1, ID_2, label from l where doc_id % 4 <> 0 union all select 'test_far', ID_1, ID_2, label from l where doc_id % 4 = 0 union all select 'test', ID_1, ID_2, label from l where doc_id % 4 = 0""")
def collection_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection's pairs by content, of ids that come from two sources; the primary test stands there twice."""
    s = _letters(spark, sf_dir).where("s <> ''").select("doc_id", F.concat(F.lit("D"), "doc_id").alias("id"), F.lower("s").alias("sequence"))
    sources = {"even": s.where("doc_id % 2 = 0"), "odd": s.where("doc_id % 2 = 1")}
    x = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("id_1"), (F.col("doc_id") - F.col("doc_id") % 10).alias("id_2"), F.col("quality").cast("int").alias("label"))
    have = written(s.select("doc_id", "id"), "ids")
    known = x.join(have.select(F.col("doc_id").alias("id_1"), F.col("id").alias("one")), "id_1").join(have.select(F.col("doc_id").alias("id_2"), F.col("id").alias("two")), "id_2")
    pairs = written(known.select(F.col("id_1").alias("at"), F.col("one").alias("ID_1"), F.col("two").alias("ID_2"), "label"), "pairs")
    tables = {"train": pairs.where("at % 4 <> 0").drop("at"), "test_far": pairs.where("at % 4 = 0").drop("at")}
    out = collections.built(collections.Collection("labelled", ("even", "odd"), {"train": "train.csv", "test_far": "test_far.csv"}, "test_far"), sources, tables)
    rows = [out[n].select(F.lit(n).alias("part"), "ID_1", "ID_2", "label") for n in ("train", "test_far", "test")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""select 'small' as model, d.doc_id as id from documents d where d.doc_id not in (select vec_id from embeddings) union all select 'labelled', doc_id from documents where doc_id not in (select doc_id from labels)""")
def vectors_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a model has no vector for, by model."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("").alias("sequence"))
    have = {"small": load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")), "labelled": load(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))}
    return collections.missing_vectors(docs, have).select("model", "id")


def _known(batch: list[str]) -> dict[str, str]:
    return {i: i[::-1] for i in batch if not i.endswith("7")}


@query("""select 'C' || c_custkey as id, reverse('C' || c_custkey) as value from customer where c_custkey % 10 <> 7""")
def records_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all customers by the batched source, half of them asked for before the rest; negative answers are kept."""
    cache = scratch(spark, "cache")
    ids = load(spark, sf_dir, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"), "c_custkey")
    readers.fetch_missing(ids.where("c_custkey % 2 = 0"), "id", cache, _known, ask_again=False)
    return readers.fetch_missing(ids, "id", cache, _known, ask_again=False)
