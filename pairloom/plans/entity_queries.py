"""Queries on entities: normalisation, hashing, registry, matching, contract rules, vectors, formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import sequences as S
from pairloom.operators import contract as C
from pairloom.operators import embeddings as V
from pairloom.operators import entities as N
from pairloom.operators import matching as M
from pairloom.operators import pairs as P
from pairloom.operators.splits import tainted_members
from pairloom.plans.registry import load, query

# DuckDB forms of the normalisers. upper() differs on the sharp s, so both sides upper-case what is left of ASCII letters
# or replace it first.
_LETTERS = "upper(regexp_replace({}, '[^A-Za-z]', '', 'g'))"
_SHARP = "replace({}, 'ß', 'ss')"
_NO_SPACE = r"regexp_replace(upper(" + _SHARP + r"), '\s+', '', 'g')"


def _text() -> Column:
    return F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))


@query(f"""select doc_id, md5({_LETTERS.format('text')}) as contract, md5({_NO_SPACE.format('text')}) as split,
  'hp_' || left(md5(upper({_SHARP.format("regexp_replace(text, '^\\s+|\\s+$', '', 'g')")})), 16) as host, md5(replace({_NO_SPACE.format('text')}, '*', '')) as structure,
  md5(regexp_replace({_NO_SPACE.format('text')}, '\\*+$', '')) as corpus from documents""")
def sequence_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _text()
    return load(spark, sf_dir, "documents").select("doc_id", S.content_md5(F.col("text")).alias("contract"), F.md5(S.no_space(t)).alias("split"), S.short_id(t).alias("host"), F.md5(S.no_space_no_stops(t)).alias("structure"), F.md5(S.no_space_no_stop(t)).alias("corpus"))


@query(f"""select doc_id, regexp_replace(upper({_SHARP.format('text')}), '[^ACDEFGHIKLMNPQRSTVWY]', 'X', 'g') as standard, left(translate(upper({_SHARP.format('text')}), 'UZOB', 'XXXX'), {S.MODEL_LENGTH}) as rare,
  left(replace(replace(translate(upper({_SHARP.format('text')}), 'UO', 'CK'), '-', ''), '.', ''), {S.MODEL_LENGTH}) as gapless from documents""")
def model_alphabets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models' alphabets; the last two are cut to the models' own maximum length."""
    t = _text()
    return load(spark, sf_dir, "documents").select("doc_id", S.standard_only(t).alias("standard"), S.rare_to_x(t, S.MODEL_LENGTH).alias("rare"), S.gapless(t, S.MODEL_LENGTH).alias("gapless"))


@query(f"""select md5({_LETTERS.format('text')}) as md5, min(doc_id) as first_doc, count(*) as n_docs, length({_LETTERS.format('arg_min(text, doc_id)')}) as length
  from documents where {_LETTERS.format('text')} <> '' group by 1""")
def sequence_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents").select("doc_id", S.letters_only(F.col("text")).alias("sequence")).where("sequence <> ''")
    return x.groupBy(F.md5("sequence").alias("md5")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_docs"), F.length(F.min_by("sequence", "doc_id")).cast("long").alias("length"))


_REGISTRY = f"""with rows as (select 'u' || (doc_id % 700) as source_id, md5({_LETTERS.format('text')}) as md5, doc_id as pos from documents where doc_id >= 100),
m as (select printf('FP%07d', doc_id + 1) as fpid, md5({_LETTERS.format('text')}) as md5, 'u' || (doc_id * 3) || ';v' || doc_id as original_ids, doc_id as pos from documents where doc_id < 100),
alias as (select source_id, arg_max(fpid, pos * 10 + k) as fpid from (select trim(unnest(string_split(original_ids, ';'))) as source_id, unnest([0, 1]) as k, fpid, pos from m) group by 1),
f as (select source_id, arg_min(md5, pos) as md5, min(pos) as pos from rows where source_id not in (select source_id from alias) group by 1),
known as (select md5, arg_max(fpid, pos) as fpid from m group by 1),
nw as (select md5, min(pos) as p from f where md5 not in (select md5 from known) group by 1),
mint as (select md5, printf('FP%07d', 100 + row_number() over (order by p)) as fpid from nw)"""


def _registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, sf_dir, "documents")
    key = S.content_md5(F.col("text")).alias("md5")
    master = docs.where("doc_id < 100").select(S.public_id(F.col("doc_id") + 1).alias("fpid"), key, F.concat(F.lit("u"), F.col("doc_id") * 3, F.lit(";v"), F.col("doc_id")).alias("original_ids"), F.col("doc_id").alias("pos"))
    rows = docs.where("doc_id >= 100").select(F.concat(F.lit("u"), F.col("doc_id") % 700).alias("source_id"), key, F.col("doc_id").alias("pos"))
    return N.register(master, rows)


@query(f"{_REGISTRY} select source_id, fpid from alias union all select f.source_id, coalesce(k.fpid, n.fpid) from f left join known k on k.md5 = f.md5 left join mint n on n.md5 = f.md5")
def registry_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir)[0]


@query(f"""{_REGISTRY}, got as (select f.source_id, f.pos, coalesce(k.fpid, n.fpid) as fpid, k.fpid is null as is_new from f left join known k on k.md5 = f.md5 left join mint n on n.md5 = f.md5)
select fpid, coalesce((select original_ids || ';' from m where m.fpid = got.fpid), '') || string_agg(source_id, ';' order by pos) as original_ids, bool_or(is_new) as is_new from got group by fpid""")
def registry_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir)[1].select("fpid", "original_ids", "is_new")


@query("select text, array_to_string(list_sort(list_distinct(list(source))), ';') as sources, array_to_string(list_sort(list_distinct(list(lang))), ';') as roles, count(*) as n from documents group by text having count(*) > 1")
def sources_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    groups = N.by_content(docs, "text", "doc_id", P.joined_distinct(F.col("source")).alias("sources"), P.joined_distinct(F.col("lang")).alias("roles"), F.count("*").alias("n")).where("n > 1")
    return N.with_text(groups, docs, "text", "doc_id")


@query("select source, doc_id, n_chars from (select *, row_number() over (partition by source order by n_chars desc, doc_id) as r from documents) where r = 1")
def canonical_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.longest(load(spark, sf_dir, "documents"), "source", "n_chars", "doc_id")


@query("select text as value, count(distinct source) as n_values from documents group by text having count(distinct source) > 1")
def conflict_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    groups = N.by_content(docs, "text", "doc_id", F.size(F.collect_set("source")).cast("long").alias("n_values")).where("n_values > 1")
    return N.with_text(groups, docs, "text", "doc_id").withColumnRenamed("text", "value")


@query(r"""with t as (select conv_id, turn, list_distinct(list_filter(list_transform(string_split(replace(coalesce(text, ''), '.', ';'), ';'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) as toks from conversations)
select conv_id, turn, len(toks) as n_tokens, array_to_string(list_sort(toks), ';') as tokens from t""")
def token_set_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = S.tokens(F.replace(F.coalesce("text", F.lit("")), F.lit("."), F.lit(";")))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(toks).cast("long").alias("n_tokens"), F.array_join(F.array_sort(toks), ";").alias("tokens"))


@query(f"""with c as (select doc_id, md5({_LETTERS.format('text')}) as cluster from documents),
touched as (select cluster from c where doc_id in (select doc_id from labels where toxic = 1))
select doc_id from c where cluster not in (select cluster from touched)""")
def cluster_taint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    clusters = docs.select("doc_id", S.content_md5(F.col("text")).alias("cluster"))
    bad = tainted_members(clusters, load(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id", "cluster")
    return P.exclude_endpoints(docs.select("doc_id"), bad, "doc_id")


_ALIASES = "[doc_id * 7 % 1500, doc_id * 5 % 1500, doc_id]"


@query(f"""with a as (select doc_id, unnest({_ALIASES}) as alias, unnest([0, 1, 2]) as at from documents)
select a.doc_id, min(a.at)::int as at, arg_min(l.quality, a.at) as quality from a join labels l on l.doc_id = a.alias group by 1""")
def first_alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id")
    aliases = F.array(F.col("doc_id") * 7 % 1500, F.col("doc_id") * 5 % 1500, F.col("doc_id"))
    return M.first_alias(docs, "doc_id", aliases, load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "alias"), "alias", "quality")


@query("""select d.doc_id, coalesce(l.quality, b.item_id % 2) as value, case when l.quality is not null then 'first' when b.item_id is not null then 'second' end as matched_by
from documents d left join labels l on l.doc_id = d.doc_id left join benchmark b on b.item_id = d.doc_id % 300""")
def fallback_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 300).alias("item_id"))
    one = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("value"))
    two = load(spark, sf_dir, "benchmark").select("item_id", (F.col("item_id") % 2).alias("value"))
    return M.fallback(docs, ("doc_id", one), ("item_id", two), "value").select("doc_id", "value", "matched_by")


@query(f"""with t as (select doc_id, md5({_LETTERS.format('text')}) as md5 from documents), lib as (select md5, min(doc_id) as first_doc from t where doc_id % 2 = 0 group by 1)
select t.doc_id, lib.first_doc, case when t.doc_id = lib.first_doc + 1 then 'neighbour' else 'content' end as match_type from t join lib using (md5) where t.doc_id % 2 = 1""")
def content_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "documents").select("doc_id", S.content_md5(F.col("text")).alias("md5"))
    lib = t.where("doc_id % 2 = 0").groupBy("md5").agg(F.min("doc_id").alias("first_doc"))
    x = t.where("doc_id % 2 = 1").join(lib, "md5")
    return x.select("doc_id", "first_doc", F.when(F.col("doc_id") == F.col("first_doc") + 1, "neighbour").otherwise("content").alias("match_type"))


@query("select count(*) as n_needed, count(l.doc_id) as n_present, count(*) - count(l.doc_id) as n_missing, count(l.doc_id) / count(*) as ratio from documents d left join labels l using (doc_id)")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.coverage(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id")


@query("select doc_id from documents where doc_id not in (select doc_id from labels) order by doc_id limit 10")
def coverage_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.missing(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), "doc_id")


@query("""with e as (select user_id, count(*) as n from events where event_type = 'purchase' group by 1)
select o.o_orderkey, case when o.o_orderstatus = 'F' and l.quality = 1 then 'local' when l.doc_id is not null then 'download' when e.n > 1 then 'model' when o.o_orderstatus = 'P' then 'pending' else 'none' end as source
from orders o left join labels l on l.doc_id = o.o_orderkey left join e on e.user_id = o.o_custkey""")
def priority_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy(F.col("user_id").alias("o_custkey")).agg(F.count("*").alias("n"))
    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("o_orderkey"), "quality", F.lit(True).alias("has"))
    x = load(spark, sf_dir, "orders").join(labels, "o_orderkey", "left").join(e, "o_custkey", "left")
    c = F.col
    steps = [((c("o_orderstatus") == "F") & (c("quality") == 1), "local"), (c("has"), "download"), (c("n") > 1, "model"), (c("o_orderstatus") == "P", "pending")]
    return x.select("o_orderkey", M.cascade(steps, "none").alias("source"))


_CELLS = "cells as (select label, generate_subscripts(embedding, 1)::int as i, unnest(embedding) as x, vec_id from embeddings)"


@query(f"with {_CELLS}, p as (select label, i, avg(x::double) as x from cells group by 1, 2) select label, list_transform(list(x order by i), lambda v: round(v, 9)) as embedding from p group by 1")
def pool_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = V.pool(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", "mean")
    return x.select("label", F.transform("embedding", lambda v: F.round(v, 9)).alias("embedding"))


@query(f"with {_CELLS}, p as (select label, i, max(x) as x from cells group by 1, 2) select label, list(x order by i) as embedding from p group by 1")
def pool_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pool(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", "max")


@query("select label, arg_min(embedding, vec_id) as embedding from embeddings group by 1")
def pool_cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pool(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", "cls")


@query("select label, len(embedding) as n_rows, list_sum(list_transform(embedding, lambda v: v[1]))::double as first_sum from (select label, list(embedding order by vec_id) as embedding from embeddings group by 1)")
def pool_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = V.pool(load(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", "residue")
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, v: a + v[0])
    return x.select("label", F.size("embedding").cast("long").alias("n_rows"), total.alias("first_sum"))


_EXPORT = "ids as (select l_partkey as id from lineitem union select l_suppkey from lineitem), idx as (select id, row_number() over (order by id) - 1 as number from ids)"


@query(f"with {_EXPORT} select number, id, embedding is not null as valid, coalesce(embedding[1], 0)::double as first_value from idx left join embeddings on vec_id = id")
def dense_index_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    rows, _ = V.export(load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey", vectors, "id", "embedding", 64)
    return rows.select("number", "id", "valid", F.col("embedding")[0].cast("double").alias("first_value"))


@query(f"with {_EXPORT} select l.l_orderkey, l.l_linenumber, a.number as left, b.number as right from lineitem l join idx a on a.id = l.l_partkey join idx b on b.id = l.l_suppkey")
def dense_index_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ids = x.select(F.explode(F.array("l_partkey", "l_suppkey")).alias("id")).distinct()
    index = N.dense_numbers(ids, "id")
    left, right = (index.select(F.col("id").alias(c), F.col("number").alias(n)) for c, n in (("l_partkey", "left"), ("l_suppkey", "right")))
    return x.join(left, "l_partkey").join(right, "l_suppkey").select("l_orderkey", "l_linenumber", "left", "right")


@query("select o_orderkey, o_custkey, o_orderstatus, (ntile(7) over (order by o_orderkey) - 1)::int as worker from orders")
def worker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.worker_buckets(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 7, "o_orderkey")


@query("select o_orderkey, o_custkey, o_totalprice, (row_number() over (order by o_orderkey) - 1) // 128 as batch from orders")
def fixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.fixed_batches(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 128, "o_orderkey")


@query("select o_orderkey, o_custkey, o_totalprice, o_orderstatus, row_number() over (order by o_custkey desc, o_orderkey) - 1 as number from orders")
def dense_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of all rows by two columns, with others that ride along."""
    x = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return N.dense_numbers(x, F.col("o_custkey").desc(), "o_orderkey")


@query("""with recursive o as (select doc_id, n_chars, source, row_number() over (order by n_chars desc, doc_id) as r from documents),
g as (select r, doc_id, n_chars, source, 0::bigint as batch, 1 as rows, n_chars as units from o where r = 1
  union all select o.r, o.doc_id, o.n_chars, o.source, case when g.rows + 1 > 32 or g.units + o.n_chars > 20000 then g.batch + 1 else g.batch end,
    case when g.rows + 1 > 32 or g.units + o.n_chars > 20000 then 1 else g.rows + 1 end, case when g.rows + 1 > 32 or g.units + o.n_chars > 20000 then o.n_chars else g.units + o.n_chars end
  from g join o on o.r = g.r + 1)
select doc_id, n_chars, source, batch from g""")
def token_budget_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy batches by count and token budget over all rows in descending length."""
    return V.budget_batches(load(spark, sf_dir, "documents").select("doc_id", "n_chars", "source"), "n_chars", "doc_id", 32, 20000)


@query("select conv_id, string_agg(coalesce(text, ''), '' order by turn) as sequence, count(*) as n_lines from conversations group by 1")
def fasta_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))))
    x = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(lines.alias("lines"))
    return x.select("conv_id", F.array_join(F.transform("lines", lambda x: x["text"]), "").alias("sequence"), F.size("lines").cast("long").alias("n_lines"))


@query(r"""select page_id, nullif(regexp_extract(url, '://([^/]+)', 1), '') as host, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') as lang, try_cast(nullif(regexp_extract(url, '/(\d+)', 1), '') as bigint) as number,
  regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') as safe_name, regexp_replace(url, '(?i)\.(pdb|html)(\.gz)?$', '') as stem from pages""")
def header_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    stem = F.regexp_replace(url, r"(?i)\.(pdb|html)(\.gz)?$", "")
    return load(spark, sf_dir, "pages").select("page_id", S.first_match(url, "://([^/]+)").alias("host"), S.first_match(url, "/([a-z]{2})/").alias("lang"), S.first_match(url, r"/(\d+)").try_cast("long").alias("number"), S.safe_name(url).alias("safe_name"), stem.alias("stem"))


@query("""select doc_id, array_to_string(list_transform(list_zip(string_split(text, ''), case when length(replace(text, 'ß', 'ss')) <= 10 then [] else string_split(lower(substr(replace(text, 'ß', 'ss'), 11)), '') end, true), lambda x: x[1] || x[2]), '') as woven, rpad(left(text, 1000), 1000, 'd') as padded from documents""")
def residue_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts woven with another string, and texts brought to a model's fixed length."""
    tdi = F.lower(F.substring(F.replace(F.col("text"), F.lit("ß"), F.lit("ss")), 11, 1 << 30))
    return load(spark, sf_dir, "documents").select("doc_id", S.interleave(F.col("text"), tdi).alias("woven"), S.cut_and_pad(F.col("text"), 1000).alias("padded"))


@query("""select 'documents' as origin, doc_id as id, text as body, lang, null::varchar as role from documents
union all select 'pages', page_id, url, null, null from pages union all select 'conversations', conv_id, text, null, role from conversations""")
def union_heterogeneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("body"), "lang")
    y = load(spark, sf_dir, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("body"))
    z = load(spark, sf_dir, "conversations").select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), F.col("text").alias("body"), "role")
    return x.unionByName(y, allowMissingColumns=True).unionByName(z, allowMissingColumns=True)


@query("select event_type as status, count(*) as n from events group by 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select user_id from events where event_type = 'purchase' and user_id is not null)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = load(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey"), F.col("event_type").alias("status"))
    return M.pending(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, "o_custkey", "status", "purchase")


_CONTRACT = """with p as (select md5(regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'Q', '', 'g')) as protein_md5, case when doc_id % 50 = 3 then 'FX' || doc_id else printf('FP%07d', doc_id + 1) end as fpid,
  upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) as sequence, case when doc_id % 40 = 1 then 'x' else (n_chars - n_chars % 5)::varchar end as length, case when doc_id % 30 = 2 then 'high' when doc_id % 3 = 0 then '1.5' end as hydrophobicity,
  case when doc_id % 2 = 0 then 'True' when doc_id % 17 = 1 then 'yes' else 'False' end as is_canonical, case when doc_id % 60 = 0 then '' else source end as original_ids from documents)
select rule, n_bad from (select count(*) filter (where not regexp_matches(fpid, '^FP[0-9]{7}$')) as fpid_format, count(*) filter (where not regexp_matches(protein_md5, '^[0-9a-f]{32}$')) as md5_format,
  count(*) filter (where not regexp_matches(sequence, '^[A-Z]+$')) as sequence_letters, count(*) filter (where protein_md5 <> md5(sequence)) as md5_of_sequence,
  count(*) filter (where try_cast(length as double) is null or try_cast(length as double) <> length(sequence)) as length_of_sequence, count(*) filter (where hydrophobicity is not null and hydrophobicity <> '' and try_cast(hydrophobicity as double) is null) as hydrophobicity_number,
  count(*) filter (where is_canonical not in ('True', 'False')) as is_canonical_text, count(*) filter (where length(original_ids) = 0) as original_ids_empty from p) unpivot (n_bad for rule in (columns(*)))"""


@query(_CONTRACT)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    seq = S.letters_only(F.col("text"))
    x = load(spark, sf_dir, "documents").select(
        F.md5(F.regexp_replace(seq, "Q", "")).alias("protein_md5"),
        F.when(d % 50 == 3, F.concat(F.lit("FX"), d)).otherwise(S.public_id(d + 1)).alias("fpid"),
        seq.alias("sequence"),
        F.when(d % 40 == 1, "x").otherwise((F.col("n_chars") - F.col("n_chars") % 5).cast("string")).alias("length"),
        F.when(d % 30 == 2, "high").when(d % 3 == 0, "1.5").alias("hydrophobicity"),
        F.when(d % 2 == 0, "True").when(d % 17 == 1, "yes").otherwise("False").alias("is_canonical"),
        F.when(d % 60 == 0, "").otherwise(F.col("source")).alias("original_ids"),
    )
    return C.count_violations(x, C.protein_rules())


@query("select l_partkey, l_suppkey, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def unique_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.duplicates(load(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("select l_orderkey, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderkey % 3 <> 0) group by 1")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.orphans(load(spark, sf_dir, "lineitem"), "l_orderkey", load(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0"), "o_orderkey")


@query("""with l as (select o_custkey, o_orderstatus from orders), r as (select o_custkey, case when o_orderkey % 100 = 0 then 'X' else o_orderstatus end as o_orderstatus from orders)
select *, 'left' as side from (select * from l except all select * from r) union all select *, 'right' from (select * from r except all select * from l)""")
def projection_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders")
    return C.unequal_rows(x.select("o_custkey", "o_orderstatus"), x.select("o_custkey", F.when(F.col("o_orderkey") % 100 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")))


@query("select min(o_orderkey) as low, max(o_orderkey) as high, count(*) as rows, count(distinct o_orderkey) as distinct from orders having not (min(o_orderkey) = 1 and max(o_orderkey) = count(*) and count(distinct o_orderkey) = count(*))")
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.not_contiguous(load(spark, sf_dir, "orders"), F.col("o_orderkey"))


@query()
def sequence_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of similar sequences by shared shingles; a test checks them against exact similarity."""
    from pairloom.operators.clusters import cluster

    x = load(spark, sf_dir, "documents").select("doc_id", S.letters_only(F.col("text")).alias("sequence"))
    return cluster(x, "doc_id", "sequence", 0.8)


@query()
def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled vectors of a small hashing extractor; models register in the same way."""
    import pairloom.functions.extractors  # noqa: F401 - registers it

    return V.embed(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "hashed-letters")


_NET = "((layer * 13 + place * 7 + input * 3 + output * 5) % 11 - 5) / 10.0"


@query(f"""with cells as (select vec_id, (i - 1) // 4 as p, (i - 1) % 4 as d, len(embedding) // 4 as n, embedding[i]::double as x from (select vec_id, embedding, unnest(range(1, len(embedding) // 4 * 4 + 1)) as i from embeddings)),
w as (select layer, place, input, output, {_NET} as value from range(2) l(layer), range(3) k(place), range(6) i(input), range(6) o(output)),
one as (select vec_id, p - place + 1 as p, n, output as d, greatest(0, sum(x * value) - 0.1 * output) as x from cells join w on layer = 0 and input = d where p - place + 1 between 0 and n - 1 group by 1, 2, 3, 4),
two as (select vec_id, p - place + 1 as p, output as d, sum(x * value) as x from one join w on layer = 1 and input = d and output < 5 where p - place + 1 between 0 and n - 1 group by 1, 2, 3),
best as (select vec_id, p, 'dpvlq'[(list(d order by x desc, d))[1] + 1] as letter from two group by 1, 2)
select vec_id, string_agg(letter, '' order by p) as letters from best group by 1""")
def structure_letters_by_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters for vectors read as rows of four numbers, by a head of two layers whose weights follow a rule."""
    from pairloom.operators.convolution import structure_letters

    every = [spark.range(n).select(F.col("id").alias(c)) for c, n in (("layer", 2), ("place", 3), ("input", 6), ("output", 6))]
    w = every[0].crossJoin(every[1]).crossJoin(every[2]).crossJoin(every[3]).withColumn("value", F.expr(_NET).cast("double"))  # 216 numbers
    w = w.where("layer = 0 and input < 4 or layer = 1 and output < 5")
    bias = every[3].select(F.lit(0).cast("long").alias("layer"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("input"), "output", (F.col("output") * -0.1).cast("double").alias("value"))
    rows = F.expr("transform(sequence(0, size(embedding) div 4 - 1), p -> cast(slice(embedding, p * 4 + 1, 4) as array<double>))")
    return structure_letters(load(spark, sf_dir, "embeddings").select("vec_id", rows.alias("matrix")), "vec_id", "matrix", w.unionByName(bias), "dpvlq")
