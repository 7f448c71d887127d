"""Queries on manifests, structure files and collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import sequences as S
from pairloom.operators import structures as T
from pairloom.plans import collections as C
from pairloom.plans.registry import load, query

_NAMES = "'AF-P' || (l_partkey % 300) || '-F' || l_linenumber || '-model_v' || (l_suppkey % 3 + 2) || '.pdb'"


@query(f"""with f as (select distinct {_NAMES} as name, 'P' || (l_partkey % 300) as accession, case when l_suppkey % 3 + 2 = 4 then case when l_linenumber = 1 then 0 else 1 end else 2 end as r from lineitem)
select accession, name from (select *, row_number() over (partition by accession order by r, name) as k from f) where k = 1""")
def versioned_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    name = F.concat(F.lit("AF-P"), c("l_partkey") % 300, F.lit("-F"), c("l_linenumber"), F.lit("-model_v"), c("l_suppkey") % 3 + 2, F.lit(".pdb"))
    return T.preferred_file(load(spark, sf_dir, "lineitem").select(name.alias("name")), 4)


@query("""select l_orderkey, l_quantity, l_linenumber from (
  select *, row_number() over (partition by l_orderkey order by abs(l_quantity - 25), l_quantity desc, l_linenumber) as k from lineitem) where k = 1""")
def closest_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").withColumn("wanted", F.lit(25.0))
    return T.closest_length(x, "l_orderkey", "l_quantity", "wanted", "l_linenumber")


_STATES = "case o_orderkey % 6 when 0 then 'copied' when 1 then 'missing_source' when 2 then 'exists' when 3 then 'dry_run' else 'copy_error' end"


@query(f"""with s as (select md5(o_orderkey::varchar) as sequence_md5, o_orderkey as k from orders),
loc as (select md5(o_orderkey::varchar) as sequence_md5, {_STATES} as status from orders where o_orderkey % 5 = 0), dl as (select md5(o_orderkey::varchar) as sequence_md5, {_STATES} as status from orders where o_orderkey % 7 = 0),
m as (select md5(o_orderkey::varchar) as sequence_md5, case when o_orderstatus = 'O' then 'ok' else 'error' end as status from orders where o_orderkey % 3 = 0)
select sequence_md5, case when sequence_md5 in (select sequence_md5 from loc where status in ('copied', 'exists')) then 'local'
  when sequence_md5 in (select sequence_md5 from dl where status in ('downloaded', 'exists')) then 'download_manifest' when k % 11 = 0 then 'download_file'
  when sequence_md5 in (select sequence_md5 from m where status in ('ok', 'exists')) then 'model_manifest' when k % 13 = 0 then 'model_file'
  when sequence_md5 in (select sequence_md5 from loc) then 'download_pending' else 'model_pending' end as source from s""")
def structure_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    x = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.md5(k.cast("string")).alias("sequence_md5"))
    state = F.when(k % 6 == 0, "copied").when(k % 6 == 1, "missing_source").when(k % 6 == 2, "exists").when(k % 6 == 3, "dry_run").otherwise("copy_error").alias("status")
    files = x.where(k % 11 == 0).select("sequence_md5", F.lit("download").alias("kind")).unionAll(x.where(k % 13 == 0).select("sequence_md5", F.lit("model").alias("kind")))
    model = x.where(k % 3 == 0).select("sequence_md5", F.when(F.col("o_orderstatus") == "O", "ok").otherwise("error").alias("status"))
    return T.structure_sources(x.select("sequence_md5"), x.where(k % 5 == 0).select("sequence_md5", state), x.where(k % 7 == 0).select("sequence_md5", state), model, files)


@query("""with q as (select l_orderkey, 'P' || (l_partkey % 50) as pdb, 'A' || (l_linenumber % 3) as chain_1, chr((66 + l_suppkey % 2)::int) || '9' as chain_2, l_linenumber from lineitem),
i as (select 'p' || (p_partkey % 50) as pdb, case when p_size % 2 = 0 then 'B' else 'A' end as r, case when p_size % 2 = 0 then 'A' else 'B' end as l, p_brand as acc_r, p_name as acc_l, p_partkey as pos from part),
f as (select pdb, least(r, l) as x, greatest(r, l) as y, arg_min(acc_r, pos) as acc_r, arg_min(acc_l, pos) as acc_l from i group by 1, 2, 3)
select q.l_orderkey, q.l_linenumber, f.acc_r as "acc_R", f.acc_l as "acc_L" from q join f on lower(q.pdb) = f.pdb and f.x = 'A' and f.y = left(q.chain_2, 1)""")
def chain_pair_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    q = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("P"), c("l_partkey") % 50).alias("pdb"), F.concat(F.lit("A"), c("l_linenumber") % 3).alias("chain_1"), F.concat(F.when(c("l_suppkey") % 2 == 0, "B").otherwise("C"), F.lit("9")).alias("chain_2"))
    even = c("p_size") % 2 == 0
    i = load(spark, sf_dir, "part").select(F.concat(F.lit("p"), c("p_partkey") % 50).alias("pdb"), F.when(even, "B").otherwise("A").alias("chain_R"), F.when(even, "A").otherwise("B").alias("chain_L"), c("p_brand").alias("acc_R"), c("p_name").alias("acc_L"), c("p_partkey").alias("pos"))
    return T.chain_pairs(q, i).select("l_orderkey", "l_linenumber", "acc_R", "acc_L")


_SEQS = """with s as (select case when doc_id % 90 = 4 then 'x' || doc_id else md5(regexp_replace(upper(replace(text, 'ß', 'ss')), '\\s+', '', 'g')) end as id, replace(text, 'ß', 'ss') || case when doc_id % 70 = 5 then 'z' else '' end as sequence from documents)"""


@query(f"""{_SEQS} select rule, n_bad from (select count(*) filter (where not regexp_matches(id, '^[0-9a-f]{{32}}$')) as id_format,
  count(*) filter (where id <> md5(regexp_replace(upper(sequence), '\\s+', '', 'g'))) as id_of_sequence, count(id) - count(distinct id) as id_unique from s) unpivot (n_bad for rule in (columns(*)))""")
def split_contract_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, t = F.col("doc_id"), F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    x = load(spark, sf_dir, "documents").select(F.when(d % 90 == 4, F.concat(F.lit("x"), d)).otherwise(F.md5(S.no_space(t))).alias("id"), F.concat(t, F.when(d % 70 == 5, "z").otherwise("")).alias("sequence"))
    return C.sequence_violations(x)


@query("""with s as (select distinct md5(p_partkey::varchar) as id from part where p_partkey % 9 <> 0), p as (select case when l_orderkey % 97 = 0 then 'bad' else md5(l_partkey::varchar) end as a, md5(l_suppkey::varchar) as b, l_linenumber - 1 as label from lineitem)
select rule, n_bad from (select count(*) filter (where a = 'bad') as endpoint_format, count(*) filter (where a not in (select id from s) or b not in (select id from s)) as endpoint_known, count(*) filter (where label not in (0, 1)) as label_value from p) unpivot (n_bad for rule in (columns(*)))""")
def split_contract_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, c = load(spark, sf_dir, "part"), F.col
    s = part.where("p_partkey % 9 <> 0").select(F.md5(c("p_partkey").cast("string")).alias("id"))
    p = load(spark, sf_dir, "lineitem").select(F.when(c("l_orderkey") % 97 == 0, "bad").otherwise(F.md5(c("l_partkey").cast("string"))).alias("ID_1"), F.md5(c("l_suppkey").cast("string")).alias("ID_2"), (c("l_linenumber") - 1).alias("label"))
    return C.pair_violations(p, s)


@query("""select text as body, array_to_string(list_sort(list_distinct(list(role))), ';') as roles, array_to_string(list_sort(list_distinct(list(conv_id::varchar))), ';') as datasets, count(*) filter (where role = 'user') as n_user, count(*) as n from conversations group by 1""")
def entity_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairloom.operators.pairs import joined_distinct

    x = load(spark, sf_dir, "conversations").groupBy(F.col("text").alias("body"))
    return x.agg(joined_distinct(F.col("role")).alias("roles"), joined_distinct(F.col("conv_id").cast("string")).alias("datasets"), F.count_if(F.col("role") == "user").alias("n_user"), F.count("*").alias("n"))


@query(r"""select doc_id, trim(substr(k, 1, position('_' in k) - 1)) as left_id, trim(substr(k, position('_' in k) + 1)) as right_id, rpad(left(source, 4), 8, 'd') as padded, printf('FP%07d', doc_id * 1000003) as fpid
from (select *, source || ' _ ' || lang || '_x' as k from documents)""")
def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = S.split_pair(F.col("k"))
    x = load(spark, sf_dir, "documents").withColumn("k", F.concat("source", F.lit(" _ "), "lang", F.lit("_x")))
    return x.select("doc_id", a.alias("left_id"), b.alias("right_id"), F.rpad(F.substring("source", 1, 4), 8, "d").alias("padded"), S.public_id(F.col("doc_id") * 1000003).alias("fpid"))
