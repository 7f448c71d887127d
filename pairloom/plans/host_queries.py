"""Queries on host and pathogen pairs, names, model inputs, searches and rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import models, names
from pairloom.functions import sequences as S
from pairloom.operators import contract as C
from pairloom.operators import matching as M
from pairloom.operators import pairs as P
from pairloom.operators.clusters import alike, alike_targets
from pairloom.operators.tables import written
from pairloom.plans import build as B
from pairloom.plans import host
from pairloom.plans.registry import RAW_PAIRS, SOURCES, TAG_NAMES, load, query, raw_pairs

_HOST = """base as (select *, trim(' H' || o_custkey % 50 || ' ') as host_id, case when o_orderkey % 13 = 0 then null else 'V' || o_orderkey % 70 end as pathogen_id,
  upper(replace(o_orderpriority, ' ', '')) as host_sequence, case when o_orderkey % 11 = 0 then null else o_orderstatus || o_orderkey % 9 end as pathogen_sequence from orders),
raw_part as (select 'host:raw:' || (row_number() over (order by o_orderkey) - 1) as record_uid, 'raw/Virus_' || o_orderstatus || '_High_Confidence.parquet' as source_table, 'raw' as split, 'VIRUS_' || o_orderstatus as source_database, 'high' as confidence,
  1 as label, host_id, pathogen_id, host_sequence, pathogen_sequence, 'k' || o_orderkey as original_pair_id from base where o_orderkey % 2 = 0),
split_part as (select 'host:split:' || (row_number() over (order by o_orderkey) - 1) as record_uid, 'split/' || case when o_orderkey % 3 = 0 then 'highconfidence_data/' else '' end || 'train.parquet' as source_table,
  case when o_orderkey % 3 = 0 then 'highconfidence_train' else 'train' end as split, 'DB' || o_orderstatus as source_database, case when o_orderkey % 4 = 1 then null else 'c' end as confidence,
  (o_orderkey % 5 > 1)::int as label, host_id, pathogen_id, host_sequence, pathogen_sequence, o_orderkey::varchar as original_pair_id from base where o_orderkey % 2 = 1),
pairs as (select *, 'virus-host' as dataset, 'Homo sapiens' as host_taxon, 'virus' as pathogen_taxon, length(host_sequence) as host_len, length(pathogen_sequence) as pathogen_len, null::varchar as pathogen_family,
  host_sequence is not null as has_host_sequence, pathogen_sequence is not null as has_pathogen_sequence from (select * from raw_part union all select * from split_part))"""


def _corpus(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    k, c = F.col("o_orderkey"), F.col
    base = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.concat(F.lit(" H"), c("o_custkey") % 50, F.lit(" ")).alias("UNIPROT_HUMAN"),
        F.when(k % 13 == 0, "  ").otherwise(F.concat(F.lit("V"), k % 70)).alias("UNIPROT_VIRUS"),
        c("o_orderpriority").alias("SEQUENCE_HUMAN"),
        F.when(k % 11 == 0, " *").otherwise(F.concat(F.lower("o_orderstatus"), k % 9, F.lit("**"))).alias("SEQUENCE_VIRUS"),
    )
    sides = ("UNIPROT_HUMAN", "SEQUENCE_HUMAN"), ("UNIPROT_VIRUS", "SEQUENCE_VIRUS")
    raw = base.where(k % 2 == 0).withColumn("pair_key", F.concat(F.lit("k"), k))
    given = base.where(k % 2 == 1).withColumns({"ID": k.cast("string"), "source": F.concat(F.lit("DB"), c("o_orderstatus")), "confidence": F.when(k % 4 == 1, " ").otherwise("c"), "REG_LABEL": (k % 5 > 1).cast("int")})
    one = host.standard(raw, F.concat(F.lit("raw/Virus_"), c("o_orderstatus"), F.lit("_High_Confidence.parquet")), *sides, ["o_orderkey"], F.lit("host:raw"), "raw")
    path = F.concat(F.lit("split/"), F.when(k % 3 == 0, "highconfidence_data/").otherwise(""), F.lit("train.parquet"))
    return host.corpus([one, host.standard(given, path, *sides, ["o_orderkey"], F.lit("host:split"), "split")])


@query(f"with {_HOST} select * from pairs")
def host_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir)["pairs"]


@query(f"""with {_HOST}, sides as (select 'host' as role, host_id as protein_id, host_sequence as sequence, dataset from pairs where has_host_sequence and has_pathogen_sequence
  union all select 'pathogen', pathogen_id, pathogen_sequence, dataset from pairs where has_host_sequence and has_pathogen_sequence)
select role, protein_id, md5(sequence) as sequence_md5, length(sequence) as length, string_agg(distinct dataset, ';') as datasets, sequence from sides where protein_id is not null group by role, protein_id, sequence""")
def host_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir)["sequences"]


@query(f"""with {_HOST} select count(*) as rows_total, count(*) filter (where has_host_sequence and has_pathogen_sequence) as rows_with_sequences, count(*) filter (where not has_host_sequence) as rows_missing_host_sequence,
  count(*) filter (where not has_pathogen_sequence) as rows_missing_pathogen_sequence, count(distinct host_id) as unique_host_ids, count(distinct pathogen_id) as unique_pathogen_ids from pairs""")
def host_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir)["summary"]


_HASHED = f"""with {_HOST}, h as (select 'hp_' || left(md5(host_sequence), 16) as "ID_1", 'hp_' || left(md5(pathogen_sequence), 16) as "ID_2", label, dataset, split, source_database, host_id, pathogen_id, original_pair_id, record_uid
  from pairs where has_host_sequence and has_pathogen_sequence),
hashed as (select * from (select *, row_number() over (partition by "ID_1", "ID_2", label order by record_uid) as r from h where "ID_1" <> "ID_2") where r = 1)"""


@query(f'{_HASHED} select "ID_1", "ID_2", label, dataset, split, source_database, host_id, pathogen_id, original_pair_id from hashed')
def host_hashed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host.hashed_pairs(_corpus(spark, sf_dir)["with_sequences"])


@query(f"""{_HASHED}, chosen as (select * from hashed where (dataset, split) in (('virus-host', 'raw'), ('virus-host', 'highconfidence_train')))
select c.dataset, c.split, count(*) as rows, count(*) filter (where label = 1) as positives, count(*) filter (where label = 0) as negatives,
  (select count(distinct id) from (select unnest(["ID_1", "ID_2"]) as id from chosen x where x.dataset = c.dataset and x.split = c.split)) as unique_proteins from chosen c group by c.dataset, c.split""")
def host_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = host.hashed_pairs(_corpus(spark, sf_dir)["with_sequences"])
    return host.subset_counts(host.only(pairs, [("virus-host", "raw"), ("virus-host", "highconfidence_train")]))


@query(f"""with {_HOST}, full_pairs as (select * from pairs where has_host_sequence and has_pathogen_sequence), sides as (select 'host' as role, host_id as protein_id, host_sequence as sequence, dataset from full_pairs
  union all select 'pathogen', pathogen_id, pathogen_sequence, dataset from full_pairs)
select 'hp_' || left(md5(sequence), 16) as id, sequence, md5(sequence) as sequence_md5, array_to_string(list_sort(list_distinct(list(role))), ';') as roles, array_to_string(list_sort(list_distinct(list(protein_id))), ';') as original_ids,
  array_to_string(list_sort(list_distinct(list(dataset))), ';') as datasets from sides where protein_id is not null group by sequence""")
def host_hashed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host.hashed_sequences(_corpus(spark, sf_dir)["with_sequences"])


_ALIKE = """q as (select distinct p_partkey as query, substr(p_name || p_brand, i::int, 5) as s, count(*) over () as z from part, range(1, 60) r(i) where p_partkey % 40 = 0 and i <= length(p_name || p_brand) - 4),
t as (select distinct p_partkey as target, substr(p_name || p_brand, i::int, 5) as s from part, range(1, 60) r(i) where p_partkey % 40 <> 0 and i <= length(p_name || p_brand) - 4),
met as (select query, target, count(*) as shared from q join t using (s) group by 1, 2),
hits as (select query, target, shared / least((select count(distinct s) from q where q.query = met.query), (select count(distinct s) from t where t.target = met.target)) as identity, shared from met)"""


def _alike(spark: SparkSession, sf_dir: str, find=alike) -> DataFrame:
    part = load(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("sequence"))
    return find(part.where("p_partkey % 40 = 0"), part.where("p_partkey % 40 <> 0"), "p_partkey", "sequence", 0.6)


@query(f"with {_ALIKE} select query, target, identity, shared from hits where identity >= 0.6")
def homology_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stated query set (every fortieth part) against all others, by shared shingles."""
    return _alike(spark, sf_dir)


@query(f"with {_ALIKE}, pairs as (select l_partkey as \"ID_2\", l_suppkey as \"ID_1\" from lineitem), held as (select distinct \"ID_1\", \"ID_2\" from pairs where \"ID_2\" % 97 = 5) select p.\"ID_1\", p.\"ID_2\", count(*) as n from pairs p where \"ID_2\" not in (select \"ID_2\" from held) and \"ID_2\" not in (select target from hits where identity >= 0.6) group by 1, 2")
def host_training_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ID_1"), F.col("l_partkey").alias("ID_2"))
    left = host.training_remainder(pairs, pairs.where("ID_2 % 97 = 5"), _alike(spark, sf_dir, alike_targets))
    return left.groupBy("ID_1", "ID_2").agg(F.count("*").alias("n"))


@query(r"""with x as (select page_id, url, regexp_replace(split_part(url, '/', -1), '\.[^.]*$', '') as stem from pages)
select page_id, stem, regexp_replace(lower(stem), '_(high|medium)_confidence$', '') as source, case when length(url) > 40 then url else 'p1_A' end as source_id, 'n_' || page_id || case when url like '%.cif.gz' then '.cif.gz' else regexp_extract(url, '(\.[^./]*)$', 1) end as target from x""")
def path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    made = names.target_name("id", F.concat(F.lit("n "), F.col("page_id")), url, url, url)
    known = F.when(F.length("url") > 40, url).otherwise("UNDEFINED")
    return load(spark, sf_dir, "pages").select("page_id", names.stem(url).alias("stem"), names.source_of(url).alias("source"), names.source_id(known, F.lit("P1"), F.lit("A")).alias("source_id"), made.alias("target"))


@query("""select doc_id, array_to_string(list_concat(list_concat(['148'], list_transform(string_split(left(replace(text, 'ß', ''), 1024), ''), lambda c: coalesce((127 + nullif(position(lower(c) in 'algvsredtipkfqnymhwc'), 0))::varchar, '2'))), ['1']), ' ') as structure_ids,
  array_to_string(string_split(left(translate(upper(replace(text, 'ß', '')), 'UZOB', 'XXXX'), 1024), ''), ' ') as spaced from documents""")
def model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of structure letters, and residues apart; 1024 is the models' own length."""
    t = F.replace(F.col("text"), F.lit("ß"), F.lit(""))
    return load(spark, sf_dir, "documents").select("doc_id", F.array_join(models.structure_ids(t).cast("array<string>"), " ").alias("structure_ids"), models.spaced(t).alias("spaced"))


@query("""select o_orderkey, case when l.doc_id is not null then l.quality else b.item_id % 2 end as value, case when l.doc_id is not null then 'id' else 'sequence' end as match_type
from orders left join labels l on l.doc_id = o_orderkey left join benchmark b on b.item_id = o_orderkey % 300 where l.doc_id is not null or b.item_id is not null""")
def two_phase_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("doc_id"), (F.col("o_orderkey") % 300).alias("item_id"))
    one = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("value"))
    two = load(spark, sf_dir, "benchmark").select("item_id", (F.col("item_id") % 2).alias("value"))
    return M.two_phase(x, "o_orderkey", ("doc_id", one), ("item_id", two), "value")


@query("select doc_id, source, n_chars from documents where source in ('src1', 'src2', 'src3') and source <> 'src2' and length(text) between 200 and 5000 and contains(text, 'the')")
def chosen_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by included and excluded sources, length bounds and a literal text."""
    x = M.chosen_rows(load(spark, sf_dir, "documents"), ["src1", "src2", "src3"], ["src2"])
    return M.containing(M.of_length(x, "text", 200, 5000), "text", "the").select("doc_id", "source", "n_chars")


@query(f"""with {RAW_PAIRS}, pos as (select distinct a, b from raw where label = 1 and a <> b), known as (select distinct least(a, b) as a, greatest(a, b) as b from pos),
n as (select count(*) as positives, least(round_even(count(*) * 1.5, 0)::bigint, 3000) as wanted from pos),
weights as (select node, count(*) as w from (select a as node from pos union all select b from pos) group by 1),
ranges as materialized (select node, sum(w) over (order by node) - w as lo, sum(w) over (order by node) as hi, sum(w) over () as total from weights),
draws as materialized (select k, ('0x' || substr(md5((k // greatest(64, 2 * wanted) + 4) || ':left:' || k % greatest(64, 2 * wanted)), 1, 15))::bigint % total as x, ('0x' || substr(md5((k // greatest(64, 2 * wanted) + 4) || ':right:' || k % greatest(64, 2 * wanted)), 1, 15))::bigint % total as y
  from (select unnest(range(5 * greatest(64, 2 * wanted))) as k from n), n, (select max(total) as total from ranges)),
half as materialized (select d.k, d.y, l.node as u from draws d join ranges l on d.x >= l.lo and d.x < l.hi),
drawn as (select k, u, r.node as v from half d join ranges r on d.y >= r.lo and d.y < r.hi where u <> r.node),
firsts as (select least(u, v) as a, greatest(u, v) as b, min(k) as k from drawn group by 1, 2),
new as (select f.a, f.b, row_number() over (order by k) as r from firsts f where not exists (select 1 from known p where p.a = f.a and p.b = f.b))
select a, b, 1 as label, 'positive' as category from pos union all select a, b, 0, 'negative_degree' from new, n where r <= wanted""")
def negatives_by_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct positives and one and a half negatives for each, 3,000 at most."""
    x = raw_pairs(spark, sf_dir).where("label = 1")
    return P.with_negatives(x, "a", "b", 1.5, 4, most=3000)


@query(f"""with {RAW_PAIRS}, chosen as (select a, b, label from raw), pos as (select a, b from chosen where label = 1), known as (select distinct least(a, b) as a, greatest(a, b) as b from pos),
given as (select distinct least(a, b) as a, greatest(a, b) as b from chosen where label = 0),
n as (select (select count(*) from pos) as target, (select count(*) from pos) - (select count(*) from given) as lacks),
weights as (select node, 1 as w from (select a as node from chosen union select b from chosen)),
ranges as (select node, sum(w) over (order by node) - w as lo, sum(w) over (order by node) as hi, sum(w) over () as total from weights),
draws as (select k, ('0x' || substr(md5((k // greatest(64, 2 * lacks) + 8) || ':left:' || k % greatest(64, 2 * lacks)), 1, 15))::bigint % total as x, ('0x' || substr(md5((k // greatest(64, 2 * lacks) + 8) || ':right:' || k % greatest(64, 2 * lacks)), 1, 15))::bigint % total as y
  from (select unnest(range(6 * greatest(64, 2 * lacks))) as k from n), n, (select max(total) as total from ranges)),
drawn as (select d.k, l.node as u, r.node as v from draws d join ranges l on d.x >= l.lo and d.x < l.hi join ranges r on d.y >= r.lo and d.y < r.hi where l.node <> r.node),
firsts as (select least(u, v) as a, greatest(u, v) as b, min(k) as k from drawn group by 1, 2),
new as (select f.a, f.b, row_number() over (order by k) as r from firsts f where not exists (select 1 from known p where p.a = f.a and p.b = f.b) and not exists (select 1 from given g where g.a = f.a and g.b = f.b)),
every as (select a, b from given union all select a, b from new, n where r <= lacks),
kept as (select a, b, row_number() over (order by a, b) as r from every)
select a, b, 1 as label, 'positive' as category from pos union all select a, b, 0, 'negative_sampled' from kept, n where r <= target""")
def negatives_filled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given negatives first, random ones until there is one for each positive."""
    return P.fill_negatives(raw_pairs(spark, sf_dir).select("a", "b", "label"), "a", "b", "label", 1, 8)


_INTERACTIONS = f"""with {RAW_PAIRS}, g as (select a, b, max(label) as label, count(distinct source) as n_sources, array_to_string(list_sort(list_distinct(list(source))), ';') as sources, list_sort(list_distinct(flatten(list(string_split(evidence, ';'))))) as tags from canon where a <> b group by 1, 2)"""
_SUPPORT = "list_has_any(string_split(sources, ';'), ['S2', 'S3'])"
_NEW = f"case when list_contains(string_split(sources, ';'), 'S1') then list_distinct(list_concat(case when {_SUPPORT} then tags else list_filter(tags, lambda t: t <> 'mixed') end, ['HTP', 'LTP'])) else tags end"


@query(f"""{_INTERACTIONS}, x as (select *, {_NEW} as fixed from g), y as (select *, array_to_string(fixed, ';') as evidence_tags from x),
z as (select *, case when label = 0 then 'negative_synthetic' when list_contains(fixed, 'HTP') and list_contains(fixed, 'LTP') then 'HTP_LTP' when list_contains(fixed, 'LTP') then 'LTP' when list_contains(fixed, 'complex_curation') then 'complex_curation'
  when list_contains(fixed, 'HTP') then 'HTP' when list_contains(fixed, 'mixed') then 'mixed' when list_contains(fixed, 'no_exp') then 'no_exp' else 'unknown' end as kind from y)
select counter, n from (select count(*) as rows_read, count(*) filter (where list_sort(fixed) <> tags) as rows_changed, count(*) filter (where list_contains(tags, 'mixed') and not list_contains(fixed, 'mixed')) as mixed_removed, 0::bigint as curation_added,
  count(*) filter (where kind = 'no_exp') as class_no_exp, count(*) filter (where kind = 'LTP') as "class_LTP", count(*) filter (where kind = 'HTP') as "class_HTP", count(*) filter (where kind = 'negative_synthetic') as class_negative_synthetic,
  count(*) filter (where kind = 'mixed') as class_mixed, count(*) filter (where kind = 'HTP_LTP') as "class_HTP_LTP", count(*) filter (where kind = 'structural') as class_structural, count(*) filter (where kind = 'complex_curation') as class_complex_curation,
  count(*) filter (where kind in ('LTP', 'HTP_LTP') and n_sources >= 2) as tier_diamond, count(*) filter (where kind in ('LTP', 'HTP_LTP') and n_sources < 2 or kind = 'HTP' and n_sources >= 2 or kind = 'mixed' and n_sources >= 3) as tier_gold,
  count(*) filter (where kind = 'HTP' and n_sources < 2 or kind = 'mixed' and n_sources = 2 or kind = 'complex_curation' and n_sources >= 2) as tier_silver,
  count(*) filter (where kind = 'mixed' and n_sources < 2 or kind = 'complex_curation' and n_sources < 2 or kind in ('no_exp', 'unknown')) as tier_bronze, count(*) filter (where kind = 'negative_synthetic') as tier_negative_synthetic from z) unpivot (n for counter in (columns(*)))""")
def rewrite_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repairing the primary source's evidence changes: counts over the rows before and after."""
    rows = raw_pairs(spark, sf_dir).select(F.col("a").alias("FPid_1"), F.col("b").alias("FPid_2"), F.lit("").alias("original_id1"), F.lit("").alias("original_id2"), F.col("source").alias("PPI_Source"), F.col("source").alias("Seq_Source"), "label", F.lit("").alias("Experimental_Method"), F.col("evidence").alias("Evidence_Tags"))
    # Three steps read the merged rows: what they count by is made and written once.
    kept = written(B.merged(rows, sources=SOURCES, tags=TAG_NAMES).select("FPid_1", "FPid_2", "PPI_Source", "label", "n_sources", "Evidence_Tags"), "interactions")
    before = kept.withColumns({c: F.lit(None).cast("string") for c in C.INTERACTIONS if c not in kept.columns}).select(*C.INTERACTIONS)
    own = before.select("FPid_1", "FPid_2", F.array(F.lit("HTP"), F.lit("LTP")).alias("raw"))
    return B.rewrite_counts(before, B.normalised(B.repaired(before, "S1", ["S2", "S3"], own)))


@query(f"""with {RAW_PAIRS}, i as (select a as f1, b as f2, source, label, case row % 9 when 0 then 'odd' when 1 then 'HTP_LTP' when 2 then 'mixed' else case label when 0 then 'negative_synthetic' else 'LTP' end end as kind,
  case row % 8 when 0 then 'none' when 1 then 'gold' else case label when 0 then 'negative_synthetic' else 'silver' end end as tier, case when row % 6 = 0 then evidence || ';odd' else evidence end as tags, case when row % 5 = 0 then 2 else 1 end as n from raw)
select rule, n_bad from (select 0::bigint as endpoint_format, count(*) filter (where f1 >= f2) as endpoint_order, count(*) filter (where label not in (0, 1)) as label_value, count(*) filter (where n <> 1) as n_sources_count, count(*) filter (where kind = 'odd') as evidence_type_enum,
  count(*) filter (where tier = 'none') as tier_enum, count(*) filter (where tier in ('none', 'gold')) as tier_name, count(*) filter (where tags like '%odd') as evidence_tags_enum,
  count(*) filter (where label = 0 and not (kind = 'negative_synthetic' and tier = 'negative_synthetic')) as negative_class, count(*) filter (where source not in ('S1', 'S2', 'S3')) as source_enum from i) unpivot (n_bad for rule in (columns(*)))""")
def interaction_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row rules of interactions over rows that break each of them."""
    r, label = F.col("row"), F.col("label")
    kind = F.when(r % 9 == 0, "odd").when(r % 9 == 1, "HTP_LTP").when(r % 9 == 2, "mixed").otherwise(F.when(label == 0, "negative_synthetic").otherwise("LTP"))
    tier = F.when(r % 8 == 0, "none").when(r % 8 == 1, "gold").otherwise(F.when(label == 0, "negative_synthetic").otherwise("silver"))
    chinese = F.when(tier == "silver", "白银").when(tier == "negative_synthetic", "负样本").otherwise("x")
    x = raw_pairs(spark, sf_dir).select(F.col("a").alias("FPid_1"), F.col("b").alias("FPid_2"), F.col("source").alias("PPI_Source"), "label", kind.alias("Evidence_Type"), F.when(r % 6 == 0, F.concat("evidence", F.lit(";odd"))).otherwise(F.col("evidence")).alias("Evidence_Tags"), tier.alias("PPI_Tier"), chinese.alias("PPI_Tier_ZH"), F.when(r % 5 == 0, 2).otherwise(1).alias("n_sources"))
    return C.count_violations(x, C.interaction_rules(["S1", "S2", "S3"]))


@query("""with p as (select o_orderkey as pos, case when o_orderkey % 500 = 7 then o_orderkey else o_orderkey + 1 end as number from orders) select pos, number from p where number <> pos + 1""")
def row_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    x = load(spark, sf_dir, "orders").select(k.alias("pos"), F.when(k % 500 == 7, k).otherwise(k + 1).alias("n"))
    return C.out_of_order(x, F.col("n"), "pos")


@query(r"""with x as (select page_id, case page_id % 4 when 0 then 'AF-P' || page_id || '-F1-model_v4.pdb.gz chain' when 1 then md5(page_id::varchar) || '_A extra' when 2 then 'dir/x' || page_id || '.cif' else 'sp|P' || page_id || '|N' end as h from pages),
w as (select page_id, h, regexp_extract(h, '^\s*(\S+)', 1) as word, nullif(regexp_extract(h, '([0-9a-f]{32})', 1), '') as m from x)
select page_id, array_to_string(list_distinct(list_filter([m], lambda y: y is not null)), ';') as md5, word, regexp_replace(split_part(word, '/', -1), '\.(pdb|cif|mmcif)(\.gz)?$', '') as structure from w""")
def structure_header_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    header = F.when(k % 4 == 0, F.concat(F.lit("AF-P"), k, F.lit("-F1-model_v4.pdb.gz chain"))).when(k % 4 == 1, F.concat(F.md5(k.cast("string")), F.lit("_A extra"))).when(k % 4 == 2, F.concat(F.lit("dir/x"), k, F.lit(".cif"))).otherwise(F.concat(F.lit("sp|P"), k, F.lit("|N")))
    found = names.header_candidates(header)
    x = load(spark, sf_dir, "pages").select("page_id", found.alias("found"), header.alias("header"))
    word = S.first_match(F.col("header"), r"^\s*(\S+)")
    md5 = F.filter("found", lambda y: y.rlike("^[0-9a-f]{32}$"))
    structure = F.filter("found", lambda y: y == S.structure_stem(F.element_at(F.split(word, "/"), -1)))
    return x.select("page_id", F.array_join(md5, ";").alias("md5"), word.alias("word"), structure[0].alias("structure"))


_TWO = """r as (select doc_id, regexp_replace(upper(replace(text, 'ß', '')), '[^A-Z]', '', 'g') as r, case when doc_id % 7 <> 0 then regexp_replace(lower(lang || text), '[^a-z]', '', 'g') end as s from documents)"""


@query(f"""with {_TWO} select doc_id, array_to_string(list_transform(range(1, least(length(r), length(s), 1024) + 1), lambda i: r[i] || s[i]), '') as text from r where s is not null""")
def two_input_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residues and structure letters joined for a model that takes both, for the documents that have both."""
    return _two_inputs(spark, sf_dir)[0]


@query(f"""with {_TWO} select count(*) as given, count(*) filter (where s is null) as missing, count(*) filter (where length(r) <> length(s)) as uneven, count(*) filter (where s is not null and least(length(r), length(s)) > 1024) as truncated from r""")
def two_input_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_inputs(spark, sf_dir)[1]


def _two_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, sf_dir, "documents")
    residues = docs.select("doc_id", F.regexp_replace(F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit(""))), "[^A-Z]", "").alias("sequence"))
    structure = docs.where("doc_id % 7 <> 0").select("doc_id", F.regexp_replace(F.lower(F.concat("lang", "text")), "[^a-z]", "").alias("sequence"))
    return models.two_inputs("saprot", residues, structure, "doc_id")


_LETTERS = models.RESIDUE_LETTERS


def _rule_step():
    """A next-token function by rule: of the residue at the place and the letter before it; in one of all states it ends early."""
    import numpy as np

    a, p, k = np.ogrid[:21, :21, :20]
    table = np.full((21, 21, 150), -50.0)
    table[:, :, 128:148] = (a * 7 + p * 3 + k * k * 5 + k * a) % 101 / 10
    table[20, 5, 1] = 20.0
    beyond = np.full(150, -50.0)
    beyond[1] = 20.0

    def step(inputs, prefixes, parents):
        t = prefixes.shape[1]
        before = prefixes[:, -1] - 127 if t else np.zeros(len(inputs), int)
        at = np.array([x[t + 1] for x in inputs])  # the direction's token comes first
        residue = np.where((at >= 3) & (at < 23), at - 3, 20)
        return np.where((at == models.END_ID)[:, None], beyond, table[residue, before])

    return step


@query(f"""with best as (select list(k order by a, p) as b from (select a, p, arg_max(k, v - k / 1000.0) as k from (select a, p, k, (a * 7 + p * 3 + k * k * 5 + k * a) % 101 as v from range(21) r(a), range(21) s(p), range(20) t(k)) group by 1, 2)),
r as (select doc_id, regexp_replace(regexp_replace(upper(replace(text, 'ß', '')), '[^A-Z]', '', 'g')[:1024], '[BJOUZ]', 'X', 'g') as r from documents where length(text) > 0),
walked as (select doc_id, length(r) as n, list_reduce(list_prepend('', string_split(r, '')), lambda acc, c: case when right(acc, 1) = '.' then acc
  when c = 'X' and right(acc, 1) = '{models.STRUCTURE_LETTERS[4]}' then acc || '.'
  else acc || '{models.STRUCTURE_LETTERS}'[b[(strpos('{_LETTERS}', c) - 1) * 21 + (case when acc = '' then 0 else strpos('{models.STRUCTURE_LETTERS}', right(acc, 1)) end) + 1] + 1] end) as w from r, best where r <> '')
select doc_id, rpad(replace(w, '.', ''), n::int, 'd') as letters from walked""")
def generated_structure_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure letters that a next-token function by rule writes for all documents' residues, to the models' own length."""
    from pairloom.operators import generation

    generation.register_generator("by-rule", _rule_step)
    t = F.regexp_replace(F.upper(F.replace(F.col("text"), F.lit("ß"), F.lit(""))), "[^A-Z]", "")
    x = load(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(t, "J", "X").alias("r")).where("r <> ''")
    return generation.structure_by_generation(x, "doc_id", "r", "by-rule", batch=500).select("doc_id", "letters")
