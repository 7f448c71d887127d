"""Queries on pairs: dedup, classes, exclusion, splits, negatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import evidence as E
from pairloom.functions import sequences as S
from pairloom.operators import pairs as P
from pairloom.operators import splits
from pairloom.operators.entities import last_value
from pairloom.operators.tables import spread, written
from pairloom.plans.registry import CLASS, RAW_PAIRS, SOURCES, TAG_NAMES, TAGS, TIER, load, query, raw_pairs

_DEDUP = f"""with {RAW_PAIRS}, dedup as (
  select a, b, max(label) as label, count(distinct label) as n_labels, count(distinct source) as n_sources,
    array_to_string(list_sort(list_distinct(list(source))), ';') as sources, {TAGS} as evidence_tags from canon group by a, b
)"""


def _deduped(rows: DataFrame, n: int | None = None) -> DataFrame:
    return P.dedup(rows, "a", "b", "label", "source", "evidence", sources=SOURCES, tags=TAG_NAMES, rows=rows.count() if n is None else n)


@query(f"""{_DEDUP}, classed as (select *, {CLASS} as evidence_type from dedup)
select a, b, label, n_labels, n_sources, sources, evidence_tags, evidence_type, {TIER} as tier from classed""")
def pair_dedup_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_tier(_deduped(raw_pairs(spark, sf_dir)))


@query(f"with {RAW_PAIRS} select distinct a, b, a || '|' || b as pair_key from canon")
def pair_canonical_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_pairs(spark, sf_dir)
    return P.undirected(rows, "a", "b", rows=rows.count()).select("a", "b", F.concat_ws("|", "a", "b").alias("pair_key"))


@query(f"with {RAW_PAIRS} select case when a > b then b else a end as a, case when a > b then a else b end as b, case when a > b then line else row end as original_a, case when a > b then row else line end as original_b from raw")
def pair_swap_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = raw_pairs(spark, sf_dir).select("a", "b", F.col("row").alias("original_a"), F.col("line").cast("long").alias("original_b"))
    return P.canonical(x, "a", "b", [("original_a", "original_b")])


@query(f"{_DEDUP} select count(*) as n_pairs, count(*) filter (where n_labels > 1) as n_conflicts from dedup")
def pair_dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_pairs(spark, sf_dir)
    x = spread(P.canonical(rows, "a", "b").select("a", "b", "label"), "a", "b", rows=rows.count()).groupBy("a", "b").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return x.agg(F.count("*").alias("n_pairs"), F.count_if(F.col("most") > F.col("least")).alias("n_conflicts"))


@query(f"{_DEDUP} select n_sources, label, count(*) as n_pairs from dedup group by 1, 2")
def pair_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _deduped(raw_pairs(spark, sf_dir))
    return x.groupBy("n_sources", "label").agg(F.count("*").alias("n_pairs")).orderBy("n_sources", "label")


@query("""select source, count(*) filter (where lang = 'de') as de, count(*) filter (where lang = 'en') as en, count(*) filter (where lang = 'es') as es,
  count(*) filter (where lang = 'fr') as fr from documents group by source""")
def source_label_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).count().na.fill(0)


@query(f"with {RAW_PAIRS} select node, count(*) as degree from (select a as node from raw union all select b from raw) group by node")
def endpoint_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.degrees(raw_pairs(spark, sf_dir), "a", "b")


@query(f"with {RAW_PAIRS} select count(distinct node) as n_endpoints from (select a as node from raw union all select b from raw)")
def endpoint_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_pairs(spark, sf_dir).select(F.explode(F.array("a", "b")).alias("node")).agg(F.count_distinct("node").alias("n_endpoints"))


@query(f"{_DEDUP}, classed as (select *, {CLASS} as evidence_type from dedup), tiered as (select *, {TIER} as tier from classed) select evidence_type, tier, count(*) as n_pairs from tiered group by 1, 2")
def evidence_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_dedup_tiered(spark, sf_dir).groupBy("evidence_type", "tier").agg(F.count("*").alias("n_pairs"))


_MIXED = ["S2", "S3"]
#: What throughput texts become.
_RAW_TOKENS = ["HTP", "LTP", "no_exp", "negative_synthetic", "unknown"]


@query(f"""{_DEDUP}, evidence as (
  select c.a, c.b, list_sort(list_distinct(flatten(list(case o.o_orderstatus when 'F' then ['HTP'] when 'O' then ['LTP'] when 'P' then ['HTP', 'LTP'] else ['unknown'] end)))) as raw
  from canon c join orders o on o.o_orderkey = c.row where c.source = 'S1' group by 1, 2
), fixed as (
  select d.a, d.b, string_split(d.evidence_tags, ';') as tags, e.raw, list_contains(string_split(d.sources, ';'), 'S1') as own, list_has_any(string_split(d.sources, ';'), ['S2', 'S3']) as others
  from dedup d left join evidence e on d.a = e.a and d.b = e.b
), joined as (
  select a, b, case when own and raw is not null then list_distinct(list_concat(case when others then tags else list_filter(tags, lambda t: t <> 'mixed') end, raw)) else tags end as tags from fixed
)
select a, b, array_to_string(list_transform(list_sort(list_transform(tags, lambda t: {{'p': coalesce(map {{'HTP': 0, 'LTP': 1, 'mixed': 2, 'no_exp': 3, 'structural': 4, 'negative_synthetic': 5}}[t], 99), 't': t}})), lambda x: x.t), ';') as evidence_tags from joined""")
def evidence_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_pairs(spark, sf_dir)
    n = rows.count()
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row"), F.create_map(*map(F.lit, ("F", "HTP", "O", "LTP", "P", "both")))[F.col("o_orderstatus")].alias("throughput"))
    own = spread(P.canonical(rows.where("source = 'S1'"), "a", "b").select("a", "b", "row"), "row", rows=n).join(orders, "row")
    own = own.select("a", "b", P.token_mask(F.array_join(E.throughput_tokens(F.col("throughput")), ";"), _RAW_TOKENS).alias("mask"))
    own = spread(own, "a", "b", rows=n).groupBy("a", "b").agg(F.bit_or("mask").alias("mask"))
    x = _deduped(rows, n).join(own.select("a", "b", S.tokens(P.names_of(F.col("mask"), _RAW_TOKENS)).alias("raw")), ["a", "b"], "left")
    tags = E.repaired(S.tokens(F.col("evidence_tags")), F.col("raw"), S.tokens(F.col("sources")), "S1", _MIXED)
    return x.select("a", "b", S.ordered_tokens(tags, E.REPAIR_ORDER).alias("evidence_tags"))


@query(f"""{_DEDUP}, curated as (select distinct a, b from canon where row % 7 = 0), tagged as (
  select d.a, d.b, d.label, d.n_sources, case when list_contains(string_split(sources, ';'), 'S1') and c.a is not null then list_distinct(list_append(string_split(evidence_tags, ';'), 'complex_curation')) else string_split(evidence_tags, ';') end as tags
  from dedup d left join curated c on d.a = c.a and d.b = c.b
)
select a, b, array_to_string(list_transform(list_sort(list_transform(tags, lambda t: {{'p': coalesce(map {{'structural': 0, 'HTP': 1, 'LTP': 2, 'complex_curation': 3, 'mixed': 4, 'no_exp': 5, 'negative_synthetic': 6}}[t], 99), 't': t}})), lambda x: x.t), ';') as evidence_tags from tagged""")
def evidence_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_pairs(spark, sf_dir)
    n = rows.count()
    curated = P.undirected(rows.where("row % 7 = 0"), "a", "b", rows=n).withColumn("curated", F.lit(True))
    x = _deduped(rows, n).join(curated, ["a", "b"], "left")
    tags = E.with_curation(S.tokens(F.col("evidence_tags")), S.tokens(F.col("sources")), "S1", F.coalesce("curated", F.lit(False)))
    return x.select("a", "b", S.ordered_tokens(tags, E.TAG_ORDER).alias("evidence_tags"))


@query(f"""with {RAW_PAIRS}, held as (select a, b from canon where line = 1 and label = 1 and row % 50 = 0)
select c.a, c.b, count(*) as n_rows from canon c where not exists (select 1 from held h where h.a = c.a and h.b = c.b) group by 1, 2""")
def holdout_pair_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_pairs(spark, sf_dir)
    x = P.canonical(rows, "a", "b")
    held = x.where("line = 1 and label = 1 and row % 50 = 0")
    # Grouped before the join: an anti join of rows would be moved below their shuffle.
    counts = spread(x.select("a", "b"), "a", "b", rows=rows.count()).groupBy("a", "b").agg(F.count("*").alias("n_rows"))
    return P.exclude_pairs(counts, held, ["a", "b"])


_SPLIT = f"""with {RAW_PAIRS}, pairs as (select a, b, max(label) as label from canon group by 1, 2),
clusters as (select distinct node as member, left(node, 8) as cluster from (select a as node from raw union all select b from raw)),
held as (select a, b, label from pairs where substr(md5('9|' || a || '|' || b), 1, 3) < '001'),
ends as (select a as id from held where label = 1 union select b from held where label = 1),
bad as (select member from clusters where cluster in (select cluster from clusters join ends on id = member)),
flagged as (
  select p.*, p.a in (select member from bad) or p.b in (select member from bad) as tainted, exists (select 1 from held h where h.a = p.a and h.b = p.b) as is_held from pairs p
)"""


def _split_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw = raw_pairs(spark, sf_dir)
    pairs = written(spread(P.canonical(raw, "a", "b").select("a", "b", "label"), "a", "b", rows=raw.count()).groupBy("a", "b").agg(F.max("label").alias("label")), "pairs")
    held = pairs.where(F.substring(P.hash_rank(9, "a", "b"), 1, 3) < "001")
    clusters = raw.select(F.explode(F.array("a", "b")).alias("member")).distinct().withColumn("cluster", F.substring("member", 1, 8))
    return pairs, held, clusters


@query(f"{_SPLIT} select a, b, label from flagged where label = 1 and not tainted and not is_held")
def split_c3_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.training_rows(*_split_parts(spark, sf_dir), "a", "b", "label", "member", "cluster")


@query(f"{_SPLIT} select count(*) as rows_in, count(*) filter (where label = 1) as positives, count(*) filter (where label = 1 and not tainted) as after_taint, count(*) filter (where label = 1 and not tainted and not is_held) as rows_out from flagged")
def split_c3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.cascade_counts(*_split_parts(spark, sf_dir), "a", "b", "label", "member", "cluster")


@query(f"""{_SPLIT} select member, cluster, member in (select id from ends) as is_positive_holdout, member in (select member from bad) as is_tainted from clusters""")
def cluster_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, held, clusters = _split_parts(spark, sf_dir)
    ends = held.where("label = 1").select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return splits.cluster_flags(clusters, ends, "member", "cluster")


@query(f"""with {RAW_PAIRS}, pos as (select distinct a, b from canon where label = 1),
ranked as (select a, b, row_number() over (order by md5('3|' || a || '|' || b), a, b) as r from pos)
select a, b, case when r <= 100 then 'val' else 'test' end as part from ranked where r <= 250""")
def sample_val_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.sample_holdout(P.undirected(raw_pairs(spark, sf_dir).where("label = 1"), "a", "b"), ["a", "b"], 100, 150, 3)


@query("select o_orderkey, o_custkey from orders order by md5('7|' || o_orderkey), o_orderkey limit 500")
def sample_uniform_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.sample(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 500, 7, "o_orderkey")


@query("select doc_id, source from documents order by case source when 'src3' then 0 when 'src1' then 1 else 2 end, md5('5|' || doc_id), doc_id limit 120")
def sample_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("source") == "src3", 0).when(F.col("source") == "src1", 1).otherwise(2)
    return P.sample_by_priority(load(spark, sf_dir, "documents").select("doc_id", "source"), 120, rank, 5, "doc_id")


@query(f"""with {RAW_PAIRS}, pos as (select distinct a, b from canon where label = 1),
weights as (select node, count(*) as w from (select a as node from raw where label = 1 union all select b from raw where label = 1) group by 1),
ranges as (select node, sum(w) over (order by node) - w as lo, sum(w) over (order by node) as hi, sum(w) over () as total from weights),
draws as (select k, ('0x' || substr(md5((k // 400 + 1) || ':left:' || k % 400), 1, 15))::bigint % total as x, ('0x' || substr(md5((k // 400 + 1) || ':right:' || k % 400), 1, 15))::bigint % total as y
  from range(8000) t(k), (select max(total) as total from ranges)),
drawn as (select d.k, l.node as u, r.node as v from draws d join ranges l on d.x >= l.lo and d.x < l.hi join ranges r on d.y >= r.lo and d.y < r.hi where l.node <> r.node),
firsts as (select least(u, v) as a, greatest(u, v) as b, min(k) as k from drawn group by 1, 2)
select a, b from firsts f where not exists (select 1 from pos p where p.a = f.a and p.b = f.b) order by k limit 200""")
def negative_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 negatives, drawn by degree at hashed positions."""
    return P.sample_negatives(raw_pairs(spark, sf_dir).where("label = 1"), "a", "b", 200, 1)


@query(f"""with {RAW_PAIRS}, pos as (select distinct a, b from canon where label = 1), neg as (select distinct a, b from canon where label = 0 and a <> b)
select n.a, n.b from neg n where not exists (select 1 from pos p where p.a = n.a and p.b = n.b) order by n.a, n.b limit 1000""")
def negatives_one_to_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = raw_pairs(spark, sf_dir)
    n = x.count()
    negative = P.undirected(x.where("label = 0 and a <> b"), "a", "b", rows=n)
    return P.exclude_pairs(negative, P.undirected(x.where("label = 1"), "a", "b", rows=n), ["a", "b"]).orderBy("a", "b").limit(1000)


@query(f"with {RAW_PAIRS} select row, line, role, endpoint from (select row, line, 'left' as role, a as endpoint from raw union all select row, line, 'right', b from raw)")
def unpivot_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.unpivot(raw_pairs(spark, sf_dir), ["row", "line"], [("a", "left"), ("b", "right")], "endpoint")


@query("select x.l_orderkey, x.l_partkey as left, y.l_partkey as right from lineitem x join lineitem y on x.l_orderkey = y.l_orderkey and x.l_linenumber < y.l_linenumber")
def group_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.combinations(load(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_linenumber")


@query(f"""with {RAW_PAIRS}, parts as (select distinct a, b, case when row % 10 = 0 then 'test' when row % 10 = 1 then 'val' else 'train' end as part from canon)
select (select count(*) from (select a, b from parts where part = 'train' intersect select a, b from parts where part = 'val')) as train_val,
  (select count(*) from (select a, b from parts where part = 'train' intersect select a, b from parts where part = 'test')) as train_test,
  (select count(*) from (select a, b from parts where part = 'val' intersect select a, b from parts where part = 'test')) as val_test""")
def overlap_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("row") % 10 == 0, 4).when(F.col("row") % 10 == 1, 2).otherwise(1)
    rows = raw_pairs(spark, sf_dir)
    x = spread(P.canonical(rows, "a", "b").select("a", "b", part.alias("part")), "a", "b", rows=rows.count()).groupBy("a", "b").agg(F.bit_or("part").alias("m"))
    both = lambda k: F.count_if(F.col("m").bitwiseAND(F.lit(k)) == k)
    return x.agg(both(3).alias("train_val"), both(5).alias("train_test"), both(6).alias("val_test"))


@query("""with tiers as (select p_partkey, case when regexp_matches(lower(p_type), 'small|weak') then 'weak' when regexp_matches(lower(p_type), 'large|strong') then 'strong' when contains(lower(p_type), 'medium') then 'medium' end as tier from part),
rows as (select l_orderkey, l_linenumber, tier, (l_discount >= 0.05)::int as label from lineitem join tiers on p_partkey = l_partkey)
select t.tier, count(*) filter (where r.label = 1) as n_positive, count(*) filter (where r.label = 0) as n_control from (values ('weak'), ('medium'), ('strong')) t(tier)
join rows r on (r.label = 1 and r.tier = t.tier) or r.label = 0 group by 1""")
def tier_with_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("p_type")
    tiers = load(spark, sf_dir, "part").select("p_partkey", F.when(low.rlike("small|weak|large|strong|medium"), E.interface_tier(F.col("p_type"))).alias("tier"))
    rows = load(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_discount") >= 0.05).cast("int").alias("label")).join(tiers, F.col("l_partkey") == F.col("p_partkey"))
    controls = rows.where("label = 0").select(F.explode(F.array(*map(F.lit, ("weak", "medium", "strong")))).alias("tier"), "label")
    both = rows.where("label = 1 and tier is not null").select("tier", "label").unionByName(controls)
    return both.groupBy("tier").agg(F.count_if(F.col("label") == 1).alias("n_positive"), F.count_if(F.col("label") == 0).alias("n_control"))


@query("select l_partkey, count(*) as n_positive, round_even(count(*) * 0.5, 0)::double as target from lineitem where l_discount >= 0.05 group by 1")
def banker_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").where("l_discount >= 0.05").groupBy("l_partkey").agg(F.count("*").alias("n_positive"))
    return x.withColumn("target", S.round_half_even(F.col("n_positive") * 0.5))


@query("""select l_partkey, l_discount as identity, l_extendedprice as score, l_orderkey, l_linenumber from (
  select *, row_number() over (partition by l_partkey order by l_discount desc, l_extendedprice desc, l_orderkey desc, l_linenumber desc) as r from lineitem where l_discount >= 0.06) where r = 1""")
def best_hit_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairloom.operators.matching import best_hits

    x = load(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_discount").alias("identity"), F.col("l_extendedprice").alias("score"), "l_orderkey", "l_linenumber")
    return best_hits(x, "l_partkey", 0.06, "identity", "score", "l_orderkey", "l_linenumber")


@query("""select max(best) as max_best, median(best) as median_best, count(*) as n_targets from (select l_partkey, max(l_extendedprice) as best from lineitem where l_discount >= 0.06 group by 1)""")
def median_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").where("l_discount >= 0.06").groupBy("l_partkey").agg(F.max("l_extendedprice").alias("best"))
    return x.agg(F.max("best").alias("max_best"), F.median("best").alias("median_best"), F.count("*").alias("n_targets"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (partition by l_partkey, l_suppkey order by l_shipdate, l_orderkey, l_linenumber) as r from lineitem) where r = 1""")
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pairloom.operators.entities import first_per_key

    x = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return first_per_key(x, ["l_partkey", "l_suppkey"], "l_shipdate", "l_orderkey", "l_linenumber").drop("l_shipdate")


@query("select l_partkey, arg_max(l_suppkey, l_orderkey * 10 + l_linenumber) as l_suppkey from lineitem group by 1")
def last_key_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return last_value(x, "l_partkey", "l_suppkey", "pos")


@query("""select l_partkey, l_suppkey, count(*) as n from lineitem where not exists (select 1 from (select l_suppkey as s from lineitem where l_shipdate < timestamp '1992-02-01') t where s = l_suppkey) group by 1, 2""")
def target_side_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    seen = x.where("l_shipdate < timestamp'1992-02-01'").select("l_suppkey")
    return P.exclude_endpoints(x, seen, "l_suppkey").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
