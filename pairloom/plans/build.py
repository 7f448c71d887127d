"""Building the database: sources to registry, merged pairs, repaired and classified evidence, contract tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import evidence as E
from pairloom.functions import sequences as S
from pairloom.operators import contract as C
from pairloom.operators import entities as N
from pairloom.operators import pairs as P
from pairloom.operators.matching import containing, require


@dataclass(frozen=True)
class Source:
    """One upstream source: its proteins (id, sequence, pos), its pairs (id_1, id_2, label) and what its rows are marked with.

    Pairs may bring detection_methods and throughput of their own; `method` and `evidence` stand in where they are blank.
    """

    name: str
    proteins: DataFrame
    pairs: DataFrame
    method: str = ""
    evidence: str = "mixed"
    sequence_source: str = field(default="")


def incoming(sources: list[Source]) -> DataFrame:
    """(source_id, sequence, md5, pos) of all sources: sources in list order, rows in their own."""
    parts = []
    for rank, source in enumerate(sources):
        x = source.proteins.where("id <> ''").select(F.col("id").alias("source_id"), S.letters_only(F.col("sequence")).alias("sequence"), (F.lit(rank) * 10**12 + F.col("pos")).alias("pos"))
        parts.append(x.where("sequence <> ''"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("md5", F.md5("sequence"))


def proteins(master: DataFrame, sources: list[Source]) -> tuple[DataFrame, DataFrame]:
    """The contract's protein table, new entities at its end, and (source_id, fpid). master has the contract's columns and pos."""
    rows = incoming(sources)
    known = master.select("fpid", F.col("protein_md5").alias("md5"), "original_ids", "pos")
    ids, touched = N.register(known, rows.select("source_id", "md5", "pos"))
    texts = rows.groupBy("md5").agg(F.min_by("sequence", "pos").alias("sequence"))
    new = touched.where("is_new").join(texts, "md5").select(F.col("md5").alias("protein_md5"), "fpid", "sequence", F.length("sequence").alias("length"), F.lit(None).cast("double").alias("hydrophobicity"), F.lit("False").alias("is_canonical"), "original_ids")
    renamed = touched.where("not is_new").select("fpid", F.col("original_ids").alias("__ids"))
    old = master.join(renamed, "fpid", "left").withColumn("original_ids", F.coalesce("__ids", "original_ids"))
    return old.select(*C.PROTEINS).unionByName(new.select(*C.PROTEINS)), ids


def interactions(ids: DataFrame, sources: list[Source]) -> DataFrame:
    """Merged rows of all sources between known entities, before dedup; rows with an unknown endpoint go."""
    one = ids.select(F.col("source_id").alias("id_1"), F.col("fpid").alias("FPid_1"))
    two = ids.select(F.col("source_id").alias("id_2"), F.col("fpid").alias("FPid_2"))
    out = None
    for s in sources:
        has = set(s.pairs.columns)
        blank = lambda c, d, has=has: F.when(F.trim(c) != "", F.col(c)).otherwise(F.lit(d)) if c in has else F.lit(d)
        label = F.coalesce(F.col("label").cast("int"), F.lit(1)) if "label" in has else F.lit(1)
        tags = F.when(F.col("throughput").isin(*E.THROUGHPUT), F.array_join(E.throughput_tokens(F.col("throughput")), ";")).otherwise(F.lit(s.evidence)) if "throughput" in has else F.lit(s.evidence)
        rows = s.pairs.select("id_1", "id_2", label.alias("label"), blank("detection_methods", s.method).alias("Experimental_Method"), F.when(label == 0, F.lit("negative_synthetic")).otherwise(tags).alias("Evidence_Tags"))
        x = rows.join(one, "id_1").join(two, "id_2").select("FPid_1", "FPid_2", F.col("id_1").alias("original_id1"), F.col("id_2").alias("original_id2"), F.lit(s.name).alias("PPI_Source"), F.lit(s.sequence_source or s.name).alias("Seq_Source"), "label", "Experimental_Method", "Evidence_Tags")
        out = x if out is None else out.unionByName(x)
    return out


def merged(rows: DataFrame, drop_self: bool = True, sources: list[str] | None = None, tags: list[str] | None = None) -> DataFrame:
    """The contract's interaction table from merged rows: one shuffle, then column expressions only.

    With enumerated sources and tags their sets are bits of a number, as in dedup(), so these aggregates keep no sets.
    """
    x = P.canonical(rows, "FPid_1", "FPid_2", [("original_id1", "original_id2")])
    x = x.where("FPid_1 <> FPid_2") if drop_self else x
    if sources is not None and tags is not None:
        masks = P.source_mask(F.col("PPI_Source"), sources), P.token_mask(F.col("Evidence_Tags"), tags)
        y = x.groupBy("FPid_1", "FPid_2").agg(
            *(P.joined_distinct(F.col(c)).alias(c) for c in ("original_id1", "original_id2", "Seq_Source", "Experimental_Method")),
            F.max("label").alias("label"),
            *(F.bit_or(m).alias(n) for m, n in zip(masks, ("__sources", "__tags"), strict=True)),
        )
        names = {"PPI_Source": P.names_of(F.col("__sources"), sources), "Evidence_Tags": P.names_of(F.coalesce("__tags", F.lit(0)), tags), "n_sources": F.bit_count("__sources").cast("int")}
        return normalised(y.withColumns(names))
    y = x.groupBy("FPid_1", "FPid_2").agg(
        *(P.joined_distinct(F.col(c)).alias(c) for c in ("original_id1", "original_id2", "PPI_Source", "Seq_Source", "Experimental_Method")),
        F.max("label").alias("label"),
        P.joined_tokens(F.col("Evidence_Tags")).alias("Evidence_Tags"),
        P.distinct_with_null(F.col("PPI_Source")).cast("int").alias("n_sources"),
    )
    return normalised(y)


def normalised(pairs: DataFrame) -> DataFrame:
    """Tags in order, class, tier and its name."""
    names = F.create_map(*(F.lit(x) for pair in E.TIER_NAMES.items() for x in pair))
    tags = S.tokens(F.col("Evidence_Tags"))
    x = pairs.withColumn("Evidence_Type", E.evidence_class(tags, F.col("label"))).withColumn("Evidence_Tags", S.ordered_tokens(tags, E.TAG_ORDER))
    x = x.withColumn("PPI_Tier", E.tier(F.col("Evidence_Type"), F.col("label"), F.col("n_sources"))).withColumn("PPI_Tier_ZH", names[F.col("PPI_Tier")])
    return x.select(*C.INTERACTIONS)


def pair_evidence(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(FPid_1, FPid_2, raw): evidence tokens of the primary source's own rows (sequence_1, sequence_2, throughput), by content."""
    md5 = known.select("protein_md5", "fpid")
    x = rows.select(S.content_md5(F.col("sequence_1")).alias("m1"), S.content_md5(F.col("sequence_2")).alias("m2"), E.throughput_tokens(F.col("throughput")).alias("raw"))
    x = x.join(md5.withColumnsRenamed({"protein_md5": "m1", "fpid": "a"}), "m1").join(md5.withColumnsRenamed({"protein_md5": "m2", "fpid": "b"}), "m2")
    keyed = x.select(F.least("a", "b").alias("FPid_1"), F.greatest("a", "b").alias("FPid_2"), "raw")
    return keyed.groupBy("FPid_1", "FPid_2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("raw")))).alias("raw"))


def curated_pairs(rows: DataFrame, known: DataFrame, mark: str = "complex curation") -> DataFrame:
    """(FPid_1, FPid_2) of the primary source's rows (sequence_1, sequence_2, method) whose method names the curation."""
    md5 = known.select("protein_md5", "fpid")
    x = containing(rows, "method", mark).select(S.content_md5(F.col("sequence_1")).alias("m1"), S.content_md5(F.col("sequence_2")).alias("m2"))
    x = x.join(md5.withColumnsRenamed({"protein_md5": "m1", "fpid": "FPid_1"}), "m1").join(md5.withColumnsRenamed({"protein_md5": "m2", "fpid": "FPid_2"}), "m2")
    return P.undirected(x, "FPid_1", "FPid_2")


def repaired(pairs: DataFrame, primary: str, mixed_sources: list[str], evidence: DataFrame) -> DataFrame:
    """Interactions with the primary source's own evidence in the place of its blanket tag; class and tier are made anew later."""
    x = require(pairs, "FPid_1", "FPid_2", "PPI_Source", "Evidence_Tags").join(evidence, ["FPid_1", "FPid_2"], "left")
    tags = E.repaired(S.tokens(F.col("Evidence_Tags")), F.col("raw"), S.tokens(F.col("PPI_Source")), primary, mixed_sources)
    return x.withColumn("Evidence_Tags", S.ordered_tokens(tags, E.REPAIR_ORDER)).drop("raw")


def curated(pairs: DataFrame, primary: str, keys: DataFrame) -> DataFrame:
    """Interactions with complex_curation added where the primary source curated the pair."""
    x = pairs.join(keys.select("FPid_1", "FPid_2", F.lit(True).alias("__curated")).distinct(), ["FPid_1", "FPid_2"], "left")
    tags = E.with_curation(S.tokens(F.col("Evidence_Tags")), S.tokens(F.col("PPI_Source")), primary, F.coalesce("__curated", F.lit(False)))
    return x.withColumn("Evidence_Tags", F.array_join(tags, ";")).drop("__curated")


def rewrite_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(counter, n) of a rewrite: rows read and changed, `mixed` removed, curation added, and the classes and tiers it leaves."""
    keys = ["FPid_1", "FPid_2"]
    old = before.select(*keys, F.col("Evidence_Tags").alias("__old"))
    x = after.select(*keys, "Evidence_Tags", "Evidence_Type", "PPI_Tier").join(old, keys)
    has = lambda c, t: F.array_contains(S.tokens(F.col(c)), t)
    same = F.array_sort(S.tokens(F.col("__old"))) == F.array_sort(S.tokens(F.col("Evidence_Tags")))
    counts = [F.count("*").alias("rows_read"), F.count_if(~same).alias("rows_changed"), F.count_if(has("__old", "mixed") & ~has("Evidence_Tags", "mixed")).alias("mixed_removed"), F.count_if(~has("__old", "complex_curation") & has("Evidence_Tags", "complex_curation")).alias("curation_added")]
    counts += [F.count_if(F.col("Evidence_Type") == k).alias(f"class_{k}") for k in E.EVIDENCE_TYPES]
    counts += [F.count_if(F.col("PPI_Tier") == k).alias(f"tier_{k}") for k in E.TIER_NAMES]
    y = x.agg(*counts)
    return y.select(F.explode(F.array(*(F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in y.columns))).alias("x")).select("x.counter", "x.n")


@dataclass(frozen=True)
class Primary:
    """The primary source: its name, the sources that support a `mixed` of their own, and its raw rows (sequence_1, sequence_2, throughput, method)."""

    name: str
    mixed_sources: tuple[str, ...]
    rows: DataFrame


def build(master: DataFrame, sources: list[Source], primary: Primary | None = None) -> dict[str, DataFrame]:
    """All four contract tables; with a primary source its evidence is repaired and its curation marked, in the same plan."""
    prot, ids = proteins(master, sources)
    inter = merged(interactions(ids, sources))
    if primary is not None:
        inter = repaired(inter, primary.name, list(primary.mixed_sources), pair_evidence(primary.rows, prot))
        inter = normalised(curated(inter, primary.name, curated_pairs(primary.rows, prot)))
    return {
        "proteins": prot,
        "sequences": prot.select(F.col("fpid").alias("id"), "sequence"),
        "interactions": inter,
        "pairs": inter.select(F.col("FPid_1").alias("fpid_1"), F.col("FPid_2").alias("fpid_2"), "label"),
    }
