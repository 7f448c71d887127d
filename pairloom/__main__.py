"""Command line: `python -m pairloom COMMAND ...`; an unknown command ends with status 2."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pairloom import catalog
from pairloom.operators import alignment, clusters, contract, embeddings, generation, matching, pairs
from pairloom.plans import build, collections, host, split
from pairloom.sources import readers, remote, writers


def _query(spark: SparkSession, a: argparse.Namespace) -> None:
    catalog.QUERIES[a.name](spark, a.tables).write.mode("overwrite").parquet(a.out)


def _validate(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = [readers.read_delimited(spark, f"{a.folder}/{n}.csv") for n in ("proteins", "sequences", "interactions", "pairs")]
    if a.sources.startswith("@"):
        names = [r.value for r in spark.read.text(a.sources[1:]).collect() if r.value]  # an enumeration, a name a line
    else:
        names = a.sources.split(",")
    print(writers.report(contract.validate(*tables, sources=names, quick=a.quick)))


def _split(spark: SparkSession, a: argparse.Namespace) -> None:
    proteins = readers.read_delimited(spark, f"{a.folder}/proteins.csv")
    mapped = split.mapped_pairs(readers.read_delimited(spark, f"{a.folder}/interactions.csv"), proteins)
    sequences = proteins.groupBy(F.col("protein_md5").alias("id")).agg(F.first("sequence").alias("sequence"))
    known = readers.read_clusters(spark, a.clusters) if a.clusters else None
    given = {n: readers.read_delimited(spark, p).withColumn("label", F.col("label").cast("int")) if (p := getattr(a, n)) else None for n in ("val", "test")}
    out = split.split(mapped, known, sequences, split.Sizes(a.val_pos, a.test_pos, a.val_neg, a.test_neg), a.seed, **given, preferred=a.preferred.split(",") if a.preferred else None)
    for name, df in out.items():
        writers.write_delimited(df, f"{a.out}/{name}")


def _dedup(spark: SparkSession, a: argparse.Namespace) -> None:
    out = build.merged(readers.read_delimited(spark, a.interactions).withColumn("label", F.col("label").cast("int")))
    writers.write_delimited(out, a.out, separator=",", key="FPid_1")


def _raw(spark: SparkSession, a: argparse.Namespace):
    return readers.read_parquet(spark, a.raw), readers.read_delimited(spark, f"{a.folder}/proteins.csv"), readers.read_delimited(spark, f"{a.folder}/interactions.csv").withColumns({"label": F.col("label").cast("int"), "n_sources": F.col("n_sources").cast("int")})


def _evidence(spark: SparkSession, a: argparse.Namespace) -> None:
    raw, proteins, before = _raw(spark, a)
    after = before
    if a.mixed_sources is not None:
        after = build.repaired(after, a.primary, a.mixed_sources.split(","), build.pair_evidence(raw, proteins))
    after = build.normalised(build.curated(after, a.primary, build.curated_pairs(raw, proteins)))
    target = f"{a.folder}/interactions.csv" if a.in_place else a.output
    staged = f"{target}.new"
    writers.write_delimited(after, staged, key="FPid_1")
    print(writers.report({"changes": build.rewrite_counts(before, after)}))
    writers.move(spark, staged, target)


def _negatives(spark: SparkSession, a: argparse.Namespace) -> None:
    pairs_in = readers.pair_columns(readers.read_delimited(spark, a.positives)).where("label = 1")
    extra = readers.pair_columns(readers.read_delimited(spark, a.exclude)).where("label = 1") if a.exclude else None
    out = pairs.with_negatives(pairs_in, "ID_1", "ID_2", a.per_positive, a.seed, a.strategy == "degree", a.most, extra, a.no_positives)
    writers.write_delimited(out, a.out)


def _fill(spark: SparkSession, a: argparse.Namespace) -> None:
    given = readers.pair_columns(readers.read_delimited(spark, a.pairs))
    writers.write_delimited(pairs.fill_negatives(given, "ID_1", "ID_2", "label", a.per_positive, a.seed), a.out)


def _cluster_map(spark: SparkSession, a: argparse.Namespace) -> None:
    sequences = readers.read_sequences(spark, a.sequences)
    found = clusters.cluster(sequences, "id", "sequence", a.similarity) if a.similarity else alignment.cluster_by_alignment(sequences, "id", "sequence", a.identity, a.coverage)
    writers.write_delimited(found, a.out, key="id")


def _homology(spark: SparkSession, a: argparse.Namespace) -> None:
    hits = alignment.search(readers.read_sequences(spark, a.queries), readers.read_sequences(spark, a.targets), "id", "sequence", a.identity, a.coverage, a.max_seqs)
    writers.write_delimited(matching.best_hits(hits, "target", a.identity, "identity", "score", "query"), a.out, key="target")


def _host_corpus(spark: SparkSession, a: argparse.Namespace) -> None:
    parts = []
    for kind, folder in (("raw", a.raw), ("split", a.split)):
        for path in [r.path for r in readers.list_files(spark, folder, "*.parquet").select("path").orderBy("path").collect()] if folder else []:
            df = spark.read.parquet(path)
            parts.append(host.standard(df, F.lit(path), ("UNIPROT_HUMAN", "SEQUENCE_HUMAN"), ("UNIPROT_VIRUS", "SEQUENCE_VIRUS"), a.order.split(","), F.lit(f"{kind}:{path.rsplit('/', 1)[-1]}"), kind))
    out = host.corpus(parts)
    for name in ("pairs", "with_sequences"):
        writers.write_table(out[name], f"{a.out}/{name}")
    for name in ("index", "sequences"):
        writers.write_delimited(out[name], f"{a.out}/{name}")
    print(writers.report({"summary": out["summary"]}))


def _host_benchmarks(spark: SparkSession, a: argparse.Namespace) -> None:
    df = spark.read.parquet(a.pairs)
    writers.write_delimited(host.hashed_sequences(df), f"{a.out}/sequences_hp", key="id")
    hashed = host.hashed_pairs(df)
    for subset in a.subsets.split(","):
        writers.write_delimited(hashed.where(F.col("split") == subset), f"{a.out}/{subset}_hp")
    print(writers.report({"subsets": host.subset_counts(hashed)}))


def _embed(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.model not in embeddings.EXTRACTORS:
        raise SystemExit(f"no extractor is registered for {a.model}: import a module that registers one (--plugin)")
    out = embeddings.embed_by_model(readers.read_sequences(spark, a.sequences), "id", "sequence", a.model, a.pool, per_residue=a.per_residue, mean_pool=a.mean_pool)
    writers.append_new(out, a.out, "id")


def _structure_letters(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.generator not in generation.GENERATORS:
        raise SystemExit(f"no generator is registered as {a.generator}: import a module that registers one (--plugin)")
    drawn = {"seed": a.seed, "temperature": 1.2, "top_k": 6, "top_p": 0.95, "penalty": 1.2} if a.beams > 1 else {}
    done = spark.read.parquet(a.done) if a.done else None
    out = generation.structure_by_generation(readers.read_sequences(spark, a.sequences), "id", "sequence", a.generator, generation.Rules(a.beams, **drawn), batch=a.batch, done=done, seconds=a.seconds)
    writers.append_new(out, a.out, "id")


def _fetch(spark: SparkSession, a: argparse.Namespace) -> None:
    ids = readers.read_delimited(spark, a.ids, [a.column]).select(F.col(a.column).alias("id"))
    fetch = remote.by_http(a.url, a.parameter, remote.fasta_values, format="fasta", size=500)
    found = remote.fetch_missing(ids, "id", a.cache, fetch, a.batch, a.ask_again, a.tasks, a.rate)
    writers.write_delimited(found.withColumnRenamed("value", "sequence"), a.out, key="id")


def _coverage(spark: SparkSession, a: argparse.Namespace) -> None:
    vectors = {m: spark.read.parquet(f"{a.vectors}/{m}") for m in a.models.split(",")}
    print(writers.report({m: f"{n} of {n + lacks}" for m, (n, lacks) in collections.embedding_coverage(readers.read_sequences(spark, a.sequences), vectors, a.require.split(",") if a.require else []).items()}))


def _snapshot(spark: SparkSession, a: argparse.Namespace) -> None:
    print(writers.report({"files": contract.file_facts(spark, a.folder)}))


#: command -> (what it does, function, positional arguments, options as add_argument takes them)
COMMANDS: dict[str, tuple[str, Callable, list[str], dict[str, dict]]] = {
    "query": ("run a registered query over a folder of tables", _query, ["name", "tables", "out"], {}),
    "validate": ("check the merged tables against their contract", _validate, ["folder"], {"--sources": {"default": "", "help": "the source tags, separated by commas, or @ and a file with one a line"}, "--quick": {"action": "store_true"}}),
    "snapshot": ("rows and checksums of a folder's files", _snapshot, ["folder"], {}),
    "dedup": ("one row for each pair of merged interactions", _dedup, ["interactions", "out"], {}),
    "evidence": ("repair and normalise the primary source's evidence", _evidence, ["folder", "raw"], {"--primary": {"required": True}, "--mixed-sources": {}}),
    "split": ("make a leakage-safe split", _split, ["folder", "out"], {f"--{n}": {"default": ""} for n in ("clusters", "val", "test", "preferred")} | {f"--{n}": {"type": int, "default": 0} for n in ("val-pos", "test-pos", "val-neg", "test-neg", "seed")}),
    "negatives": ("sample negatives for each positive", _negatives, ["positives", "out"], {"--exclude": {}, "--per-positive": {"type": float, "default": 10.0}, "--most": {"type": int}, "--strategy": {"choices": ("degree", "uniform"), "default": "degree"}, "--seed": {"type": int, "default": 42}, "--no-positives": {"action": "store_true"}}),
    "fill-negatives": ("given negatives, and random ones until there are enough", _fill, ["pairs", "out"], {"--per-positive": {"type": int, "default": 1000}, "--seed": {"type": int, "default": 42}}),
    "cluster-map": ("clusters of sequences by alignment, or by shared shingles", _cluster_map, ["sequences", "out"], {"--identity": {"type": float, "default": 0.4}, "--coverage": {"type": float, "default": 0.8}, "--similarity": {"type": float, "help": "of shingle sets, in place of an alignment"}}),
    "homology": ("best hits of targets among queries", _homology, ["queries", "targets", "out"], {"--identity": {"type": float, "default": 0.6}, "--coverage": {"type": float, "default": 0.0}, "--max-seqs": {"type": int, "default": 100_000}}),
    "host-corpus": ("standardise tables of host and pathogen pairs", _host_corpus, ["out"], {"--raw": {}, "--split": {}, "--order": {"default": "UNIPROT_HUMAN,UNIPROT_VIRUS"}}),
    "host-benchmarks": ("benchmark subsets of a host corpus by content id", _host_benchmarks, ["pairs", "subsets", "out"], {}),
    "embed": ("vectors of sequences by a registered extractor", _embed, ["sequences", "model", "out"], {"--pool": {}, "--per-residue": {"action": "store_true"}, "--mean-pool": {"action": "store_true"}}),
    "structure-letters": ("structure letters of sequences by a registered generator; several beams are drawn", _structure_letters, ["sequences", "generator", "out"], {"--beams": {"type": int, "default": 1}, "--seed": {"type": int, "default": 0}, "--batch": {"type": int, "default": 8}, "--seconds": {"type": float, "help": "kill a batch that takes longer"}, "--done": {"help": "a table of ids that are left out"}}),
    "fetch-sequences": ("sequences of ids from a service that answers in FASTA, through a cache", _fetch, ["ids", "url", "cache", "out"], {"--column": {"default": "id"}, "--parameter": {"default": "accessions"}, "--batch": {"type": int, "default": 200}, "--tasks": {"type": int, "default": 8}, "--rate": {"type": float, "default": 10.0, "help": "requests a second of all tasks"}, "--ask-again": {"action": "store_true", "help": "also for ids that weren't found before"}}),
    "coverage": ("present and missing vectors by model", _coverage, ["sequences", "vectors", "models"], {"--require": {"default": ""}}),
}
#: Other names of commands.
ALIASES = {"validate-merged": "validate", "split-c3": "split", "normalize-evidence": "evidence"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pairloom", description=__doc__)
    top.add_argument("--plugin", action="append", default=[], help="a module to import first, which registers extractors")
    sub = top.add_subparsers(required=True, metavar="COMMAND")
    for name, (text, run, positional, options) in COMMANDS.items():
        p = sub.add_parser(name, help=text, aliases=[k for k, v in ALIASES.items() if v == name])
        for x in positional:
            p.add_argument(x, **({"choices": sorted(catalog.QUERIES)} if x == "name" else {}))
        for x, kw in options.items():
            p.add_argument(x, **kw)
        if name == "evidence":  # one of the two, never both
            where = p.add_mutually_exclusive_group(required=True)
            where.add_argument("--output")
            where.add_argument("--in-place", action="store_true")
        p.set_defaults(run=run)
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    for module in a.plugin:
        importlib.import_module(module)
    spark = SparkSession.builder.appName("pairloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    a.run(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
