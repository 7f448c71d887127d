"""Merkle manifest of a dataset: a hash tree over the rows of each group, one over the groups' roots, and proofs.

Leaves of a group are numbered in the order of their key. A node is the SHA-256 of up to `fanout` consecutive digests, as
hexadecimal text; the last run of a level may be short, and nothing is padded.

Rows are ranged by group and key, sorted and written once, so a task reads stretches of consecutive leaves. It keeps a
mountain range: a stack with the open run of every level. A run that is full and began at a multiple of the fanout is
carried, as in counting in that base: it becomes a node of the next level. Nodes leave the task as records; what no carry
took are its peaks. Only peaks are shuffled, a few for each level and stretch: level by level the runs that a stretch's
edges cut, and the short last ones, are put together from them.

Proofs are made in blocks of fanout ** BLOCK_LEVEL leaves: a block gets the siblings above it in a row of its own, and
makes those below from its leaves. So no task holds a group, whatever its size.

Nulls: a null value has a mark of its own in its leaf, a null group comes first, and null keys come first in a group.
Rows that repeat a key are ordered by their digest, and each is a leaf. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import materialize

FANOUT, BLOCK_LEVEL = 8, 3
#: Digits of a digest.
WIDTH = 64
_NODES = "g string, level int, i long, digest string, open boolean"
_PATH = "array<struct<position:int,siblings:string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 of the values, each as its length in UTF-8, a colon and itself, or a dash if it is null."""
    one = lambda v: F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(one, values)), 256)


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, bytewise and null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(0, len(batch), 2000):
            yield from zip(*(c.to_pylist() for c in batch.slice(k, 2000).columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def mountains(leaves: Iterator[tuple[str, int, str]], fanout: int) -> Iterator[tuple[str, int, int, str, bool]]:
    """(group, level, number, digest, open) of the nodes over stretches of consecutive leaves (group, number, digest).

    Peaks, leaves among them, are open; a node that a carry took is not. Closed leaves are not returned.
    """
    group, after = None, -1
    ranges: list[list] = []  # for each level: the number of the open run's first node, and the digests of the run

    def peaks() -> Iterator[tuple]:
        for level, (first, run) in enumerate(ranges):
            yield from ((group, level, first + k, d, True) for k, d in enumerate(run))

    for g, i, leaf in leaves:
        if g != group or i != after:
            yield from peaks()
            group, ranges = g, []
        after, level, digest = i + 1, 0, leaf
        while True:
            if len(ranges) == level:
                ranges.append([i, []])
            first, run = ranges[level]
            if not run:
                ranges[level][0] = first = i
            run.append(digest)
            if (i + 1) % fanout:
                break
            if len(run) < fanout:  # cut by the stretch's left edge: its nodes are peaks
                yield from ((group, level, first + k, d, True) for k, d in enumerate(run))
                run.clear()
                break
            if level:
                yield from ((group, level, first + k, d, False) for k, d in enumerate(run))
            digest = _sha("".join(run))
            run.clear()
            i, level = i // fanout, level + 1
    yield from peaks()


def numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, i, ...) with the number of every leaf in its group, and (g, n) with the groups' sizes; written once.

    `leaves` has g, key and digest, by which it is ordered, and any other columns.
    """
    order = ["g", F.col("key").asc_nulls_first(), "digest"]
    table = materialize(leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "leaves")
    starts = table.groupBy("g", F.shiftright("__id", 33).alias("__part")).agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    starts = materialize(starts, "starts")  # a row for each range and group in it
    before = F.sum("__n").over(Window.partitionBy("g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    base = starts.select("g", "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__base"))
    placed = table.withColumn("__part", F.shiftright("__id", 33)).join(base, ["g", "__part"])
    return placed.withColumn("i", F.col("__id") + F.col("__base")).drop("__id", "__part", "__base"), starts.groupBy("g").agg(F.sum("__n").alias("n"))


def tree(leaves: DataFrame, sizes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(g, level, i, digest) of all nodes above the leaves (g, i, digest); a group of one leaf has that leaf as level 0."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("g", pa.string()), ("level", pa.int32()), ("i", pa.int64()), ("digest", pa.string()), ("open", pa.bool_())])
        yield from _batches(mountains(_rows(batches), fanout), schema)

    found = materialize(leaves.select("g", "i", "digest").sortWithinPartitions("g", "i").mapInArrow(climb, _NODES), "nodes")
    nodes = found.where("level > 0").select("g", "level", "i", "digest")
    largest = sizes.agg(F.max("n")).first()[0] or 0
    carried, level, count = found.where("open and level = 0").select("g", "i", "digest"), 0, largest
    while count > 1:
        # A run any of whose nodes is open has only open ones, as a carry takes whole runs.
        level, count = level + 1, -(-count // fanout)
        runs = carried.join(sizes.where(f"n > {fanout ** (level - 1)}").select("g"), "g", "left_semi").groupBy("g", F.expr(f"i div {fanout}").alias("i"))
        made = runs.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"]), ""), 256).alias("digest"))
        made = materialize(made.select("g", F.lit(level).alias("level"), "i", "digest"), "merged")
        nodes = nodes.unionAll(made)
        carried = made.select("g", "i", "digest").unionAll(found.where(f"open and level = {level}").select("g", "i", "digest"))
    single = leaves.join(sizes.where("n = 1").select("g"), "g", "left_semi").select("g", F.lit(0).alias("level"), "i", "digest")
    return nodes.unionAll(single)


def roots(nodes: DataFrame) -> DataFrame:
    """(g, digest) of every group's root: the only node of its highest level."""
    return nodes.groupBy("g").agg(F.max_by("digest", "level").alias("digest"))


def paths(nodes: DataFrame, sizes: DataFrame, above: DataFrame, level: int, fanout: int = FANOUT) -> DataFrame:
    """(g, i, path, subroot) for the nodes of a level, or for the root of a group that is not so high.

    A path has for each level the place in the run and the siblings there, up to the group's root, and then what `above`
    (g, path, subroot) has for it. It grows from the root down, a join of runs with their parents' paths for each level.
    """
    top = sizes.agg(F.max("n")).first()[0] or 0
    height = 0
    while fanout**height < top:
        height += 1
    rooted = sizes.join(above, "g")
    at_root = lambda low, high: rooted.where(f"n > {low} and n <= {high}").select("g", F.lit(0).cast("long").alias("i"), "path", "subroot")
    least = lambda k: fanout ** (k - 1) if k else 0  # noqa: E731 - a group whose root is at level k has more leaves than this
    known = at_root(least(max(height, level)), top)
    for k in range(height - 1, level - 1, -1):  # known: paths of the nodes of level k + 1
        runs = nodes.where(f"level = {k}").groupBy("g", F.expr(f"i div {fanout}").alias("up")).agg(F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("run"))
        x = runs.join(known.withColumnRenamed("i", "up"), ["g", "up"]).select("g", "path", "subroot", "run", F.posexplode("run").alias("position", "node"))
        others = F.array_join(F.transform(F.filter("run", lambda y: y["i"] != F.col("node.i")), lambda y: y["digest"]), "")
        step = F.array(F.struct("position", others.alias("siblings")))
        known = x.select("g", F.col("node.i").alias("i"), F.concat(step, "path").alias("path"), "subroot")
        known = materialize(known.unionAll(at_root(least(k), fanout**k)), "paths")
    return known.unionAll(at_root(0, least(level)))


def in_blocks(leaves: DataFrame, blocks: DataFrame, level: int, fanout: int = FANOUT) -> DataFrame:
    """(g, i, path, subroot, leaf) for every leaf (g, i, digest, ...): the path within its block, then its block's; leaf has its columns.

    `blocks` (g, i, n, path, subroot) has the nodes of a level, or a lower group's root.
    """
    size = fanout**level

    def steps(digests: list[str], whole: bool) -> Iterator[list[dict]]:
        """For each leaf of a block, the steps in it; a whole group ends at its root."""
        levels, now = [], digests
        while len(levels) < level and not (whole and len(now) == 1):
            levels.append(now)
            now = [_sha("".join(now[k : k + fanout])) for k in range(0, len(now), fanout)]
        for k in range(len(digests)):
            found = []
            for nodes in levels:
                up, place = divmod(k, fanout)
                found.append({"position": place, "siblings": "".join(nodes[up * fanout : k] + nodes[k + 1 : (up + 1) * fanout])})
                k = up
            yield found

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs(rows: Iterator[tuple]) -> Iterator[tuple]:
            held: list = []  # a block's head and its leaves
            for g, _, _, i, leaf, n, path, subroot in rows:
                if leaf is None:
                    yield from done(held)
                    held = [(g, i * size, n <= size, path, subroot)]
                else:
                    held.append(leaf)
            yield from done(held)

        def done(held: list) -> Iterator[tuple]:
            if held:
                (g, first, whole, path, subroot), *own = held
                for k, found in enumerate(steps([x["digest"] for x in own], whole)):
                    yield g, first + k, found + path, subroot, own[k]

        first = next(batches, None)
        if first is None:
            return
        kinds = first.schema
        schema = pa.schema([("g", pa.string()), ("i", pa.int64()), ("path", kinds.field("path").type), ("subroot", pa.string()), ("leaf", kinds.field("leaf").type)])
        yield from _batches(proofs(_rows(chain([first], batches))), schema, 200)

    own = F.struct(*(c for c in leaves.columns if c not in ("g", "i")))
    kind = leaves.select(own.alias("leaf")).schema["leaf"].dataType.simpleString()
    none = F.lit(None)
    rows = leaves.select("g", F.expr(f"i div {size}").alias("block"), F.lit(1).alias("kind"), "i", own.alias("leaf"), none.cast("long").alias("n"), none.cast(_PATH).alias("path"), none.cast("string").alias("subroot"))
    heads = blocks.select("g", F.col("i").alias("block"), F.lit(0).alias("kind"), "i", none.cast(kind).alias("leaf"), "n", "path", "subroot")
    x = rows.unionAll(heads).repartition("g", "block").sortWithinPartitions("g", "block", "kind", "i")
    return x.mapInArrow(prove, f"g string, i long, path {_PATH}, subroot string, leaf {kind}")


class Manifest:
    """The tree over the groups of a table, and what is needed to prove its rows."""

    def __init__(self, rows: DataFrame, group: Column, key: Column, digest: Column, *extra: Column, fanout: int = FANOUT) -> None:
        """`extra` columns are kept with the leaves."""
        self.fanout = fanout
        leaves = rows.select(group_key(group).alias("g"), key.alias("key"), digest.alias("digest"), *extra)
        self.leaves, self.sizes = numbered(leaves)
        self.leaves, self.sizes = materialize(self.leaves, "numbered"), materialize(self.sizes, "sizes")
        self.nodes = materialize(tree(self.leaves, self.sizes, fanout), "tree")
        self.subroots = materialize(roots(self.nodes), "subroots")
        over, self.group_sizes = numbered(self.subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), "digest"))
        self.over, self.group_sizes = materialize(over, "groups"), materialize(self.group_sizes, "sizes")
        self.over_nodes = materialize(tree(self.over, self.group_sizes, fanout), "tree")
        self.root = next((r.digest for r in roots(self.over_nodes).collect()), None)  # one group: one row

    def proofs(self) -> DataFrame:
        """(g, i, path, subroot, leaf) for every leaf; path has (position, siblings) for each level from the leaf to the root."""
        empty = F.array().cast(_PATH)
        start = self.group_sizes.select("g", empty.alias("path"), F.lit(None).cast("string").alias("subroot"))
        every = self.over.select("g", F.lit(0).alias("level"), "i", "digest").unionAll(self.over_nodes.where("level > 0"))
        over = paths(every, self.group_sizes, start, 0, self.fanout)
        above = materialize(over.drop("subroot", "g").join(self.over, "i").select(F.col("key").alias("g"), "path", F.col("digest").alias("subroot")), "above")
        blocks = paths(self.nodes, self.sizes, above, BLOCK_LEVEL, self.fanout).join(self.sizes, "g")
        return in_blocks(self.leaves, blocks, BLOCK_LEVEL, self.fanout)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    step = lambda own, x: F.sha2(F.concat(F.substr(x["siblings"], F.lit(1), x["position"] * WIDTH), own, F.substr(x["siblings"], x["position"] * WIDTH + 1)), 256)
    return F.aggregate(path, leaf, step)


def document_manifest(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest of documents by language; leaves keep doc_id and, where a condition holds, the digest of the tampered row.

    Tampering lower-cases the text's A-Z.
    """
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    other = F.when(F.lit(False) if tampered is None else tampered, digest_of(*columns, lower))
    return Manifest(docs, F.col("lang"), F.col("doc_id"), digest_of(*columns, F.col("text")), other.alias("tampered"))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Leaf, roots, digest of the proof, and what it says of a row that was tampered with in a third of all cases."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    m = document_manifest(docs, chosen)
    x = m.proofs().select(F.col("leaf.key").alias("doc_id"), F.col("leaf.digest").alias("leaf"), "leaf.tampered", "subroot", "path")
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s["siblings"]), ""), 256)
    root = F.lit(m.root).cast("string").alias("root")
    x = x.select("doc_id", "leaf", "subroot", root, proof.alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return x.withColumn("verified", F.col("folded_root") == F.col("root"))
