"""SimHash near-duplicates through vantage-point trees.

Distinct fingerprints are cut into shards by a tree of vantage points: a fingerprint within a node's radius of its
vantage point goes inside, any other outside. The triangle inequality bounds what a search must visit: two fingerprints
that differ in at most r bits have distances to a vantage point that differ by at most r, so a pair that a node
separates has its outer member in the shell (radius, radius + r]. That shell, and nothing else, also travels inside as
a visitor. Every pair within r bits therefore meets in exactly one shard at least, and the pair search is exact.

The tree's vantage points and radii are fitted on a bounded sample of distinct fingerprints (SAMPLE); they decide only
how even the shards are, never which pairs are found. Shards are counted, and one of more than MOST fingerprints gets a
tree of its own and is dealt out again, until none is larger: a task's memory doesn't grow with the corpus. What no
tree can split (balls of a few bits' radius) is joined by one-bit variants, 65 rows for each fingerprint, of which a
group holds 65 at most. A shard goes on splitting in memory by the same rules. Shards return a spanning forest, so links
grow with the number of fingerprints and not with its square.

Nulls: a null text is a text without words; a null doc_id keeps its row, its class being the smallest non-null id that
is reachable (null if none). Empty tables give no rows; repeated rows and ids give a row each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import components, free_name, hash_sample, materialize, release, slices, with_values
from pairloom.operators.clusters import missed_links

#: Fingerprints that the first tree is fitted on, and those of all later ones together, at most; how many of all
#: fingerprints a shard should hold, and how many it may hold.
SAMPLE, AGAIN, SHARD, MOST = 32768, 1 << 20, 512, 65536
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `size` words of the A-Z lower-cased text, repeats included; of all words if fewer."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero without any."""
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k : k + (1 << 16)].astype("<u8", copy=False)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(shingle_hashes(t, size)) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


class Node:
    """An inner node of a vantage-point tree; a child is a Node or a shard's number."""

    __slots__ = ("inside", "outside", "point", "radius")

    def __init__(self, point: int, radius: int, inside: Node | int, outside: Node | int) -> None:
        self.point, self.radius, self.inside, self.outside = point, radius, inside, outside


def best_split(fps: np.ndarray, r: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """Vantage point and radius with the least work: the larger side, visitors counted, as even as can be."""
    best, found = len(fps) * 0.97, None
    for at in rng.choice(len(fps), min(12, len(fps)), replace=False):
        for point in (fps[at], ~fps[at]):
            counts = np.bincount(np.bitwise_count(fps ^ point), minlength=65)
            upto = np.cumsum(counts)
            visit = upto[np.minimum(np.arange(65) + r, 64)]
            worst = np.maximum(visit, len(fps) - upto) + 0.25 * (visit - upto)
            worst[(upto == 0) | (upto == len(fps))] = np.inf
            if worst.min() < best:
                best, found = worst.min(), (int(point), int(worst.argmin()))
    return found


def fit_tree(sample: np.ndarray, r: int, shards: int) -> tuple[Node | int, int]:
    """A tree with about so many shards, and its number of shards."""
    rng, made = np.random.default_rng(7), [0]
    least = max(8, len(sample) // max(1, shards))

    def grow(fps: np.ndarray) -> Node | int:
        split = best_split(fps, r, rng) if len(fps) > least else None
        if split is None:
            made[0] += 1
            return made[0] - 1
        near = np.bitwise_count(fps ^ np.uint64(split[0])) <= split[1]
        return Node(*split, grow(fps[near]), grow(fps[~near]))

    return grow(sample), made[0]


def route(fps: np.ndarray, tree: Node | int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that go to a shard (positions in fps) and the shards: one in which each is at home, others that it visits."""
    rows, shards = [], []
    todo = [(tree, np.arange(len(fps)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            rows.append(at)
            shards.append(np.full(len(at), node))
            continue
        d = np.bitwise_count(fps[at] ^ np.uint64(node.point))
        # The shell outside seeks its partners inside as well.
        todo += [(node.inside, at[d <= node.radius + r]), (node.outside, at[d > node.radius])]
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return join(rows), join(shards)


class Forest:
    """Union-find over positions; the smallest label is a set's root."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        find, up = self.find, self.up
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)


_BRUTE = 384


def _all_pairs(fps: np.ndarray, at: np.ndarray, r: int, forest: Forest) -> None:
    step = max(1, 4_000_000 // max(1, len(at)))
    for k in range(0, len(at), step):
        a, b = np.nonzero(np.bitwise_count(fps[at[k : k + step], None] ^ fps[at][None, :]) <= r)
        more = b > a + k
        forest.join(at[a[more] + k], at[b[more]])


def _variants(fps: np.ndarray, at: np.ndarray, forest: Forest) -> None:
    """Joins all pairs within two bits: these share a fingerprint with at most one bit changed. 65 sorted keys each."""
    own = fps[at]
    keys = np.concatenate([own, *(own ^ np.uint64(1 << i) for i in range(64))])
    who = np.tile(at, 65)
    order = np.argsort(keys, kind="stable")
    keys, who = keys[order], who[order]
    same = keys[1:] == keys[:-1]
    forest.join(who[:-1][same], who[1:][same])


def link_shard(fps: np.ndarray, r: int) -> Forest:
    """Union-find of the pairs within r bits among a shard's fingerprints, homes and visitors alike."""
    forest, rng = Forest(len(fps)), np.random.default_rng(11)
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        split = best_split(fps[at] if len(at) < 4096 else fps[at[:: len(at) // 4096]], r, rng) if len(at) > _BRUTE else None
        if len(at) <= _BRUTE or split is None and (r != 2 or len(at) < 4096):
            _all_pairs(fps, at, r, forest)
        elif split is None:
            _variants(fps, at, forest)
        else:
            d = np.bitwise_count(fps[at] ^ np.uint64(split[0]))
            inner, outer = at[d <= split[1] + r], at[d > split[1]]
            if max(len(inner), len(outer)) == len(at):
                (_variants(fps, at, forest) if r == 2 else _all_pairs(fps, at, r, forest))
            else:
                todo += [inner, outer]
    return forest


_DEALT = "shard long, fp long, rep long"


def _dealer(trees: dict[int, tuple[Node | int, int]], r: int):
    """shard, fp, rep -> the same under the shards of each old shard's tree, numbered from its base."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            old, fps, rep = (batch.column(k).to_numpy() for k in range(3))
            for shard in np.unique(old).tolist():
                own = np.flatnonzero(old == shard)
                tree, base = trees[shard]
                rows, new = route(fps[own].view(np.uint64), tree, r)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (new + base, fps[own][rows], rep[own][rows])], names=["shard", "fp", "rep"])

    return deal


def shards(reps: DataFrame, r: int = 2, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(shard, fp, rep): distinct fingerprints dealt out so that each pair within r bits meets; and those of balls that no tree makes smaller than `most`."""
    n = reps.count()
    sample = np.array([x.fp for x in hash_sample(reps.select("fp"), "fp", SAMPLE, n)], np.int64).view(np.uint64)
    tree, made = fit_tree(sample, r, min(SAMPLE // 8, -(-n // SHARD)))
    now = materialize(reps.select(F.lit(0).cast("long").alias("shard"), "fp", "rep").mapInArrow(_dealer({0: (tree, 0)}, r), _DEALT), "dealt")
    parts, dense = [], []
    while True:
        large = {x.shard: x["count"] for x in now.groupBy("shard").count().where(F.col("count") > most).collect()}
        if not large:
            return reduce(DataFrame.unionAll, parts, now), reduce(DataFrame.unionAll, dense, now.where("false"))
        names = reps.sparkSession.createDataFrame([(x,) for x in large], "shard long")  # as many as there are shards
        again = now.join(F.broadcast(names), "shard")
        parts.append(now.join(F.broadcast(names), "shard", "left_anti"))
        points: dict[int, list[int]] = {}
        for x in hash_sample(again.select("shard", "fp"), "fp", min(AGAIN, SAMPLE * len(large)), sum(large.values())):
            points.setdefault(x.shard, []).append(x.fp)
        trees: dict[int, tuple[Node | int, int]] = {}
        for shard, size in large.items():
            tree, leaves = fit_tree(np.array(points.get(shard, ()), np.int64).view(np.uint64), r, -(-size // max(1, most // 8)))
            if leaves > 1:
                trees[shard] = (tree, made)
                made += leaves
        whole = again.where(~F.col("shard").isin(*trees)) if trees else again
        dense.append(whole)
        now = materialize((again.where(F.col("shard").isin(*trees)) if trees else again.where("false")).mapInArrow(_dealer(trees, r), _DEALT), "dealt")


def variant_links(dense: DataFrame, r: int) -> DataFrame:
    """(a, b) among (fp, rep), r even: fingerprints within r bits share one of their variants of r / 2 changed bits at most."""
    if r % 2:
        raise ValueError(f"{r} is odd: such balls can't be joined by variants")
    flips = [sum(1 << b for b in bits) for k in range(r // 2 + 1) for bits in combinations(range(64), k)]
    masks = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips))
    keys = dense.select("fp", "rep").distinct().select("rep", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))
    met = keys.groupBy("key").agg(F.min("rep").alias("b"), F.collect_list("rep").alias("all"))  # as many as there are variants
    return met.select(F.explode("all").alias("a"), "b").where("a <> b").distinct()


def links(reps: DataFrame, r: int = 2, most: int = MOST) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints (fp, rep) that differ in at most r bits."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _groups(batches):
            _, fps, rep = shard
            order = np.argsort(rep)  # so that a set's root is its smallest id
            fps, rep = fps[order].view(np.uint64), rep[order]
            forest = link_shard(fps, r)
            roots = np.array([forest.find(k) for k in range(len(fps))], np.int64)
            tied = roots != np.arange(len(fps))
            yield pa.RecordBatch.from_arrays([pa.array(rep[tied]), pa.array(rep[roots[tied]])], names=["a", "b"])

    dealt, dense = shards(reps, r, most)
    found = dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(search, "a long, b long")
    return found if dense.isEmpty() else found.unionAll(variant_links(dense, r))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of each shard, from batches that are sorted by shard."""
    kept: list[pa.RecordBatch] = []
    now = None
    for batch in slices(batches):
        ids = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if kept and ids[a] != now:
                yield now, *(np.concatenate([x.column(k).to_numpy() for x in kept]) for k in (1, 2))
                kept = []
            now = ids[a]
            kept.append(batch.slice(a, b - a))
    if kept:
        yield now, *(np.concatenate([x.column(k).to_numpy() for x in kept]) for k in (1, 2))


def near_duplicates(docs: DataFrame, size: int = 3, r: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document; documents link at r or fewer differing bits."""
    found = materialize(fingerprints(docs, size), "fingerprints")
    reps = materialize(found.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    lone = found.where("doc_id is null").select("fp").distinct().join(reps, "fp", "left_anti")
    if not lone.isEmpty():  # without an id, such fingerprints can still connect others
        low = F.lit(-(2**62)) - F.pmod(F.xxhash64("fp"), F.lit(2**61))
        reps = materialize(reps.unionAll(lone.select("fp", low.alias("rep"))), "reps")
    classes = components(links(reps, r))
    if not lone.isEmpty():
        real = classes.where(F.col("node") > -(2**61)).groupBy("component").agg(F.min("node").alias("least"))
        classes = classes.join(real, "component", "left").select("node", F.col("least").alias("component"))
    moved = materialize(reps.join(classes, F.col("rep") == F.col("node"), "left").select("fp", F.when(F.col("node").isNull(), F.when(F.col("rep") > -(2**61), F.col("rep"))).otherwise(F.col("component")).alias("component_id")), "classes")
    return found.join(moved, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: For similarity: so many bands of so many minimum hashes; two texts with Jaccard similarity 0.8 share a band with
#: probability 1 - (1 - 0.8**5)**16 = 0.998.
BANDS, ROWS = 16, 5


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of minimum hashes of a set of shingles."""
    rng = np.random.default_rng(17)
    flip, by = (rng.integers(0, 2**63, BANDS * ROWS, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 2048):
            np.minimum(low, ((hashes[k : k + 2048, None] ^ flip) * by).min(axis=0), out=low)
    h = xxhash.xxh64_intdigest
    return np.array([h(low[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)], np.uint64).view(np.int64)


def _nodes(signed: DataFrame) -> DataFrame:
    """Adds `node`, a number for each doc_id and text: the doc_id itself, or one from 2^62 on for further texts of an id."""
    several = signed.groupBy("doc_id").agg(F.min("sig").alias("__least"), F.max("sig").alias("__most")).where("__most > __least").select("doc_id", "__least")
    extra = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "sig"), F.lit(1 << 61))
    return signed.join(several, "doc_id", "left").withColumn("node", F.when(F.col("sig") > F.col("__least"), extra).otherwise(F.col("doc_id"))).drop("__least")


def near_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, r: int = 2) -> DataFrame:
    """(doc_id, sig, node, component): near-duplicates on shingles of `size` words, a row for each that has one.

    sig is the text's hash: texts of one doc_id are nodes of their own. Texts without words are copies of each other.

    Links are fingerprints within r bits, found by the trees above, and pairs of at least the given Jaccard similarity.
    A similarity of 0.8 leaves about ten differing bits of 64; shells of that width hold most of all fingerprints, so a
    tree prunes nothing there. Such pairs are found by bands of minimum hashes instead: each text is compared, exactly
    and by its whole shingle set, with the first text and with the hub of each of its bands' groups. What that leaves
    unconnected in a group is then compared exactly with everything in it that it isn't connected to, so every pair that
    shares a band is decided. Links stay linear in a group; comparisons are quadratic only in the texts of a group that
    are not like its most common class. What is compared are shingle sets, made once for the members of groups; a hub's
    is sent once for each few hundred of its partners.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_hashes(t, size) for t in batch.column(2).to_pylist()]
            fps = np.array([fingerprint(s) for s in sets], np.uint64).view(np.int64)
            keys = [band_keys(s).tolist() if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "sig", "fp", "bands"])

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(t, size).view(np.int64)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = (batch.column(k) for k in (2, 3))
            good = []
            for k in range(len(batch)):
                x, y = (side[k].values.to_numpy() for side in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("sig"), "text").where("doc_id is not null")
    signed = named.mapInArrow(sign, "doc_id long, sig long, fp long, bands array<long>")
    signed = materialize(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    nodes = materialize(_nodes(signed.select("doc_id", "sig", "fp", "row")), "nodes")
    reps = nodes.groupBy("fp").agg(F.min(F.struct("node", "row")).alias("one"), F.max("node").alias("most"))
    reps = materialize(reps.select("fp", F.col("one.node").alias("rep"), "one.row", "most"), "reps")
    copies = nodes.join(reps.where("most > rep").select("fp", "rep"), "fp").where("node > rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    # Texts with one fingerprint are near copies already; the first of them stands for all.
    keyed = signed.select("row", "bands").join(reps.select("row", F.col("rep").alias("node")), "row").select("node", F.posexplode("bands").alias("band", "key"))
    keyed = materialize(keyed, "bands")
    firsts = materialize(keyed.groupBy("band", "key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    grouped = materialize(keyed.join(firsts, ["band", "key"]), "grouped")
    release(signed, keyed, firsts)
    # The hub of a band group is the member whose groups are largest in sum: an original, or what is closest to it.
    score = materialize(grouped.groupBy("node").agg(F.sum("n").alias("score")), "scores")
    hubs = grouped.join(score, "node").groupBy("band", "key").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("hub"))
    hubs = materialize(hubs, "hubs")
    stars = grouped.select("node", "first").unionAll(grouped.select("node", "band", "key").join(hubs, ["band", "key"]).select("node", "hub"))
    pairs = materialize(stars.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "pairs")
    ids = score.select("node").join(nodes.select("node", "doc_id", "sig"), "node").distinct()
    texts = named.join(ids, ["doc_id", "sig"]).groupBy("doc_id", "sig", "node").agg(F.min("text").alias("text"))  # a repeated row counts once
    sets = materialize(texts.select("node", "text").mapInArrow(shingle, "node long, set array<long>"), "sets")
    release(score, hubs)
    like = with_values(pairs, sets, ["a"], ["b"], ["node"], "set").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")
    like = materialize(like, "alike")
    near = materialize(links(reps.select("fp", "rep"), r), "links")
    classes = materialize(components(near.unionAll(copies).unionAll(like)), "near-classes")
    release(pairs, near, like)
    members = grouped.select(F.col("node").alias("id"), F.col("key").alias("group"))
    known = classes.select(F.col("node").alias("id"), F.col("component").alias("class"))
    more = materialize(missed_links(members, known, sets.select(F.col("node").alias("id"), F.col("set").alias("value")), similarity, set), "more")
    release(sets, grouped)
    if not more.isEmpty():
        classes = components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b").unionAll(more))
    rows = nodes.select("doc_id", "sig", "node").join(classes, "node").distinct()
    # Further texts of an id have large numbers, but may have the smallest id of their class.
    least = materialize(rows.where(F.col("node") >= 1 << 62).groupBy("component").agg(F.min(F.struct("doc_id", "sig", "node")).alias("least")), "least")
    smaller = F.col("least.doc_id") < F.col("component")
    return rows.join(least, "component", "left").select("doc_id", "sig", "node", F.when(smaller, F.col("least.node")).otherwise(F.col("component")).alias("component"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents but for near-duplicates of one with a smaller id, all columns kept; rows with a null doc_id stay.

    Of texts under one doc_id that are near-duplicates one stays, others are judged each by itself. Of rows that repeat
    doc_id and text one stays, that with the smallest hash of all its columns.
    """
    names = {c: free_name(docs, f"__{c}") for c in ("doc_id", "sig")}
    gone = materialize(near_groups(docs, size, similarity).where("node <> component").select("doc_id", "sig").distinct(), "gone").withColumnsRenamed(names)
    sig = F.xxhash64(docs["text"])
    left = docs.join(gone, (docs["doc_id"].cast("long") == F.col(names["doc_id"])) & (sig == F.col(names["sig"])), "left_anti")
    again = materialize(docs.where("doc_id is not null").groupBy("doc_id", F.xxhash64("text").alias("sig")).agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").cast("long"), "sig"), "again")
    if again.isEmpty():
        return left
    again = again.withColumnsRenamed(names)
    same = (left["doc_id"].cast("long") == F.col(names["doc_id"])) & (F.xxhash64(left["text"]) == F.col(names["sig"]))
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    number, order = free_name(docs, "__number"), F.xxhash64(*plain)
    once = left.join(again, same).withColumn(number, F.row_number().over(Window.partitionBy(names["doc_id"], names["sig"]).orderBy(order)))
    return left.join(again, same, "left_anti").unionAll(once.where(F.col(number) == 1).select(*docs.columns))
