"""Pairs: canonical order, multi-source dedup, degrees, exclusion, negatives."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.evidence import class_of, tier
from pairloom.operators.entities import ranked, with_base
from pairloom.operators.tables import spread, written

#: The bit of a mask that stands for NULL.
NULL_BIT = 62


def canonical(df: DataFrame, a: str, b: str, payload: list[tuple[str, str]] = ()) -> DataFrame:
    """Orders each pair's endpoints, swapping what belongs to them. A pair with a NULL endpoint stays as it is."""
    swap = F.coalesce(F.col(a) > F.col(b), F.lit(False))
    turned = {}
    for x, y in [(a, b), *payload]:
        turned[x] = F.when(swap, F.col(y)).otherwise(F.col(x))
        turned[y] = F.when(swap, F.col(x)).otherwise(F.col(y))
    return df.withColumns(turned)


def unordered(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows as unordered pairs (a, b), repeated ones too; rows with a NULL endpoint go, as least() and greatest() pass NULLs over."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b))


def undirected(df: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """Distinct unordered pairs (a, b) without NULL endpoints. rows: as in spread()."""
    return spread(unordered(df, a, b), a, b, rows=rows).distinct()


def joined_distinct(x: Column, separator: str = ";") -> Column:
    """Sorted distinct non-NULL values of a group as one text."""
    return F.array_join(F.array_sort(F.collect_set(x)), separator)


def joined_tokens(x: Column) -> Column:
    """Sorted distinct tokens of a group's ;-lists as one text."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.split(x, ";"), lambda t: t != ""))))), ";")


def distinct_with_null(x: Column) -> Column:
    """Number of distinct values, NULL counting as one. A group's set is kept once, so several such counts don't multiply rows as DISTINCT would."""
    return (F.size(F.collect_set(x)) + F.max(x.isNull().cast("int"))).cast("long")


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def _unknown(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"no {what} of the enumeration: "), F.coalesce(value, F.lit("null")))).cast("long")


def source_mask(source: Column, names: list[str]) -> Column:
    """A bit for an enumerated source, one of its own for NULL; any other value is an error."""
    at = F.array_position(F.array(*map(F.lit, names)), source).cast("int")
    return F.when(source.isNull(), F.lit(1 << NULL_BIT)).when(at > 0, _bit(at - 1)).otherwise(_unknown("source", source))


def token_mask(text: Column, names: list[str]) -> Column:
    """A bit for each enumerated token of a ;-list; any other token is an error."""
    items = F.split(text, ";")
    bits = [F.when(F.array_contains(items, n), F.lit(1 << k)).otherwise(F.lit(0)) for k, n in enumerate(names)]
    known = F.size(F.array_except(items, F.array(*map(F.lit, [*names, ""])))) == 0
    return F.when(text.isNull() | known, reduce(Column.bitwiseOR, bits).cast("long")).otherwise(_unknown("token", text))


def names_of(mask: Column, names: list[str]) -> Column:
    """The names whose bits are set, sorted, as one text."""
    return F.concat_ws(";", *(F.when(mask.bitwiseAND(F.lit(1 << names.index(n))) != 0, F.lit(n)) for n in sorted(names)))


def dedup(df: DataFrame, a: str, b: str, label: str, source: str, evidence: str, joined: list[str] = (), sources: list[str] | None = None, tags: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """One row for each canonical pair: a positive label wins, sources are counted, texts are merged.

    There is one shuffle. Aggregates combine before it, unless `rows` tells of a table too large for that (see spread()).
    With enumerated sources and tags (at most 62 each) and labels of 0 and 1 a group's sets are bits of a number, and the
    aggregate runs in generated code on flat buffers.
    """
    ordered = canonical(df, a, b)
    texts = [joined_distinct(F.col(c)).alias(c) for c in joined]
    if sources is None or tags is None:
        return spread(ordered, a, b, rows=rows).groupBy(a, b).agg(
            F.max(label).alias("label"),
            F.size(F.collect_set(label)).cast("long").alias("n_labels"),
            distinct_with_null(F.col(source)).alias("n_sources"),
            joined_distinct(F.col(source)).alias("sources"),
            joined_tokens(F.col(evidence)).alias("evidence_tags"),
            *texts,
        )
    masked = ordered.select(a, b, F.col(label).alias("__label"), source_mask(F.col(source), sources).alias("__source"), token_mask(F.col(evidence), tags).alias("__tag"), *joined)
    masks = F.bit_or("__source").alias("__sources"), F.bit_or("__tag").alias("__tags")
    x = spread(masked, a, b, rows=rows).groupBy(a, b).agg(F.max("__label").alias("label"), F.min("__label").alias("__least"), *masks, *texts)
    n_labels = F.when((F.col("__least") < 0) | (F.col("label") > 1), F.raise_error(F.lit("labels are 0 and 1"))).when(F.col("label").isNull(), 0).when(F.col("label") == F.col("__least"), 1).otherwise(2).cast("long")
    n_sources = F.bit_count("__sources").cast("long")
    return x.select(a, b, "label", n_labels.alias("n_labels"), n_sources.alias("n_sources"), names_of(F.col("__sources"), sources).alias("sources"), names_of(F.col("__tags"), tags).alias("evidence_tags"), *joined)


def with_tier(pairs: DataFrame) -> DataFrame:
    """Class and tier of deduplicated pairs."""
    listed = F.concat(F.lit(";"), F.coalesce("evidence_tags", F.lit("")), F.lit(";"))
    kind = class_of(lambda t: F.contains(listed, F.lit(f";{t};")), F.col("label"))
    return pairs.withColumn("evidence_type", kind).withColumn("tier", tier(F.col("evidence_type"), F.col("label"), F.col("n_sources")))


def degrees(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, degree): how often each endpoint stands on either side."""
    return pairs.select(F.explode(F.array(a, b)).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def exclude_pairs(pairs: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key pair isn't among the other's."""
    return pairs.join(other.select(*keys).distinct(), keys, "left_anti")


def exclude_endpoints(pairs: DataFrame, ids: DataFrame, a: str, b: str | None = None) -> DataFrame:
    """Rows of which no endpoint (or only a's side, without b) is among the ids (first column)."""
    key = ids.columns[0]
    bad = ids.select(F.col(key).alias("__bad")).distinct()
    for side in [a] + ([b] if b else []):
        pairs = pairs.join(bad, F.col(side) == F.col("__bad"), "left_anti")
    return pairs


def hash_rank(seed: int | str, *keys: str) -> Column:
    """A seeded order of rows that depends on nothing but their keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def lowest(df: DataFrame, n: int, *order: str | Column, rows: int | None = None) -> DataFrame:
    """The first n rows in an order that no two rows share, whatever n: no task or driver holds or sorts them all.

    Rows are ranged by the order, sorted and written; the ranges' sizes tell which lie below the n-th row as a whole, and
    only in the one range that it falls into do places count. rows: how many df has, if known; large tables get more ranges.
    """
    parts, sizes = ranked(df, *order, rows=rows)
    ends = list(accumulate(sizes))
    last = next((k for k, end in enumerate(ends) if end >= n), len(sizes))
    inside = n - (ends[last - 1] if last else 0)
    return parts.where((F.col("__part") < last) | (F.col("__part") == last) & (F.col("__at") < inside)).select(*df.columns)


def lowest_hashes(df: DataFrame, n: int, rank: Column, keys: tuple[str, ...], priority: Column | None = None, digits: int = 3) -> DataFrame:
    """The first n rows by priority, then by a hexadecimal hash, then by unique keys, whatever n.

    The driver sees how many rows each priority and prefix of the hash has (4,096 prefixes). Cells below the n-th row are
    taken as they are; only the one cell that it falls into is sorted.
    """
    first = F.lit(0.0) if priority is None else F.coalesce(priority.cast("double"), F.lit(float("-inf")))
    x = df.withColumns({"__priority": first, "__rank": rank})
    cell = F.substring("__rank", 1, digits)
    counts = sorted((r["__priority"], r["__cell"], r.n) for r in x.groupBy("__priority", cell.alias("__cell")).agg(F.count("*").alias("n")).collect())
    ends = list(accumulate(c for _, _, c in counts))
    at = next((k for k, end in enumerate(ends) if end > n), None)
    if at is None:
        return df
    p, prefix, _ = counts[at]
    mine = F.col("__priority") == F.lit(p)
    whole = x.where((F.col("__priority") < F.lit(p)) | mine & (cell < prefix))
    opened = lowest(x.where(mine & (cell == prefix)), n - (ends[at - 1] if at else 0), "__rank", *keys)
    return whole.unionByName(opened).drop("__priority", "__rank")


def sample(df: DataFrame, n: int, seed: int | str, *keys: str) -> DataFrame:
    """A uniform sample of n rows: those with the smallest seeded hashes of their unique keys."""
    return lowest_hashes(df, n, hash_rank(seed, *keys), keys)


def sample_by_priority(df: DataFrame, n: int, priority: Column, seed: int | str, *keys: str) -> DataFrame:
    """n rows, the lower priority numbers used up first, each class in hash order."""
    return lowest_hashes(df, n, hash_rank(seed, *keys), keys, priority)


def hash_number(*parts: Column) -> Column:
    """A number of 60 bits from the MD5 of texts, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def draw_endpoints(pairs: DataFrame, a: str, b: str, draws: int, seed: int, weighted: bool = True) -> DataFrame:
    """(k, left, right): endpoints drawn with replacement, by degree or uniformly.

    Draw k's two positions are hashes of seed, side and k into the running total of weights, nodes in order; a position
    finds its endpoint by a range join that is made an equi-join on blocks of the running total, so no task scans all
    endpoints.
    """
    spark = pairs.sparkSession
    nodes = degrees(pairs, a, b).select("node", (F.col("degree") if weighted else F.lit(1)).cast("long").alias("w"))
    parts, sizes = ranked(nodes, "node")
    sums = {x["__part"]: x.w for x in parts.groupBy("__part").agg(F.sum("w").alias("w")).collect()}  # a number for each range
    bases = list(accumulate((sums.get(k, 0) for k in range(len(sizes))), initial=0))
    inner = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    local = with_base(parts.withColumn("upto", F.sum("w").over(inner)), bases[:-1])
    ranges = local.select("node", (F.col("__base") + F.col("upto") - F.col("w")).alias("lo"), (F.col("__base") + F.col("upto")).alias("hi"))
    total = bases[-1]
    block = max(1, total // max(4096, sum(sizes) // 8))  # about eight endpoints a block, however many there are
    cells = ranges.select("node", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("cell"))
    out = spark.range(draws).select(F.col("id").alias("k"))
    for side in ("left", "right"):
        at = F.pmod(hash_number(F.lit(str(seed)), F.lit(side), F.col("k").cast("string")), F.lit(max(1, total)))
        hit = spread(out.withColumn("at", at).withColumn("cell", F.floor(F.col("at") / block)), "cell", rows=draws).join(cells, "cell").where("at >= lo and at < hi")
        out = hit.select(*(c for c in out.columns), F.col("node").alias(side))
    return out


def sample_negatives(positives: DataFrame, a: str, b: str, n: int, seed: int, weighted: bool = True, most_rounds: int = 20, exclude: DataFrame | None = None, known: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """n distinct unordered pairs of endpoints of `positives` that are no known pair (these, unless told) and no self pair; an error if that fails.

    Each round's draws are written, so a further round adds to them and repeats nothing. rows: of positives and of
    pairs that are known or excluded, about; with the draws they tell how many partitions the steps need.
    """
    known = unordered(positives if known is None else known, a, b)
    known = known.unionByName(unordered(exclude, a, b)) if exclude is not None else known
    found, draws = None, max(64, 2 * n)
    for turn in range(most_rounds):
        new = draw_endpoints(positives, a, b, draws, seed + turn, weighted).where("left <> right")
        new = spread(new.select(F.least("left", "right").alias(a), F.greatest("left", "right").alias(b), "k"), a, b, rows=draws + rows)
        new = new.groupBy(a, b).agg((F.min("k") + turn * draws).alias("k"))
        new = written(new.join(known, [a, b], "left_anti"), "negatives")
        found = new if found is None else found.unionAll(new)
        first = found if turn == 0 else spread(found, a, b, rows=(turn + 1) * draws).groupBy(a, b).agg(F.min("k").alias("k"))
        if (made := first.count()) >= n:
            return lowest(first, n, "k", rows=made).select(a, b)
    raise ValueError(f"fewer than {n} negatives after {most_rounds} rounds")


def with_negatives(positives: DataFrame, a: str, b: str, per_positive: float, seed: int, weighted: bool = True, most: int | None = None, exclude: DataFrame | None = None, only_negatives: bool = False) -> DataFrame:
    """(a, b, label, category): distinct positives without self pairs, and for each so many sampled negatives.

    The number of negatives is rounded half to even, and capped if asked for; pairs of `exclude` are no negatives either.
    """
    real = positives.where(F.col(a) != F.col(b)).select(a, b).distinct()
    wanted = round(real.count() * per_positive)
    wanted = min(wanted, most) if most is not None else wanted
    listed = real.select(a, b, F.lit(1).alias("label"), F.lit("positive").alias("category"))
    if wanted <= 0:
        if only_negatives:
            raise ValueError("nothing to write: no positives are wanted and no negatives are due")
        return listed
    drawn = sample_negatives(real, a, b, wanted, seed, weighted, exclude=exclude)
    drawn = drawn.select(a, b, F.lit(0).alias("label"), F.lit(f"negative_{'degree' if weighted else 'uniform'}").alias("category"))
    return drawn if only_negatives else listed.unionByName(drawn)


def fill_negatives(pairs: DataFrame, a: str, b: str, label: str, per_positive: int, seed: int) -> DataFrame:
    """(a, b, label, category): positives as they are, and `per_positive` negatives for each.

    Given negatives come first, unchecked; random pairs of all endpoints that are no positive fill up what lacks. Of more
    given ones than are wanted the first in order stay.
    """
    positives = pairs.where(F.col(label) == 1)
    rows = pairs.count()
    given = written(undirected(pairs.where(F.col(label) == 0), a, b, rows=rows), "given")  # several steps read them
    target = positives.count() * per_positive
    n_given = given.count()
    lacks = target - n_given
    every = given
    if lacks > 0:
        more = sample_negatives(pairs, a, b, lacks, seed, False, exclude=given, known=positives, rows=rows)
        every = given.unionByName(more)
    chosen = lowest(every, target, a, b, rows=max(n_given, target))
    return positives.select(a, b, F.lit(1).alias("label"), F.lit("positive").alias("category")).unionByName(chosen.select(a, b, F.lit(0).alias("label"), F.lit("negative_sampled").alias("category")))


def combinations(df: DataFrame, group: str, item: str, order: str) -> DataFrame:
    """Every two items of a group, the earlier first. Groups are small by nature (the chains of one structure)."""
    x = df.select(F.col(group), F.col(item).alias("left"), F.col(order).alias("__a"))
    y = df.select(F.col(group), F.col(item).alias("right"), F.col(order).alias("__b"))
    return x.join(y, group).where("__a < __b").select(group, "left", "right")


def unpivot(df: DataFrame, keys: list[str], sides: list[tuple[str, str]], value: str = "value", role: str = "role") -> DataFrame:
    """A row for each side of a pair, with its role."""
    return df.select(*keys, F.explode(F.array(*(F.struct(F.lit(name).alias(role), F.col(c).alias(value)) for c, name in sides))).alias("x")).select(*keys, f"x.{role}", f"x.{value}")
