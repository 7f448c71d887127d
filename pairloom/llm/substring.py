"""Substring dedup through super-k-mers of words.

A window is WINDOW consecutive words. Its minimiser is the run of MINIMISER words inside it whose hash is smallest (the
leftmost of equals). Consecutive windows with the same minimiser form a super-k-mer and travel as one packed string to
the minimiser's bucket; equal windows have equal minimisers and so meet there, where sorting brings equal ones together.

1. Whole copies: a later copy of a text with a window or more is covered by the first one entirely, so only first
   copies go on (equal SHA-256).
2. Every super-k-mer sends its minimiser, its document and a hash of its words. Minimisers found in one document only
   can't hold a repeat. Of equal super-k-mers one is packed, that of the smallest document, so copies of a passage send
   one string however many they are.
3. Buckets are sorted by words. A minimiser with more than GROUP different strings is split by a longer second one:
   around the first, SPAN consecutive windows share a core of WINDOW - SPAN + 1 words, and they travel as one packed
   string to the core's bucket. Equal windows have their minimiser at the same place, so equal cores. Cores that still
   gather more than GROUP different strings go on with a span of one window, whose core is the window itself.
   Pieces add up: a string is cut into at most one piece for each SPAN windows. So no bucket grows with a frequent passage.
4. A bucket answers with a row for each string: ranges of windows that a smaller document has. Each document takes the
   ranges of its strings that a smaller document than itself has, and loses the words they cover.

Nulls: a null text has no words; a row with a null doc_id has no smaller id and is no one's smaller document, so it
keeps its words. Rows that repeat a doc_id are judged each by its own text, and never against one another: only smaller
ids count. Empty tables give no rows. Other columns are ignored. Very long texts are handled whole, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import hash_words, materialize, mix, release, signed_texts, slices, sliding_min, words_of

WINDOW, MINIMISER, GROUP, SPAN = 50, 16, 256, 7
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_STRING = "key long, h long, least long, most long, packed binary"


def gram_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Hash of each run of `size` words, combined from runs of 1, 2, 4, ... words."""
    have, step, done, out = hash_words(words), 1, 0, None
    with np.errstate(over="ignore"):
        while done < size:
            if size & step:
                part = have[done : done + len(words) - size + 1]
                out = mix(part) if out is None else mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
                done += step
            if done < size:
                have = mix(have[:-step] * np.uint64(0xC2B2AE3D27D4EB4F) + have[step:])
                step *= 2
    return out


def super_kmers(words: list[bytes], window: int = WINDOW, mini: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each super-k-mer of a text."""
    n = len(words) - window + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    low = sliding_min(gram_hashes(words, mini), window - mini + 1)
    cut = np.flatnonzero(low[1:] != low[:-1]) + 1
    first = np.concatenate([[0], cut])
    return first, np.diff(np.concatenate([first, [n]])), low[first].view(np.int64)


class Line:
    """Words joined by single spaces; the bytes of any run of them."""

    def __init__(self, words: list[bytes]) -> None:
        self.bytes = memoryview(b" ".join(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def run(self, first: int, n_words: int) -> memoryview:
        return self.bytes[self.starts[first] : self.ends[first + n_words - 1]]


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, sig, text -> a row for each super-k-mer: its minimiser, the hash of its words, first window, windows."""
    digest = xxhash.xxh3_64_intdigest
    for batch in slices(batches):
        docs, sigs, minis, hashes, firsts, ns = [], [], [], [], [], []
        for doc, sig, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            words = words_of(text)
            first, n, mini = super_kmers(words)
            if len(first):
                line = Line(words)
                begins, ends = line.starts[first].tolist(), line.ends[first + n + WINDOW - 2].tolist()
                hashes += [digest(line.bytes[a:b]) for a, b in zip(begins, ends, strict=True)]
                docs.append(np.full(len(first), doc, np.int64))
                sigs.append(np.full(len(first), sig, np.int64))
                minis.append(mini)
                firsts.append(first)
                ns.append(n)
        joined = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        columns = [pa.array(joined(x)) for x in (docs, sigs, minis)] + [pa.array(_signed(hashes))] + [pa.array(joined(x), pa.int32()) for x in (firsts, ns)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sig", "mini", "h", "first", "n"])


def _table(rows: list[tuple], names: str, kinds: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names.split())


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, runs -> the words of each super-k-mer, with the smallest and the largest document that has it."""
    kinds = (*[pa.int64()] * 4, pa.binary())
    for batch in slices(batches):
        out: list[tuple] = []
        for doc, text, runs in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            line = Line(words_of(text))
            out += [(r["mini"], r["h"], doc, r["most"], bytes(line.run(r["first"], r["n"] + WINDOW - 1))) for r in runs]
        yield _table(out, "key h least most packed", kinds)


def around_minimiser(words: list[bytes], mini: int) -> list[tuple[int, int, int]]:
    """(first window, windows, second key) of the pieces of a super-k-mer whose windows share a core around the minimiser."""
    n = len(words) - WINDOW + 1
    found = np.flatnonzero(gram_hashes(words, MINIMISER).view(np.int64) == mini)
    at = found[np.searchsorted(found, np.arange(n))]  # each window's leftmost minimiser
    block = (at - np.arange(n)) // SPAN
    starts = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]) | (block[1:] != block[:-1])) + 1])
    line, out = Line(words), []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
        core = line.run(int(at[a] - block[a] * SPAN), WINDOW - SPAN + 1)
        out.append((a, b - a, xxhash.xxh3_64_intdigest(core, int(block[a]))))
    return out


def single_windows(words: list[bytes], _: int) -> list[tuple[int, int, int]]:
    """The same for a span of one window."""
    line = Line(words)
    return [(k, 1, xxhash.xxh3_64_intdigest(line.run(k, WINDOW), SPAN)) for k in range(len(words) - WINDOW + 1)]


def _splitter(pieces: Callable[[list[bytes], int], list[tuple[int, int, int]]]) -> Callable:
    """Strings of crowded keys -> their pieces under longer keys, with the string they come from and their place in it."""
    kinds = (*[pa.int64()] * 4, pa.binary(), *[pa.int64()] * 2, pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, 200):
            out, keys, hashes = [], [], []
            for key, h, least, most, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = packed.split()
                line = Line(words)
                for first, n, longer in pieces(words, key):
                    piece = bytes(line.run(first, n + WINDOW - 1))
                    keys.append(longer)
                    hashes.append(digest(piece))
                    out.append((least, most, piece, key, h, first))
            rest = list(zip(*out, strict=True)) if out else [()] * 6
            columns = [pa.array(_signed(keys)), pa.array(_signed(hashes)), *(pa.array(c, k) for c, k in zip(rest, kinds[2:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "h", "least", "most", "packed", "of_key", "of_h", "base"])

    return run


def sort_bucket(least: np.ndarray, most: np.ndarray, packed: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """For each of a bucket's strings, ranges (first window, windows, document): a document smaller than `most` has these windows.

    Windows that documents smaller than all with the string have make ranges together, with the largest of these; so do
    windows that the smallest with the string has first.
    """
    split = [p.split() for p in packed]
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for s in split for w in s], np.int64)  # exact: equal words, equal codes
    ends = np.cumsum([len(s) for s in split])
    begins = ends - [len(s) for s in split]
    # Ranks of runs of 1, 2, 4, ... words by sorting pairs of ranks; equal rank means equal words.
    size, rank = 1, codes
    while size * 2 <= WINDOW:
        rank = _pair(rank[:-size], rank[size:])
        size *= 2
    rest = WINDOW - size
    rank = _pair(rank[: len(rank) - rest], rank[rest:]) if rest else rank
    at = np.concatenate([np.arange(a, b - WINDOW + 1) for a, b in zip(begins, ends, strict=True)])
    who = np.repeat(np.arange(len(split)), ends - begins - WINDOW + 1)
    rank, doc = rank[at], least[who]
    order = np.lexsort((doc, rank))
    r = rank[order]
    start = np.concatenate([[True], r[1:] != r[:-1]])
    low = np.empty_like(doc)
    low[order] = doc[order][np.maximum.accumulate(np.where(start, np.arange(len(r)), 0))]
    below = low < doc
    cut = np.concatenate([[0], np.flatnonzero((who[1:] != who[:-1]) | (below[1:] != below[:-1])) + 1])
    low = np.maximum.reduceat(low, cut)
    out: list[list[tuple[int, int, int]]] = [[] for _ in packed]
    use = low < most[who[cut]]
    for string, first, n, document in zip(*(x[use].tolist() for x in (who[cut], (at - begins[who])[cut], np.diff(np.concatenate([cut, [len(at)]])), low)), strict=True):
        out[string].append((first, n, document))
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


_RANGE = pa.struct([("first", pa.int32()), ("n", pa.int32()), ("least", pa.int64())])
_FOUND = "key long, h long, ranges array<struct<first:int,n:int,least:long>>"


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings sorted by key and hash -> a row for each that has ranges."""
    kept: list[tuple] = []
    now = None

    def close() -> Iterator[pa.RecordBatch]:
        if kept:
            hashes, least, most, packed = zip(*kept, strict=True)
            found = sort_bucket(np.array(least, np.int64), np.array(most, np.int64), list(packed))
            rows = [(now, h, [dict(zip(("first", "n", "least"), r, strict=True)) for r in ranges]) for h, ranges in zip(hashes, found, strict=True) if ranges]
            yield _table(rows, "key h ranges", (pa.int64(), pa.int64(), pa.list_(_RANGE)))

    for batch in slices(batches):
        for key, *row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if key != now:
                yield from close()
                kept, now = [], key
            if not kept or kept[-1][0] != row[0]:  # repeated rows of a table send a string twice
                kept.append(tuple(row))
    yield from close()


def _moved(by: str, below: str) -> Column:
    """The ranges that a smaller document than `below` has, from another origin."""
    return F.expr(f"transform(filter(ranges, r -> r.least < {below}), r -> named_struct('first', r.first + {by}, 'n', r.n, 'least', r.least))")


def solve(strings: DataFrame, depth: int = 0) -> DataFrame:
    """(key, h, ranges): windows of different strings (key, h, least, most, packed) that a smaller document has."""
    crowded = materialize(strings.groupBy("key").agg(F.count("*").alias("strings")).where(F.col("strings") > GROUP).select("key"), "crowded")
    calm = strings.join(crowded, "key", "left_anti").select("key", "h", "least", "most", "packed")
    found = calm.repartition("key").sortWithinPartitions("key", "h").mapInArrow(_buckets, _FOUND)
    if crowded.isEmpty():
        return found
    if depth == 2:
        raise RuntimeError(f"more than {GROUP} different windows share a hash of 64 bits")
    split = _splitter((around_minimiser, single_windows)[depth])
    dense = strings.join(crowded, "key", "left_semi").select("key", "h", "least", "most", "packed")
    pieces = materialize(dense.mapInArrow(split, f"{_STRING}, of_key long, of_h long, base int"), "pieces")
    different = materialize(pieces.groupBy("key", "h", "packed").agg(F.min("least").alias("least"), F.max("most").alias("most")).select("key", "h", "least", "most", "packed"), "different")
    inner = materialize(solve(different, depth + 1), "inner")
    places = pieces.select("key", "h", "of_key", "of_h", "base", "most").join(inner, ["key", "h"])
    places = places.select(F.col("of_key").alias("key"), F.col("of_h").alias("h"), _moved("base", "most").alias("ranges")).where("size(ranges) > 0")
    return found.unionAll(places.groupBy("key", "h").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    for batch in slices(batches):
        out = []
        for doc, text, copy, ranges in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            words = words_of(text)
            n = len(words)
            if copy and n >= WINDOW:
                keep: list[bytes] = []
            elif ranges:
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, [r["first"] for r in ranges], 1)
                np.add.at(edge, [r["first"] + r["n"] + WINDOW - 1 for r in ranges], -1)
                keep = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            else:
                keep = words
            out.append((doc, n, n - len(keep), hashlib.sha256(b" ".join(keep)).hexdigest()))
        yield _table(out, "doc_id n_words n_removed kept_sha256", kinds)


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sig, ranges): windows that also start in a document with a smaller id; and (doc_id, sig): later whole copies, which have none there."""
    named = signed_texts(docs)
    sha = named.select("doc_id", "sig", F.sha2("text", 256).alias("sha"))
    copies = materialize(sha.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("most > least").select("sha", "least"), "copies")
    later = materialize(sha.join(copies, "sha").where("doc_id > least").select("doc_id", "sig").distinct(), "later")
    runs = materialize(named.select("doc_id", "sig", "text").mapInArrow(_runs, "doc_id long, sig long, mini long, h long, first int, n int"), "runs")
    several = lambda x: x.groupBy("mini").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("high > low").select("mini")
    own = materialize(runs.join(several(runs), "mini", "left_semi").join(later, ["doc_id", "sig"], "left_anti"), "own")
    release(runs, copies)
    strings = materialize(own.groupBy("mini", "h").agg(F.min(F.struct("doc_id", "sig", "first", "n")).alias("one"), F.max("doc_id").alias("most")), "strings")
    shared = materialize(strings.groupBy("mini").agg(F.min("one.doc_id").alias("low"), F.max("most").alias("high")).where("high > low").select("mini"), "shared")
    wanted = strings.join(shared, "mini", "left_semi").select("one.doc_id", "one.sig", F.struct("one.first", "one.n", "mini", "h", "most").alias("run"))
    wanted = wanted.groupBy("doc_id", "sig").agg(F.collect_list("run").alias("runs"))
    packed = materialize(named.join(wanted, ["doc_id", "sig"]).select("doc_id", "text", "runs").mapInArrow(_pack, _STRING), "packed")
    found = materialize(solve(packed), "found")
    release(strings, shared, packed)
    places = own.join(found.withColumnRenamed("key", "mini"), ["mini", "h"])
    return places.select("doc_id", "sig", _moved("first", "doc_id").alias("ranges")).where("size(ranges) > 0"), later


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: its words, how many are removed, and the SHA-256 of the words that stay."""
    ranges, later = repeated_ranges(docs)
    gone = ranges.groupBy("doc_id", "sig").agg(F.flatten(F.collect_set("ranges")).alias("ranges")).select("doc_id", "sig", F.lit(False).alias("copy"), "ranges")
    gone = materialize(gone.unionAll(later.select("doc_id", "sig", F.lit(True), F.lit(None))), "gone")
    every = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("sig"))
    return every.join(gone, ["doc_id", "sig"], "left").select("doc_id", "text", "copy", "ranges").mapInArrow(_finish, OUT)
