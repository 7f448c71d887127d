"""Line dedup by pairwise alignment of overlapping documents.

1. Every text becomes the hashes of its lines (white space around them ignored). Lines of fewer than LINE_WORDS words
   can't start an overlap, but may be part of one.
2. Later whole copies (same line hashes) lose everything to the first copy, without an alignment.
3. A line found in several documents pairs each of them with the first document that has it: a star, so pairs grow with
   the occurrences of lines and never with their square. Every pair is aligned, however frequent its lines are, and an
   original with many partners is sent in copies, so that none of its pairs gather in a task.
4. Each pair is aligned by patience diff: lines that occur once on both sides are anchors, the longest increasing
   sequence of these holds, and the gaps between are treated likewise. Lines that both still have then, but in another
   order, are aligned one by one. Runs of aligned lines that contain a line of LINE_WORDS words or more are deleted from
   the later document.

So a line of LINE_WORDS words or more that stands in an earlier document goes from the later one, as often as its first
holder has it. A line's first holder never loses it, as it has no earlier partner for it. All decisions are made on the
input. Nulls: a null text has no lines; a row with a null doc_id is kept as it is. Documents that lose all their words
go; those that had none stay. Rows that repeat a doc_id are judged each by its own text and never against one another:
only smaller ids count. Empty tables give no rows. Other columns pass through, whatever their names; n_chars, if there,
is set anew. Long texts are aligned whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import free_name, materialize, signed_texts, slices, with_values

LINE_WORDS = 5
_SPACE = b" \t\n\x0b\x0c\r"


def line_hashes(text: str | None) -> np.ndarray:
    """A signed 64-bit hash for each line: zero for a blank one, odd for one of LINE_WORDS words or more, else even."""
    if not text:
        return np.empty(0, np.int64)
    h = xxhash.xxh64_intdigest
    out = []
    for line in text.encode().split(b"\n"):
        line = line.strip(_SPACE)
        out.append((h(line) & ~1 or 2) | (len(line.split(None, LINE_WORDS - 1)) >= LINE_WORDS) if line else 0)
    return np.array(out, np.uint64).view(np.int64)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j) of equal lines, in order."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        here: dict[int, int] = {}
        for k in range(i, i_end):
            here[a[k]] = -1 if a[k] in here else k
        there: dict[int, int] = {}
        for k in range(j, j_end):
            there[b[k]] = -1 if b[k] in there else k
        anchors = [(k, there[x]) for x, k in here.items() if x and k >= 0 and there.get(x, -1) >= 0]
        if not anchors:
            continue
        anchors.sort()
        tops: list[int] = []
        piles: list[int] = []
        back = [-1] * len(anchors)
        for at, (_, y) in enumerate(anchors):
            pile = bisect_left(tops, y)
            back[at] = piles[pile - 1] if pile else -1
            tops[pile : pile + 1], piles[pile : pile + 1] = [y], [at]
        at, chain = piles[-1], []
        while at >= 0:
            chain.append(anchors[at])
            at = back[at]
        for x, y in reversed(chain):
            if x >= i and y >= j:  # what the runs before have taken is over
                todo.append((i, x, j, y))
                i, j = x, y
                while i < i_end and j < j_end and a[i] == b[j]:
                    found.append((i, j))
                    i, j = i + 1, j + 1
        todo.append((i, i_end, j, j_end))
    return sorted(found)


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff, and then what it leaves on both sides because its order differs: each line with the next equal one."""
    found = patience(a, b)
    taken_a, taken_b = ({x[k] for x in found} for k in (0, 1))
    rest: dict[int, list[int]] = defaultdict(list)
    for j in range(len(b) - 1, -1, -1):
        if b[j] and j not in taken_b:
            rest[b[j]].append(j)
    return sorted(found + [(i, rest[x].pop()) for i, x in enumerate(a) if i not in taken_a and rest.get(x)])


def blocks(later: list[int], earlier: list[int]) -> list[tuple[int, int]]:
    """(first line, lines) of the runs to delete from the later text."""
    out: list[tuple[int, int]] = []
    start = last = -2
    other = -2
    for i, j in [*aligned(later, earlier), (-9, -9)]:
        if i != last + 1 or j != other + 1:
            if start >= 0 and any(x & 1 for x in later[start : last + 1]):
                out.append((start, last + 1 - start))
            start = i
        last, other = i, j
    return out


def shared_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, sig, other_id, first, n): lines to delete from a row, which the earlier document other_id has; n is -1 for all of a whole copy."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [line_hashes(t) for t in batch.column(2).to_pylist()]
            sha = [hashlib.sha1(r.tobytes()).digest() for r in rows]
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lines, pa.array(sha, pa.binary())], names=["doc_id", "sig", "lines", "sha"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [(*row, at, n) for *row, a, b in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True) for at, n in blocks(a, b)]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (*[pa.int64()] * 3, *[pa.int32()] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "sig", "other_id", "first", "n"])

    row, other = ["doc_id", "sig"], ["other_id", "other_sig"]
    signed = materialize(signed_texts(docs).mapInArrow(sign, "doc_id long, sig long, lines array<long>, sha binary"), "lines")
    firsts = signed.where("exists(lines, x -> x % 2 <> 0)").groupBy("sha").agg(F.min("doc_id").alias("other_id"), F.max("doc_id").alias("most")).where("most > other_id")
    firsts = materialize(firsts.select("sha", "other_id"), "firsts")
    copies = materialize(signed.select(*row, "sha").join(firsts, "sha").where("doc_id > other_id").select(*row, "other_id").distinct(), "copies")
    keys = signed.join(copies, row, "left_anti").select(*row, F.explode(F.array_distinct(F.filter("lines", lambda x: x % 2 != 0))).alias("line"))
    keys = materialize(keys, "keys")
    held = keys.groupBy("line").agg(F.min(F.struct(*row)).alias("one"), F.max("doc_id").alias("most")).where("most > one.doc_id")
    held = materialize(held.select("line", F.col("one.doc_id").alias("other_id"), F.col("one.sig").alias("other_sig")), "held")
    pairs = materialize(keys.join(held, "line").where("doc_id > other_id").select(*row, *other).distinct(), "pairs")
    both = with_values(pairs, signed, row, other, row, "lines").select(*row, "other_id", "x", "y")
    found = both.mapInArrow(align, "doc_id long, sig long, other_id long, first int, n int")
    return found.unionAll(copies.select(*row, "other_id", F.lit(0), F.lit(-1)))


def _cut(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of the spans, and how many lines went."""
    lines = text.split("\n")
    gone = {k for at, n in spans for k in (range(len(lines)) if n < 0 else range(at, min(at + n, len(lines))))}
    return "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)


def _with_spans(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The rows with their spans and the documents that have these, and the two columns' names."""
    spans = shared_blocks(docs).groupBy("doc_id", "sig").agg(F.collect_set(F.struct("first", "n")).alias("spans"), F.array_sort(F.collect_set("other_id")).alias("others"))
    names = {c: free_name(docs, f"__{c}") for c in ("doc_id", "sig", "spans", "others")}
    spans = materialize(spans, "spans").withColumnsRenamed(names)
    same = (docs["doc_id"].cast("long") == F.col(names["doc_id"])) & (F.xxhash64(docs["text"]) == F.col(names["sig"]))
    # One plan at every size: the texts move once, and what is to be cut is hashed on their side's partitions.
    return docs.join(spans.hint("shuffle_hash"), same, "left").drop(names["doc_id"], names["sig"]), names["spans"], names["others"]


def remove_shared_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that an earlier one has, all columns kept."""
    schema, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, keep = batch.column(names.index("text")).to_pylist(), []
            for k, spans in enumerate(batch.column(len(names)).to_pylist()):
                if spans:
                    texts[k], _ = _cut(texts[k] or "", [(x["first"], x["n"]) for x in spans])
                keep.append(not spans or bool(texts[k].encode().split()))
            cols = {n: batch.column(i) for i, n in enumerate(names)} | {"text": pa.array(texts, batch.column(names.index("text")).type)}
            if "n_chars" in names:
                at = batch.column(names.index("n_chars"))
                cols["n_chars"] = pa.array([len(t) if s else n for t, s, n in zip(texts, batch.column(len(names)).to_pylist(), at.to_pylist(), strict=True)], at.type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names).filter(pa.array(keep, pa.bool_()))

    found, _, others = _with_spans(docs)
    return found.drop(others).mapInArrow(run, schema)


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: its lines, how many are removed, the SHA-256 of the text that stays, and the documents that have them."""
    schema = "doc_id long, n_lines long, n_removed long, kept_sha256 string, others array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc, text, spans, others in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                kept, n = _cut(text or "", [(x["first"], x["n"]) for x in spans or ()])
                out.append((doc, (text or "").count("\n") + 1 if text else 0, n, hashlib.sha256(kept.encode()).hexdigest(), others or []))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    found, *names = _with_spans(docs.select(F.col("doc_id").cast("long"), "text"))
    return found.select("doc_id", "text", *names).mapInArrow(run, schema)
