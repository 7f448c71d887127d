"""Best-fit packing of tokenised documents into sequences of bounded length, by large-item matching.

Pieces longer than a third of a sequence are large: no more than two fit one sequence, so packing them is a matching.
Taken from the largest down, each is matched with the largest partner that still fits. Smaller pieces then go, from the
largest down, into the open sequence with the smallest gap that holds them (best fit), or into a new one.

Only lengths matter to this plan, so it is made from the histogram of lengths: at most `capacity` numbers, whatever the
corpus. Equal sequences are planned together with a multiplicity, so the plan stays small too. Pieces then find their
places by their rank within their length.

Nulls: a null text is an empty one (a piece of one end token); a null doc_id keeps its piece. Empty tables give no
pieces. Repeated rows are packed each. Other columns are ignored. A long text is cut into pieces, never shortened.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import materialize, slices

CAPACITY, END = 1024, 2
#: Chunks (a space and what follows it) whose ids a worker remembers at most.
REMEMBERED = 250_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
_encoders: dict[str, Encoder] = {}
#: Characters whose classes are the same in every regex engine: printable ASCII without <, new line, Latin letters.
_PLAIN = re.compile("[\n -;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _quick(path: str) -> Callable[[str], list[int]] | None:
    """A faster encoder of the same byte-level BPE vocabulary for plain text, or None if the file holds another kind.

    The ids of a chunk are those that the tokenizers library gives; a test compares them.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex") or spec.get("normalizer") or spec["model"].get("ignore_merges"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such files
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}
    special = {x["content"] for x in spec.get("added_tokens", ())}
    ranks = {bytes(back[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special}
    merged = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    if len(ranks) != 256 + len(merged) or any(spec["model"]["vocab"][m.replace(" ", "")] != 256 + k for k, m in enumerate(merged)):
        return None  # ids must be the merges' ranks
    # The pattern of byte-level BPE with the regex switched on (fixed value).
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Ids as the tokenizers library gives them for whole texts, with the ids of frequent chunks remembered.

    Before a space that stands alone between two other characters the vocabulary's pre-tokeniser always cuts, and no
    merge crosses a cut. So a text whose white space is single spaces is the sequence of its chunks, each encoded
    alone; any other text is encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        self.path, self.known, self.closing = path, {}, {}
        self.quick = _quick(path)

    @cached_property
    def tokenizer(self):
        """Loaded when a text needs it: a worker that meets plain chunks only holds one vocabulary."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ids(self, text: str) -> bytes:
        if self.quick is not None and _PLAIN.fullmatch(text):
            return array("I", self.quick(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers."""
        head, *runs = text.split(" ")
        if head and head[-1].isspace():
            return self._ids(text)
        ids = list(map(self.known.get, runs))  # of a space and the run
        if None in ids:
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                run = runs[at]
                if not run or run[0].isspace() or run[-1].isspace():
                    return self._ids(text)
                ids[at] = self._chunk(run)
        return (self._ids(head) if head else b"") + b"".join(ids) if runs else self._ids(text)

    def _chunk(self, run: str) -> bytes:
        """Ids of a space and the run. A closing full stop or comma after a letter is a token of its own."""
        known = self.known
        if run[-1] in ".," and len(run) > 1 and run[-2].isalpha():
            word, last = run[:-1], run[-1]
            if last not in self.closing:
                self.closing[last] = self._ids(last)
            ids = known.get(word)
            if ids is None:
                ids = self._ids(" " + word)
                if len(known) < REMEMBERED:
                    known[word] = ids
            ids += self.closing[last]
        else:
            ids = self._ids(" " + run)
        if len(known) < REMEMBERED:
            known[run] = ids
        return ids


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first, which takes what is over."""
    first = n % capacity or capacity
    return [(0, first)] + [(k, capacity) for k in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces, with the task that made them and their place among that task's pieces of equal length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, encode = TaskContext.get().partitionId(), [0] * (capacity + 1), encoder(vocabulary).encode
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


class _Open:
    """Sequences still open, by gap: gap -> [(pattern, how many)], and the gaps in order."""

    def __init__(self) -> None:
        self.by: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        self.gaps: list[int] = []

    def put(self, gap: int, pattern: tuple[int, ...], n: int) -> None:
        if gap not in self.by:
            self.by[gap] = []
            insort(self.gaps, gap)
        self.by[gap].append((pattern, n))

    def take(self, gap: int, most: int) -> tuple[tuple[int, ...], int]:
        pattern, n = self.by[gap].pop()
        if n > most:
            self.by[gap].append((pattern, n - most))
        if not self.by[gap]:
            del self.by[gap]
            self.gaps.remove(gap)
        return pattern, min(n, most)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and their multiplicities, for so many pieces of each length."""
    left = {k: n for k, n in counts.items() if n > 0}
    large = sorted(k for k in left if 3 * k > capacity)
    open_, rest = _Open(), dict(left)
    for a in reversed(large):
        while rest.get(a, 0) > 0:
            at = bisect_left(large, capacity - a + 1) - 1
            while at >= 0 and (rest.get(large[at], 0) == 0 or large[at] == a and rest[a] < 2):
                at -= 1
            if at < 0:
                open_.put(capacity - a, (a,), rest.pop(a))
                break
            b = large[at]
            n = rest[a] // 2 if a == b else min(rest[a], rest[b])
            rest[a] -= n
            rest[b] -= n
            open_.put(capacity - a - b, (a, b), n)
    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        need = left[s]
        while need:
            at = bisect_left(open_.gaps, s)
            if at < len(open_.gaps):
                gap = open_.gaps[at]
                pattern, n = open_.take(gap, need)
                # As many of this length at once as go into one such sequence: best fit would choose it again.
                times = min(gap // s, max(1, need // n))
                open_.put(gap - s * times, pattern + (s,) * times, n)
                need -= n * times
            else:
                times = min(capacity // s, need)
                n = need // times
                open_.put(capacity - s * times, (s,) * times, n)
                need -= n * times
    return [x for gap in open_.gaps for x in open_.by[gap]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks, sequence of the first rank, ranks in a row, and offset, sorted by first rank."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rank = seen.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, offset))
            seen[length] = rank + n
            offset += length
        sequence += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = materialize(pieces(docs, vocabulary, capacity), "pieces")
    per_part = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = per_part.select("part", "length", F.coalesce(upto, F.lit(0)).alias("base"))
    counts = {x.length: x.n for x in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    where = places(plan(counts, capacity))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for one in np.unique(length).tolist():
                mine = length == one
                first, sequence, offset = where[one]
                at = np.searchsorted(first, rank[mine], side="right") - 1
                seq[mine], off[mine] = sequence[at] + rank[mine] - first[at], offset[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(off)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = made.join(base, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
