"""Quality rules: zstandard compression bands with limits by length.

Text that compresses far better than prose repeats itself; text that hardly compresses is random or encoded. A
document is judged as a whole and in fixed chunks, the last shorter one included, each ratio against the limits of its
own length. Chunks count by their bytes, so a last chunk of a few bytes weighs little.

How far good text compresses depends on its length above all, so the largest ratios are fitted to labelled documents,
with a limit for every half octave of length: fit_bands() takes at most LABELLED documents (those with the smallest
hashes), of which it reads lengths and ratios. Without labels the fixed limits hold, which only reject what is far off.

A label of null, or of a document that isn't there, says nothing; a document with several labels has the lowest.
Null text: a text with no words (base rule fails). Empty tables: no rows. Repeated rows are judged each. Other columns of
the input are passed through by `keep_quality` and ignored by `quality_report`. Long texts are judged whole.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import hash_sample, slices

#: (shorter than so many bytes, least ratio, largest ratio) for whole documents and last chunks. The least ratios lie above
#: base64 with line breaks (0.92, 1.01, 1.06, 1.19, 1.26, 1.31, 1.33 and 1.33 at most) and below the prose of the documents
#: (0.97, 1.05, 1.14, 1.34, 1.41, 1.68, 2.09 and 2.33 at least). Texts of 50 words have 99 bytes at least.
WHOLE_BANDS = ((128, 0.95, 2.5), (192, 1.03, 3.0), (256, 1.08, 3.5), (512, 1.22, 3.5), (1024, 1.3, 3.5), (4096, 1.36, 5.0), (16384, 1.38, 6.5), (float("inf"), 1.4, 8.0))
CHUNK_BYTES = 4096
#: Least and largest ratio of a full chunk.
CHUNK_BAND = (1.36, 5.0)
#: A document goes if more than this share of its bytes lies in chunks outside the band.
CHUNK_SHARE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
REPORT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, whole_ratio double, bad_chunks long, n_chunks long, reason string"


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text, first occurrences included."""
    n = len(words) - 2
    if n < 2:
        return 0
    grams = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(grams)
    if len(counts) == n:
        return 0
    again = np.fromiter((counts[g] > 1 for g in grams), dtype=bool, count=n)
    covered = np.zeros(n + 2, dtype=bool)
    for k in range(3):
        covered[k : k + n] |= again
    return int(covered.sum())


def dup_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in raw.split(b"\n"):
        if line.strip(_SPACE):
            n += line in seen
            seen.add(line)
    return n


#: Labelled documents at most that the limits are fitted to, and fewest good ones near a length for a limit there.
LABELLED, FEWEST = 20_000, 10
#: A good document lost counts as so many bad ones kept.
COST = 8.0


@dataclass(frozen=True)
class Bands:
    """Limits by length: fixed least ratios, and largest ratios at points of log2(bytes), the fixed ones without points."""

    points: tuple[tuple[float, float], ...] = ()

    def limits(self, size: int) -> tuple[float, float]:
        """Least and largest ratio of a whole text, or of a chunk, of so many bytes."""
        low, high = next((low, high) for most, low, high in WHOLE_BANDS if size < most)
        if not self.points:
            return low, high
        at, points = math.log2(size), self.points
        k = bisect_right(points, (at, 0.0))
        if k == 0:
            return low, points[0][1]  # ratios grow with the length, so the first limit is on the safe side
        if k == len(points):
            slope = max(0.0, (points[-1][1] - points[0][1]) / max(points[-1][0] - points[0][0], 0.5))
            return low, points[-1][1] + slope * (at - points[-1][0])
        (x, y), (x2, y2) = points[k - 1 : k + 1]
        return low, y + (y2 - y) * (at - x) / (x2 - x)


#: The fixed limits.
FIXED = Bands()


def fitted(sizes: np.ndarray, ratios: np.ndarray, good: np.ndarray) -> Bands:
    """Largest ratios from examples: for each half octave the median of good texts, and above it the step that errs least.

    The step is chosen over an octave, where texts differ from the median's line only; losing a good text costs COST times
    as much as keeping a bad one. Lengths with fewer than FEWEST good texts get no point of their own.
    """
    at = np.log2(np.maximum(sizes, 1))
    ends = np.arange(6.0, 40.0, 0.5)
    middle = [(c, np.median(ratios[good & (np.abs(at - c) <= 0.25)])) for c in ends if (good & (np.abs(at - c) <= 0.25)).sum() >= FEWEST]
    if not middle or good.all():
        return FIXED
    x, y = map(np.array, zip(*middle, strict=True))
    above = ratios - np.interp(at, x, y)
    points = []
    for c, m in middle:
        near = np.abs(at - c) <= 0.5
        mine, other = np.sort(above[near & good]), np.sort(above[near & ~good])
        steps = np.unique(np.concatenate([mine, other]))
        steps = np.append((steps[1:] + steps[:-1]) / 2, steps[-1] + 0.05)
        lost = 1 - np.searchsorted(mine, steps, side="right") / len(mine)
        kept = np.searchsorted(other, steps, side="right") / max(1, len(other))
        points.append((float(c), float(m + steps[np.argmin(COST * lost + kept)])))
    return Bands(tuple(points))


def fit_bands(docs: DataFrame, labels: DataFrame | None, most: int = LABELLED) -> Bands:
    """Limits from labels (doc_id, quality: 1 good, 0 bad) of documents that pass the base rule; the fixed ones without labels."""
    if labels is None:
        return FIXED
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = hash_sample(known, "doc_id", most, known.count())
    if not chosen:
        return FIXED
    table = docs.sparkSession.createDataFrame([(r.doc_id, int(r.quality)) for r in chosen], "doc_id long, quality int")
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(table), "doc_id").select("text", "quality")  # `most` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            rows = [(len(t.encode()), j[7], q) for t, q in zip(*(c.to_pylist() for c in batch.columns), strict=True) if not (j := judge(t, press))[5]]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.float64(), pa.int32()), strict=True)], names=["size", "ratio", "quality"])

    # Rows that repeat an id are examples each; sorted, so that the driver sees at most as many as were chosen.
    found = texts.mapInArrow(run, "size long, ratio double, quality int").orderBy("size", "ratio", "quality").limit(most).collect()
    sizes, ratios, good = (np.array([r[k] for r in found], float) for k in range(3))
    return fitted(sizes, ratios, good > 0)


def bands(raw: bytes, press: zstandard.ZstdCompressor, by: Bands = FIXED) -> tuple[float | None, int, int, str | None]:
    """Ratio of the whole text, chunks outside the band, chunks, and why the text is rejected (or None)."""
    size = len(raw)
    if not size:
        return None, 0, 0, None
    ratio = size / len(press.compress(raw))
    low, high = by.limits(size)
    bad = outside = chunks = 0
    if size > CHUNK_BYTES:
        full = (CHUNK_BAND[0], by.limits(CHUNK_BYTES)[1] if by.points else CHUNK_BAND[1])
        for k in range(0, size, CHUNK_BYTES):
            part = raw[k : k + CHUNK_BYTES]
            least, largest = full if len(part) == CHUNK_BYTES else by.limits(len(part))
            chunks += 1
            if not least <= len(part) / len(press.compress(part)) <= largest:
                bad, outside = bad + 1, outside + len(part)
    why = "incompressible" if ratio < low else "repetitive" if ratio > high else "chunks" if outside > CHUNK_SHARE * size else None
    return ratio, bad, chunks, why


def judge(text: str | None, press: zstandard.ZstdCompressor, by: Bands = FIXED) -> tuple:
    """The report's columns after doc_id."""
    raw = text.encode() if text else b""
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    repeats = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    ratio, bad, judged, why = bands(raw, press, by)
    return len(words), len(text or "") - spaces, symbols, dup_lines(raw), repeats, failed, not failed and why is None, ratio, bad, judged, "base" if failed else why


def quality_report(docs: DataFrame, by: Bands = FIXED) -> DataFrame:
    """A row for every document: the counts, the compression ratios, the verdict and its reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            rows = [judge(t, press, by) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 11
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[f.split()[0] for f in REPORT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, REPORT)


def keep_quality(docs: DataFrame, by: Bands = FIXED) -> DataFrame:
    """The documents that pass, with all their columns, in one pass and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            keep = pa.array([judge(t, press, by)[6] for t in batch.column(at).to_pylist()], pa.bool_())
            yield batch.filter(pc.fill_null(keep, False))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
