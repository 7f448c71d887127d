"""Benchmark decontamination by latent semantic retrieval.

1. Terms are the benchmark's words (A-Z in lower case, punctuation off) that few of its items share. One pass over all
   documents notes where these terms stand; what follows reads that small table, not the texts.
2. Document frequencies of the terms over all documents give TF-IDF weights.
3. A randomised SVD of the TF-IDF passages of all documents: each task multiplies its passages by a random test matrix
   and back (AᵀAΩ), the products are summed by term, and a Nyström step on the driver gives the leading right singular
   vectors. The benchmark's own passages are rows too, weighted to ITEM_WEIGHT of all the documents', so that their
   rare terms keep a place in the space. What reaches the driver is bounded by the benchmark: its terms x RANK numbers.
4. Overlapping windows of every document and passages of every item are compared by cosine in the latent space; what
   comes near must also share OVERLAP of the item passage's TF-IDF weight.
5. Candidates are confirmed by longest common subsequences, of the terms first and then of all words: an item counts as
   found if COPY of its words stand there in order, or as paraphrased if PARAPHRASE of them do and the answer (its last
   sentence) does too, to ANSWER of its words.

All items share one vocabulary, one space and one scan of the documents, so what is found doesn't depend on how they are
grouped. The benchmark is the small side by nature: at most MOST_WORDS words are taken, and more is an error, not a cut.
Items of fewer than LEAST_WORDS words are found where all their words stand in a row; those of fewer than SHORTEST can't
be told from chance and are passed over, like null ones.

Null texts have no words. Rows that repeat a doc_id are searched each in its own text; a row with a null doc_id is searched
by nobody and kept. Repeated items are reported under each of their ids. Empty tables give no rows. Other columns pass
through, whatever their names. Long texts are searched whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import free_name, materialize, signed_texts, slices

RANK, EXTRA = 64, 8
WINDOW, STRIDE = 32, 16
LEAST_WORDS, SHORTEST, MOST_WORDS = 8, 4, 5_000_000
COSINE, OVERLAP = 0.5, 0.3
#: What the benchmark's passages weigh in the SVD, against all passages of the documents.
ITEM_WEIGHT = 0.5
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
#: Items that may share a term, as a share of all; an item's KEEP rarest words are terms in any case.
SHARE, KEEP = 0.04, 6
_PLAIN = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b + 32 if 65 <= b <= 90 else b for b in range(256))
FOUND = "doc_id long, item_id long, start int, coverage double, answer_coverage double, kind string"


def plain_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a bit for each element of a."""
    at: dict = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        m = at.get(x)
        if m:
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


class Items:
    """The benchmark: words, answers, terms and passages, and the short items by their first words."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        cut = [(i, plain_words(t), t) for i, t in rows]
        kept = [(i, w, plain_words(answer_of(t))) for i, w, t in cut if len(w) >= LEAST_WORDS]
        self.short: dict[bytes, list[tuple[int, list[bytes]]]] = {}
        for i, w, _ in cut:
            if SHORTEST <= len(w) < LEAST_WORDS:
                self.short.setdefault(w[0], []).append((i, w))
        self.ids = [x[0] for x in kept]
        self.words = [x[1] for x in kept]
        self.answers = [x[2] for x in kept]
        share = Counter(w for words in self.words for w in set(words))
        most = max(1, int(SHARE * len(kept)))
        terms: set[bytes] = set()
        for words in self.words:
            own = sorted(set(words), key=lambda w: (share[w], w))
            terms.update(w for k, w in enumerate(own) if k < KEEP or share[w] <= most)
        self.terms = {w: k for k, w in enumerate(sorted(terms))}
        self.sequences = [[self.terms[w] for w in words if w in self.terms] for words in self.words]
        self.passages: list[tuple[int, np.ndarray]] = []
        for k, words in enumerate(self.words):
            starts = range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE)
            for s in starts:
                got = [self.terms[w] for w in words[s : s + WINDOW] if w in self.terms]
                if got:
                    self.passages.append((k, np.array(got)))


def answer_of(text: str) -> str:
    """The last sentence, with the one before it as long as it has under three words."""
    parts = [p for p in text.replace("\n", " ").replace("? ", ". ").split(". ") if p.strip()]
    out = parts.pop() if parts else ""
    while parts and len(out.split()) < 3:
        out = f"{parts.pop()} {out}"
    return out


_TERMS = "doc_id long, sig long, n_words int, at array<int>, term array<int>, short array<struct<item_id:long,start:int>>"


def term_positions(docs: DataFrame, terms: dict[bytes, int], short: dict[bytes, list[tuple[int, list[bytes]]]] | None = None) -> DataFrame:
    """(doc_id, sig, n_words, at, term, short): where each row has the terms, and short items whole; rows with neither are left out."""
    short = short or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.get
        for batch in slices(batches):
            rows, sizes, at, term, ends, whole = [], [], [], [], [0], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                words = plain_words(text)
                ids = list(map(get, words))
                here = [k for k, x in enumerate(ids) if x is not None]
                found = {}
                if not short.keys().isdisjoint(words):
                    for k, w in enumerate(words):
                        for item, own in short.get(w, ()):
                            if words[k : k + len(own)] == own:
                                found.setdefault(item, k)
                if here or found:
                    rows.append(row)
                    sizes.append(len(words))
                    at += here
                    term += [ids[k] for k in here]
                    ends.append(len(at))
                    whole.append([{"item_id": i, "start": k} for i, k in found.items()])
            offsets = pa.array(np.array(ends, np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (at, term)]
            own = batch.take(pa.array(rows, pa.int64()))
            shorts = pa.array(whole, pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32())])))
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(sizes, pa.int32()), *lists, shorts], names=["doc_id", "sig", "n_words", "at", "term", "short"])

    return signed_texts(docs).mapInArrow(run, _TERMS)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each term, its position and the term, for a batch of (at, term) lists in its last two columns."""
    at, term = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    ends = at.offsets.to_numpy()
    who = np.repeat(np.arange(len(batch)), np.diff(ends))
    return who, at.flatten().to_numpy(), term.flatten().to_numpy()


def document_frequency(found: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that have each term (of those noted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in slices(batches):
            who, _, term = _lists(batch)
            total += np.bincount(np.unique(who * n_terms + term) % n_terms, minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    df = np.zeros(n_terms, np.int64)
    for x in found.select("at", "term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[x.term] = x.n
    return df


def _rows_times(row: np.ndarray, n: int, term: np.ndarray, weight: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Sparse matrix (row sorted, term, weight) times a dense one."""
    out = np.zeros((n, by.shape[1]), np.float32)
    if len(row):
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[starts]] = np.add.reduceat(by[term] * weight[:, None], starts, axis=0)
    return out


def latent_basis(found: DataFrame, idf: np.ndarray, items: Items) -> np.ndarray:
    """Leading right singular vectors (terms x RANK) of the TF-IDF passages of all documents, by a randomised SVD."""
    n_terms = len(idf)
    width = min(n_terms, RANK + EXTRA)
    test = np.random.default_rng(5).standard_normal((n_terms, width)).astype(np.float32)

    def product(row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """AᵀAΩ of passages with unit length."""
        weight = idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight))
        weight = weight / np.maximum(norm[row], 1e-9)
        y = _rows_times(row, int(row[-1]) + 1, term, weight.astype(np.float32), test)
        order = np.argsort(term, kind="stable")
        return _rows_times(term[order], n_terms, row[order], weight[order].astype(np.float32), y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_terms, width))
        for batch in slices(batches):
            for part in (batch.slice(k, 500) for k in range(0, len(batch), 500)):
                who, at, term = _lists(part)
                if len(term):
                    key = who * (1 << 32) + at // WINDOW
                    total += product(np.cumsum(np.concatenate([[False], key[1:] != key[:-1]])), term)
        some = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, k]) for k in range(width))], names=["term", *(f"z{k}" for k in range(width))])

    columns = [f"z{k}" for k in range(width)]
    summed = found.select("at", "term").mapInArrow(run, "term long, " + ", ".join(f"{c} double" for c in columns)).groupBy("term").agg(*(F.sum(c).alias(c) for c in columns))
    z = np.zeros((n_terms, width))
    got = summed.toArrow()
    z[got.column("term").to_numpy()] = np.column_stack([got.column(c).to_numpy() for c in columns])
    rows = np.repeat(np.arange(len(items.passages)), [len(t) for _, t in items.passages])
    passages = found.agg(F.sum(F.ceil(F.col("n_words") / WINDOW))).first()[0] or 0
    z += (1 + ITEM_WEIGHT * passages / len(items.passages)) * product(rows, np.concatenate([t for _, t in items.passages]))
    omega = test.astype(float)
    shift = 1e-6 * np.linalg.norm(z)
    core = omega.T @ (z + shift * omega)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * values.max()
    half = (z + shift * omega) @ (vectors[:, good] / np.sqrt(values[good]))
    return np.linalg.svd(half, full_matrices=False)[0][:, :RANK].astype(np.float32)


def candidates(found: DataFrame, idf: np.ndarray, basis: np.ndarray, items: Items) -> DataFrame:
    """(doc_id, sig, item, at): windows like an item's passage whose terms also stand there in the item's order."""
    owner = np.array([k for k, _ in items.passages])
    known = np.stack([(basis[t] * idf[t, None]).sum(axis=0) for _, t in items.passages])
    known = (known / np.maximum(np.linalg.norm(known, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    scaled = (basis * idf[:, None]).astype(np.float32)
    sizes = [len(w) for w in items.words]
    # What confirm() accepts lacks at most 1 - PARAPHRASE of the words, so at most so many of the terms.
    least = [max(1, len(t) - int((1 - PARAPHRASE) * len(w) + 1e-9)) for t, w in zip(items.sequences, items.words, strict=True)]
    # Each term's share of its passage's weight, as a sparse matrix: sorted keys of passage and term.
    n_terms = len(idf)
    held, shares = [], []
    for k, (_, t) in enumerate(items.passages):
        own = np.unique(t)
        held.append(k * n_terms + own)
        shares.append((idf[own] ** 2 / max((idf[own] ** 2).sum(), 1e-9)).astype(np.float32))
    held, shares = np.concatenate(held), np.concatenate(shares)

    def weight(passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        key = passage * n_terms + term
        spot = np.minimum(np.searchsorted(held, key), len(held) - 1)
        return np.where(held[spot] == key, shares[spot], 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for part in (batch.slice(k, 200) for k in range(0, len(batch), 200)):
                yield from search(part)

    def search(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        docs, sigs, (who, at, term) = part.column(0).to_numpy(), part.column(1).to_numpy(), _lists(part)
        if not len(term):
            return
        # Sums of strides, then of the strides of a window: a window starts at every stride.
        key = who * (1 << 32) + at // STRIDE
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sums = np.add.reduceat(scaled[term], starts, axis=0)
        number = np.diff(np.concatenate([starts, [len(term)]]))
        cell = key[starts]
        follows = np.concatenate([cell[1:] == cell[:-1] + 1, [False]])
        # A window is a stride and the next; one whose first stride is empty is covered by the window at its second.
        first = starts
        full = sums + np.where(follows[:, None], np.concatenate([sums[1:], sums[:1]]), 0)
        number = number + np.where(follows, np.concatenate([number[1:], number[:1]]), 0)
        seen: set[tuple[int, int, int]] = set()
        step = max(1, (1 << 22) // len(known))
        for k in range(0, len(full), step):
            x = full[k : k + step]
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
            hit, passage = np.nonzero(x @ known.T >= COSINE)
            own, count = first[k + hit], number[k + hit]
            at_pair = np.repeat(np.arange(len(hit)), count)
            inside = np.arange(len(at_pair)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(own, count)
            good = np.bincount(at_pair, weight(passage[at_pair], term[inside]), minlength=len(hit)) >= OVERLAP
            hit, passage = hit[good], passage[good]
            for cell_at, item in zip(cell[k + hit].tolist(), owner[passage].tolist(), strict=True):
                seen.add((cell_at >> 32, (cell_at & 0xFFFFFFFF) * STRIDE, item))
        out = []
        ends = np.searchsorted(who, np.arange(len(part) + 1))
        for d, start, item in sorted(seen):
            own = at[ends[d] : ends[d + 1]]
            low, high = np.searchsorted(own, (start - sizes[item], start + WINDOW + sizes[item] * 3 // 2))
            sequence = items.sequences[item]
            if lcs(sequence, term[ends[d] + low : ends[d] + high].tolist()) >= least[item]:
                out.append((int(docs[d]), int(sigs[d]), item, start))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "sig", "item", "at"])

    return found.select("doc_id", "sig", "at", "term").mapInArrow(run, "doc_id long, sig long, item int, at int")


def confirm(words: list[bytes], item: list[bytes], answer: list[bytes], start: int) -> tuple[float, float, str | None]:
    """Share of the item's words, and of its answer's, that stand around the window in order; and what that makes it."""
    low = max(0, start - len(item))
    best = answered = 0.0
    for a in range(low, max(low + 1, start + WINDOW), max(1, len(item) // 4)):
        here = words[a : a + len(item) * 3 // 2]
        got = lcs(item, here) / len(item)
        if got > best:
            best, answered = got, lcs(answer, here) / max(1, len(answer))
    kind = "copy" if best >= COPY else "paraphrase" if best >= PARAPHRASE and answered >= ANSWER else None
    return best, answered, kind


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """contaminated(), with the hash of the text that has the item."""
    schema = f"sig long, {FOUND}"
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").distinct()
    size = rows.agg(F.sum(F.size(F.split(F.trim("text"), "\\s+")))).first()[0] or 0
    if size > MOST_WORDS:
        raise ValueError(f"a benchmark of {size} words; at most {MOST_WORDS} are searched for at once, so call this for parts of it")
    items = Items([(x.item_id, x.text) for x in rows.orderBy("item_id", "text").collect()])
    if not items.ids and not items.short:
        return docs.sparkSession.createDataFrame([], schema)
    found = materialize(term_positions(docs, items.terms, items.short), "terms")
    short = found.select("sig", "doc_id", F.explode("short").alias("x")).select("sig", "doc_id", "x.item_id", "x.start", F.lit(1.0).alias("coverage"), F.lit(1.0).alias("answer_coverage"), F.lit("short").alias("kind"))
    if not items.ids:
        return short.distinct()
    idf = np.log((docs.count() + 1) / (document_frequency(found, len(items.terms)) + 1)) + 1e-3
    near = candidates(found, idf, latent_basis(found, idf, items), items)
    near = materialize(near.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("item", "at")).alias("spots")), "candidates")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.string())
        for batch in slices(batches):
            out: dict[tuple[int, int, int], tuple] = {}
            for sig, doc, text, spots in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = plain_words(text)
                for spot in sorted((x["item"], x["at"]) for x in spots):
                    share, answered, kind = confirm(words, items.words[spot[0]], items.answers[spot[0]], spot[1])
                    key = (sig, doc, items.ids[spot[0]])
                    if kind and (key not in out or out[key][4] < share):
                        out[key] = (*key, spot[1], share, answered, kind)
            cols = list(zip(*out.values(), strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    texts = signed_texts(docs).join(near, ["doc_id", "sig"]).select("sig", "doc_id", "text", "spots")
    return texts.mapInArrow(check, schema).unionAll(short).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, coverage, answer_coverage, kind): the items that each document contains."""
    return find_items(docs, benchmark).drop("sig").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item of the benchmark is found, with all their columns."""
    names = {c: free_name(docs, f"__{c}") for c in ("doc_id", "sig")}
    bad = materialize(find_items(docs, benchmark).select("doc_id", "sig").distinct(), "leaks").withColumnsRenamed(names)
    return docs.join(bad, (docs["doc_id"].cast("long") == F.col(names["doc_id"])) & (F.xxhash64(docs["text"]) == F.col(names["sig"])), "left_anti")
