"""Packing by first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents are tokenised and written once. What is longer than a sequence gives full sequences from its start; the rest of
each document, shorter than a sequence, goes to a group by a hash of its row, so groups are equally large and mixed
whatever the order, sources and copies in the input. Groups are packed independently, each by one task, which holds its
ids: pieces from the longest down, each into the first sequence that has room. The sequences' free room stands in the
leaves of a tournament tree, whose inner nodes hold the larger of two: one walk down from the root finds the first fit.

Sequences are padded to their capacity unless their length is a power of two. First fit leaves small gaps, so the
emptiest sequences of a group are then dealt out over the gaps of the fullest, cut where a gap ends, and the last one is
cut into powers of two: no padding is left. With cut=False pieces stay whole and gaps are left.

Nulls: a null text is an empty one (one end token); a null doc_id keeps its pieces. Empty tables give no pieces. Repeated
rows are packed each. Other columns are ignored. Long texts are cut into pieces, never shortened.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import materialize, slices

CAPACITY, END, GROUP_ROWS = 4096, 2, 2048
#: Words whose ids a worker remembers at most.
REMEMBERED = 400_000
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
_PLACED = f"{_PIECES}, sequence_id long, offset long"
_encoders: dict[str, WordEncoder] = {}
#: Characters whose classes and lower case are the same in every library: printable ASCII without <, Latin letters, new lines between words.
_PLAIN = re.compile("[\n!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u017f]+")
#: The vocabulary's own parts of a word (fixed value), and the same for plain words in lower case.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|\n|[^a-z\u00df-\u00f6\u00f8-\u017f0-9\n]+")


class WordEncoder:
    """Ids of whole texts under a vocabulary that drops white space and never joins what it parts.

    Such a text's ids are those of its words, one after the other; a test holds them against the tokenizers library's for
    whole texts. Ids of words are remembered; those of words that a worker has not met are made together.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.plain = Tokenizer.from_file(path), {}, _plain_words(path)

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words as unsigned 32-bit numbers."""
        plain = words
        if self.plain is None:
            plain = []
        elif not _PLAIN.fullmatch(b"\n".join(words).decode()):
            plain = [w for w in words if _PLAIN.fullmatch(w.decode())]
        found = dict(zip(plain, self.plain(b"\n".join(plain).decode()), strict=True)) if plain else {}
        for word in words if len(found) < len(words) else ():
            if word not in found:
                found[word] = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit numbers."""
        cut = [t.encode().split() for t in texts]  # at ASCII white space
        new = self._new(list(set().union(*cut).difference(self.known)))
        self.known |= new
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        if len(self.known) > REMEMBERED:
            for word in new:
                del self.known[word]
        return out


def _plain_words(path: str) -> Callable[[str], list[bytes]] | None:
    """A faster encoder of the same vocabulary for lines of a word of _PLAIN characters each, or None if the file holds another kind.

    A token that ends a word has a mark behind its last letter, here a byte that no such word has. The letter takes the
    mark before any other merge, then the merges follow in the order of the vocabulary's numbers.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", ())]
    cuts = [(x.get("type"), (x.get("pattern") or {}).get("Regex"), x.get("use_regex")) for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("ignore_merges") or steps != ["NFC", "Replace", "Lowercase"] or cuts != [("Split", _CUT, None), ("ByteLevel", None, False)]:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in such files
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in shown)}
    special = {x["content"] for x in spec.get("added_tokens", ())}
    merged = ["".join(m if not isinstance(m, str) else m.split(" ")) for m in model["merges"]]
    if any(model["vocab"][m] != 512 + k for k, m in enumerate(merged)):
        return None  # numbers must be the merges' ranks
    ranks, numbers = {}, np.zeros(len(model["vocab"]) + 1, "<u4")
    for token, number in model["vocab"].items():
        ends = token.endswith("</w>")
        raw = bytes(back[c] for c in token.removesuffix("</w>")) + (b"\0" if ends else b"") if token not in special else b"\0"
        if raw[:1] != b"\0":
            rank = number if number >= 512 else number - 256 if ends else number + 256
            ranks[raw], numbers[rank] = rank, number
    ranks[b"\0"] = len(model["vocab"])
    quick, line = tiktoken.Encoding("words", pat_str="[^\0]*\0", mergeable_ranks=ranks, special_tokens={}), ranks[b"\n\0"]

    def encode(lines: str) -> list[bytes]:
        got = quick.encode_to_numpy("\0".join(_PART.findall(lines.lower())) + "\0\n\0", disallowed_special=())
        ends, raw = np.flatnonzero(got == line), numbers[got].tobytes()
        return [raw[lo:hi] for lo, hi in zip((4 * np.append(0, ends[:-1] + 1)).tolist(), (4 * ends).tolist(), strict=True)]

    return encode


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


_KINDS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary()}


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids in pieces: full ones from its start, and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, most = encoder(vocabulary).encode, array("I", [END]).tobytes(), 4 * capacity
        for batch in slices(batches, 200):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                for k in range(0, len(ids), most):
                    part = ids[k : k + most]
                    out.append((doc, k // 4, len(part) // 4, len(ids) // 4, part))
            yield _batch(out, _KINDS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def first_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences of items (their indexes), each item in the first one with room for it, in the given order."""
    size = 1
    while size < len(lengths):
        size *= 2
    room = [capacity] * (2 * size)  # node k has the children 2k and 2k + 1; leaf size + s is sequence s
    out: list[list[int]] = []
    for item, n in enumerate(lengths):
        k = 1
        while k < size:
            k *= 2
            if room[k] < n:
                k += 1
        if k - size == len(out):
            out.append([])
        out[k - size].append(item)
        room[k] -= n
        while k > 1:
            k //= 2
            larger = max(room[2 * k], room[2 * k + 1])
            if room[k] == larger:
                break
            room[k] = larger
    return out


def _move(source: list[tuple], target: list[tuple], n: int) -> int:
    """Moves up to n tokens from the source's end, cutting the last piece if need be; how many were moved."""
    left = n
    while left and source:
        item, at, length = source.pop()
        taken = min(length, left)
        target.append((item, at + length - taken, taken))
        if taken < length:
            source.append((item, at, length - taken))
        left -= taken
    return n - left


def without_gaps(sequences: list[list[tuple]], capacity: int) -> list[list[tuple]]:
    """The same tokens, so that each sequence is full or has a power of two of them; pieces are (item, start, length)."""
    used = lambda s: sum(n for _, _, n in s)
    whole = lambda n: n == capacity or n & (n - 1) == 0
    out = [s for s in sequences if whole(used(s))]
    rest = sorted((s for s in sequences if not whole(used(s))), key=used, reverse=True)
    i, j = 0, len(rest) - 1
    gap = capacity - used(rest[0]) if rest else 0
    while i < j:
        gap -= _move(rest[j], rest[i], gap)
        if not rest[j]:
            j -= 1
        if not gap:
            out.append(rest[i])
            i += 1
            gap = capacity - used(rest[i])
    if i == j:
        last, n = rest[i], used(rest[i])
        for bit in reversed(range(n.bit_length())):
            if n >> bit & 1:
                out.append([])
                _move(last, out[-1], 1 << bit)
    return out


def pack_groups(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, seed: int = 42, cut: bool = True) -> DataFrame:
    """A row for every piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset."""
    made = materialize(pieces(docs, vocabulary, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    names = [x.split()[0] for x in _PIECES.split(", ")]
    full = made.where(f"length = {capacity}").select(*names, F.col("row").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = made.where(f"length < {capacity}")
    groups = max(1, -(-rest.count() // group_rows))
    dealt = rest.select(*names, F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)).alias("group"), "row")

    def placed(group: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sequences = [[(k, 0, rows[k][2]) for k in s] for s in first_fit([r[2] for r in rows], capacity)]
        if cut:
            sequences = without_gaps(sequences, capacity)
        out = []
        for number, sequence in enumerate(sequences):
            offset = 0
            for k, at, n in sequence:
                doc, start, _, total, ids = rows[k]
                out.append((doc, start + at, n, total, ids[4 * at : 4 * (at + n)], group << 24 | number, offset))
                offset += n
            if len(out) >= 500:
                yield _batch(out, kinds)
                out = []
        yield _batch(out, kinds)

    kinds = _KINDS | {"sequence_id": pa.int64(), "offset": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in slices(batches):
            for *row, group, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != now and held:
                    yield from placed(now, held)
                    held = []
                now = group
                held.append(row)
        if held:
            yield from placed(now, held)

    return dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "row").mapInArrow(run, _PLACED).unionAll(full)


def packing_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The pieces with the checksum of their ids."""
    x = pack_groups(docs, vocabulary)
    return x.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
