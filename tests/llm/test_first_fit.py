import collections
import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pairloom.llm import first_fit

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def library(text):
    return np.array([*tokenizer().encode(text, add_special_tokens=False).ids, 2], "<u4")


def test_ids_are_the_tokenizer_s(texts):
    e = first_fit.WordEncoder(VOCABULARY)
    odd = [" ", "  a", "a  b", "\n", "a\n b c", "é, b  c  d.", "<|endoftext|> a<|endoftext|> b<|startoftext|>", "a\u0085 b c", "​a b​ c", "don't 'll a's b ' s", "a\tb\x0bc\x1cd", "1, 22. c333. ٣. ²,", "𝒳. ǅ, ª. ʰ.", "a b  c", "é ́x ́", "Å ΑΣ ΣΑΣ, İ ß ﬁ", "가 ᅡᆨ", "a ̈ b", "😀😀 x😀"]
    letters = [chr(k) for k in range(33, 0x250)]
    r = random.Random(1)
    odd += letters + ["".join(r.choices(letters, k=r.randint(1, 12))) for _ in range(3000)]
    odd += ["".join(r.choices("abcdefghijklmnopqrstuvwxyzéß'S", k=r.randint(1, 14))) for _ in range(3000)]
    assert e.plain is not None
    assert e.encode(odd) == [library(t)[:-1].tobytes() for t in odd]
    e = first_fit.WordEncoder(VOCABULARY)
    for t in [t for _, t in texts if t] + odd[:20]:
        want = library(t)[:-1].tobytes()
        assert e.encode([t]) == [want] == e.encode([t])


@pytest.mark.parametrize("seed", range(40))
def test_tournament_is_plain_first_fit_and_gaps_close(seed):
    r = random.Random(seed)
    cap = r.choice([16, 64, 4096, 100])
    lengths = sorted((r.randint(1, r.choice([cap, cap // 2])) for _ in range(r.choice([0, 1, 5, 70, 400]))), reverse=True)
    plain, room = [], []
    for k, n in enumerate(lengths):
        at = next((b for b, x in enumerate(room) if x >= n), len(room))
        if at == len(room):
            plain.append([])
            room.append(cap)
        plain[at].append(k)
        room[at] -= n
    got = first_fit.first_fit(lengths, cap)
    assert got == plain
    packed = first_fit.without_gaps([[(k, 0, lengths[k]) for k in s] for s in got], cap)
    parts = collections.defaultdict(list)
    for s in packed:
        n = sum(x for _, _, x in s)
        assert n == cap or n & (n - 1) == 0 and 0 < n <= cap
        for k, at, x in s:
            assert x > 0
            parts[k].append((at, x))
    for k, n in enumerate(lengths):
        at = 0
        for start, x in sorted(parts[k]):
            assert start == at
            at += x
        assert at == n
    assert len(packed) <= sum(lengths) // cap + len([s for s in got if sum(lengths[k] for k in s) < cap and (u := sum(lengths[k] for k in s)) & (u - 1) == 0]) + cap.bit_length()


def check(rows, texts, copies, cap):
    ids = {d: library(t or "") for d, t in texts.items()}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        covered = np.zeros(len(ids[doc]), int)
        for r in own:
            assert r.doc_tokens == len(ids[doc])
            assert zlib.crc32(ids[doc][r.start : r.start + r.length].tobytes()) == zlib.crc32(r.ids)
            covered[r.start : r.start + r.length] += 1
        assert (covered == copies.get(doc, 1)).all()
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= cap
        padding += 0 if at & (at - 1) == 0 else cap - at
    return padding


def test_every_id_lies_in_one_place(spark, corpus, texts, empty):
    assert check(first_fit.pack_groups(corpus, VOCABULARY).collect(), dict(texts), {2: 2}, 4096) == 0
    small = first_fit.pack_groups(corpus.withColumn("group", F.lit(1)), VOCABULARY, capacity=256, group_rows=20)
    assert check(small.collect(), dict(texts), {2: 2}, 256) == 0
    left = first_fit.pack_groups(corpus, VOCABULARY, cut=False).collect()
    assert check(left, dict(texts), {2: 2}, 4096) < 4096 + 0.05 * sum(r.length for r in left)
    assert all(r.length == min(4096, r.doc_tokens - r.start) for r in left)
    assert first_fit.packing_report(empty, VOCABULARY).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (None, None), (1, "")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.start, r.length, r.doc_tokens) for r in first_fit.packing_report(nulls, VOCABULARY).collect()) in ([("1", 0, 1, 1), ("None", 0, 1, 1), ("None", 0, 3, 3)], [("1", 0, 1, 1), ("None", 0, 1, 1), ("None", 0, 2, 3), ("None", 2, 1, 3)], [("1", 0, 1, 1), ("None", 0, 1, 1), ("None", 0, 1, 3), ("None", 1, 2, 3)])


def test_query_on_the_small_documents(spark):
    from pairloom.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = QUERIES["op13_first_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    by_doc = collections.defaultdict(int)
    for r in rows:
        by_doc[r.doc_id] += r.length
    assert by_doc == {r.doc_id: len(library(r.text or "")) for r in docs.collect()}
