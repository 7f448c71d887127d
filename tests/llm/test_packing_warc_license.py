import collections
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from pairloom.llm import license_scan, packing, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(40))
def test_plan_uses_every_piece_once(seed):
    r = random.Random(seed)
    cap = r.choice([16, 64, 1024])
    counts = collections.Counter(r.randint(1, cap) for _ in range(r.choice([1, 5, 50, 500])))
    counts = {k: n * (r.randint(1, 1000) if seed % 3 else 1) for k, n in counts.items()}
    plan = packing.plan(counts, cap)
    got = collections.Counter()
    for pattern, n in plan:
        assert sum(pattern) <= cap and n > 0
        assert sum(3 * k > cap for k in pattern) <= 2
        for k in pattern:
            got[k] += n
    assert got == counts
    assert sum(n for _, n in plan) <= 1.25 * max(sum(k * n for k, n in counts.items()) / cap, sum(n for k, n in counts.items() if 2 * k > cap)) + 2


def test_ids_are_the_tokenizer_s(texts):
    e = packing.Encoder(VOCABULARY)
    odd = [" ", "  a", "a  b", "a \n b", "\n", "a\n b c", "a b ", "é, b  c  d.", "x . , y", "<|endoftext|> a<|endoftext|> b", "a\u0085 b c", "\u200ba b\u200b c", "don't 'll a's b", "a\tb\t c", "1, 2. c3. ٣. ²,", "𝒳. ǅ, ª. ʰ.", "a\u00a0b \u00a0c", "<a> <|x|> b"]
    for t in [t for _, t in texts if t] + odd:
        want = np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert e.encode(t) == want == e.encode(t)


def test_packing_places_every_piece(corpus, texts, empty):
    e = packing.Encoder(VOCABULARY)
    rows = packing.pack(corpus, VOCABULARY).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc, text in texts:
        ids = e.encode(text or "") + np.array([2], "<u4").tobytes()
        n = len(ids) // 4
        got = sorted(by_doc[doc], key=lambda r: r.piece)
        got = got[:: 2 if doc == 2 else 1]  # the repeated row
        first = n % 1024 or 1024
        want = [(0, first)] + [(k, 1024) for k in range(first, n, 1024)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [(k, s, x, zlib.crc32(ids[4 * s : 4 * (s + x)])) for k, (s, x) in enumerate(want)]
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= 1.05 * sum(r.length for r in rows) / 1024 + 2
    assert packing.pack(empty, VOCABULARY).count() == 0


PAGES = [(1, "http://a/\r\nX: y", "q" * 1000), (2, None, "q" * 1000), (3, "http://b/ü", "q" * 999), (4, "http://c", "q" * 999), (5, "http://d", None), (6, "http://e", ""), (7, "u", "ß" * 600), (8, "u", "ß" * 600), (None, "u", "ß" * 600), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (10, "big", "z y" * 900_000), (10, "big", "z y" * 900_000)]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, refers_to string").repartition(3)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()}
    assert got == {(1, "revisit", 2, 1000), (2, "response", None, 1000), (3, "response", None, 999), (4, "response", None, 999), (5, "response", None, 0), (6, "response", None, 0), (7, "revisit", 8, 1200), (8, "response", None, 1200), (None, "revisit", 8, 1200), (9, "response", None, 1600), (10, "response", None, 2_700_000)}
    assert warc.round_trip(pages.where("false")).count() == 0
    paths = warc.write_archives(warc.plan_records(pages), f"file://{tmp_path}").cache()
    back = warc.read_archives(paths).where("record_type = 'response' and page_id < 10").collect()
    assert {r.page_id: r.payload.decode() for r in back} == {i: h or "" for i, _, h in PAGES if i in (2, 3, 4, 5, 6, 8, 9)}


def test_reader_rejects_damage():
    raw = warc.record(1, "u", b"x" * 5000, None)
    good = warc.gzip_member(raw) + warc.gzip_member(warc.record(2, "v", b"", None))
    assert [f["WARC-Record-ID"] for f, _ in warc.Reader(io.BytesIO(good))] == ["<urn:page:1>", "<urn:page:2>"]
    for bad in (good[:-5], warc.gzip_member(raw.replace(b"xxx", b"xyx", 1)), warc.gzip_member(raw + b"more"), warc.gzip_member(raw[:-4]), warc.gzip_member(b"no warc\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.Reader(io.BytesIO(bad)))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return license_scan.train([" ".join(rng.choice("the of grand house went under river stone with many words about copy use work".split()) for _ in range(12)) for _ in range(600)])


def test_licences_in_other_texts(model):
    rng = random.Random(99)
    words = "some plain words that stand around here and tell nothing much of any kind".split()
    fill = lambda n: " ".join(rng.choice(words) for _ in range(n))
    right = total = 0
    for family, group in license_scan.TEMPLATES.items():
        for t in group:
            got, _ = model.predict(f"{fill(rng.randint(0, 40))} {t}. {fill(rng.randint(0, 60))}")
            total += 1
            right += got == family
            if got == family:
                assert model.confirm(f"{fill(5)} {t}", family)[0]
    assert right >= 0.95 * total
    wrong = sum(model.predict(fill(rng.randint(3, 60)) + rng.choice([" licence", " permission", " the free library", " source", ""]))[0] != "unknown" for _ in range(500))
    assert wrong <= 2


def test_licences_in_phrases_that_training_has_not_seen():
    """Recall 0.9 and no family taken for another (measured: 510 of 564, 0), no false alarm among near misses."""
    rng = random.Random(4)
    plain = [" ".join(rng.choice("the of grand house went under river stone with many words about copy use work".split()) for _ in range(12)) for _ in range(800)]
    right = wrong = total = 0
    for out in ("Licensed under the {}", "SPDX-License-Identifier: {}", "This project is subject to the {}"):
        model = license_scan.train(plain, templates=license_scan.templates_of(tuple(p for p in license_scan.PHRASES if p != out)))
        for family, names in license_scan.NAMES.items():
            for text in (t.format(out.format(n)) for n in names for t in ("{}.", f"{plain[3]} {{}} {plain[5]}")):
                got = model.predict(text)[0]
                total, right, wrong = total + 1, right + (got == family), wrong + (got not in (family, "unknown"))
    assert right >= 0.85 * total and wrong <= 0.02 * total
    near = ["The committee will license the venue under public rules", "The public library holds rights to these terms", "He was granted permission to publish the general results", "version 2.0 of the documentation was published", "A lesser known mozilla of the sea", "Common creative attribution of works"]
    assert [model.predict(x)[0] for x in near] == ["unknown"] * len(near)


def test_scan_finds_what_a_plain_search_finds(spark):
    """Every line of the small documents with a licence's words, and no other line."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    marks = ("licensed under", "released under", "rights reserved", "public license")
    want = {(r.doc_id, k) for r in docs.collect() for k, line in enumerate((r.text or "").split("\n")) if any(m in line.lower() for m in marks)}
    found = license_scan.scan(docs).collect()
    assert {(r.doc_id, r.paragraph) for r in found} == want and want
    assert all(r.confirmed for r in found)


def test_scan_finds_notices(spark, corpus, empty, model):
    notices = [(6, "All rights reserved.", "proprietary", 0), (0, "Some text.\nReleased under the MIT License.", "mit", 1), (1, "Licensed under CC BY-NC 4.0. And then more text follows in the line.", "cc-by-nc", 0), (2, "This work is licensed under the GNU General Public License, version 3.", "gpl", 0), (3, "Nothing here\nor there", None, 0), (None, "Licensed under the Apache License, Version 2.0.", "apache-2.0", 0), (4, None, None, 0), (5, "", None, 0)]
    df = spark.createDataFrame([(i, t, "clash") for i, t, _, _ in notices], "doc_id long, text string, family string")
    got = {(r.doc_id, r.family, r.paragraph, r.confirmed) for r in license_scan.scan(df, model).collect()}
    assert got == {(i, f, k, True) for i, _, f, k in notices if f}
    assert license_scan.scan(corpus).count() == 0
    assert license_scan.scan(empty).count() == 0
