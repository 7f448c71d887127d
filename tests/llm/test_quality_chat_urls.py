import base64
import collections
import hashlib
import os
import random
import re

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from pairloom.llm import chat, quality, queries, urls

SF = "/root/testdata/sf0.001"


def test_counts_equal_brute_force(corpus, texts):
    got = {r.doc_id: r for r in quality.quality_report(corpus).collect()}
    for doc, text in texts:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(grams) < 800 else None
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        if covered is not None:
            assert r.n_repeat_words == len(covered)
            assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert quality.quality_report(corpus).count() == corpus.count()


def test_bands_reject_both_ends_and_leave_prose():
    press = zstandard.ZstdCompressor(level=3)
    assert quality.bands(b"Again and again. " * 200, press)[3] == "repetitive"
    assert quality.bands(base64.b85encode(os.urandom(6000)), press)[3] == "incompressible"
    prose = open(__file__, "rb").read()
    assert quality.bands(prose, press)[3] is None
    assert quality.bands(prose[:200], press)[3] is None
    half = prose[:4096] + b"ab " * 8000
    assert quality.bands(half, press)[3] in ("repetitive", "chunks")


@pytest.mark.parametrize("size", [300, 511, 600, 1023, 1100, 4095, 4200, 16000, 17000, 81000])
def test_base64_with_line_breaks_is_rejected_at_every_length(size):
    press = zstandard.ZstdCompressor(level=3)
    raw = base64.encodebytes(random.Random(size).randbytes(size))[:size]
    assert quality.bands(raw, press)[3] == "incompressible"
    prose = open(__file__, "rb").read()[:4096]
    mixed = b"".join(base64.encodebytes(random.Random(size + k).randbytes(4096))[:4096] if k % 3 else prose for k in range(12))
    _, bad, judged, _ = quality.bands(mixed, press)
    assert bad > quality.CHUNK_SHARE * judged


def judged_again(text):
    """The verdict by a second way: whole text, then bytes of the chunks outside."""
    raw = (text or "").encode()
    words = re.findall(rb"[^ \t\n\x0b\x0c\r]+", raw)
    if len(words) < 50:
        return False
    threes = collections.Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for k in range(len(words) - 2):
        if threes[words[k], words[k + 1], words[k + 2]] > 1:
            inside |= {k, k + 1, k + 2}
    if 2 * len(inside) > len(words):
        return False
    press = zstandard.ZstdCompressor(level=3)
    edges = [(128, 0.95, 2.5), (192, 1.03, 3), (256, 1.08, 3.5), (512, 1.22, 3.5), (1024, 1.3, 3.5), (4096, 1.36, 5), (16384, 1.38, 6.5), (10**12, 1.4, 8)]

    def good(part, full):
        low, high = (1.36, 5) if full else next(e[1:] for e in edges if len(part) < e[0])
        return low <= len(part) / len(press.compress(part)) <= high

    parts = [raw[k : k + 4096] for k in range(0, len(raw), 4096)] if len(raw) > 4096 else []
    return good(raw, False) and 2 * sum(len(x) for x in parts if not good(x, len(x) == 4096)) <= len(raw)


def test_verdicts_equal_a_second_implementation(spark, corpus):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(corpus.select(F.col("doc_id") + 10**6, "text"))
    rng = random.Random(8)
    short = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    odd = [short(50), short(90), short(125), " ".join("abc"[k % 3] * 2 for k in range(60)), base64.encodebytes(rng.randbytes(60)).decode() * 1 + short(49), "x " * 60]
    prose = " ".join(f"word{k * 7919 % 4001}" for k in range(1000))
    odd += [prose[:4096] + base64.encodebytes(rng.randbytes(3000)).decode(), prose[:4090] + " tail end", prose[:4096] + base64.encodebytes(rng.randbytes(700)).decode()]
    docs = docs.unionAll(spark.createDataFrame([(-1 - k, t) for k, t in enumerate(odd)], "doc_id long, text string"))
    got = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    want = {r.doc_id: judged_again(r.text) for r in docs.collect() if len(r.text or "") < 60000}
    assert {d: got[d] for d in want} == want and 0 < sum(want.values()) < len(want)
    assert got[-6] is False and {got[-1], got[-2], got[-3]} != {None}


def test_bands_fitted_to_labels_judge_held_out_documents(spark):
    """Fitted to even documents, tried on odd ones that pass the base rule: 0.85 of the bad ones go, at most 2 % of the good ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    by = quality.fit_bands(docs, labels.where("doc_id % 2 = 0"))
    tried = docs.join(labels.where("doc_id % 2 = 1"), "doc_id")
    verdicts = {r.doc_id: r for r in quality.quality_report(tried, by).where("not base_failed").collect()}
    kind = {r.doc_id: r.quality for r in labels.collect()}
    rate = lambda q: sum(not r.kept for d, r in verdicts.items() if kind[d] == q) / sum(kind[d] == q for d in verdicts)
    assert rate(0) >= 0.85 and rate(1) <= 0.02
    assert {r.reason for r in verdicts.values()} >= {None, "repetitive"}


def test_fit_handles_odd_labels(spark, corpus, empty):
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (5, None), (10**9, 0)], "doc_id long, quality int")
    assert quality.fit_bands(corpus, labels) == quality.fit_bands(empty, labels) == quality.fit_bands(corpus, labels.where("false")) == quality.FIXED
    r = random.Random(2)
    sizes = [int(2 ** r.uniform(7, 15)) for _ in range(3000)]
    good = [r.random() < 0.8 for _ in sizes]
    ratios = [1 + 0.1 * n.bit_length() + r.uniform(-0.1, 0.1) + (0 if g else 0.3) for n, g in zip(sizes, good)]
    import numpy as np

    by = quality.fitted(np.array(sizes, float), np.array(ratios), np.array(good))
    limits = [by.limits(2**k)[1] for k in range(5, 22)]
    assert limits == sorted(limits) and all(1.05 + 0.1 * (k + 1) < by.limits(2**k)[1] < 1.3 + 0.1 * (k + 1) for k in range(8, 15))
    assert quality.fitted(np.array(sizes, float), np.array(ratios), np.ones(len(sizes), bool)) == quality.FIXED


def test_kept_documents_keep_their_columns(corpus, empty):
    kept = quality.keep_quality(corpus)
    assert kept.schema == corpus.schema
    want = {r.doc_id for r in quality.quality_report(corpus).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and 20 < len(want) < 140
    tight = quality.Bands(((8.0, 1.5), (12.0, 1.9)))
    fewer = {r.doc_id for r in quality.keep_quality(corpus, tight).collect()}
    assert fewer == {r.doc_id for r in quality.quality_report(corpus, tight).where("kept").collect()} and fewer < want
    assert quality.keep_quality(empty).count() == quality.quality_report(empty).count() == 0


NASTY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end\\|>", "<\\\\|x", "", "\n", "a<|im_end|>", "<|im_start|>", "\\", "<|", "<\\|", "plain", "<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n", None, "\\n\\l", "é<|é"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, NASTY[(c + t) % len(NASTY)]) for c in range(len(NASTY)) for t, role in enumerate(["system", "user", "assistant", "as\nsist", "<|im_end|>", "a\\nb", None, "assistant"])]
    rows += [(None, 0, "user", "x"), (99, None, "user", "first"), (99, 1, "user", "b"), (99, 1, "user", "a"), (99, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    want: dict = {}
    for c, t, role, text in sorted(rows, key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1], x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(x) for x in got[c].turns] == turns
        assert got[c].loss_text == "".join(t for r, t in turns if r == "assistant")
        assert got[c].formatted.count("<|im_start|>") == got[c].formatted.count("<|im_end|>") == len(turns)
    assert chat.digest(df.where("false")).count() == 0


def test_chat_digest_of_the_probe(spark):
    r = chat.digest(chat.probe(spark)).first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-1, 2, len(said))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


URLS = [None, "", "nothing", "http://", "https://EXAMPLE.com/en/7", "http://a.b.example.COM/en/77?x#y", "http://notexample.com/en/7", "http://x.net/de/", "http://x.net/dex", "ftp://example.net/de/8", "http://example.org/es/a#b", "http://example.org?/es/", "a://b://c.com/en/", "http://com/en/1", "http://.com/en/1", "http://é.com/en/", "http://www.Ä.net/de/1", "http://a.com:80/en/1", "http://" + "a." * 500 + "com/en/" + "x" * 3000]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0] if rest else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for r, v in rules if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return (host, path, *((max(fits)[1:]) if fits else (None, "allow")))


@pytest.mark.parametrize("extra", [[], [(f"d{k}.com/p{k % 7}", "block") for k in range(400)], [(f"d{k % 5}.com/{'p' * (k // 5)}", "allow" if k % 3 else "block") for k in range(300)] + [("host x.com/", "block"), ("d1.com", "block")]])
def test_urls_equal_brute_force(spark, extra):
    rules = [*queries.URL_RULES, *extra]
    more = [f"http://w.d{k}.com/p{k % 9}/x" for k in range(500)] + ["http://hot.net/de/1"] * 300
    pages = spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate(URLS + more)], "page_id long, url string, key string, block string").repartition(4)
    df = spark.createDataFrame([*rules, (None, "block"), ("", "block")], "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, df).collect()}
    assert got == {k: brute(u, rules) for k, u in enumerate(URLS + more)}
    assert urls.filter_urls(pages.where("false"), df).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, df.where("false")).collect()} == {"allow"}


def test_url_rules_are_the_contracts(spark):
    """The words that the contract gives to its five rules, each met by a URL of its own, and the default."""
    want = {"http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/71": ("example.com/en/7", "allow"), "http://a.net/de/1": ("net/de/", "allow"), "http://example.net/de/81": ("example.net/de/8", "block"), "http://a.org/es/1": ("org/es/", "block"), "http://a.org/en/1": (None, "allow")}
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(want)], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.filter_urls(pages, rules).collect()}
    assert got == dict(enumerate(want.values()))


def test_bloom_filter_admits_all_listed_and_few_others(spark):
    listed = spark.range(20000).select(F.concat(F.lit("a"), "id").alias("key"))
    other = spark.range(20000).select(F.concat(F.lit("b"), "id").alias("key"))
    blocks = 1250
    bits = urls.bloom_filter(listed, blocks)
    admits = lambda df: df.withColumn("block", urls._block(F.col("key"), blocks)).join(bits, "block").where(" and ".join(f"(w{k} & shiftleft(1L, cast(pmod(shiftrightunsigned(xxhash64(key, 'bit'), {5 * k}), 32) as int))) <> 0" for k in range(8))).count()
    assert admits(listed) == 20000 and admits(other) < 1000


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    assert sorted(map(str, map(tuple, df.select(cols).collect()))) == sorted(map(str, con.sql(f"select {', '.join(cols)} from ({queries.ORACLE_SQL[name]})").fetchall()))
