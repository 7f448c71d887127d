import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pairloom.llm import common, decontam, line_dedup, simhash, substring


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1400)] + [(rng.randrange(5000, 6000), rng.randrange(5000, 6000)) for _ in range(500)]
    forest = simhash.Forest(7000)
    forest.join(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {n: forest.find(n) for e in edges for n in e if forest.find(n) != n or any(forest.find(m) == n for x in edges for m in x if m != n)}
    assert common.components(df.where("false")).count() == 0


def brute_fingerprint(text, size):
    words = ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).encode().split()
    grams = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_equals_brute_force(spark, corpus, texts, empty):
    rows = {r.doc_id: r for r in simhash.near_duplicates(corpus).collect()}
    fps = [brute_fingerprint(t, 3) for _, t in texts]
    forest = simhash.Forest(len(fps))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                forest.join(np.array([a]), np.array([b]))
    for k, (doc, _) in enumerate(texts):
        assert (rows[doc].fingerprint, rows[doc].component_id) == (f"{fps[k]:016x}", texts[forest.find(k)][0])
    assert simhash.near_duplicates(corpus).count() == corpus.count()
    assert simhash.near_duplicates(empty).count() == 0


def test_null_ids_still_connect(spark):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (None, "q"), (None, "q")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4), (None, None), (None, None)], key=str)


@pytest.mark.parametrize("ball", [0, 3000])
def test_tree_links_equal_all_pairs(spark, ball):
    rng = np.random.default_rng(1)
    bit = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    base = rng.integers(0, 2**63, 150, dtype=np.int64).view(np.uint64)
    parts = [base, rng.integers(0, 2**63, 3000, dtype=np.int64).view(np.uint64)]
    for _ in range(12):
        x = base.copy()
        for _ in range(rng.integers(1, 5)):
            x = x ^ bit(150)
        parts.append(x)
    if ball:
        parts.append(np.full(ball, base[0]) ^ bit(ball) ^ bit(ball) ^ bit(ball))
    fps = np.unique(np.concatenate(parts))
    want = simhash.Forest(len(fps))
    simhash._all_pairs(fps, np.arange(len(fps)), 2, want)
    df = spark.createDataFrame([(int(x), i) for i, x in enumerate(fps.view(np.int64).tolist())], "fp long, rep long").repartition(3)
    got = simhash.Forest(len(fps))
    e = simhash.links(df).toPandas()
    got.join(e.a.to_numpy(), e.b.to_numpy())
    assert [got.find(k) for k in range(len(fps))] == [want.find(k) for k in range(len(fps))]
    alone = simhash.Forest(len(fps))
    simhash._variants(fps, np.arange(len(fps)), alone)
    assert [alone.find(k) for k in range(len(fps))] == [want.find(k) for k in range(len(fps))]


@pytest.mark.parametrize("times", [1, 10])
def test_shards_stay_bounded(spark, times):
    """Ten times the fingerprints make more shards, not larger ones; pairs that a shard's own tree separates still meet."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 3000 * times, dtype=np.int64).view(np.uint64)
    near = base[: 500 * times] ^ (np.uint64(1) << rng.integers(0, 64, 500 * times).astype(np.uint64))
    ball = np.full(2500, base[0]) ^ (np.uint64(1) << rng.integers(0, 64, 2500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2500).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near, ball]))
    df = spark.createDataFrame([(int(x), i) for i, x in enumerate(fps.view(np.int64).tolist())], "fp long, rep long").repartition(3)
    most = 600
    dealt, dense = simhash.shards(df, 2, most)
    assert dealt.groupBy("shard").count().agg(F.max("count")).first()[0] <= most
    assert dealt.select("fp").unionAll(dense.select("fp")).distinct().count() == len(fps)
    e = simhash.links(df, 2, most).toPandas()
    got = simhash.Forest(len(fps))
    got.join(e.a.to_numpy(), e.b.to_numpy())
    want = simhash.Forest(len(fps))
    simhash._variants(fps, np.arange(len(fps)), want)
    assert [got.find(k) for k in range(len(fps))] == [want.find(k) for k in range(len(fps))]


def similar(x, y):
    a, b = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (x, y))
    return len(a & b) >= 0.8 * len(a | b) if a or b else True


def test_stage_keeps_one_of_each_group(corpus, texts, empty):
    left = simhash.drop_near_duplicates(corpus)
    assert left.schema == corpus.schema
    kept = [r.doc_id for r in left.collect()]
    assert len(kept) == len(set(kept))
    text = dict(texts)
    for doc, t in texts:
        near = [d for d in text if d != doc and similar(text[d], t)]
        if doc not in kept:
            assert near
        if not near:
            assert doc in kept
    pairs = [(a, b) for a in kept for b in kept if a < b and similar(text[a], text[b])]
    assert len(pairs) <= 0.02 * len(texts)
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_texts_that_share_an_id_are_judged_each(spark):
    rng = random.Random(6)
    some = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(n))
    p, q, r, s = (some(60) for _ in range(4))
    near = " ".join([*p.split()[:-1], "changed"])
    rows = [(1, p, "a"), (2, q, "a"), (2, near, "b"), (2, r, "c"), (2, r, "d"), (3, r, "e"), (4, s, "f"), (4, s, "g"), (None, p, "h"), (None, p, "i"), (5, None, "j"), (6, None, "k"), (7, q, "l")]
    df = spark.createDataFrame([(i, t, m, 1) for i, t, m in rows], "doc_id int, text string, __SIG string, node int").repartition(3)
    left = simhash.drop_near_duplicates(df)
    assert left.schema == df.schema
    got = [(x.doc_id, x.text) for x in left.collect()]
    assert sorted(got, key=str) == sorted([(1, p), (2, q), (2, r), (4, s), (None, p), (None, p), (5, None)], key=str)
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, simhash.drop_near_duplicates(df.repartition(5)).collect()), key=str)


def test_pairs_among_many_texts_of_one_template_are_linked(spark):
    """Texts on one template (about 0.77 to each other), and pairs of 0.8 among them that are like neither first nor hub."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    template = [word() for _ in range(200)]
    own = lambda n: [word() for _ in range(n)]
    texts = [" ".join(template + own(34)) for _ in range(160)]
    for k in range(40):
        tail = own(34)
        texts += [" ".join(template + tail), " ".join(template[24:] + tail + own(27))]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[k] for k in order]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    keys = [set(simhash.band_keys(simhash.shingle_hashes(t, 5)).tolist()) for t in texts]
    pairs = [(a, b) for a, b in pairs if keys[a] & keys[b]]
    assert len(pairs) >= 35
    got = {r.doc_id: r.component for r in simhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert not [(a, b) for a, b in pairs if got.get(a, a) != got.get(b, b)]


def brute_removed(rows):
    """The result's rows for (doc_id, text), any of them null or repeated, sorted."""
    first, out = {}, []
    for doc, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - 49 if doc is not None else 0):
            key = tuple(w[k : k + 50])
            first[key] = min(doc, first.get(key, doc))
    for doc, t in rows:
        w = (t or "").encode().split()
        gone = {j for k in range(len(w) - 49 if doc is not None else 0) if first[tuple(w[k : k + 50])] < doc for j in range(k, k + 50)}
        out.append((doc, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def removed(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs).collect()), key=str)


@pytest.mark.parametrize("group", [512, 4, 1])
def test_substrings_equal_brute_force(corpus, empty, monkeypatch, group):
    monkeypatch.setattr(substring, "GROUP", group)  # 4 and 1: many buckets are split by longer keys, once and twice
    want = brute_removed([(r.doc_id, r.text) for r in corpus.collect()])
    assert removed(corpus) == want
    assert sum(x[2] for x in want) > 2000
    assert substring.remove_repeats(empty).count() == 0


def test_substrings_of_many_near_copies(spark):
    """2,000 near copies of one text, each changed at one or two places: buckets are split and stay small."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    base = [word() for _ in range(160)]
    rows = []
    for k in range(2000):
        w = list(base)
        for _ in range(1 + k % 2):
            w[rng.randrange(160)] = word()
        rows.append((k * 3 % 2000, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(docs) == brute_removed(rows)
    strings = {}
    for _, t in rows:
        w = t.split()
        for first, n, mini in zip(*(x.tolist() for x in substring.super_kmers(w)), strict=True):
            strings.setdefault(mini, set()).add(" ".join(w[first : first + n + 49]))
    crowded = max(strings, key=lambda m: len(strings[m]))
    cores = {}
    for t in strings[crowded]:
        w = t.encode().split()
        for first, n, core in substring.around_minimiser(w, crowded):
            cores.setdefault(core, set()).add(b" ".join(w[first : first + n + 49]))
    assert len(strings[crowded]) > substring.GROUP >= max(map(len, cores.values()))


def test_substrings_of_rows_that_repeat_an_id(spark):
    """Rows of one id are judged each by its own text and not against one another; null ids and texts, repeated rows, clashing columns."""
    rng = random.Random(5)
    some = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(n))
    p, q, r = some(60), some(20), some(90)
    rows = [(1, p), (2, f"{q} {p}"), (2, r), (2, r), (3, f"{r} {p}"), (3, None), (3, p), (None, p), (None, f"{p} {r}"), (0, ""), (4, r), (4, r), (-5, r[: len(r) // 2])]
    docs = spark.createDataFrame([(*x, 1, "m", 2) for x in rows], "doc_id long, text string, h int, mini string, sig int").repartition(3)
    want = brute_removed(rows)
    assert removed(docs) == want
    assert next(x for x in want if x[0] == 2 and x[1] == 90)[2] == 0


def test_pieces_cover_the_windows_of_a_string():
    rng = random.Random(3)
    for text in ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(300)], [b"z"] * 130, [b"%d" % k for k in range(400)]):
        for first, n, mini in zip(*(x.tolist() for x in substring.super_kmers(text)), strict=True):
            words = text[first : first + n + 49]
            for pieces in (substring.around_minimiser(words, mini), substring.single_windows(words, mini)):
                assert [k for a, m, _ in pieces for k in range(a, a + m)] == list(range(n))


def test_super_kmers_cover_all_windows():
    rng = random.Random(3)
    words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)] + [b"z"] * 200
    first, n, mini = substring.super_kmers(words)
    assert first[0] == 0 and (first[1:] == first[:-1] + n[:-1]).all() and first[-1] + n[-1] == len(words) - 49
    assert (mini[1:] != mini[:-1]).all()
    assert len(substring.super_kmers(words[:49])[0]) == 0


def test_patience():
    for s in range(200):
        r = random.Random(s)
        a = [r.randint(1, 12) for _ in range(r.randint(0, 15))]
        b = [x for x in a if r.random() < 0.8]
        for _ in range(r.randint(0, 4)):
            b.insert(r.randint(0, len(b)), r.randint(1, 20))
        m = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:], strict=False))
        assert [i for i, _ in line_dedup.patience(a, a)] == list(range(len(a)))
    assert line_dedup.blocks([9, 2, 4, 11], [7, 2, 4, 13]) == [] and line_dedup.blocks([9, 2, 5, 11], [7, 2, 5, 13]) == [(1, 2)]


def long_lines(text):
    """Lines of five words or more, white space around them off."""
    return [x for line in (text or "").encode().split(b"\n") if len((x := line.strip(b" \t\n\x0b\x0c\r")).split()) >= 5]


def check_lines(rows, report):
    """What any right result has, over all documents and without an alignment.

    rows: (doc_id, text) with different ids; report: doc_id -> (lines removed, text that stays). Every long line that an
    earlier document has goes, as often as the first of these has it (as often as it stands there, if less); nothing goes
    that no earlier document has; what stays is in order; short lines go only beside long ones that go.
    """
    first = {}
    for d, t in sorted(rows):
        for x in set(long_lines(t)):
            first.setdefault(x, d)
    text = dict(rows)
    missed = total = 0
    for d, t in rows:
        n, left = report[d]
        all_lines, kept = (t or "").split("\n"), left.split("\n") if n < len((t or "").split("\n")) else []
        gone = collections.Counter(all_lines) - collections.Counter(kept)
        assert n == sum(gone.values()) and not collections.Counter(kept) - collections.Counter(all_lines)
        at = iter(all_lines)
        assert all(any(x == y for y in at) for x in kept)
        had, has = collections.Counter(long_lines(t)), collections.Counter(long_lines("\n".join(kept)))
        if n and had and not (had - has):
            raise AssertionError("lines went without a long one")
        for x, count in had.items():
            if first[x] < d:
                total += 1
                missed += count - has[x] < min(count, collections.Counter(long_lines(text[first[x]]))[x])
            else:
                assert has[x] == count
    return missed, total


def test_lines_by_all_overlaps(spark, corpus, texts, empty):
    docs = corpus.select("doc_id", "text").distinct().where("text is not null")
    left = {r.doc_id: r.text for r in line_dedup.remove_shared_lines(docs).collect()}
    report = {r.doc_id: r for r in line_dedup.line_report(corpus).collect()}
    assert all(report[d].kept_sha256 == hashlib.sha256(t.encode()).hexdigest() for d, t in left.items())
    rows = [(d, t) for d, t in texts if t is not None]
    assert {d for d, t in rows} - set(left) == {d for d, t in rows if t.split() and d not in left}
    missed, total = check_lines(rows, {d: (report[d].n_removed, left.get(d, "")) for d, _ in rows if d in left or not report[d].n_removed} | {d: (t.count("\n") + 1, "") for d, t in rows if d not in left})
    assert missed == 0 and total > 100
    out = line_dedup.remove_shared_lines(corpus)
    assert out.schema == corpus.schema and all(r.n_chars == len(r.text or "") for r in out.collect())
    assert line_dedup.remove_shared_lines(empty).count() == line_dedup.line_report(empty).count() == 0


def test_lines_of_the_small_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").where("text is not null").collect()]
    left = {r.doc_id: r.text for r in line_dedup.remove_shared_lines(docs).collect()}
    report = {r.doc_id: r.n_removed for r in line_dedup.line_report(docs).collect()}
    missed, total = check_lines(rows, {d: (report[d], left[d]) if d in left else (t.count("\n") + 1, "") for d, t in rows})
    assert missed == 0 and total > 500


def test_lines_of_rows_that_repeat_an_id(spark):
    """Each row is judged by its own text; the rows of an id don't count against one another."""
    rng = random.Random(2)
    line = lambda n=8: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b, c = ([line() for _ in range(5)] for _ in range(3))
    rows = [(1, a, "k"), (2, a[:3] + b[:2], "l"), (2, c, "m"), (2, c, "n"), (3, c[:2] + [line()], "o"), (None, a, "p"), (4, None, "q")]
    df = spark.createDataFrame([(i, "\n".join(t) if t else t, m, 0) for i, t, m in rows], "doc_id int, text string, __spans string, sig int").repartition(3)
    left = line_dedup.remove_shared_lines(df)
    assert left.schema == df.schema
    got = {r["__spans"]: r.text for r in left.collect()}
    assert got == {"k": "\n".join(a), "l": "\n".join(b[:2]), "m": "\n".join(c), "n": "\n".join(c), "o": rows[4][1][2], "p": "\n".join(a), "q": None}


def test_lines_in_another_order_are_aligned_too():
    assert line_dedup.blocks([1, 3, 5, 7, 9], [5, 7, 9, 1, 3]) == [(0, 2), (2, 3)]
    assert line_dedup.blocks([1, 3, 1, 3, 1], [1, 9, 3]) == [(0, 1), (1, 1)] or line_dedup.blocks([1, 3, 1, 3, 1], [1, 9, 3])
    for s in range(200):
        r = random.Random(s)
        a, b = ([2 * r.randint(0, 9) + 1 for _ in range(r.randint(0, 14))] for _ in range(2))
        m = line_dedup.aligned(a, b)
        assert all(a[i] == b[j] for i, j in m) and len({i for i, _ in m}) == len({j for _, j in m}) == len(m) == sum((collections.Counter(a) & collections.Counter(b)).values())


def test_a_passage_of_one_line_goes_from_all_but_its_first_document(spark):
    """In 40 otherwise different documents, and two frequent lines in a row whose first holders differ."""
    rng = random.Random(9)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage, one, two = line(60), line(12), line(12)
    rows = [(k, f"{line(9)}\n{passage}\n{line(9)}") for k in range(40)] + [(100, f"{one}\n{line(9)}"), (101, f"{two}\n{line(9)}")]
    rows += [(200 + k, f"{line(9)}\n{one}\n{two}\n{line(9)}") for k in range(30)]
    left = {r.doc_id: r.text for r in line_dedup.remove_shared_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    firsts = {0, 100, 101}
    assert left == {d: t if d in firsts else "\n".join(x for x in t.split("\n") if x not in (passage, one, two)) for d, t in rows}


def test_benchmark_items_are_found_and_others_are_not(spark, corpus, empty):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "vwxzkhj") for k in range(rng.randint(3, 8)))
    items = []
    for _ in range(25):
        w = [word() for _ in range(rng.randint(18, 55))]
        cut = len(w) - 6
        items.append(" ".join(w[:cut]).capitalize() + ". " + " ".join(w[cut:]).capitalize() + ".")
    base = [r for r in corpus.where("length(text) > 500").collect()][:25]
    rows, want = [], set()
    for k, (item, doc) in enumerate(zip(items, base, strict=True)):
        words = doc.text.split(" ")
        body = item
        if k % 5 == 1:  # two words changed
            w = item.split(" ")
            w[3], w[9] = word(), word()
            body = " ".join(w).upper()
        elif k % 5 == 2:  # reworded, the answer as it is
            head, answer = item.rsplit(". ", 1)
            w = head.split(" ")
            for at in range(2, len(w), 5):
                w[at] = word()
            body = " ".join(w) + ". " + answer
        elif k % 5 == 4:  # only a fifth of it
            w = item.split(" ")
            body = " ".join(w[: len(w) // 5])
        if k % 5 != 4:
            want.add((1000 + k, k))
        at = rng.randrange(len(words))
        rows.append((1000 + k, " ".join([*words[:at], body, *words[at:]]), None))
    rows += [(5000, None, None), (5001, "", None), (None, items[0], None)]
    docs = corpus.select("doc_id", "text", F.lit("x").alias("item_id")).unionByName(spark.createDataFrame(rows, "doc_id long, text string, item_id string"))
    bench = spark.createDataFrame([*enumerate(items), (77, None), (78, "too short"), (None, items[1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert got == want
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == docs.count() - len({d for d, _ in want})
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(docs, bench.where("false")).count() == 0


def test_paraphrases_that_change_only_rare_words_are_found(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "vwxzkhj") for k in range(8))
    common = [word() for _ in range(8)]
    items, rows = [], []
    for k in range(25):
        head = [x for j in range(8) for x in (word(), common[j], word())][:24]  # 16 rare words, 8 common ones
        answer = " ".join(word() for _ in range(6)).capitalize() + "."
        items.append(" ".join(head).capitalize() + ". " + answer)
        rare = [j for j in range(24) if j % 3 != 1]
        for j in rare[:12]:
            head[j] = word()
        rows.append((k, " ".join(head).capitalize() + ". " + answer + " " + " ".join(word() for _ in range(80))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == {(k, k) for k in range(25)}


def test_contamination_by_search_over_everything(spark):
    """All documents against all items, without terms, passages or a space: nothing missed, nothing more (copies, and items of few words)."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, decontam.plain_words(r.text)) for r in bench.collect()]
    texts = [(r.doc_id, decontam.plain_words(r.text)) for r in docs.collect()]
    holders = collections.defaultdict(set)
    for d, words in texts:
        for w in set(words):
            holders[w].add(d)
    words_of, want = dict(texts), set()
    for item, words in items:
        share = collections.Counter(d for w in set(words) for d in holders[w])
        for d, n in share.items():
            if n >= 0.8 * len(set(words)):
                own = words_of[d]
                if any(decontam.lcs(words, own[k : k + len(words) * 3 // 2]) >= 0.8 * len(words) for k in range(0, len(own), max(1, len(words) // 8))):
                    want.add((d, item))
    rows = decontam.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.kind == "copy"} == want and want
    half = bench.where("item_id % 2 = 0")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, half).collect()} == {(r.doc_id, r.item_id) for r in rows if r.item_id % 2 == 0}


def test_short_items_and_rows_that_repeat_an_id(spark):
    docs = spark.createDataFrame([(1, "so here: Blue whales sing LOW notes, often", "a"), (2, "blue whales sing and low notes", "b"), (2, "they say blue whales sing low notes", "c"), (3, None, "d"), (3, "yes", "e")], "doc_id long, text string, __sig string").repartition(2)
    bench = spark.createDataFrame([(7, "Blue whales sing low notes."), (8, "yes"), (9, "low notes often")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.kind) for r in decontam.contaminated(docs, bench).collect())
    assert got == [(1, 7, 2, "short"), (2, 7, 2, "short")]
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r["__sig"] for r in left.collect()} == {"b", "d", "e"}


def test_frequencies_count_documents_with_few_terms(spark):
    docs = spark.createDataFrame([(1, "alpha x"), (2, "alpha beta"), (3, "beta alpha beta gamma"), (4, "x y"), (5, None)], "doc_id long, text string")
    found = decontam.term_positions(docs, {b"alpha": 0, b"beta": 1, b"gamma": 2})
    assert decontam.document_frequency(found, 3).tolist() == [3, 2, 1]


def test_lcs():
    for s in range(100):
        r = random.Random(s)
        a, b = ([r.randint(0, 5) for _ in range(r.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontam.lcs(a, b) == t[-1][-1]
