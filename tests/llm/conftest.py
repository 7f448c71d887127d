import random

import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """A small corpus with copies, near copies, shared passages, repeats, junk, nulls and empty texts; extra columns with clashing names."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randint(2, 9)))
    vocabulary = [word() for _ in range(900)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    prose = lambda lines, n=14: "\n".join(sentence(n) for _ in range(lines))
    texts = [prose(rng.randint(2, 12)) for _ in range(40)]
    passage = sentence(70)
    texts += [f"{sentence(9)}\n{passage}\n{sentence(8)}" for _ in range(30)]
    texts += [texts[3]] * 25
    for k in range(30):  # near copies of one text
        words = texts[5].split(" ")
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += ["Again and again. " * 90, "x" * 3000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(4000))]
    texts += ["", " \n\t ", "one", "two words", None, None, " ".join(rng.choice(vocabulary) for _ in range(9000)), "é ß ü " * 40, "ÀÉ" + texts[0]]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "clash", "clash") for i, t in enumerate(texts)]
    rows.append(rows[2])  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, first string, fp string").repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark, corpus):
    return spark.createDataFrame([], corpus.schema)


@pytest.fixture(scope="session")
def texts(corpus):
    """(doc_id, text) of the corpus, the repeated row once."""
    return sorted({(r.doc_id, r.text) for r in corpus.collect()}, key=lambda x: x[0])
