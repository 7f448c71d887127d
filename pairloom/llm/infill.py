"""Fill-in-middle transformation by lookaround splitting.

A unit grammar says what a text's units are. Each is given as the places where a unit ends: between a character of one
class and a character of another. Such a place is a zero-width regular expression that looks at its two neighbours, so
Spark's split() cuts there and keeps every character; an empty text, for which split() gives one empty piece, has no unit.

A document's prefix, middle and suffix end at two unit borders drawn from a hash of seed and doc_id, so they are the same
on every run and cluster. The output holds the parts behind their marks, in prefix-suffix-middle (psm) or
suffix-prefix-middle (spm) order; restored() rebuilds the text from output and form. A text that holds a mark stays plain.

Nulls: a null text is an empty one, which stays plain; a null doc_id is hashed as an empty text. Repeated rows give
repeated results, empty tables none. Other columns are ignored. Texts are cut whole, however long. No step shuffles.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE, WORD, ANY = "\\x20\\x09-\\x0D", "^\\x20\\x09-\\x0D", "^\\x{DC00}-\\x{DFFF}"  # the last: no place inside a character
#: Unit grammars: the regular expression of a unit, matched from left to right, and the classes before and after a border.
UNITS: dict[str, tuple[str, tuple[tuple[str, str], ...]]] = {
    "token": ("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+", ((WORD, SPACE),)),
    "word": ("[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*|[\\x20\\x09-\\x0D]+", ((SPACE, WORD),)),
    "run": ("[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+", ((WORD, SPACE), (SPACE, WORD))),
    "line": ("[^\\n]*\\n|[^\\n]+", (("\\n", ANY),)),
    "character": ("[^\\n]|\\n", (("\\x{0}-\\x{10FFFF}", ANY),)),
}
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")


def border(units: str) -> str:
    """The regular expression of the places between units."""
    return "|".join(f"(?<=[{before}])(?=[{after}])" for before, after in UNITS[units][1])


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be found again whatever surrounds them: none may hold another, or begin as one ends."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"marks {a!r} and {b!r} can run into each other")


def draws(seed: int, key: Column, n: int = 4) -> list[Column]:
    """n numbers of 32 bits from the SHA-256 of seed and key, which are joined by a colon."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def fill_in_middle(docs: DataFrame, units: str = "token", seed: int = 42, percent: int = 50, spm_percent: int = 80, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(doc_id, n, form, prefix, middle, suffix, output): for every document, n its units; the three parts are null if plain."""
    check_marks(marks)
    h = draws(seed, F.col("doc_id"))
    text = F.coalesce("text", F.lit(""))
    x = docs.select("doc_id", text.alias("text"), *(v.alias(f"h{k}") for k, v in enumerate(h)))
    x = x.withColumn("units", F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", border(units), -1)))
    x = x.withColumn("n", F.size("units").cast("long"))
    held = [F.contains("text", F.lit(m)) for m in marks]
    plain = (F.col("n") == 0) | held[0] | held[1] | held[2] | (F.col("h2") % 100 >= percent)
    x = x.withColumn("form", F.when(plain, "plain").when(F.col("h3") % 100 < spm_percent, "spm").otherwise("psm"))
    a, b = F.col("h0") % (F.col("n") + 1), F.col("h1") % (F.col("n") + 1)
    x = x.select("doc_id", "text", "n", "form", "units", F.least(a, b).cast("int").alias("lo"), F.greatest(a, b).cast("int").alias("hi"))
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("units", start, length), ""))
    lo, hi, n = F.col("lo"), F.col("hi"), F.col("n").cast("int")
    x = x.select("doc_id", "text", "n", "form", part(F.lit(1), lo).alias("prefix"), part(lo + 1, hi - lo).alias("middle"), part(hi + 1, n - hi).alias("suffix"))
    p, s, m = map(F.lit, marks)
    psm, spm = F.concat(p, "prefix", s, "suffix", m, "middle"), F.concat(s, "suffix", p, "prefix", m, "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return x.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text of an output, by its form: cut at the marks and put in order again."""
    cut = F.array(F.split(output, "|".join(re.escape(m) for m in marks), -1))  # in an array, so that it is cut once
    psm = F.transform(cut, lambda p: F.concat(p[1], p[3], p[2]))[0]
    spm = F.transform(cut, lambda p: F.concat(p[2], p[3], p[1]))[0]
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def infill_report(docs: DataFrame) -> DataFrame:
    """Lengths and digests of every document's parts, output and restored text."""
    x = fill_in_middle(docs).withColumn("restored", restored(F.col("output"), F.col("form")))
    size = lambda c: F.char_length(c).cast("long").alias(f"{c}_chars")
    return x.select("doc_id", "n", "form", size("prefix"), size("middle"), F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
