"""Sequence and header functions: the normalisers, hashes, accessions and string forms, all as Column expressions.

The normalisers agree only on upper-case letters; each keeps its own rule on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STANDARD_RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
#: Residues that a protein language model takes (fixed value).
MODEL_LENGTH = 1022
#: Unicode white space, as splitting a text without a separator takes it (fixed values).
SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def letters_only(s: Column) -> Column:
    """Contract rule: ASCII letters only, upper case."""
    return F.upper(F.regexp_replace(s, "[^A-Za-z]+", ""))


def no_space(s: Column) -> Column:
    """Split rule: upper case without any (Unicode) white space; * and - stay."""
    return F.regexp_replace(F.upper(s), r"(?U)[\s\x1c-\x1f]+", "")


def no_space_no_stop(s: Column) -> Column:
    """Host-corpus rule: white space and closing stops off, upper case; empty becomes NULL."""
    return F.nullif(F.regexp_replace(no_space(s), r"\*+$", ""), F.lit(""))


def stripped_upper(s: Column) -> Column:
    """Upper case, white space off at both ends only."""
    return F.upper(F.btrim(s, F.lit(SPACE)))


def no_space_no_stops(s: Column) -> Column:
    """Structure-database rule: white space and every stop off, upper case."""
    return F.replace(no_space(s), F.lit("*"), F.lit(""))


def standard_only(s: Column) -> Column:
    """Residues outside the twenty standard ones become X."""
    return F.regexp_replace(F.upper(s), f"[^{STANDARD_RESIDUES}]", "X")


def rare_to_x(s: Column, most: int) -> Column:
    """U, Z, O and B become X; cut to the model's length."""
    return F.substring(F.translate(F.upper(s), "UZOB", "XXXX"), 1, most)


def gapless(s: Column, most: int) -> Column:
    """Gaps off, U to C, O to K; cut to the model's length."""
    return F.substring(F.translate(F.upper(s), "UO-.", "CK"), 1, most)


def content_md5(s: Column) -> Column:
    return F.md5(letters_only(s))


def short_id(s: Column, prefix: str = "hp_") -> Column:
    """Prefix and the first 16 hex digits of the MD5 of the stripped upper-case text."""
    return F.concat(F.lit(prefix), F.substring(F.md5(stripped_upper(s)), 1, 16))


def tokens(s: Column, separator: str = ";") -> Column:
    """Distinct trimmed non-empty tokens in order of appearance; NULL is an empty list."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), separator), lambda x: F.btrim(x, F.lit(" \t\n\r\x0b\x0c"))), lambda x: x != ""))


def ordered_tokens(items: Column, order: dict[str, int], rest: int = 99) -> Column:
    """Tokens joined by ; in the given order, unknown ones last, ties by name."""
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    keyed = F.transform(items, lambda t: F.struct(F.coalesce(rank[t], F.lit(rest)).alias("p"), t.alias("t")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["t"]), ";")


def first_match(s: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL without one."""
    return F.nullif(F.regexp_extract(s, pattern, group), F.lit(""))


def accession(header: Column) -> Column:
    """Accession in a header: predicted-structure name, UA= field, middle of db|acc|name, or a bare first word; upper case without isoform number."""
    word = first_match(header, r"^>?(\S+)")
    found = F.coalesce(
        first_match(header, r"(?i)AF-([A-Z0-9]+)-F\d+"),
        first_match(header, r"(?i)\bUA=([A-Z0-9-]+)"),
        first_match(word, r"^[^|]*\|([A-Za-z0-9-]+)(?:\||$)"),
        first_match(word, r"(?i)^([A-Z0-9]{6,10}(?:-\d+)?)$"),
    )
    return F.regexp_replace(F.upper(found), r"-\d+$", "")


def safe_name(s: Column) -> Column:
    """Characters that a file name can't be trusted with become _."""
    return F.regexp_replace(s, r"[^A-Za-z0-9_.-]+", "_")


def structure_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)\.(pdb|cif|mmcif)(\.gz)?$", "")


def interleave(a: Column, b: Column) -> Column:
    """Characters of two strings in turn, to the length of the shorter; linear in it."""
    n = F.least(F.length(a), F.length(b))
    letters = lambda s: F.slice(F.split(s, ""), F.lit(1), n)
    return F.array_join(F.zip_with(letters(a), letters(b), lambda x, y: F.concat(x, y)), "")


def cut_and_pad(s: Column, n: int, pad: str = "d") -> Column:
    return F.rpad(F.substring(s, 1, n), n, pad)


def split_pair(s: Column) -> tuple[Column, Column]:
    """The two sides of a text cut once at its first underscore."""
    at = F.instr(s, "_")
    return F.when(at > 0, F.trim(F.substr(s, F.lit(1), at - 1))), F.when(at > 0, F.trim(F.substr(s, at + 1)))


def public_id(n: Column) -> Column:
    return F.format_string("FP%07d", n)


def wrapped(s: Column, width: int) -> Column:
    return F.regexp_replace(s, "(.{%d})(?=.)" % width, "$1\n")


def round_half_even(x: Column) -> Column:
    return F.bround(x)
