"""Evidence classes and quality tiers of interactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the contract.
EVIDENCE_TYPES = ("no_exp", "LTP", "HTP", "negative_synthetic", "mixed", "HTP_LTP", "structural", "complex_curation")
EVIDENCE_TAGS = ("HTP", "LTP", "mixed", "no_exp", "structural", "negative_synthetic", "complex_curation")
TIER_NAMES = {"diamond": "钻石", "gold": "黄金", "silver": "白银", "bronze": "青铜", "negative_synthetic": "负样本"}
#: Two orders of tokens are in use: that of the repair step and that of the normalisation (fixed values).
REPAIR_ORDER = {"HTP": 0, "LTP": 1, "mixed": 2, "no_exp": 3, "structural": 4, "negative_synthetic": 5}
TAG_ORDER = {"structural": 0, "HTP": 1, "LTP": 2, "complex_curation": 3, "mixed": 4, "no_exp": 5, "negative_synthetic": 6}
#: Throughput text to tokens (fixed values).
THROUGHPUT = {"LTP": ("LTP",), "HTP": ("HTP",), "both": ("HTP", "LTP"), "no_exp": ("no_exp",), "negative_sample": ("negative_synthetic",)}


def class_of(has: Callable[[str], Column], label: Column) -> Column:
    """Class of a token set: label 0 is synthetic; else the strongest evidence that is there decides."""
    return (
        F.when(label == 0, "negative_synthetic")
        .when(has("structural"), "structural")
        .when(has("HTP") & has("LTP"), "HTP_LTP")
        .when(has("LTP"), "LTP")
        .when(has("complex_curation"), "complex_curation")
        .when(has("HTP"), "HTP")
        .when(has("mixed"), "mixed")
        .when(has("no_exp"), "no_exp")
        .when(has("negative_synthetic"), "negative_synthetic")
        .otherwise("unknown")
    )


def evidence_class(tags: Column, label: Column) -> Column:
    """The same for an array of tokens."""
    return class_of(lambda t: F.array_contains(tags, t), label)


def tier(kind: Column, label: Column, n_sources: Column) -> Column:
    """Quality tier by class and number of sources."""
    return (
        F.when((label == 0) | (kind == "negative_synthetic"), "negative_synthetic")
        .when(kind == "structural", "diamond")
        .when(kind.isin("LTP", "HTP_LTP"), F.when(n_sources >= 2, "diamond").otherwise("gold"))
        .when(kind == "HTP", F.when(n_sources >= 2, "gold").otherwise("silver"))
        .when(kind == "mixed", F.when(n_sources >= 3, "gold").when(n_sources >= 2, "silver").otherwise("bronze"))
        .when(kind == "complex_curation", F.when(n_sources >= 2, "silver").otherwise("bronze"))
        .otherwise("bronze")
    )


def throughput_tokens(text: Column, unknown: str = "unknown") -> Column:
    """Tokens of a throughput text; `unknown` (or `mixed` at ingest) for any other."""
    out = F.array(F.lit(unknown))
    for name, found in THROUGHPUT.items():
        out = F.when(text == name, F.array(*map(F.lit, found))).otherwise(out)
    return out


def with_curation(tags: Column, sources: Column, primary: str, curated: Column) -> Column:
    """Adds complex_curation where the primary source is one of the row's and its pair is a curated one."""
    return F.when(F.array_contains(sources, primary) & curated, F.array_union(tags, F.array(F.lit("complex_curation")))).otherwise(tags)


def repaired(tags: Column, raw: Column, sources: Column, primary: str, mixed_sources: list[str]) -> Column:
    """For the primary source's rows with raw tokens: `mixed` goes unless another source supports it, then raw tokens join."""
    others = F.arrays_overlap(sources, F.array(*map(F.lit, mixed_sources)))
    base = F.when(others, tags).otherwise(F.array_remove(tags, "mixed"))
    return F.when(F.array_contains(sources, primary) & raw.isNotNull(), F.array_union(base, raw)).otherwise(tags)


def interface_tier(text: Column) -> Column:
    """Weak, strong or medium interface from its description; any other text is an error."""
    low = F.lower(text)
    return F.when(low.rlike("weak|small"), "weak").when(low.rlike("strong|large"), "strong").when(low.contains("medium"), "medium").otherwise(F.raise_error(F.concat(F.lit("no interface tier in "), F.coalesce(text, F.lit("null")))))
