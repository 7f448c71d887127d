"""What the sequence models take: letters, length, special tokens, pooling. Weights are not part of this repository.

A model's input is a column expression, so it is made in the JVM; a registered extractor gets what the expression gives
and returns a row for each token, of which the special ones at both ends are cut off before pooling.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from pairloom.functions.sequences import gapless, interleave, rare_to_x

MAX_LENGTH = 1024
POOLS = ("mean", "max", "cls", "residue")
#: Token ids of the structure alphabet and of the two directions, in the vocabulary of the bilingual model (fixed values).
STRUCTURE_LETTERS = "algvsredtipkfqnymhwc"
FIRST_STRUCTURE_ID, UNKNOWN_ID, END_ID, TO_RESIDUES_ID, TO_STRUCTURE_ID = 128, 2, 1, 148, 149
#: Residues stand in the same order in that vocabulary, the unknown residue behind them (fixed values).
RESIDUE_LETTERS, FIRST_RESIDUE_ID = STRUCTURE_LETTERS.upper() + "X", 3
#: Structure tokens of the quantised model are shifted by this, behind its start and before its end (fixed values).
QUANTISED_SHIFT, QUANTISED_START, QUANTISED_END = 3, 1, 2


@dataclass(frozen=True)
class Model:
    """A model's input rules: vector length, batch, special tokens before and after the residues, and its pooling."""

    size: int | None
    text: Callable[[Column, int], Column]
    batch: int = 4
    before: int = 1
    after: int = 1
    pool: str = "mean"
    has_cls: bool = True


def cut(s: Column, most: int = MAX_LENGTH) -> Column:
    """As it is, to the model's length."""
    return F.substring(s, 1, most)


def spaced(s: Column, most: int = MAX_LENGTH) -> Column:
    """Rare residues as X, letters apart, as piece tokenizers of residues take them."""
    return F.array_join(F.split(rare_to_x(s, most), ""), " ")


def _letter_ids(s: Column, letters: str, first: int, direction: int) -> Column:
    """A token id for each letter behind the direction's token and before the end."""
    known = F.create_map(*(x for k, c in enumerate(letters) for x in (F.lit(c), F.lit(first + k))))
    body = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), lambda c: F.coalesce(known[c], F.lit(UNKNOWN_ID)))
    return F.concat(F.array(F.lit(direction)), body, F.array(F.lit(END_ID)))


def structure_ids(s: Column, most: int = MAX_LENGTH) -> Column:
    """Token ids of structure letters behind the direction's token and before the end."""
    return _letter_ids(F.lower(F.substring(s, 1, most)), STRUCTURE_LETTERS, FIRST_STRUCTURE_ID, TO_RESIDUES_ID)


def residue_ids(s: Column, most: int = MAX_LENGTH) -> Column:
    """Token ids of residues, rare ones as X, behind the direction's token and before the end."""
    return _letter_ids(rare_to_x(s, most), RESIDUE_LETTERS, FIRST_RESIDUE_ID, TO_STRUCTURE_ID)


def structure_letters_of(tokens: Column, n: Column, filler: str = "d") -> Column:
    """The structure letters among token ids, n of them: cut off or filled up; other tokens are passed over."""
    own = F.filter(tokens, lambda i: i.between(FIRST_STRUCTURE_ID, FIRST_STRUCTURE_ID + len(STRUCTURE_LETTERS) - 1))
    letters = F.transform(own, lambda i: F.substring(F.lit(STRUCTURE_LETTERS), i - (FIRST_STRUCTURE_ID - 1), F.lit(1)))
    return F.rpad(F.array_join(letters, ""), n, filler)


def woven(residues: Column, structure: Column, most: int = MAX_LENGTH) -> Column:
    """Upper-case residue and lower-case structure letter in turn, to the shorter of both; no more of them than the model takes is cut into letters."""
    return interleave(F.substring(F.upper(residues), 1, most), F.substring(F.lower(structure), 1, most))


def paired(residues: DataFrame, structure: DataFrame, key: str = "id", sequence: str = "sequence") -> tuple[DataFrame, DataFrame]:
    """(key, text, same_length) of ids that both tables have, woven to the shorter; and the residues' ids without structure."""
    x = residues.select(key, F.col(sequence).alias("__r")).join(structure.select(key, F.col(sequence).alias("__s")), key)
    both = x.select(key, woven(F.col("__r"), F.col("__s")).alias("text"), (F.length("__r") == F.length("__s")).alias("same_length"))
    return both, residues.select(key).join(structure.select(key), key, "left_anti")


def quantised_ids(tokens: Column, length: Column, most: int = MAX_LENGTH) -> Column:
    """Shifted structure tokens of the first residues, between start and end."""
    n = F.least(length, F.size(tokens), F.lit(most))
    body = F.transform(F.slice(tokens, F.lit(1), n), lambda x: x.cast("int") + QUANTISED_SHIFT)
    return F.concat(F.array(F.lit(QUANTISED_START)), body, F.array(F.lit(QUANTISED_END)))


def with_quantised(residues: Column, tokens: Column, most: int = MAX_LENGTH) -> Column:
    """Residues to the model's length, a line, and the ids of their structure tokens."""
    ids = F.array_join(quantised_ids(tokens, F.length(residues), most).cast("array<string>"), " ")
    return F.concat(F.substring(residues, 1, most), F.lit("\n"), ids)


#: Models that take a structure beside the residues: how both are joined.
TWO_INPUTS: dict[str, Callable[[Column, Column, int], Column]] = {"saprot": woven, "prosst": with_quantised}


def two_inputs(model: str, residues: DataFrame, structure: DataFrame, key: str = "id", sequence: str = "sequence", most: int = MAX_LENGTH) -> tuple[DataFrame, DataFrame]:
    """(key, text) of ids that have residues and a structure, joined as the model takes them, and a row of counts.

    The counts are `given` ids with residues, `missing` ones without a structure, `uneven` ones whose two lengths differ
    (the shorter one counts), and `truncated` ones of which more than the model's length is there. The structure's column
    is `sequence` too: letters, or an array of tokens. A key has one row on each side.
    """
    x = residues.select(key, F.col(sequence).alias("__r")).join(structure.select(key, F.col(sequence).alias("__s")), key, "left")
    size = F.size("__s") if isinstance(structure.schema[sequence].dataType, ArrayType) else F.length("__s")
    has = F.col("__r").isNotNull() & F.col("__s").isNotNull()
    counted = x.agg(
        F.count("__r").alias("given"),
        F.count_if(F.col("__r").isNotNull() & F.col("__s").isNull()).alias("missing"),
        F.count_if(has & (F.length("__r") != size)).alias("uneven"),
        F.count_if(has & (F.least(F.length("__r"), size) > most)).alias("truncated"),
    )
    return x.where(has).select(key, TWO_INPUTS[model](F.col("__r"), F.col("__s"), most).alias("text")), counted


#: The supported models by name; None where the vector's length is the model's own hidden size.
MODELS: dict[str, Model] = {
    "esm2": Model(1280, cut),
    "esmc": Model(960, cut, batch=128),
    "prott5": Model(1024, spaced, before=0, has_cls=False),
    "prostt5": Model(1024, residue_ids),
    "prostt5-3di": Model(1024, structure_ids, batch=8),
    "saprot": Model(1280, cut),
    "profam": Model(None, gapless, before=2, pool="residue"),
    "prosst": Model(768, cut),
}


def pool_mode(pool: str | None, default: str, per_residue: bool = False, mean_pool: bool = False) -> str:
    """The pooling that flags ask for: the old mean flag beats the old residue flag, which beats the new one."""
    mode = "mean" if mean_pool else "residue" if per_residue or pool == "per-residue" else pool or default
    if mode not in POOLS:
        raise ValueError(f"no pooling {pool!r}; there are {', '.join(POOLS)}")
    return mode


def checked_pool(model: str, pool: str | None = None, **flags: bool) -> str:
    """The pooling for a model, an error if it needs a token that the model has not."""
    mode = pool_mode(pool, MODELS[model].pool, **flags)
    if mode == "cls" and not MODELS[model].has_cls:
        raise ValueError(f"{model} has no token for the whole sequence")
    return mode
