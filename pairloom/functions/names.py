"""Names in files, paths and headers: cleaned texts, what a path says, targets of copies, candidate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.sequences import SPACE, first_match, safe_name, structure_stem

#: How output files may be named.
NAME_MODES = ("id", "accession", "sequence_md5")


def clean_text(s: Column) -> Column:
    """White space off at both ends; blank becomes NULL."""
    return F.nullif(F.btrim(s.cast("string"), F.lit(SPACE)), F.lit(""))


def first_column(df: DataFrame, names: list[str], default: Column) -> Column:
    """The first of the named columns that the table has, else the default: columns are chosen, not values."""
    return next((F.col(f"`{n}`") for n in names if n in df.columns), default)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def parent(path: Column) -> Column:
    """Name of the folder that a file is in; empty at the top."""
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit(""))


def source_of(path: Column) -> Column:
    """Lower-case stem without its confidence suffix."""
    return F.regexp_replace(F.lower(stem(path)), "_(high|medium)_confidence$", "")


def confidence_of(path: Column) -> Column:
    """high or medium where the file's name says so."""
    return F.nullif(F.regexp_extract(F.lower(stem(path)), "(high|medium)_?confidence", 1), F.lit(""))


def split_of(path: Column, folder: str = "highconfidence_data", prefix: str = "highconfidence_") -> Column:
    """The stem, with a prefix for files of one folder."""
    return F.concat(F.when(parent(path) == folder, prefix).otherwise(""), stem(path))


def source_id(accession: Column, pdb: Column, chain: Column, unknown: str = "UNDEFINED") -> Column:
    """The accession, or structure and chain where it is undefined."""
    return F.when(accession != unknown, accession).otherwise(F.concat(F.lower(pdb), F.lit("_"), chain))


def target_name(mode: str, identifier: Column, accession: Column, md5: Column, source: Column, unpacked: bool = False) -> Column:
    """Name of a structure's copy: named by mode, its suffix kept (.cif when it is unpacked)."""
    if mode not in NAME_MODES:
        raise ValueError(f"no name mode {mode!r}; there are {', '.join(NAME_MODES)}")
    name = {"id": safe_name(identifier), "accession": safe_name(accession), "sequence_md5": md5}[mode]
    suffix = F.lit(".cif") if unpacked else F.when(source.endswith(".cif.gz"), ".cif.gz").otherwise(F.regexp_extract(source, r"(\.[^./]*)$", 1))
    return F.concat(name, suffix)


def header_candidates(header: Column) -> Column:
    """Ids that a structure's header may mean, an MD5 in it first: first word, its structure stem, its stem."""
    word = F.coalesce(first_match(header, r"^\s*(\S+)"), header)
    md5 = first_match(header, r"(?i)(?<![0-9a-f])([0-9a-f]{32})(?![0-9a-f])")
    return F.array_distinct(F.array_compact(F.array(md5, word, structure_stem(F.element_at(F.split(word, "/"), -1)), stem(word))))


def web_address(accession: Column, version: int, template: str = "https://alphafold.ebi.ac.uk/files/AF-{}-F1-model_v{}.cif") -> Column:
    """Address of a predicted structure."""
    before, after = template.split("{}", 1)
    return F.concat(F.lit(before), F.url_encode(accession), F.lit(after.format(version)))
