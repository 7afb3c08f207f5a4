"""Residue names and protein sequences, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldlake.functions._columns import col

#: Three- to one-letter codes of the standard residues, and of the ambiguous and rare ones; fixed values.
STANDARD = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}
RARE = {"ASX": "B", "GLX": "Z", "XLE": "J", "SEC": "U", "PYL": "O"}
#: Modified residues and the letter that they are written as; fixed values.
MODIFIED = {"MSE": "M", "SEP": "S", "TPO": "T", "PTR": "Y", "CSO": "C", "HYP": "P", "MLY": "K", "CME": "C"}


def _lookup(value: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), value)


def one_letter(value) -> Column:
    """The letter of a residue name in any case; X for names not known."""
    return F.coalesce(_lookup(F.upper(F.trim(col(value))), STANDARD | RARE), F.lit("X"))


def one_letter_modified(value) -> Column:
    """The letter of a standard or modified residue, X for other names of three letters, null for all else."""
    name = F.upper(F.trim(col(value)))
    return F.coalesce(_lookup(name, STANDARD | MODIFIED), F.when(name.rlike("^[A-Z]{3}$"), F.lit("X")))


def clean_sequence(value) -> Column:
    """A one-letter sequence from an entity's text: `(XXX)` becomes its letter or X, only capitals stay."""
    out = F.regexp_replace(col(value), r"[\n\r ]", "")
    for name, letter in MODIFIED.items():
        out = F.replace(out, F.lit(f"({name})"), F.lit(letter))
    return F.regexp_replace(F.regexp_replace(out, r"\([A-Z]{3}\)", "X"), r"[^\p{Lu}]", "")


def assemble(number: str, letter: str, *tie: str) -> Column:
    """An aggregate: letters joined in the order of number, then of the tie columns. One chain's residues are one row."""
    rows = F.array_sort(F.collect_list(F.struct(number, *tie, F.col(letter).alias("_letter"))))
    return F.array_join(F.transform(rows, lambda r: r["_letter"]), "")


def positional_identity(a, b) -> Column:
    """Percent of equal letters at equal places over the longer length; 0 if either is empty or null."""
    a, b = F.coalesce(col(a), F.lit("")), F.coalesce(col(b), F.lit(""))
    longer = F.greatest(F.length(a), F.length(b))
    same = F.aggregate(
        F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when((x == y) & (x != ""), 1).otherwise(0)),
        F.lit(0),
        lambda s, x: s + x,
    )
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(same * 100.0 / longer)
