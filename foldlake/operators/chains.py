"""Atom tables: chain selection, cleaning, merging, residues, rigid motion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldlake.functions.geometry import rigid


def _in(column: str, chains: Sequence[str]) -> Column:
    return F.coalesce(F.col(column).isin(*chains), F.lit(False))


def first_model(atoms: DataFrame) -> DataFrame:
    """The atoms of the least model number of each structure."""
    least = F.min("model_num").over(Window.partitionBy("structure_id"))
    return atoms.withColumn("_least", least).where("model_num = _least").drop("_least")


def select_author_chains(atoms: DataFrame, chains: Sequence[str] | None) -> DataFrame:
    """Atoms of the given author chains, without water; no chains means all."""
    out = atoms.where(F.coalesce(F.col("label_comp_id") != "HOH", F.lit(True)))
    return out.where(_in("auth_asym_id", chains)) if chains else out


def clean(atoms: DataFrame, chains: Sequence[str] | None) -> DataFrame:
    """Atoms whose label or author chain is given, without water and hetero atoms; no chains means all."""
    out = atoms.where((F.coalesce("label_comp_id", F.lit("")) != "HOH") & (F.coalesce("group_pdb", F.lit("")) != "HETATM"))
    return out.where(_in("label_asym_id", chains) | _in("auth_asym_id", chains)) if chains else out


def select_residues(atoms: DataFrame, chains: Sequence[str], keep_hetero: bool = True) -> DataFrame:
    """Atoms of the given author chains, without water, and without other hetero residues if asked."""
    out = atoms.where(_in("auth_asym_id", chains) & ~F.col("label_comp_id").isin("HOH", "WAT", "DOD"))
    return out if keep_hetero else out.where("group_pdb = 'ATOM'")


def extract(atoms: DataFrame, chains: Sequence[str]) -> DataFrame:
    """Atoms of the first model with chain_rank, the place of their chain in the given order."""
    place = F.array_position(F.array(*map(F.lit, chains)), F.col("auth_asym_id"))
    return first_model(atoms).withColumn("chain_rank", place.cast("int")).where("chain_rank > 0")


def merge(parts: Sequence[DataFrame]) -> DataFrame:
    """All atoms of the parts without water and hetero atoms, with part, the place of their table."""
    out = None
    for at, atoms in enumerate(parts):
        one = clean(atoms, None).withColumn("part", F.lit(at))
        out = one if out is None else out.unionByName(one)
    return out


def residues(atoms: DataFrame) -> DataFrame:
    """structure_id, chain, number, comp, serial of each standard residue of the first model, in file order by serial."""
    rows = first_model(atoms).where("group_pdb = 'ATOM'")
    number = F.col("auth_seq_id").try_cast("int").alias("number")
    rows = rows.select("structure_id", F.col("auth_asym_id").alias("chain"), number, F.col("label_comp_id").alias("comp"), "ins_code", "atom_serial")
    return rows.groupBy("structure_id", "chain", "number", "comp", "ins_code").agg(F.min("atom_serial").alias("serial")).drop("ins_code")


def move(atoms: DataFrame, motions: DataFrame, key: str = "structure_id") -> DataFrame:
    """Atoms moved by the rotation (nine numbers by rows) and shift of their key; atoms without motion stay in place."""
    turn = [[F.col("rotation")[3 * i + j] for j in range(3)] for i in range(3)]
    to = rigid(("x", "y", "z"), turn, [F.col("shift")[i] for i in range(3)])
    both = atoms.join(motions.select(key, "rotation", "shift"), key, "left")
    moved = {c: F.when(F.col("rotation").isNull(), F.col(c)).otherwise(v) for c, v in zip("xyz", to, strict=True)}
    return both.withColumns(moved).select(*atoms.columns)
