"""Epitopes: antigen residues near an antibody, their counterparts in another species, identity, rmsd and verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.functions.alignment import affine_identity, affine_pairs
from foldlake.functions.residues import assemble, one_letter
from foldlake.operators.catalogue import first_rows
from foldlake.operators.chains import first_model, residues
from foldlake.operators.contacts import rows_within
from foldlake.operators.summary import paired_rmsd


def epitope(antigen: DataFrame, antibody: DataFrame, distance: float = 5.0) -> DataFrame:
    """structure_id, chain, number, comp of the standard antigen residues with an antibody atom within the distance."""

    def points(atoms: DataFrame, mark: str) -> DataFrame:
        rows = first_model(atoms).where("group_pdb = 'ATOM'")
        return rows.select("structure_id", *[F.col(c).alias(f"{mark}{c}") for c in "xyz"], F.col("auth_asym_id").alias("chain"), F.col("auth_seq_id").try_cast("int").alias("number"), F.col("label_comp_id").alias("comp"))

    near = rows_within(points(antigen, "a"), points(antibody, "b").drop("chain", "number", "comp"), "structure_id", ("ax", "ay", "az"), ("bx", "by", "bz"), distance)
    return near.select("structure_id", "chain", "number", "comp").distinct()


def epitope_sequence(rows: DataFrame) -> DataFrame:
    """structure_id, sequence of epitope residues by chain and number; residues of no known letter are left out."""
    lettered = rows.withColumn("letter", one_letter("comp")).where("letter <> 'X'")
    return lettered.groupBy("structure_id").agg(assemble("chain", "letter", "number").alias("sequence"))


def chain_sequence(atoms: DataFrame, by_number: bool = True) -> DataFrame:
    """structure_id, sequence, places (array<struct<chain, number>>) of a structure's known residues, by number or in file order."""
    rows = residues(atoms).withColumn("letter", one_letter("comp")).where("letter <> 'X'")
    order = F.col("number") if by_number else F.col("serial")
    key = F.struct(order.alias("o"), F.col("serial").alias("s"), "chain", "number", "letter")
    out = rows.groupBy("structure_id").agg(F.array_sort(F.collect_list(key)).alias("r"))
    return out.select("structure_id", F.array_join(F.transform("r", lambda x: x["letter"]), "").alias("sequence"), F.transform("r", lambda x: F.struct(x["chain"], x["number"])).alias("places"))


def counterparts(human: DataFrame, mouse: DataFrame, by_number: bool = True) -> DataFrame:
    """structure_id, chain, number, m_chain, m_number: mouse residues aligned to human ones, which are taken by number or
    in file order. Both sides are keyed by the structure_id of the pair."""
    a = chain_sequence(human, by_number).select("structure_id", F.col("sequence").alias("sa"), F.col("places").alias("pa"))
    b = chain_sequence(mouse, by_number=False).select("structure_id", F.col("sequence").alias("sb"), F.col("places").alias("pb"))
    pairs = a.join(b, "structure_id").withColumn("p", F.explode(affine_pairs("sa", "sb")))
    at, to = F.get("pa", F.col("p.a")), F.get("pb", F.col("p.b"))
    return pairs.select("structure_id", at["chain"].alias("chain"), at["number"].alias("number"), to["chain"].alias("m_chain"), to["number"].alias("m_number"))


def alpha_carbons(atoms: DataFrame) -> DataFrame:
    rows = first_model(atoms).where("atom_name = 'CA'").select("structure_id", F.col("auth_asym_id").alias("chain"), F.col("auth_seq_id").try_cast("int").alias("number"), "atom_serial", "x", "y", "z")
    return first_rows(rows, ["structure_id", "chain", "number"], ["atom_serial"])


def validate(human: DataFrame, antibody: DataFrame, mouse: DataFrame, distance: float = 5.0, identity: float = 80.0, rmsd: float = 1.5) -> DataFrame:
    """structure_id, epitope_identity, epitope_rmsd, num_contacts (epitope residues), is_consistent for each pair that has
    an epitope. An epitope without counterparts has identity 0 and an infinite rmsd. Coordinates must be superposed."""
    own = epitope(human, antibody, distance)
    mapped = own.join(counterparts(human, mouse), ["structure_id", "chain", "number"])
    kinds = residues(mouse).select("structure_id", F.col("chain").alias("m_chain"), F.col("number").alias("m_number"), F.col("comp").alias("m_comp"))
    other = mapped.join(kinds, ["structure_id", "m_chain", "m_number"])
    m_rows = other.select("structure_id", F.col("m_chain").alias("chain"), F.col("m_number").alias("number"), F.col("m_comp").alias("comp"))
    sides = epitope_sequence(own).select("structure_id", F.col("sequence").alias("a")).join(epitope_sequence(m_rows).select("structure_id", F.col("sequence").alias("b")), "structure_id", "left")
    same = sides.select("structure_id", affine_identity(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("epitope_identity"))
    left = alpha_carbons(human).join(own.select("structure_id", "chain", "number"), ["structure_id", "chain", "number"])
    right = alpha_carbons(mouse).join(m_rows.select("structure_id", "chain", "number"), ["structure_id", "chain", "number"])
    far = paired_rmsd(left, right, "structure_id", "atom_serial", ("x", "y", "z")).select("structure_id", F.col("rmsd").alias("epitope_rmsd"))
    counts = own.groupBy("structure_id").agg(F.count("*").cast("long").alias("num_contacts"))
    out = counts.join(same, "structure_id", "left").join(far, "structure_id", "left")
    out = out.withColumn("epitope_identity", F.coalesce("epitope_identity", F.lit(0.0))).withColumn("epitope_rmsd", F.coalesce("epitope_rmsd", F.lit(float("inf"))))
    return out.withColumn("is_consistent", (F.col("epitope_identity") >= identity) & (F.col("epitope_rmsd") <= rmsd))


def carbon_pairs(human: DataFrame, mouse: DataFrame) -> DataFrame:
    """structure_id, x, y, z, fx, fy, fz: alpha carbons of mouse residues and of the human ones that they are aligned to."""
    left = alpha_carbons(human).select("structure_id", "chain", "number", *[F.col(c).alias(f"f{c}") for c in "xyz"])
    right = alpha_carbons(mouse).select("structure_id", F.col("chain").alias("m_chain"), F.col("number").alias("m_number"), "x", "y", "z")
    both = counterparts(human, mouse, by_number=False).join(left, ["structure_id", "chain", "number"]).join(right, ["structure_id", "m_chain", "m_number"])
    return both.select("structure_id", "x", "y", "z", "fx", "fy", "fz")
