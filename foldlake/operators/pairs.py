"""All measures of a pair of structures from its atoms, in one grouped pass.

The same rules as in operators.epitopes and functions.superpose, which work on tables of all pairs and meet in many joins.
Here the atoms of one pair, which are one complex and one chain, meet once, and its measures come from them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.functions.alignment import affine, identity_of_epitopes
from foldlake.functions.residues import RARE, STANDARD
from foldlake.functions.superpose import LEAST_PAIRS, refined

#: What an atom is taken for, as bits: of the chain that is aligned to, of the antigen, of the antibody, of the other species.
REFERENCE, ANTIGEN, ANTIBODY, OTHER = 1, 2, 4, 8
MEASURES = (
    "id string, n_pairs long, n_kept long, alignment_rmsd double, rotation array<double>, shift array<double>, num_contacts long,"
    " epitope_identity double, epitope_rmsd double, epitope_consistent boolean"
)
_LETTERS = STANDARD | RARE
_XYZ = ["x", "y", "z"]


def _first_model(atoms: pd.DataFrame) -> pd.DataFrame:
    return atoms[atoms["model_num"] == atoms["model_num"].min()].sort_values("atom_serial", kind="stable") if len(atoms) else atoms


def _residues(atoms: pd.DataFrame) -> pd.DataFrame:
    """chain, number, comp, letter of the standard residues of a first model, in file order."""
    found = atoms[atoms["group_pdb"] == "ATOM"].drop_duplicates(["chain", "number", "comp", "ins_code"])
    return found.assign(letter=found["comp"].str.strip().str.upper().map(_LETTERS))[["chain", "number", "comp", "letter"]]


def _carbons(atoms: pd.DataFrame) -> pd.DataFrame:
    """The first alpha carbon of each numbered residue of a first model, in file order."""
    return atoms[(atoms["atom_name"] == "CA") & atoms["number"].notna()].drop_duplicates(["chain", "number"])


def _aligned(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
    """chain, number, m_chain, m_number of residues that a global alignment of both sequences pairs."""
    a, b = own[own["letter"].notna()], other[other["letter"].notna()]
    places = np.array(affine("".join(a["letter"]), "".join(b["letter"]), 2.0, -1.0, -10.0, -0.5), int).reshape(-1, 2)
    left, right = a.iloc[places[:, 0]], b.iloc[places[:, 1]]
    return pd.DataFrame({"chain": left["chain"].values, "number": left["number"].values, "m_chain": right["chain"].values, "m_number": right["number"].values})


def _near(antigen: np.ndarray, antibody: np.ndarray, distance: float, block: int = 512) -> np.ndarray:
    """Which antigen points have an antibody point at most distance away."""
    out = np.zeros(len(antigen), bool)
    for at in range(0, len(antigen), block):
        part = antigen[at : at + block]
        low, high = part.min(axis=0) - distance, part.max(axis=0) + distance
        close = antibody[((antibody >= low) & (antibody <= high)).all(axis=1)]
        if len(close):
            gaps = part[:, None, :] - close[None, :, :]
            out[at : at + block] = ((gaps * gaps).sum(axis=2) <= distance * distance).any(axis=1)
    return out


def _text(rows: pd.DataFrame) -> str:
    found = rows[rows["letter"].notna()].sort_values(["chain", "number", "letter"], kind="stable", na_position="first")
    return "".join(found["letter"])


def measure(atoms: pd.DataFrame, distance: float, identity: float, rmsd: float, cycles: int, cutoff: float) -> dict:
    """The measures of one pair; those of an epitope are missing where there is none, all where the chains do not align."""
    sides = {role: _first_model(atoms[(atoms["roles"] & role) > 0]) for role in (REFERENCE, ANTIGEN, ANTIBODY, OTHER)}
    mouse = sides[OTHER]
    other = _residues(mouse)
    pairs = _aligned(_residues(sides[REFERENCE]), other)
    left = _carbons(sides[REFERENCE])[["chain", "number", *_XYZ]].rename(columns={c: f"f{c}" for c in _XYZ})
    right = _carbons(mouse)[["chain", "number", *_XYZ]].rename(columns={"chain": "m_chain", "number": "m_number"})
    both = pairs.merge(left, on=["chain", "number"]).merge(right, on=["m_chain", "m_number"]).dropna()
    if len(both) < LEAST_PAIRS:
        return {}
    rotation, shift, gap, kept = refined(both[_XYZ].to_numpy(float), both[[f"f{c}" for c in _XYZ]].to_numpy(float), cycles, cutoff)
    out = {"n_pairs": len(both), "n_kept": int(kept.sum()), "alignment_rmsd": gap, "rotation": rotation.ravel().tolist(), "shift": shift.tolist()}

    antigen, antibody = (sides[r][(sides[r]["group_pdb"] == "ATOM") & sides[r][_XYZ].notna().all(axis=1)] for r in (ANTIGEN, ANTIBODY))
    near = antigen[_near(antigen[_XYZ].to_numpy(float), antibody[_XYZ].to_numpy(float), distance)]
    own = near[["chain", "number", "comp"]].drop_duplicates()
    if not len(own):
        return out
    own = own.assign(letter=own["comp"].str.strip().str.upper().map(_LETTERS))
    by_number = _residues(sides[ANTIGEN]).sort_values("number", kind="stable", na_position="first")
    mapped = own.merge(_aligned(by_number, other).dropna(), on=["chain", "number"])[["m_chain", "m_number"]]
    found = mapped.merge(other.rename(columns={"chain": "m_chain", "number": "m_number"}), on=["m_chain", "m_number"])
    found = found.rename(columns={"m_chain": "chain", "m_number": "number"})
    a = _carbons(sides[ANTIGEN]).merge(own[["chain", "number"]], on=["chain", "number"]).sort_values("atom_serial", kind="stable")[_XYZ].to_numpy(float)
    b = _carbons(mouse).merge(found[["chain", "number"]], on=["chain", "number"]).sort_values("atom_serial", kind="stable")[_XYZ].to_numpy(float)
    many = min(len(a), len(b))
    gaps = (((b[:many] @ rotation.T + shift) - a[:many]) ** 2).sum(axis=1)
    gaps = gaps[~np.isnan(gaps)]
    far = float(np.sqrt(gaps.mean())) if len(gaps) else float("inf")
    same = identity_of_epitopes(_text(own), _text(found))
    return out | {"num_contacts": len(own), "epitope_identity": same, "epitope_rmsd": far, "epitope_consistent": bool(same >= identity and far <= rmsd)}


def measures(atoms: DataFrame, distance: float = 5.0, identity: float = 80.0, rmsd: float = 1.5, cycles: int = 0, cutoff: float = 2.0) -> DataFrame:
    """MEASURES of each pair, from atoms (id, roles and the columns of an atom): superposition of the other species' chain on
    the reference, and the epitope's size, identity, rmsd after superposition and verdict.

    roles says what an atom is taken for; a residue without a number has no counterpart. With cycles, superposition rejects
    outliers. One pair's atoms are one group.
    """
    names = [c.split()[0] for c in MEASURES.split(", ")]

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        row = dict.fromkeys(names) | {"id": rows["id"].iloc[0]} | measure(rows, distance, identity, rmsd, cycles, cutoff)
        return pd.DataFrame([row], columns=names, dtype=object)

    columns: Sequence = [
        "id", "roles", "model_num", "atom_serial", "group_pdb", F.col("auth_asym_id").alias("chain"), F.col("auth_seq_id").try_cast("int").cast("double").alias("number"),
        F.coalesce("ins_code", F.lit("")).alias("ins_code"), F.coalesce("label_comp_id", F.lit("")).alias("comp"), "atom_name", *_XYZ,
    ]
    return atoms.select(*columns).groupBy("id").applyInPandas(one, MEASURES)
