"""Least-squares superposition of paired points (Kabsch), with rejection of outliers if asked."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_PAIRS = 3
#: Distances up to this are rounding, not outliers.
EXACT = 1e-6


def kabsch(mobile: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Rotation R and shift t that bring R x + t of the mobile points nearest to the fixed ones, and their rmsd."""
    a, b = mobile.mean(axis=0), fixed.mean(axis=0)
    u, _, v = np.linalg.svd((mobile - a).T @ (fixed - b))
    turn = np.diag([1.0, 1.0, np.sign(np.linalg.det(v.T @ u.T)) or 1.0])
    rotation = v.T @ turn @ u.T
    shift = b - rotation @ a
    rmsd = float(np.sqrt(((mobile @ rotation.T + shift - fixed) ** 2).sum(axis=1).mean()))
    return rotation, shift, rmsd


def refined(mobile: np.ndarray, fixed: np.ndarray, cycles: int, cutoff: float) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """kabsch() of the pairs that stay when those farther apart than cutoff times the rmsd are dropped and the rest is fitted
    again, up to so many times, until none goes; and which pairs stay. Three pairs stay at least."""
    kept = np.ones(len(mobile), bool)
    rotation, shift, rmsd = kabsch(mobile, fixed)
    for _ in range(cycles):
        far = np.sqrt(((mobile @ rotation.T + shift - fixed) ** 2).sum(axis=1))
        near = kept & (far <= max(cutoff * rmsd, EXACT))
        if near.sum() < LEAST_PAIRS or (near == kept).all():
            break
        kept = near
        rotation, shift, rmsd = kabsch(mobile[kept], fixed[kept])
    return rotation, shift, rmsd, kept


def superpose(pairs: DataFrame, key: str, cycles: int = 0, cutoff: float = 2.0) -> DataFrame:
    """key, n, kept, rmsd, rotation (nine numbers by rows), shift for each key of paired points (x, y, z, fx, fy, fz).

    Pairs with a null coordinate do not count; a key with fewer than three pairs has null results. With cycles, pairs that
    do not fit are rejected as refined() says, and kept tells how many stay. One key's points are one structure and meet in
    one task.
    """
    kind = dict(pairs.dtypes)[key]

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        found = rows.dropna(subset=["x", "y", "z", "fx", "fy", "fz"])
        out = {key: rows[key].iloc[0], "n": len(found), "kept": None, "rmsd": None, "rotation": None, "shift": None}
        if len(found) >= LEAST_PAIRS:
            rotation, shift, rmsd, kept = refined(found[["x", "y", "z"]].to_numpy(float), found[["fx", "fy", "fz"]].to_numpy(float), cycles, cutoff)
            out |= {"kept": int(kept.sum()), "rmsd": rmsd, "rotation": rotation.ravel().tolist(), "shift": shift.tolist()}
        return pd.DataFrame([out])

    points = [F.col(c).cast("double").alias(c) for c in ("x", "y", "z", "fx", "fy", "fz")]
    schema = f"{key} {kind}, n long, kept long, rmsd double, rotation array<double>, shift array<double>"
    return pairs.select(key, *points).groupBy(key).applyInPandas(fit, schema)
