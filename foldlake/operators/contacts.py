"""Range joins in space: pairs of points of one structure within a distance, by a grid of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.functions.geometry import within

#: By what part of the distance a ball is taken larger than it is, so that no pair at the very distance is lost to rounding.
_SLACK = 2.0**-10
#: Coordinates of more than so many distances are beyond the grid, as their cells are not exact.
_FARTHEST = 2.0**40


def _gridded(left: DataFrame, right: DataFrame, key: str, a: Sequence[str], b: Sequence[str], distance: float):
    """Both sides with the cells of a grid of the distance, without rows beyond it. A row of right is in each cell that its
    ball reaches: of the 27 around it about 20, as most corners are too far. So every pair within the distance meets in the
    cell of its left row. A distance of 0 has no grid."""
    if distance <= 0:
        return left, right, [key]
    cells, side, ball = ["_cx", "_cy", "_cz"], F.lit(float(distance)), float(distance) * (1 + _SLACK)
    for name, value in zip(cells, a, strict=True):
        left = left.where(F.abs(value) <= side * _FARTHEST).withColumn(name, F.floor(F.col(value) / side).cast("long"))
    beside = F.lit(0.0)
    for name, value in zip(cells, b, strict=True):
        low, high = (F.floor((F.col(value) + F.lit(reach)) / side).cast("long") for reach in (-ball, ball))
        right = right.where(F.abs(value) <= side * _FARTHEST).withColumn(name, F.explode(F.sequence(low, high)))
        gap = F.greatest(F.col(name) * side - F.col(value), F.col(value) - (F.col(name) + 1) * side, F.lit(0.0))
        right = right.withColumn("_gap", beside + gap * gap).where(F.col("_gap") <= ball * ball)
        beside = F.col("_gap")
    return left, right.drop("_gap"), [key, *cells]


def pairs_within(left: DataFrame, right: DataFrame, key: str, a: Sequence[str], b: Sequence[str], distance: float) -> DataFrame:
    """Pairs of a row of left and one of right with the same key whose points are at most distance apart.

    Column names must differ but for key. right should be the smaller side, as it is copied to about 20 cells. A cell that
    holds very many rows is a skewed key, which adaptive execution splits over tasks by its left rows. Rows with a null,
    infinite or no-number coordinate, or one of more than 2 ** 40 distances, have no pairs.
    """
    left, right, on = _gridded(left, right, key, a, b, distance)
    return left.join(right, on).where(within(a, b, distance)).drop(*on[1:])


def rows_within(left: DataFrame, right: DataFrame, key: str, a: Sequence[str], b: Sequence[str], distance: float) -> DataFrame:
    """Rows of left that have a row of right with the same key at most distance away, each once. A row stops at the first
    that it finds, so a cell crowded with both kinds is no square of its rows."""
    left, right, on = _gridded(left, right, key, a, b, distance)
    marked = right.select(*on, *b).withColumnsRenamed({c: f"_r_{c}" for c in (*on, *b)})
    same = [left[c] == marked[f"_r_{c}"] for c in on]
    near = within([left[c] for c in a], [marked[f"_r_{c}"] for c in b], distance)
    condition = near
    for s in same:
        condition = condition & s
    return left.join(marked, condition, "left_semi").drop(*on[1:])


def counts_within(left: DataFrame, right: DataFrame, key: str, ident: str, a: Sequence[str], b: Sequence[str], distance: float) -> DataFrame:
    """key, ident, n: how many rows of right are within the distance of each row of left, also where none is."""
    found = pairs_within(left.select(key, ident, *a), right.select(key, *b), key, a, b, distance).groupBy(key, ident).agg(F.count("*").alias("n"))
    return left.select(key, ident).join(found, [key, ident], "left").select(key, ident, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
