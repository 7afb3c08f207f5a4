"""Distances and rigid motions, as columns that stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldlake.functions._columns import col


def squared_distance(a: Sequence, b: Sequence) -> Column:
    parts = [(col(x) - col(y)) * (col(x) - col(y)) for x, y in zip(a, b, strict=True)]
    return parts[0] + parts[1] + parts[2]


def within(a: Sequence, b: Sequence, distance: float) -> Column:
    """Whether two points are at most distance apart."""
    return squared_distance(a, b) <= F.lit(float(distance) * float(distance))


def rigid(point: Sequence, rotation: Sequence[Sequence], shift: Sequence) -> list[Column]:
    """The three coordinates of rotation * point + shift; entries are numbers or columns."""

    def entry(value) -> Column:
        return value if isinstance(value, Column) else F.lit(float(value))

    x, y, z = (col(p) for p in point)
    return [entry(r[0]) * x + entry(r[1]) * y + entry(r[2]) * z + entry(t) for r, t in zip(rotation, shift, strict=True)]
