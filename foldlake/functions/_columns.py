from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value) -> Column:
    """A column from its name; columns pass through."""
    return F.col(value) if isinstance(value, str) else value
