"""The complex catalogue: filters with counts, deduplication, candidate choice, limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldlake.functions.text import contains_ci, first_chain, number_or_null


def present(value) -> Column:
    """Neither null nor the marker NA."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & (value != "NA")


def complex_conditions(df: DataFrame, most: float | None = 2.5, paired: bool = True) -> list[tuple[str, Column]]:
    """Named conditions of the human antigen filter, in order; those of missing columns are left out."""
    out = [("human", contains_ci("antigen_species", "homo sapiens")), ("protein", contains_ci("antigen_type", "protein"))]
    if most is not None and "resolution" in df.columns:
        out.append(("resolution", F.coalesce(number_or_null("resolution") <= F.lit(float(most)), F.lit(False))))
    if paired:
        out.append(("paired", present("Hchain") & present("Lchain")))
    return [*out, ("antigen_chain", present("antigen_chain"))]


def keep_all(df: DataFrame, conditions: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows for which every condition holds."""
    return df.where(reduce(lambda a, b: a & b, (c for _, c in conditions)))


def funnel(df: DataFrame, conditions: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row: n_all, and for each condition the rows left after it and those before, counted in one pass."""
    held, columns = F.lit(True), [F.count("*").cast("long").alias("n_all")]
    for name, condition in conditions:
        held = held & F.coalesce(condition, F.lit(False))
        columns.append(F.count_if(held).cast("long").alias(f"n_{name}"))
    return df.agg(*columns)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key in the given order, which should be total. Null keys are a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def unique_complexes(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The first row, in input order, of each (pdb, antigen_chain)."""
    return first_rows(df, ["pdb", "antigen_chain"], [ordinal])


def best_candidates(df: DataFrame, keys: Sequence[str], complete: Column, resolution, ordinal: Sequence) -> DataFrame:
    """For each key the candidate with a complete antibody, then of best resolution (null last), then first."""
    resolution = F.col(resolution) if isinstance(resolution, str) else resolution
    return first_rows(df, keys, [F.when(complete, 0).otherwise(1), resolution.asc_nulls_last(), *ordinal])


def head(df: DataFrame, n: int | None, order: Sequence) -> DataFrame:
    """The first n rows in the given order; all rows if n is None or 0."""
    return df.orderBy(*order).limit(n) if n else df


def chain_info(df: DataFrame) -> DataFrame:
    """pdb, chains, species, name and resolution of each complex; a missing column gets its default, a null stays null."""
    defaults = {"antigen_species": "Unknown", "antigen_name": "Unknown", "resolution": "N/A"}
    columns = [F.col(c) if c in df.columns else F.lit(v).alias(c) for c, v in defaults.items()]
    return df.select("pdb", "Hchain", "Lchain", "antigen_chain", first_chain("antigen_chain").alias("first_chain"), *columns)
