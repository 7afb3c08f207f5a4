"""Summaries of results: counts and means by status, the best structure of each gene, contact verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldlake.operators.catalogue import first_rows


def rmsd_order(value) -> Column:
    """An rmsd for ordering: null and 0.0 count as infinite."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(float("inf")))


def best_of_gene(df: DataFrame, gene: str, rmsd: str, order: Sequence) -> DataFrame:
    """The row with the least rmsd of each non-empty gene, first in order among equals."""
    return first_rows(df.where(F.col(gene) != ""), [gene], [rmsd_order(rmsd), *order])


def status_summary(df: DataFrame, status: str, identity: str, rmsd: str) -> DataFrame:
    """One row: n_total, n_success, n_failed, n_dry_run, n_not_success, and means over successes without nulls."""
    ok = F.col(status) == "success"
    counts = {"n_success": ok, "n_failed": F.col(status) == "failed", "n_dry_run": F.col(status) == "dry_run", "n_not_success": ~ok}
    return df.agg(
        F.count("*").cast("long").alias("n_total"),
        *[F.count_if(c).cast("long").alias(n) for n, c in counts.items()],
        F.avg(F.when(ok, F.col(identity))).alias("mean_identity"),
        F.avg(F.when(ok, F.col(rmsd))).alias("mean_rmsd"),
    )


def contact_verdicts(counts: DataFrame, key: str, order: str, least: int) -> DataFrame:
    """key, contact_count, contact_count_full, passed from the contacts `n` of each atom of a structure.

    Counting stops at the atom with which the running total reaches least, and contact_count is the total there.
    """
    so_far = F.sum("n").over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n")
    reached = F.min(F.when(F.col("run") >= least, F.col("run")))
    out = counts.withColumn("run", so_far).groupBy(key).agg(
        F.coalesce(reached, total).cast("long").alias("contact_count"), total.cast("long").alias("contact_count_full")
    )
    return out.withColumn("passed", F.col("contact_count") >= least)


def missing_numbers(df: DataFrame, key: str, number: str) -> DataFrame:
    """key, number for each number between the least and the greatest of a key that no row has."""
    ends = df.groupBy(key).agg(F.min(number).alias("_a"), F.max(number).alias("_b"), F.count_distinct(number).alias("_n"))
    gaps = ends.where("_n < _b - _a + 1").select(key, F.explode(F.expr("sequence(_a, _b)")).alias(number))
    return gaps.join(df.select(key, number), [key, number], "left_anti")


def paired_rmsd(left: DataFrame, right: DataFrame, key: str, order: str, xyz: Sequence[str]) -> DataFrame:
    """key, n_pairs, rmsd of points paired by their rank in order, cut to the shorter side."""

    def ranked(df: DataFrame, mark: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
        return df.select(key, rank.alias("_rank"), *[F.col(c).cast("double").alias(f"{mark}{c}") for c in xyz])

    both = ranked(left, "_a").join(ranked(right, "_b"), [key, "_rank"])
    gap = sum(((F.col(f"_a{c}") - F.col(f"_b{c}")) * (F.col(f"_a{c}") - F.col(f"_b{c}")) for c in xyz), F.lit(0.0))
    return both.groupBy(key).agg(F.count("*").cast("long").alias("n_pairs"), F.sqrt(F.avg(gap)).alias("rmsd"))


def kept_of_total(found: DataFrame) -> DataFrame:
    """kept, total of rows with passed."""
    return found.agg(F.count_if("passed").alias("kept"), F.count("*").alias("total"))


def ok_of_total(found: DataFrame) -> DataFrame:
    """ok, total of triplets; in a dry run those with all their files are ok."""
    return found.agg(F.count_if("ok").alias("ok"), F.count("*").alias("total"))
