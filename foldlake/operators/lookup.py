"""Lookup joins: first match, tiers, fallbacks, source priority, and the status ladder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldlake.functions.text import fixed
from foldlake.operators.catalogue import first_rows


def first_match(left: DataFrame, right: DataFrame, on: Sequence[str], order: Sequence) -> DataFrame:
    """left joined to the first row of right, in the given order, for each key; rows without match stay. The planner
    broadcasts right if it is small."""
    return left.join(first_rows(right, on, order), list(on), "left")


#: Lengths of the pieces by which names are found that hold a key.
PIECES = (1, 2, 4, 8)


def holding(keys: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """key, name: the distinct pairs in which the name holds the key; empty keys are in none.

    Names are indexed by their pieces, at most one of each length of PIECES for each character. Of a key's pieces of the
    greatest length it reaches the rarest one decides: the key meets the names with that piece. So both sides meet in an
    equi-join, and names that all begin alike are met only by keys that hold nothing rarer. A key with a piece that no name
    has is in none.
    """
    wanted = keys.select(F.col(key).alias("_k")).where("_k <> ''").distinct()
    size = F.lit(0)
    for length in PIECES:
        size = F.when(F.length("_k") >= length, F.lit(length)).otherwise(size)
    own = F.expr("array_distinct(transform(sequence(1, length(_k) - _size + 1), i -> substring(_k, i, _size)))")
    own = wanted.withColumn("_size", size).withColumn("_own", own).select("_k", "_size", F.size("_own").alias("_many"), F.explode("_own").alias("_piece"))
    pieces = [
        F.expr(f"IF(length(_n) >= {x}, transform(sequence(1, length(_n) - {x - 1}), i -> struct({x} AS size, substring(_n, i, {x}) AS piece)), array())")
        for x in PIECES
    ]
    index = names.select(F.col(name).alias("_n")).where("_n <> ''").distinct()
    index = index.select("_n", F.explode(F.array_distinct(F.concat(*pieces))).alias("_p"))
    index = index.select("_n", F.col("_p.size").alias("_size"), F.col("_p.piece").alias("_piece"))
    counted = own.join(index.groupBy("_size", "_piece").agg(F.count("*").alias("_c")), ["_size", "_piece"])
    rarest = counted.groupBy("_k", "_size", "_many").agg(F.count("*").alias("_found"), F.min(F.struct("_c", "_piece")).alias("_r"))
    chosen = rarest.where("_found = _many").select("_k", "_size", F.col("_r._piece").alias("_piece"))
    met = chosen.join(index, ["_size", "_piece"]).where(F.col("_n").contains(F.col("_k")))
    return met.select(F.col("_k").alias(key), F.col("_n").alias(name))


def tiered(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of right for each row of left, with tier: 1 where names are equal, trimmed and in lower case; for rows of
    left without any such match, 2 where the name holds left's key. Empty keys match nothing.

    Both tiers are equi-joins: of whole names, and of pieces of them for the keys that are left over (holding).
    """
    wanted = left.withColumn("_key", F.lower(F.trim(key)))
    named = right.withColumn("_name", F.lower(F.trim(name)))
    exact = wanted.join(named, F.col("_key") == F.col("_name")).withColumn("tier", F.lit(1))
    rest = wanted.join(named.select(F.col("_name").alias("_key")).distinct(), "_key", "left_anti").where("_key <> ''")
    found = holding(rest, named, "_key", "_name").withColumn("tier", F.lit(2))
    partial = rest.join(found, "_key").join(named, "_name").select(exact.columns)
    return exact.unionByName(partial).drop("_key", "_name")


def fallback(left: DataFrame, exact: DataFrame, broad: DataFrame, key: str, score: str, order: Sequence) -> DataFrame:
    """For each key of left: the first row of exact; if exact has none, the row of broad with the highest score above 0,
    first in order among equals. Keys without either are left out. source tells which."""
    first = first_rows(exact, [key], order)
    near = left.select(key).distinct().join(first.select(key), key, "left_anti").join(broad.where(F.col(score) > 0), key)
    near = first_rows(near, [key], [F.col(score).desc(), *order])
    return first.withColumn("source", F.lit("exact")).unionByName(near.withColumn("source", F.lit("broad")))


def prefer(df: DataFrame, columns: dict[str, tuple[str, str]], present: str, names: tuple[str, str]) -> DataFrame:
    """df with each new column taken from its first side where present is not null, else from its second; source names
    the side, null if the second has nothing either."""
    first = F.col(present).isNotNull()
    out = df
    second = None
    for new, (a, b) in columns.items():
        out = out.withColumn(new, F.when(first, F.col(a)).otherwise(F.col(b)))
        second = F.col(b).isNotNull() if second is None else second
    return out.withColumn("source", F.when(first, names[0]).when(second, names[1]))


def status(cases: Sequence[tuple[Column, str, Column | str]], otherwise: str = "success") -> tuple[Column, Column]:
    """Status and message columns of a ladder of (condition, status, message), of which the first that holds decides."""
    state, message = None, None
    for condition, name, text in cases:
        text = F.lit(text) if isinstance(text, str) else text
        state = F.when(condition, name) if state is None else state.when(condition, name)
        message = F.when(condition, text) if message is None else message.when(condition, text)
    return state.otherwise(otherwise), message.otherwise("")


def complex_status(threshold: float, dry_run: bool) -> tuple[Column, Column]:
    """The ladder of the dataset build, over the columns uniprot, protein_name_found, sabdab_pdb, ortholog, identity,
    structure_pdb."""
    own = F.col("sabdab_pdb").isNotNull()
    low = ~own & (F.col("identity") < threshold)
    message = F.concat(F.lit("Sequence identity "), fixed("identity", 1), F.lit(f"% below threshold {float(threshold)}%"))
    # The messages of the build's table.
    cases = [
        (F.col("uniprot").isNull(), "failed", "Could not map antigen chain to UniProt"),
        (F.col("protein_name_found").isNull(), "failed", "Could not retrieve UniProt info"),
        (~own & F.col("ortholog").isNull(), "failed", "No mouse ortholog found"),
        (low, "failed", message),
        (~own & F.col("structure_pdb").isNull(), "failed", "No PDB structure found for mouse ortholog"),
    ]
    return status([*cases, *([(F.lit(True), "dry_run", "")] if dry_run else [])])
