"""The contact filter over folders of antibody and antigen structures, and the triplet export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.operators.contacts import counts_within
from foldlake.operators.summary import contact_verdicts

METADATA = "id string, files struct<antibody_pdb:string,human_ag_pdb:string>"


def folders(found: DataFrame, metadata: DataFrame) -> DataFrame:
    """dp_id, antibody, antigen, reason for each folder name DP_*: found (dp_id, path) lists files, metadata (dp_id, text)
    holds each folder's JSON. reason tells why a folder can't be evaluated, null if it can."""
    all_folders = found.select("dp_id").union(metadata.select("dp_id")).where(F.col("dp_id").startswith("DP_")).distinct()
    parsed = metadata.select("dp_id", "text", F.from_json("text", METADATA).alias("m"))
    names = found.select("dp_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).distinct()
    rows = all_folders.join(parsed, "dp_id", "left").withColumns({"antibody": F.col("m.files.antibody_pdb"), "antigen": F.col("m.files.human_ag_pdb")})
    for side in ("antibody", "antigen"):
        rows = rows.join(names.select("dp_id", F.col("name").alias(side), F.lit(True).alias(f"has_{side}")), ["dp_id", side], "left")
    broken = F.col("m").isNull() | F.coalesce(F.col("m.id").isNull() & F.col("m.files").isNull(), F.lit(False))
    empty = (F.coalesce("antibody", F.lit("")) == "") | (F.coalesce("antigen", F.lit("")) == "")
    reason = (
        F.when(F.col("text").isNull(), "metadata.json not found")
        .when(broken, "metadata load error")
        .when(empty, "missing antibody or antigen file")
        .when(F.col("has_antibody").isNull() | F.col("has_antigen").isNull(), "PDB files not found")
    )
    return rows.select("dp_id", "antibody", "antigen", reason.alias("reason"))


def filter_contacts(rows: DataFrame, antibody: DataFrame, antigen: DataFrame, distance: float = 5.0, least: int = 10) -> DataFrame:
    """id, contact_count, contact_count_full, passed, reason for each folder, from atoms (dp_id, atom_serial, x, y, z)."""
    points = antigen.select("dp_id", F.col("atom_serial"), *[F.col(c).alias(f"g{c}") for c in "xyz"])
    near = antibody.select("dp_id", *[F.col(c).alias(f"b{c}") for c in "xyz"])
    counts = counts_within(points, near, "dp_id", "atom_serial", ("gx", "gy", "gz"), ("bx", "by", "bz"), distance)
    verdicts = contact_verdicts(counts, "dp_id", "atom_serial", least)
    out = rows.join(verdicts, "dp_id", "left")
    good = F.col("reason").isNull()
    count = F.when(good, F.coalesce("contact_count", F.lit(0))).otherwise(0).cast("long")
    full = F.when(good, F.coalesce("contact_count_full", F.lit(0))).otherwise(0).cast("long")
    reason = F.when(~good, F.col("reason")).when(count < least, "no contact").otherwise("")
    return out.select(F.col("dp_id").alias("id"), count.alias("contact_count"), full.alias("contact_count_full"), (good & (count >= least)).alias("passed"), reason.alias("reason"))


def triplets(pairs: DataFrame, existing: DataFrame, files: tuple[str, ...] = ("human_antigen_file", "mouse_antigen_file", "antibody_file")) -> DataFrame:
    """pairs with triplet_name (of both genes and the human entry) and complete: whether every file that the row names is
    in existing (path)."""
    known = existing.select("path").distinct()
    out = pairs.withColumn("complete", F.lit(True))
    for name in files:
        seen = known.select(F.col("path").alias(name), F.lit(True).alias("_seen"))
        out = out.join(seen, name, "left").withColumn("complete", F.col("complete") & F.col("_seen").isNotNull()).drop("_seen")
    parts = ("human_antigen_gene", "mouse_antigen_gene", "human_antigen_pdb")
    named = F.concat_ws("_", *parts) if set(parts) <= set(pairs.columns) else F.concat(F.lit("triplet_"), "pair_name")
    return out.withColumn("triplet_name", named)
