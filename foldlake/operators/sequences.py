"""Sequence and bond documents: entity sequences, the fallback from coordinates, disulfide bonds, YAML text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.functions.residues import assemble, clean_sequence, one_letter_modified
from foldlake.functions.text import comma_list, sequence_number
from foldlake.operators.catalogue import first_rows
from foldlake.operators.chains import first_model


def from_entities(entity_poly: DataFrame) -> DataFrame:
    """structure_id, entity_rank, chains, sequence, poly_type of each entity with a sequence, in the file's order."""
    number = F.coalesce(F.col("entity_id").try_cast("int"), F.lit(2**31 - 1))
    df = entity_poly.select("structure_id", "entity_id", "poly_type", comma_list("strand_ids").alias("chains"), clean_sequence("seq_raw").alias("sequence"), number.alias("_n"))
    rank = F.row_number().over(_by("structure_id").orderBy("_n", "entity_id")) - 1
    return df.where("sequence <> ''").withColumn("entity_rank", rank.cast("int")).drop("_n", "entity_id")


def _by(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def from_coordinates(atoms: DataFrame) -> DataFrame:
    """The same columns from the residues of the first model, a chain an entity; names that have no letter are left out."""
    rows = first_model(atoms).select("structure_id", F.col("auth_asym_id").alias("chain"), F.col("auth_seq_id").try_cast("int").alias("number"), "label_comp_id", "atom_serial")
    each = first_rows(rows.where("number IS NOT NULL"), ["structure_id", "chain", "number"], ["atom_serial"])
    each = each.withColumn("letter", one_letter_modified("label_comp_id")).where("letter IS NOT NULL")
    out = each.groupBy("structure_id", "chain").agg(assemble("number", "letter", "atom_serial").alias("sequence"))
    rank = F.row_number().over(_by("structure_id").orderBy("chain")) - 1
    out = out.withColumn("entity_rank", rank.cast("int")).withColumn("chains", F.array("chain")).withColumn("poly_type", F.lit("polypeptide(L)"))
    return out.select("structure_id", "poly_type", "chains", "sequence", "entity_rank")


def sequences(entity_poly: DataFrame, atoms: DataFrame) -> DataFrame:
    """Entity sequences; for structures without any, those of their coordinates."""
    own = from_entities(entity_poly)
    rest = atoms.join(own.select("structure_id").distinct(), "structure_id", "left_anti")
    return own.unionByName(from_coordinates(rest))


def disulfides(struct_conn: DataFrame) -> DataFrame:
    """structure_id, chain1, seq1, chain2, seq2 of connections of type disulf with two numbers of digits only."""
    df = struct_conn.where(F.lower("conn_type_id") == "disulf")
    df = df.where(F.col("ptnr1_label_seq_id").rlike("^[0-9]+$") & F.col("ptnr2_label_seq_id").rlike("^[0-9]+$"))
    number = [F.col(f"ptnr{i}_label_seq_id").try_cast("int").alias(f"seq{i}") for i in (1, 2)]
    return df.select("structure_id", F.col("ptnr1_label_asym_id").alias("chain1"), number[0], F.col("ptnr2_label_asym_id").alias("chain2"), number[1])


def residue_index(atoms: DataFrame) -> DataFrame:
    """structure_id, chain, seq, index: 0-based index of each numbered residue of a label chain."""
    df = atoms.select("structure_id", F.col("label_asym_id").alias("chain"), F.col("label_seq_id").try_cast("int").alias("seq"), sequence_number("label_seq_id").alias("index"))
    return df.where("index IS NOT NULL").dropDuplicates(["structure_id", "chain", "seq"])


def bonds(conn: DataFrame, index: DataFrame, seqs: DataFrame) -> DataFrame:
    """structure_id, entity_rank, i, j of disulfide bonds inside one entity; ends that no index or chain has are dropped."""
    chains = seqs.select("structure_id", F.explode("chains").alias("chain"), "entity_rank")
    chains = first_rows(chains, ["structure_id", "chain"], ["entity_rank"])
    out = conn
    for k in (1, 2):
        ends = index.join(chains, ["structure_id", "chain"])
        ends = ends.select("structure_id", F.col("chain").alias(f"chain{k}"), F.col("seq").alias(f"seq{k}"), F.col("index").alias(f"i{k}"), F.col("entity_rank").alias(f"e{k}"))
        out = out.join(ends, ["structure_id", f"chain{k}", f"seq{k}"])
    out = out.where("e1 = e2").select("structure_id", F.col("e1").alias("entity_rank"), F.col("i1").alias("i"), F.col("i2").alias("j"))
    return out.distinct()


def documents(seqs: DataFrame, bond_rows: DataFrame) -> DataFrame:
    """structure_id, document: struct<version, sequences, bonds> of polypeptides; bonds is null where there are none."""
    kept = seqs.where(F.lower("poly_type").contains("polypeptide"))
    entry = F.struct(F.struct(F.array_join("chains", ",").alias("id"), "sequence").alias("protein"))
    listed = kept.groupBy("structure_id").agg(F.array_sort(F.collect_list(F.struct("entity_rank", entry.alias("e")))).alias("s"))
    tied = bond_rows.groupBy("structure_id").agg(F.array_sort(F.collect_list(F.array("entity_rank", "i", "j"))).alias("b"))
    both = listed.join(tied, "structure_id", "left")
    pairs = F.transform("b", lambda x: F.slice(x, 2, 2))
    return both.select("structure_id", F.struct(F.lit(1).alias("version"), F.transform("s", lambda x: x["e"]).alias("sequences"), pairs.alias("bonds")).alias("document"))


def yaml_text(docs: DataFrame) -> DataFrame:
    """structure_id, yaml: the document as block-style YAML in the order of its fields; texts are quoted."""

    def quoted(c):
        return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))

    def item(e):
        return F.concat(F.lit("- protein:\n    id: "), quoted(e["protein"]["id"]), F.lit("\n    sequence: "), quoted(e["protein"]["sequence"]), F.lit("\n"))

    def pair(b):
        return F.concat(F.lit("- - "), b[0].cast("string"), F.lit("\n  - "), b[1].cast("string"), F.lit("\n"))

    head = F.concat(F.lit("version: "), F.col("document.version").cast("string"), F.lit("\nsequences:\n"))
    body = F.array_join(F.transform("document.sequences", item), "")
    tail = F.when(F.size("document.bonds") > 0, F.concat(F.lit("bonds:\n"), F.array_join(F.transform("document.bonds", pair), ""))).otherwise("")
    return docs.select("structure_id", F.concat(head, body, tail).alias("yaml"))
