"""The dataset build as one plan: filter, deduplicate, resolve counterparts, status, pairs and summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldlake.functions.alignment import lcs_identity
from foldlake.functions.text import chain_list, first_chain, first_spaced, number_or_null, or_default, sanitize
from foldlake.operators import catalogue, lookup, summary

HUMAN, MOUSE = 9606, 10090


@dataclass(frozen=True)
class Options:
    resolution: float = 2.5
    identity: float = 50.0
    limit: int | None = None
    dry_run: bool = False
    use_catalogue_mice: bool = True
    exact_hits: int = 5
    broad_hits: int = 10


def complexes(df: DataFrame, options: Options) -> DataFrame:
    """The filtered, unique complexes in input order, up to the limit."""
    kept = catalogue.keep_all(df, catalogue.complex_conditions(df, options.resolution))
    return catalogue.head(catalogue.unique_complexes(kept), options.limit, ["ordinal"])


def mouse_candidates(df: DataFrame, wanted: DataFrame, options: Options) -> DataFrame:
    """For each antigen name of wanted: the best mouse complex with that name, else with a name that holds it. The
    resolution is tested after the choice of the tier."""
    mice = df.where(F.coalesce(F.col("antigen_species").rlike("(?i)mus musculus|mouse"), F.lit(False)))
    mice = mice.select(F.col("pdb").alias("m_pdb"), F.col("antigen_chain").alias("m_chains"), F.col("antigen_name").alias("m_name"), "Hchain", "Lchain", F.col("resolution").alias("m_resolution"), F.col("ordinal").alias("m_ordinal"))
    names = wanted.select("antigen_name").where("antigen_name IS NOT NULL").distinct()
    found = lookup.tiered(names, mice, "antigen_name", "m_name")
    number = number_or_null("m_resolution")
    found = found.where(number <= options.resolution)
    complete = catalogue.present("Hchain") & catalogue.present("Lchain")
    best = catalogue.best_candidates(found, ["antigen_name"], complete, number, ["m_ordinal"])
    return best.select("antigen_name", F.col("m_pdb").alias("sabdab_pdb"), first_spaced("m_chains").alias("sabdab_chain"), F.col("m_name").alias("sabdab_name"), "tier")


def orthologs(proteins: DataFrame, options: Options) -> DataFrame:
    """For each human protein: the first reviewed mouse protein of its gene, of the first exact_hits ones; else the most
    identical one of the first broad_hits whose gene matches in any case or holds it. Hits are in order of hit_rank (if
    proteins has it) and accession. Genes meet by pieces of their names; sequences travel with the hits only."""
    ranked = proteins if "hit_rank" in proteins.columns else proteins.withColumn("hit_rank", F.lit(None).cast("int"))
    own = ranked.where((F.col("taxon_id") == HUMAN) & (F.col("gene_name") != "")).select(F.col("accession").alias("uniprot"), "gene_name", F.col("sequence").alias("own"))
    mice = ranked.where(F.col("taxon_id") == MOUSE).select(F.col("accession").alias("ortholog"), F.col("gene_name").alias("mouse_gene"), F.col("sequence").alias("other"), "reviewed", "hit_rank")
    order = [F.col("hit_rank").asc_nulls_last(), "ortholog"]
    names = mice.select("ortholog", "mouse_gene", "reviewed", "hit_rank").withColumn("_low", F.lower("mouse_gene"))
    genes = own.select("uniprot", "gene_name")

    def hits(found: DataFrame, most: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("uniprot").orderBy(*order))
        few = found.withColumn("_hit", rank).where(F.col("_hit") <= most).select("uniprot", "ortholog", "hit_rank")
        return few.join(own, "uniprot").join(mice.drop("hit_rank"), "ortholog").withColumn("identity", lcs_identity("own", "other"))

    exact = genes.join(names.where("reviewed"), F.col("gene_name") == F.col("mouse_gene"))
    rest = genes.join(exact.select("uniprot").distinct(), "uniprot", "left_anti").withColumn("_key", F.lower("gene_name"))
    held = lookup.holding(rest, names, "_key", "_low")
    broad = rest.join(held, "_key").join(names, "_low")
    both = lookup.fallback(own, hits(exact, options.exact_hits), hits(broad, options.broad_hits), "uniprot", "identity", order)
    return both.select("uniprot", "ortholog", "mouse_gene", "identity")


def data_points(df: DataFrame, chain_map: DataFrame, proteins: DataFrame, structures: DataFrame, chains: DataFrame, options: Options) -> DataFrame:
    """A row for each unique complex with its counterpart, status and message; a null antigen name takes no catalogue match.

    The mouse gene is that of the branch taken: the antigen name of a catalogue match, else the ortholog's gene. A row that
    fails before a structure is chosen has no mouse entry, chain, source and gene; of its ortholog only the accession stays.
    """
    kept = complexes(df, options)
    rows = kept.withColumn("chain", first_chain("antigen_chain")).withColumn("pdb", F.lower("pdb"))
    mapped = chain_map.select("pdb", "chain", F.col("accession").alias("uniprot"), "rank")
    rows = lookup.first_match(rows, mapped, ["pdb", "chain"], ["rank"]).drop("rank")
    info = proteins.select(F.col("accession").alias("uniprot"), F.col("protein_name").alias("protein_name_found"), "gene_name")
    rows = rows.join(info, "uniprot", "left")
    if options.use_catalogue_mice:
        rows = rows.join(mouse_candidates(df, kept, options), "antigen_name", "left")
    else:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("sabdab_pdb", "sabdab_chain", "sabdab_name")}).withColumn("tier", F.lit(None).cast("int"))
    rows = rows.join(orthologs(proteins, options), "uniprot", "left")
    hits = structures.select(F.col("accession").alias("ortholog"), F.col("pdb").alias("structure_pdb"), "entity", "rank")
    rows = lookup.first_match(rows, hits, ["ortholog"], ["rank"]).drop("rank")
    first = chains.select(F.upper("pdb").alias("structure_pdb"), "entity", F.try_element_at("chains", F.lit(1)).alias("structure_chain"))
    rows = rows.join(first, ["structure_pdb", "entity"], "left").withColumn("structure_chain", or_default("structure_chain", "A"))
    sides = {"pdb_id_mouse": ("sabdab_pdb", "structure_pdb"), "mouse_antigen_chain": ("sabdab_chain", "structure_chain"), "mouse_gene_name": ("sabdab_name", "mouse_gene")}
    rows = lookup.prefer(rows, sides, "sabdab_pdb", ("SAbDab", "RCSB")).withColumnRenamed("source", "mouse_structure_source")
    state, message = lookup.complex_status(options.identity, options.dry_run)
    own = F.col("sabdab_pdb").isNotNull()
    rows = rows.withColumn("status", state).withColumn("error_message", message)
    chosen = F.col("status") != "failed"
    rows = rows.withColumns({c: F.when(chosen, F.col(c)) for c in (*sides, "mouse_structure_source")})
    return rows.select(
        F.concat(F.lit("DP_"), "pdb", F.lit("_"), "chain").alias("id"),
        F.col("pdb").alias("pdb_id_human"),
        "pdb_id_mouse",
        F.col("chain").alias("human_antigen_chain"),
        chain_list("antigen_chain").alias("human_antigen_chains"),
        "mouse_antigen_chain",
        F.col("Hchain").alias("heavy_chain"),
        F.col("Lchain").alias("light_chain"),
        F.col("uniprot").alias("human_uniprot"),
        F.when(~own, F.col("ortholog")).alias("mouse_uniprot"),
        "gene_name",
        F.col("protein_name_found").alias("protein_name"),
        F.when(own, F.when(chosen, 100.0)).otherwise(F.col("identity")).alias("sequence_identity"),
        "status",
        "error_message",
        "mouse_structure_source",
        "mouse_gene_name",
        "ordinal",
    )


def pair_name():
    """The name of a point's pair, safe for files."""
    return F.concat_ws("_", sanitize("gene_name", "Human"), sanitize("mouse_gene_name", "Mouse"))


def antigen_chains():
    """All antigen chains of a point; the first one where there is no list."""
    many = F.col("human_antigen_chains")
    return F.when(F.size(many) > 0, many).otherwise(F.array("human_antigen_chain"))


def point_key():
    """The name of a point's own files: its id and its other antigen chains, as complexes of one entry may share an id."""
    return sanitize(F.array_join(F.concat(F.array("id"), F.slice(antigen_chains(), 2, F.size(antigen_chains()))), "_"), "DP", 120)


def pair_folder():
    """The folder of a point's pair files: a folder for each success below that of its pair of genes."""
    return F.concat(F.lit("HumanMouse/"), pair_name(), F.lit("/"), point_key())


#: Columns of a data point, in the order of the summary table.
FIELDS = (
    "id pdb_id_human pdb_id_mouse human_antigen_chain mouse_antigen_chain heavy_chain light_chain human_uniprot mouse_uniprot"
    " gene_name protein_name sequence_identity resolution_human resolution_mouse alignment_rmsd status error_message created_at"
    " human_antigen_chains epitope_identity epitope_rmsd epitope_consistent mouse_structure_source mouse_gene_name"
).split()


def pairs(points: DataFrame) -> DataFrame:
    """The pairs table, a row for each success: names made safe for files, the parts of each side with the files that the
    structure phases write, the measures. Measures that points lacks (alignment_rmsd, epitope_*) are null."""
    kinds = {"alignment_rmsd": "double", "epitope_identity": "double", "epitope_rmsd": "double", "epitope_consistent": "boolean"}
    for name, kind in kinds.items():
        if name not in points.columns:
            points = points.withColumn(name, F.lit(None).cast(kind))
    split = F.concat(F.lit("SAbDab/{0}/"), point_key(), F.lit("_{0}.cif"))

    def part(name: str):
        return F.replace(split, F.lit("{0}"), F.lit(name))

    columns = {
        "pair_dir": pair_folder(),
        "human_antigen_pdb": F.col("pdb_id_human"),
        "human_antigen_chains": F.array_join(antigen_chains(), ","),
        "human_antigen_gene": F.col("gene_name"),
        "human_antigen_uniprot": F.col("human_uniprot"),
        "human_antigen_name": F.col("protein_name"),
        "human_antigen_file": part("antigen"),
        "mouse_antigen_pdb": F.col("pdb_id_mouse"),
        "mouse_antigen_chain": F.col("mouse_antigen_chain"),
        "mouse_antigen_gene": F.col("mouse_gene_name"),
        "mouse_antigen_uniprot": F.col("mouse_uniprot"),
        "mouse_antigen_source": F.col("mouse_structure_source"),
        "mouse_antigen_file": F.concat(F.lit("MouseAntigen/"), sanitize("mouse_gene_name", "Mouse"), F.lit(".cif")),
        "antibody_pdb": F.col("pdb_id_human"),
        "antibody_heavy_chain": F.col("heavy_chain"),
        "antibody_light_chain": F.col("light_chain"),
        "antibody_file": part("antibody"),
    }
    ok = points.where("status = 'success'").withColumn("pair_name", pair_name())
    return ok.select("pair_name", *[c.alias(n) for n, c in columns.items()], "sequence_identity", *kinds)


def library(points: DataFrame) -> DataFrame:
    """The success with the least rmsd of each mouse gene."""
    return summary.best_of_gene(points.where("status = 'success'"), "mouse_gene_name", "alignment_rmsd", ["ordinal"])
