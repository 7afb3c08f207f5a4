"""The structure phases of the build: superpose each pair, judge its epitope, and the files, metadata, library and log.

Structure files are staged below a folder, named by their entry. Each is parsed once, into a table of atoms
(structures.stage), and a pair's atoms meet once, in operators.pairs. Only the texts that are written carry whole files.
Every success has files of its own, in folders named by its point; the file of an entry as it is serves all its points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldlake.functions.superpose import superpose
from foldlake.functions.text import sanitize
from foldlake.operators import chains, epitopes, pairs, summary
from foldlake.plans.build import FIELDS, antigen_chains, pair_folder, pair_name, point_key
from foldlake.sources import sinks, structures

#: Files made of one entry that are made together, about.
JOBS_AT_ONCE = 64


def by_entry(found: DataFrame) -> DataFrame:
    """Files (path, content) with structure_id, the entry in lower case; of an entry's files the mmCIF one. Which file it is
    comes from the paths alone; contents are not aggregated."""
    df = structures._keyed(found).withColumn("structure_id", F.lower("structure_id"))
    best = F.min(F.struct(~F.lower("path").rlike(r"\.(cif|mmcif)$"), "path"))
    chosen = df.groupBy("structure_id").agg(best["path"].alias("path"))
    return df.join(chosen, ["structure_id", "path"]).select("structure_id", "path", "content")


def antibody_chains() -> Column:
    """The chains of a point's antibody: heavy, then light, without those that are missing or marked NA."""
    return F.filter(F.array("heavy_chain", "light_chain"), lambda c: c.isNotNull() & ~c.isin("", "NA"))


def complex_chains() -> Column:
    """Antibody chains, then antigen chains."""
    return F.concat(antibody_chains(), antigen_chains())


def _side(points: DataFrame, atoms: DataFrame, entry: str, kept: Column) -> DataFrame:
    """The atoms of each point's chains, keyed by the point's id as structure_id."""
    wanted = points.select("id", F.lower(entry).alias("_entry"), F.explode(F.array_distinct(kept)).alias("auth_asym_id"))
    both = wanted.join(atoms.withColumnRenamed("structure_id", "_entry"), ["_entry", "auth_asym_id"])
    return both.withColumnRenamed("id", "structure_id").select(*atoms.columns)


def _parts(points: DataFrame) -> DataFrame:
    """id (the point's key), structure_id, auth_asym_id, roles: the chains that each point needs, and what its atoms are
    taken for there."""
    human, mouse = F.lower("pdb_id_human"), F.lower("pdb_id_mouse")

    def part(entry: Column, names: Column, role: int) -> Column:
        return F.transform(names, lambda c: F.struct(entry.alias("structure_id"), c.alias("auth_asym_id"), F.lit(role).alias("role")))

    sides = [
        part(human, F.array("human_antigen_chain"), pairs.REFERENCE),
        part(human, antigen_chains(), pairs.ANTIGEN),
        part(human, antibody_chains(), pairs.ANTIBODY),
        part(mouse, F.array("mouse_antigen_chain"), pairs.OTHER),
    ]
    rows = points.select(point_key().alias("id"), F.explode(F.concat(*sides)).alias("p")).select("id", "p.*")
    return rows.groupBy("id", "structure_id", "auth_asym_id").agg(F.bit_or("role").alias("roles"))


def process(
    points: DataFrame, parsed: DataFrame, distance: float = 5.0, identity: float = 80.0, rmsd: float = 1.5, cycles: int = 0, cutoff: float = 2.0
) -> tuple[DataFrame, DataFrame]:
    """points with alignment_rmsd, resolutions, epitope_identity, epitope_rmsd, epitope_consistent and created_at, and the
    measures of each pair (n_pairs, n_kept, rotation, shift and more), with the motion of its mouse structure, under the
    point's key as id.

    parsed holds the atoms of the files of by_entry(), as structures.stage() writes them. A success whose files are missing
    or hold no atoms, or whose chains have fewer than three residues in common, fails with a message; all other rows stay as
    they are. With cycles, superposition rejects outliers beyond cutoff times the rmsd.
    """
    good = points.where("status = 'success'")
    both = parsed.where("error IS NULL").join(_parts(good), ["structure_id", "auth_asym_id"])
    measured = pairs.measures(both, distance, identity, rmsd, cycles, cutoff).where("alignment_rmsd IS NOT NULL")
    full = F.count_if(F.col("error").isNull()) > 0
    entries = parsed.groupBy("structure_id").agg(F.max("resolution").alias("ls_d_res_high"), F.when(full, F.lit(True)).alias("has_atoms"))
    out = points
    for side in ("human", "mouse"):
        own = entries.select(F.col("structure_id").alias(f"_{side}"), F.col("ls_d_res_high").alias(f"resolution_{side}"), F.lit(True).alias(f"_file_{side}"), F.col("has_atoms").alias(f"_atoms_{side}"))
        out = out.join(own, F.lower(f"pdb_id_{side}") == F.col(f"_{side}"), "left")
    own = measured.select(F.col("id").alias("_key"), "alignment_rmsd", "epitope_identity", "epitope_rmsd", "epitope_consistent")
    out = out.withColumn("_key", point_key()).join(own, "_key", "left").drop("_key")
    message = F.when(F.col("alignment_rmsd").isNull(), "Could not align sequences")
    for test, text in (("_atoms", "Could not parse structures"), ("_file", "Could not download structure for ")):
        for side in ("mouse", "human"):
            said = F.concat(F.lit(text), F.col(f"pdb_id_{side}")) if test == "_file" else F.lit(text)
            message = F.when(F.col(f"{test}_{side}").isNull(), said).otherwise(message)
    wrong = (F.col("status") == "success") & message.isNotNull()
    out = out.withColumn("error_message", F.when(wrong, F.concat(F.lit("Structure processing error: "), message)).otherwise(F.col("error_message")))
    out = out.withColumn("status", F.when(wrong, "failed").otherwise(F.col("status")))
    kept = [c for c in points.columns if c not in FIELDS]
    out = out.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return out.select(*FIELDS, *kept), measured


def _moved(points: DataFrame, motions: DataFrame) -> DataFrame:
    """The successes with the rotation and shift that motions hold under their keys."""
    turns = motions.select(F.col("id").alias("_key"), "rotation", "shift")
    return points.where("status = 'success'").withColumn("_key", point_key()).join(turns, "_key").drop("_key")


def jobs(points: DataFrame, motions: DataFrame) -> DataFrame:
    """name (the file below the output folder), entry, chains, rotation, shift, hetero: a row for each mmCIF file of the
    successes. Files of a point bear its key; that of an entry as it is comes once."""
    rows = _moved(points, motions)
    human, mouse = F.lower("pdb_id_human"), F.lower("pdb_id_mouse")
    none = F.lit(None).cast("array<double>")
    pair, key = pair_folder(), point_key()

    def file(name: Column, entry: Column, kept: Column, move: bool = False, hetero: bool = True) -> Column:
        turn = (F.col("rotation"), F.col("shift")) if move else (none, none)
        return F.struct(name.alias("name"), entry.alias("entry"), kept.alias("chains"), turn[0].alias("rotation"), turn[1].alias("shift"), F.lit(hetero).alias("hetero"))

    files = [
        file(F.concat(F.lit("SAbDab/raw/"), F.col("pdb_id_human"), F.lit(".cif")), human, F.array().cast("array<string>")),
        file(F.concat(F.lit("SAbDab/raw/"), F.col("pdb_id_mouse"), F.lit(".cif")), mouse, F.array().cast("array<string>")),
        file(F.concat(F.lit("SAbDab/cleaned/"), key, F.lit(".cif")), human, complex_chains(), hetero=False),
        file(F.concat(F.lit("SAbDab/antibody/"), key, F.lit("_antibody.cif")), human, antibody_chains()),
        file(F.concat(F.lit("SAbDab/antigen/"), key, F.lit("_antigen.cif")), human, antigen_chains()),
        file(F.concat(pair, F.lit("/human_ag.cif")), human, antigen_chains()),
        file(F.concat(pair, F.lit("/mouse_ag_aligned.cif")), mouse, F.array("mouse_antigen_chain"), move=True),
    ]
    each = rows.select("ordinal", F.explode(F.array(*files)).alias("j")).groupBy("j.name").agg(F.min_by("j", "ordinal").alias("j"))
    return each.select("j.*").unionByName(library_jobs(points, motions))


def library_jobs(points: DataFrame, motions: DataFrame) -> DataFrame:
    """The jobs of the library: for each mouse gene the aligned structure of its success with the least rmsd."""
    best = summary.best_of_gene(_moved(points, motions), "mouse_gene_name", "alignment_rmsd", ["ordinal"])
    name = F.concat(F.lit("MouseAntigen/"), sanitize("mouse_gene_name", "Mouse"), F.lit(".cif"))
    rows = best.select(name.alias("name"), F.lower("pdb_id_mouse").alias("entry"), F.array("mouse_antigen_chain").alias("chains"), "rotation", "shift", F.lit(True).alias("hetero"), "ordinal")
    return rows.groupBy("name").agg(F.min_by(F.struct("entry", "chains", "rotation", "shift", "hetero"), "ordinal").alias("j")).select("name", "j.*")


def texts(work: DataFrame, files: DataFrame) -> DataFrame:
    """name, text of the mmCIF files that jobs ask for. An entry's jobs come together, about JOBS_AT_ONCE of them, so that its
    file is sent and parsed once for them."""
    blocks = work.groupBy("entry").agg(F.ceil(F.count("*") / JOBS_AT_ONCE).alias("_blocks"))
    asked = F.struct("name", "chains", "rotation", "shift", "hetero")
    rows = work.join(blocks, "entry").withColumn("_block", F.pmod(F.xxhash64("name"), F.col("_blocks")))
    jobs_of = rows.groupBy("entry", "_block").agg(F.collect_list(asked).alias("jobs"))
    return structures.many_cif_texts(files.withColumnRenamed("structure_id", "entry").join(jobs_of, "entry"))


def pdb_texts(points: DataFrame, motions: DataFrame, parsed: DataFrame) -> DataFrame:
    """name, text of the aligned mouse chains in the PDB format, a file for each success."""
    good = _moved(points, motions).withColumn("_name", F.concat(pair_folder(), F.lit("/mouse_ag_aligned.pdb")))
    atoms = parsed.where("error IS NULL AND label_comp_id <> 'HOH'")
    named = good.select(F.col("_name").alias("id"), "pdb_id_mouse", "mouse_antigen_chain")
    turned = good.select(F.col("_name").alias("structure_id"), "rotation", "shift")
    moved = chains.move(_side(named, atoms, "pdb_id_mouse", F.array("mouse_antigen_chain")), turned)
    return sinks.structure_files(moved).select(F.col("structure_id").alias("name"), "text")


def metadata(points: DataFrame) -> DataFrame:
    """name, text: the JSON of each success."""
    columns = {
        "pair_name": pair_name(),
        "pdb_id_human": F.col("pdb_id_human"),
        "pdb_id_mouse": F.col("pdb_id_mouse"),
        "human_antigen_chains": antigen_chains(),
        "mouse_antigen_chain": F.col("mouse_antigen_chain"),
        "antibody_heavy_chain": F.col("heavy_chain"),
        "antibody_light_chain": F.col("light_chain"),
        "human_uniprot": F.col("human_uniprot"),
        "mouse_uniprot": F.col("mouse_uniprot"),
        "human_gene_name": F.col("gene_name"),
        "mouse_gene_name": F.col("mouse_gene_name"),
        "alignment_rmsd": F.col("alignment_rmsd"),
        "mouse_structure_source": F.col("mouse_structure_source"),
        "files": F.struct(F.lit("human_ag.cif").alias("human_ag"), F.lit("mouse_ag_aligned.cif").alias("mouse_ag_aligned")),
    }
    whole = F.struct(*[c.alias(n) for n, c in columns.items()])
    text = F.to_json(whole, {"ignoreNullFields": "false", "pretty": "true"})
    return points.where("status = 'success'").select(F.concat(pair_folder(), F.lit("/metadata.json")).alias("name"), text.alias("text"))


def by_gene(points: DataFrame) -> DataFrame:
    """mouse_gene_name and the ids of its successes, in input order."""
    rows = points.where("status = 'success' AND mouse_gene_name <> ''")
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "id")))
    return rows.groupBy("mouse_gene_name").agg(F.transform(listed, lambda x: x["id"]).alias("ids"))


def log(points: DataFrame) -> DataFrame:
    """timestamp, level, message: a row for each point."""
    failed = F.col("status") == "failed"
    said = F.when(failed, F.concat(F.col("id"), F.lit(": "), F.col("error_message"))).otherwise(F.concat(F.col("id"), F.lit(": "), F.col("status")))
    return points.select(F.col("created_at").alias("timestamp"), F.when(failed, "ERROR").otherwise("INFO").alias("level"), said.alias("message"))


def write(points: DataFrame, motions: DataFrame, files: DataFrame, parsed: DataFrame, out: str) -> DataFrame:
    """Writes all files of the successes below out; returns their names and paths."""
    every = texts(jobs(points, motions), files).unionByName(pdb_texts(points, motions, parsed)).unionByName(metadata(points))
    return sinks.write_texts(every, out, "name", "text")


def align_triplets(rows: DataFrame, files: DataFrame, cycles: int = 0, cutoff: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """The complete triplets of rows with rmsd and ok, and name and text of their three files each.

    rows have triplet_name, the paths of three files, human_antigen_chains (the first is aligned to) and
    mouse_antigen_chain; files (structure_id, path, content) are keyed by those paths. The mouse antigen is moved onto the
    human one, with rejection of outliers if cycles are given; a triplet whose chains do not align is not ok and has no files.
    """
    first = F.coalesce(F.nullif(F.trim(F.split("human_antigen_chains", ",")[0]), F.lit("")), F.lit("A"))
    good = rows.where("complete").select(
        F.col("triplet_name").alias("id"), "human_antigen_file", "mouse_antigen_file", "antibody_file",
        first.alias("human_chain"), F.coalesce(F.trim("mouse_antigen_chain"), F.lit("A")).alias("mouse_chain"),
    )
    lower = files.withColumn("structure_id", F.lower("structure_id"))
    atoms = structures.atom_site(lower).where("error IS NULL")
    human = _side(good, atoms, "human_antigen_file", F.array("human_chain"))
    mouse = _side(good, atoms, "mouse_antigen_file", F.array("mouse_chain"))
    fitted = superpose(epitopes.carbon_pairs(human, mouse), "structure_id", cycles, cutoff).where("rmsd IS NOT NULL").withColumnRenamed("structure_id", "id")
    done = good.join(fitted, "id")
    none = F.lit(None).cast("array<double>")
    parts = [("human_antigen", "human_antigen_file", none, none), ("mouse_antigen", "mouse_antigen_file", F.col("rotation"), F.col("shift")), ("antibody", "antibody_file", none, none)]
    each = F.array(*[F.struct(F.concat(F.col("id"), F.lit(f"/{name}.cif")).alias("name"), F.lower(path).alias("entry"), turn.alias("rotation"), to.alias("shift")) for name, path, turn, to in parts])
    work = done.select(F.explode(each).alias("j")).select("j.*").withColumn("chains", F.array().cast("array<string>")).withColumn("hetero", F.lit(True))
    measured = fitted.select(F.col("id").alias("triplet_name"), "rmsd")
    out = rows.join(measured, "triplet_name", "left").withColumn("ok", F.col("complete") & F.col("rmsd").isNotNull())
    return out, texts(work, lower)
