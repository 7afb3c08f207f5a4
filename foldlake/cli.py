"""Command line: build, to-yaml, filter-interactions, triplet. Lookup payloads are staged JSON lines. The catalogue and
missing structure files are fetched if their URLs are given; all else is staged."""

from __future__ import annotations

import argparse
import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.functions.text import component_label
from foldlake.operators import sequences, summary
from foldlake.plans import build, contacts, phases
from foldlake.session import session
from foldlake.sources import catalogue, entries, payloads, sinks, structures


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foldlake", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("build", help="resolve counterparts and write points, pairs and summary")
    p.add_argument("--output", default="./output")
    p.add_argument("--data-dir", default="./data", help="holds catalogue.tsv; proteins, chains, structures, entities as JSON; files, the structures by entry")
    p.add_argument("--url", help="where to fetch the catalogue if it is missing")
    p.add_argument("--structure-url", help="template with {id} and {kind}, from which missing structure files are fetched")
    p.add_argument("--limit", type=int)
    p.add_argument("--resolution", type=float, default=2.5)
    p.add_argument("--identity", type=float, default=50.0)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--force-download", action="store_true")
    p.add_argument("--no-catalogue-mice", action="store_true")
    p.add_argument("--filtered-catalogue", action="store_true", help="write the complexes that pass the filter as CSV, too")
    p.add_argument("--epitope-distance", type=float, default=5.0)
    p.add_argument("--epitope-identity", type=float, default=80.0)
    p.add_argument("--epitope-rmsd", type=float, default=1.5)
    refining(p)
    p = sub.add_parser("to-yaml", help="sequence and bond documents of the CIF files below a folder")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--no-bonds", action="store_true")
    p = sub.add_parser("filter-interactions", help="contact filter over DP_* folders")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--distance-threshold", type=float, default=5.0)
    p.add_argument("--min-contacts", type=int, default=10)
    p.add_argument("--dry-run", action="store_true")
    p = sub.add_parser("triplet", help="align and write the triplets of pairs that have all their files")
    p.add_argument("--data-dir", default="./data", help="holds pairs.csv, or the pairs folder of build, and the files that it names")
    p.add_argument("--output")
    p.add_argument("--dry-run", action="store_true")
    refining(p)
    return top


def refining(p: argparse.ArgumentParser) -> None:
    p.add_argument("--refine-cycles", type=int, default=0, help="how often superposition drops pairs that do not fit; 0: never")
    p.add_argument("--refine-cutoff", type=float, default=2.0, help="pairs farther apart than so many times the rmsd do not fit")


def run_build(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    path = f"{a.data_dir}/catalogue.tsv"
    if a.url:
        catalogue.fetch(a.url, path, a.force_download)
    df = catalogue.read_catalogue(spark, path)

    def lines(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).json(f"{a.data_dir}/{name}")

    options = build.Options(a.resolution, a.identity, a.limit, a.dry_run, not a.no_catalogue_mice)
    if a.filtered_catalogue:
        sinks.write_csv(build.complexes(df, options).drop("ordinal"), f"{a.output}/filtered_catalogue")
    points = build.data_points(
        df,
        payloads.chain_map(lines("chains", "payload string")),
        payloads.proteins(lines("proteins", "payload string, rank int")),
        payloads.structures(lines("structures", "accession string, payload string")),
        payloads.entity_chains(lines("entities", "pdb string, entity string, payload string")),
        options,
    )
    if not a.dry_run:
        points.write.mode("overwrite").parquet(f"{a.output}/resolved")
        resolved = spark.read.parquet(f"{a.output}/resolved")
        staged = f"{a.data_dir}/files"
        if a.structure_url:
            needed = resolved.where("status = 'success'").select(F.explode(F.array("pdb_id_human", "pdb_id_mouse")).alias("structure_id"))
            entries.fetch(needed, folder_uri(staged), a.structure_url).write.mode("overwrite").parquet(f"{a.output}/fetched")
        none = "://" not in staged and not os.path.isdir(staged)
        found = spark.createDataFrame([], "path string, content binary") if none else structures.files(spark, staged)
        files = phases.by_entry(found)
        parsed = structures.stage(files, f"{a.output}/atoms")
        measured = (a.epitope_distance, a.epitope_identity, a.epitope_rmsd, a.refine_cycles, a.refine_cutoff)
        points, motions = phases.process(resolved, parsed, *measured)
        motions.write.mode("overwrite").parquet(f"{a.output}/motions")
    else:
        points = with_fields(points)
    points.write.mode("overwrite").parquet(f"{a.output}/points")
    written = spark.read.parquet(f"{a.output}/points")
    if written.where("status = 'success'").limit(1).count():
        sinks.write_csv(build.pairs(written), f"{a.output}/pairs")
        listed = phases.write(written, spark.read.parquet(f"{a.output}/motions"), files, parsed, folder_uri(a.output))
        listed.write.mode("overwrite").parquet(f"{a.output}/written")
    if written.limit(1).count():
        sinks.write_csv(written.select(*build.FIELDS), f"{a.output}/dataset_summary")
        sinks.write_json(phases.log(written), f"{a.output}/processing_log")
    report = summary.status_summary(written, "status", "sequence_identity", "alignment_rmsd")
    sinks.write_json(report, f"{a.output}/summary")
    return report


def with_fields(points: DataFrame) -> DataFrame:
    """points with all columns of a data point; measures that need structures are null."""
    kinds = dict.fromkeys(("resolution_human", "resolution_mouse", "alignment_rmsd", "epitope_identity", "epitope_rmsd"), "double")
    out = points.withColumns({c: F.lit(None).cast(k) for c, k in (kinds | {"epitope_consistent": "boolean"}).items()})
    return out.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def folder_uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def run_yaml(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Writes a YAML file for each CIF file, under its own name, or with its folder before it where several folders have a
    file of that name; returns and writes how each file of each folder went."""
    found = structures.relative_id(structures.files(spark, a.input, "*.cif"), os.path.abspath(a.input))
    atoms = structures.atom_site(found)
    good = atoms.where("error IS NULL")
    seqs = sequences.sequences(structures.entity_poly(found), good)
    bonds = sequences.bonds(sequences.disulfides(structures.struct_conn(found)), sequences.residue_index(good), seqs)
    docs = sequences.yaml_text(sequences.documents(seqs, bonds.limit(0) if a.no_bonds else bonds))
    names = found.select("structure_id", F.regexp_extract("structure_id", r"([^/]*)$", 1).alias("stem"))
    alone = names.groupBy("stem").agg((F.count("*") == 1).alias("alone"))
    names = names.join(alone, "stem").withColumn("name", F.when(F.col("alone"), F.col("stem")).otherwise(F.replace("structure_id", F.lit("/"), F.lit("_"))))
    work = docs.join(names, "structure_id").select("name", "yaml")
    sinks.write_texts(work, folder_uri(a.output), "name", "yaml", ".yaml").write.mode("overwrite").parquet(f"{a.output}/_written")
    paths = spark.read.parquet(f"{a.output}/_written")
    errors = atoms.where("error IS NOT NULL").select("structure_id", "error").distinct()
    each = names.join(paths, "name", "left").join(errors, "structure_id", "left")
    label = component_label(F.concat("stem", F.lit(".cif")))
    label = F.when(label == "human_ag", "human_antigen").when(label == "mouse_ag", "mouse_antigen").otherwise(label)
    failed = F.concat(F.lit("ERROR: "), F.coalesce("error", F.lit("no sequence")))
    each = each.select(
        F.regexp_extract("structure_id", r"^(.*?)/?[^/]*$", 1).alias("folder"), label.alias("component"), "stem",
        F.coalesce("path", failed).alias("result"), F.col("path").isNotNull().alias("converted"),
    )
    entry = F.struct(F.when(F.col("converted"), F.col("component")).otherwise(F.col("stem")).alias("key"), F.col("result").alias("value"))
    report = each.groupBy("folder").agg(F.map_from_entries(F.array_sort(F.collect_set(entry))).alias("results"), F.count_if("converted").alias("converted"))
    with_last_key_wins(spark, lambda: sinks.write_json(report, f"{a.output}/conversion_summary"))
    return spark.read.schema(report.schema).json(f"{a.output}/conversion_summary")


def with_last_key_wins(spark: SparkSession, run) -> None:
    """Runs with maps whose later entries replace earlier ones of the same key: two files may stand for one component."""
    key = "spark.sql.mapKeyDedupPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, "LAST_WIN")
    try:
        run()
    finally:
        spark.conf.set(key, before)


def run_filter(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if not a.dry_run and os.path.abspath(a.input) == os.path.abspath(a.output):
        raise SystemExit("input and output must differ")
    base = os.path.abspath(a.input)
    found = structures.files(spark, a.input)
    below = F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/"), F.lit("^" + re.escape(base + "/")), F.lit(""))
    listed = found.select(F.regexp_extract(below, r"^(DP_[^/]+)/", 1).alias("dp_id"), below.alias("below"), "path", "content").where("dp_id <> ''")
    own = listed.where("below = concat(dp_id, '/', regexp_extract(below, '([^/]+)$', 1))")
    metadata = own.where("below LIKE '%/metadata.json'").select("dp_id", F.col("content").cast("string").alias("text"))
    rows = contacts.folders(own.select("dp_id", "path"), metadata)
    pdbs = own.where("below LIKE '%.pdb'").select("path", "content", F.col("below").alias("structure_id"))
    atoms = structures.atom_site(pdbs).where("error IS NULL")

    def side(column: str) -> DataFrame:
        wanted = rows.where("reason IS NULL").select("dp_id", F.concat("dp_id", F.lit("/"), F.col(column)).alias("structure_id"))
        return atoms.join(wanted, "structure_id").select("dp_id", "atom_serial", "x", "y", "z")

    out = contacts.filter_contacts(rows, side("antibody"), side("antigen"), a.distance_threshold, a.min_contacts)
    if not a.dry_run:
        sinks.write_csv(out.orderBy("id"), f"{a.output}/filter_summary")
        out = spark.read.option("header", True).schema(out.schema).csv(f"{a.output}/filter_summary").fillna("", ["reason"])
        passed = listed.join(out.where("passed").select(F.col("id").alias("dp_id")), "dp_id", "left_semi")
        sinks.write_texts(passed, folder_uri(a.output), "below", "content").write.format("noop").mode("overwrite").save()
    return out


def run_triplet(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    at = next((p for p in (f"{a.data_dir}/pairs.csv", f"{a.data_dir}/pairs") if os.path.exists(p)), f"{a.data_dir}/pairs.csv")
    pairs = spark.read.option("header", True).csv(at)
    base = os.path.abspath(a.data_dir)
    found = structures.files(spark, a.data_dir)
    found = found.withColumn("path", F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/"), F.lit("^" + re.escape(base + "/")), F.lit("")))
    out = contacts.triplets(pairs, found.select("path"))
    to = a.output or f"{a.data_dir}/HumanMouseAntigenAntibody"
    if a.dry_run:
        out = out.withColumn("ok", F.col("complete"))
        sinks.write_json(summary.ok_of_total(out), f"{to}/triplet_summary")
        return out
    if "mouse_antigen_chain" not in pairs.columns:
        out = out.withColumn("mouse_antigen_chain", F.lit("A"))
    if "human_antigen_chains" not in pairs.columns:
        out = out.withColumn("human_antigen_chains", F.lit("A"))
    out, files = phases.align_triplets(out, found.withColumn("structure_id", F.col("path")), a.refine_cycles, a.refine_cutoff)
    sinks.write_texts(files, folder_uri(to), "name", "text").write.format("noop").mode("overwrite").save()
    sinks.write_csv(out, f"{to}/triplets")
    sinks.write_json(summary.ok_of_total(out), f"{to}/triplet_summary")
    return out


def main(argv: Sequence[str] | None = None) -> None:
    a = parser().parse_args(argv)
    run = {"build": run_build, "to-yaml": run_yaml, "filter-interactions": run_filter, "triplet": run_triplet}[a.command]
    run(session("foldlake"), a).show(20, False)


if __name__ == "__main__":
    main()
