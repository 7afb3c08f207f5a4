"""The whole build on two staged complexes: files read back, measures, metadata, library, log; and the triplets of its output."""

import json

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from foldlake import cli
from foldlake.functions.superpose import superpose
from foldlake.operators import chains, epitopes, pairs, summary
from foldlake.plans import build, phases
from foldlake.sources import structures

LETTERS = "ALA CYS ASP GLU PHE GLY HIS ILE LYS LEU MET ASN".split()
TURN = np.array([[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]])


def cif(name, chains, resolution="2.0"):
    """chains: chain id to residues (name, xyz); each residue has its alpha carbon; and one water a file."""
    rows = [(c, i + 1, kind, xyz) for c, residues in chains.items() for i, (kind, xyz) in enumerate(residues)]
    head = "data_{}\n_refine.ls_d_res_high {}\nloop_\n".format(name, resolution)
    fields = "group_PDB id type_symbol label_atom_id label_alt_id label_comp_id label_asym_id label_seq_id auth_seq_id auth_asym_id Cartn_x Cartn_y Cartn_z occupancy pdbx_PDB_model_num"
    head += "".join(f"_atom_site.{f}\n" for f in fields.split())
    lines = [f"ATOM {k} C CA . {kind} {c} {n} {n} {c} {x:.3f} {y:.3f} {z:.3f} 1.0 1" for k, (c, n, kind, (x, y, z)) in enumerate(rows, 1)]
    lines.append(f"HETATM {len(rows) + 1} O O . HOH W . 1 {list(chains)[0]} 0.0 0.0 0.0 1.0 1")
    return head + "\n".join(lines) + "\n"


def coil(seed, n=12):
    return np.cumsum(np.random.default_rng(seed).normal(0, 2, (n, 3)), axis=0)


def staged(tmp_path, more=()):
    data = tmp_path / "data"
    (data / "files").mkdir(parents=True)
    header = "pdb\tHchain\tLchain\tantigen_chain\tantigen_species\tantigen_type\tantigen_name\tresolution"
    rows = ["1ABC\tH\tL\tA | B\thomo sapiens\tprotein\tAlpha\t2.0", "2DEF\tH\tNA\tA\thomo sapiens\tprotein\tBeta\t2.0", "3GHI\tH\tL\tA\thomo sapiens\tprotein\tBeta\t2.1", "7MMM\tH\tL\tM\tmus musculus\tprotein\talpha\t1.9", "8MMM\tH\tL\tM\tmus musculus\tprotein\tbeta\t1.9"]
    (data / "catalogue.tsv").write_text("\n".join([header, *rows, *more]) + "\n")
    payload = lambda x: json.dumps({"payload": json.dumps(x)})
    protein = lambda a, g: {"primaryAccession": a, "genes": [{"geneName": {"value": g}}], "organism": {"taxonId": 9606}, "sequence": {"value": "ACDE"}}
    (data / "proteins").write_text("\n".join(payload(protein(*x)) for x in (("U1", "GEN1"), ("U3", "GEN/3"))) + "\n")
    maps = {"1abc": "U1", "3ghi": "U3", "4jkl": "U1"}
    (data / "chains").write_text("\n".join(payload({p: {"UniProt": {u: {"mappings": [{"chain_id": "A"}]}}}}) for p, u in maps.items()) + "\n")
    for name in ("structures", "entities"):
        (data / name).write_text("")
    own, other = coil(1), coil(2)
    near = lambda xyz: [("TRP", xyz[0] + [1.0, 0, 0]), ("TYR", xyz[1] + [0, 1.0, 0])]
    human = list(zip(LETTERS, own))
    (data / "files" / "1ABC.cif").write_text(cif("1ABC", {"A": human, "B": human[:3], "H": near(own), "L": [("SER", own[0] + 90)]}))
    (data / "files" / "7MMM.cif").write_text(cif("7MMM", {"M": list(zip(LETTERS, own @ TURN.T + [5.0, 6.0, 7.0])), "N": human[:2]}, "1.9"))
    (data / "files" / "3ghi.cif").write_text(cif("3GHI", {"A": list(zip(LETTERS, other)), "H": near(other), "L": near(other)}))
    return data, own


def test_build_writes_aligned_structures(spark, tmp_path):
    data, own = staged(tmp_path)
    out = tmp_path / "out"
    args = cli.parser().parse_args(["build", "--data-dir", str(data), "--output", str(out)])
    report = cli.run_build(spark, args).first()
    assert (report.n_total, report.n_success, report.n_failed) == (2, 1, 1)
    points = {r.id: r for r in spark.read.parquet(str(out / "points")).collect()}
    a, b = points["DP_1abc_A"], points["DP_3ghi_A"]
    assert a.alignment_rmsd < 2e-3 and (a.epitope_identity, a.epitope_consistent, a.resolution_human, a.resolution_mouse) == (100.0, True, 2.0, 1.9)
    assert a.epitope_rmsd < 2e-3 and a.created_at[:2] == "20"
    assert (b.status, b.error_message) == ("failed", "Structure processing error: Could not download structure for 8MMM")

    def atoms(path):
        return structures.cif_tables((out / path).read_text())["_atom_site"]

    pair = "HumanMouse/GEN1_alpha/DP_1abc_A_B"
    for path in (f"{pair}/mouse_ag_aligned.cif", "MouseAntigen/alpha.cif"):
        rows = atoms(path)
        assert {r["auth_asym_id"] for r in rows} == {"M"} and len(rows) == 12
        assert np.allclose([[float(r[f"Cartn_{c}"]) for c in "xyz"] for r in rows], own, atol=2e-3)
    pdb = structures.pdb_atoms("x", (out / pair / "mouse_ag_aligned.pdb").read_text())
    assert np.allclose([r[15:18] for r in pdb], own, atol=2e-3)
    assert {r["auth_asym_id"] for r in atoms("SAbDab/antibody/DP_1abc_A_B_antibody.cif")} == {"H", "L"}
    assert {r["auth_asym_id"] for r in atoms("SAbDab/antigen/DP_1abc_A_B_antigen.cif")} == {"A", "B"} == {r["auth_asym_id"] for r in atoms(f"{pair}/human_ag.cif")}
    assert {r["auth_asym_id"] for r in atoms("SAbDab/cleaned/DP_1abc_A_B.cif")} == {"A", "B", "H", "L"}
    meta = json.loads((out / pair / "metadata.json").read_text())
    assert meta["human_antigen_chains"] == ["A", "B"] and meta["pdb_id_mouse"] == "7MMM" and abs(meta["alignment_rmsd"] - a.alignment_rmsd) < 1e-9
    pairs = pd.concat(map(pd.read_csv, (out / "pairs").glob("*.csv")))
    assert list(pairs["mouse_antigen_file"]) == ["MouseAntigen/alpha.cif"] and (out / pairs["human_antigen_file"].iloc[0]).exists()
    table = pd.concat(map(pd.read_csv, (out / "dataset_summary").glob("*.csv")))
    assert len(table) == 2 and len(table.columns) == 24
    logged = [json.loads(x) for f in (out / "processing_log").glob("*.json") for x in f.read_text().splitlines()]
    assert {x["level"] for x in logged} == {"INFO", "ERROR"}

    args = cli.parser().parse_args(["triplet", "--data-dir", str(out), "--output", str(tmp_path / "three")])
    row = cli.run_triplet(spark, args).first()
    count = spark.read.json(str(tmp_path / "three" / "triplet_summary")).first()
    assert (count.ok, count.total) == (1, 1)
    assert (row.triplet_name, row.complete, row.ok) == ("GEN1_alpha_1abc", True, True) and row.rmsd < 3e-3
    at = tmp_path / "three" / "GEN1_alpha_1abc"
    assert sorted(p.name for p in at.iterdir()) == ["antibody.cif", "human_antigen.cif", "mouse_antigen.cif"]


def test_build_without_structures(spark, tmp_path):
    data, _ = staged(tmp_path)
    args = cli.parser().parse_args(["build", "--data-dir", str(data), "--output", str(tmp_path / "dry"), "--dry-run", "--filtered-catalogue"])
    report = cli.run_build(spark, args).first()
    assert (report.n_total, report.n_success, report.n_dry_run) == (2, 0, 2)
    kept = pd.concat(map(pd.read_csv, (tmp_path / "dry" / "filtered_catalogue").glob("*.csv")))
    assert sorted(kept["pdb"]) == ["1ABC", "3GHI"] and list(kept.columns)[:3] == ["pdb", "Hchain", "Lchain"]
    assert not (tmp_path / "dry" / "pairs").exists() and (tmp_path / "dry" / "dataset_summary").exists()


def test_folders_with_files_of_one_name(spark, tmp_path):
    def pdb(x):
        return "".join(f"ATOM  {i + 1:>5}  CA  ALA A{i + 1:>4}    {x + i:8.3f}{0:8.3f}{0:8.3f}  1.00  0.00           C\n" for i in range(4))

    for name, x in (("DP_1", 1.0), ("DP_2", 500.0)):
        folder = tmp_path / "in" / name
        (folder / "more").mkdir(parents=True)
        (folder / "metadata.json").write_text(json.dumps({"id": name, "files": {"antibody_pdb": "ab.pdb", "human_ag_pdb": "ag.pdb"}}))
        (folder / "ab.pdb").write_text(pdb(x))
        (folder / "ag.pdb").write_text(pdb(0.0))
        (folder / "more" / "note.txt").write_text("x")
    options = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--distance-threshold", "1.5", "--min-contacts", "4"]
    out = cli.run_filter(spark, cli.parser().parse_args(["filter-interactions", *options]))
    got = {r.id: (r.contact_count_full, r.passed, r.reason) for r in out.collect()}
    assert got == {"DP_1": (9, True, ""), "DP_2": (0, False, "no contact")}
    assert tuple(summary.kept_of_total(out).first()) == (1, 2)
    copied = sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file() and "DP_" in str(p))
    assert copied == ["DP_1/ab.pdb", "DP_1/ag.pdb", "DP_1/metadata.json", "DP_1/more/note.txt"]


def test_documents_of_folders_with_files_of_one_name(spark, tmp_path):
    for name, letters in (("DP_A", LETTERS[:5]), ("DP_B", LETTERS[5:9])):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "human_ag.cif").write_text(cif(name, {"A": [(x, (i, 0, 0)) for i, x in enumerate(letters)]}))
        (folder / f"{name}_antibody.cif").write_text(cif(name, {"H": [("TRP", (0, 0, 0))]}))
    (tmp_path / "in" / "DP_B" / "bad.cif").write_text("nothing")
    args = cli.parser().parse_args(["to-yaml", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")])
    got = {r.folder: (r.results, r.converted) for r in cli.run_yaml(spark, args).collect()}
    assert got["DP_A"][1] == 2 and got["DP_B"][1] == 2 and got["DP_B"][0]["bad"].startswith("ERROR")
    assert "ACDEF" in (tmp_path / "out" / "DP_A_human_ag.yaml").read_text() and "GHIK" in (tmp_path / "out" / "DP_B_human_ag.yaml").read_text()
    assert set(got["DP_A"][0]) == {"antibody", "human_antigen"} and (tmp_path / "out" / "DP_A_antibody.yaml").exists()


def test_two_successes_of_one_gene_pair_have_their_own_files(spark, tmp_path):
    more = ["4JKL\tH\tNAN\tA\thomo sapiens\tprotein\tAlpha\t2.2", "1ABC\tH\tL\tA | L\thomo sapiens\tprotein\tAlpha\t2.0"]
    data, own = staged(tmp_path, more)
    turned = own @ TURN.T - 3.0
    (data / "files" / "4JKL.pdb").write_text("x")
    (data / "files" / "4JKL.cif").write_text(cif("4JKL", {"A": list(zip(LETTERS, turned)), "H": [("TRP", turned[3] + 1.0)], "NAN": [("TRP", turned[4] + 1.0)]}, "2.2"))
    out = tmp_path / "out"
    args = cli.parser().parse_args(["build", "--data-dir", str(data), "--output", str(out), "--refine-cycles", "3"])
    report = cli.run_build(spark, args).first()
    assert (report.n_total, report.n_success) == (4, 3)
    points = spark.read.parquet(str(out / "points")).where("status = 'success'").collect()
    assert sorted(p.id for p in points) == ["DP_1abc_A", "DP_1abc_A", "DP_4jkl_A"]
    for name, fixed in (("DP_1abc_A_B", own), ("DP_1abc_A_L", own), ("DP_4jkl_A", turned)):
        rows = structures.cif_tables((out / "HumanMouse/GEN1_alpha" / name / "mouse_ag_aligned.cif").read_text())["_atom_site"]
        assert np.allclose([[float(r[f"Cartn_{c}"]) for c in "xyz"] for r in rows], fixed, atol=3e-3)
        assert (out / "SAbDab/antigen" / f"{name}_antigen.cif").exists() and (out / "SAbDab/antibody" / f"{name}_antibody.cif").exists()
    pairs = pd.concat(map(pd.read_csv, (out / "pairs").glob("*.csv")))
    assert len(pairs) == 3 and all((out / f).exists() for c in ("human_antigen_file", "antibody_file", "mouse_antigen_file") for f in pairs[c])


def test_a_build_parses_each_file_once_and_meets_atoms_once(spark, tmp_path):
    data, _ = staged(tmp_path)
    files = phases.by_entry(structures.files(spark, str(data / "files")))
    parsed = structures.stage(files, str(tmp_path / "atoms"))
    assert parsed.groupBy("structure_id").agg(F.max("resolution").alias("r")).where("r IS NOT NULL").count() == 3
    points = spark.createDataFrame(
        [("DP_1abc_A", "1abc", "7MMM", "A", ["A", "B"], "M", "H", "L", "success", "", 1), ("DP_9_A", "9xyz", "7MMM", "A", ["A"], "M", "H", "L", "success", "", 2)],
        "id string, pdb_id_human string, pdb_id_mouse string, human_antigen_chain string, human_antigen_chains array<string>, mouse_antigen_chain string, heavy_chain string, light_chain string, status string, error_message string, ordinal int",
    )
    for name in build.FIELDS:
        if name not in points.columns and name not in ("created_at", "alignment_rmsd", "resolution_human", "resolution_mouse", "epitope_identity", "epitope_rmsd", "epitope_consistent"):
            points = points.withColumn(name, F.lit(None).cast("string"))
    out, _ = phases.process(points, parsed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("MapInPandas") == 0 and initial.count("FlatMapGroupsInPandas") == 1 and initial.count("Exchange") < 20
    assert {r.id: r.status for r in out.collect()} == {"DP_1abc_A": "success", "DP_9_A": "failed"}
    stage = structures.parsed(files)._jdf.queryExecution().executedPlan().toString()
    assert stage.split("Initial Plan")[-1].count("MapInPandas") == 1


def test_measures_equal_those_of_the_joins(spark):
    rng = np.random.default_rng(11)
    names = ["ALA", "CYS", "GLY", "SER", "MSE", "TRP", "XYZ"]
    columns = "structure_id string, model_num int, group_pdb string, auth_asym_id string, auth_seq_id string, ins_code string, label_comp_id string, atom_name string, atom_serial int, x double, y double, z double"
    sides = {"human": [], "antibody": [], "mouse": []}
    for pair in ("p", "q", "r"):
        walk, serial = np.cumsum(rng.normal(0, 2, (40, 3)), axis=0), 0
        for chain in "AB":
            for k in range(20):
                kind, at = names[rng.integers(7)], walk[k + 20 * (chain == "B")]
                for atom in ("N", "CA"):
                    serial += 1
                    row = (pair, 1, "HETATM" if kind == "MSE" else "ATOM", chain, str(k + 5) if k != 7 else "11A", "B" if k == 3 else None, kind, atom, serial, *map(float, at + rng.normal(0, 0.3, 3)))
                    sides["human"].append(row)
                    if chain == "A" and rng.random() < 0.9:
                        sides["mouse"].append((*row[:3], "M", *row[4:6], names[rng.integers(7)] if rng.random() < 0.2 else kind, *row[7:9], *(float(v) for v in TURN @ np.array(row[9:]) + rng.normal(0, 0.4, 3))))
        sides["antibody"] += [(pair, 1 + i % 2, "ATOM", "H", str(i), None, "TRP", "CA", 500 + i, *map(float, walk[rng.integers(20)] + 1.0)) for i in range(12)]
    human, antibody, mouse = (spark.createDataFrame(sides[k], columns) for k in ("human", "antibody", "mouse"))
    first = human.where("auth_asym_id = 'A'")
    fitted = {r.structure_id: r for r in superpose(epitopes.carbon_pairs(first, mouse), "structure_id").collect()}
    motions = spark.createDataFrame([(k, r.rotation, r.shift) for k, r in fitted.items()], "structure_id string, rotation array<double>, shift array<double>")
    joined = {r.structure_id: r for r in epitopes.validate(human, antibody, chains.move(mouse, motions), 3.0).collect()}
    roles = [(human, F.when(F.col("auth_asym_id") == "A", pairs.REFERENCE | pairs.ANTIGEN).otherwise(pairs.ANTIGEN)), (antibody, F.lit(pairs.ANTIBODY)), (mouse, F.lit(pairs.OTHER))]
    parts = [df.withColumn("roles", r.cast("int")) for df, r in roles]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnRenamed("structure_id", "id")
    got = {r.id: r for r in pairs.measures(both.repartition(3), 3.0).collect()}
    assert set(got) == set(fitted) and len(joined) == 3
    for k, r in got.items():
        assert np.isclose(r.alignment_rmsd, fitted[k].rmsd) and r.n_pairs == fitted[k].n and np.allclose(r.rotation, fitted[k].rotation)
        j = joined[k]
        assert (r.num_contacts, r.epitope_consistent) == (j.num_contacts, j.is_consistent) and np.isclose(r.epitope_identity, j.epitope_identity) and np.isclose(r.epitope_rmsd, j.epitope_rmsd)
