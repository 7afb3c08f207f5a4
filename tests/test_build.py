"""The dataset build and the stream on a small catalogue."""

from pyspark.sql import functions as F

from foldlake.plans import build
from foldlake.sources.catalogue import numbered, read_catalogue
from foldlake.streaming import catalogue as stream

HEADER = "pdb\tHchain\tLchain\tantigen_chain\tantigen_species\tantigen_type\tantigen_name\tresolution"
ROWS = [
    "5FUO\tH\tL\tA | B\thomo sapiens\tprotein\tAlpha One\t2.0",
    "5FUO\tX\tY\tA | B\tHomo sapiens\tprotein\tAlpha One\t1.0",
    "1AAA\tH\tNA\tA\thomo sapiens\tprotein\tAlpha One\t2.0",
    "2BBB\tH\tL\tC\tHomo Sapiens; virus\tProtein | peptide\tBeta\t2.5",
    "3CCC\tH\tL\tD\thomo sapiens\tprotein\tGamma\tNOT",
    "4DDD\tH\tL\tE\thomo sapiens\tprotein\tDelta\t2.1",
    "6EEE\tH\tL\tF\thomo sapiens\tprotein\tNA\t2.2",
    "7MMM\tH\tL\tM | N\tmus musculus\tprotein\talpha one \t1.9",
    "8MMM\tNA\tL\tP\tMouse\tprotein\tALPHA ONE\t1.1",
]


def read(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    return read_catalogue(spark, str(tmp_path / "c.tsv"))


def test_build(spark, tmp_path):
    df = read(spark, tmp_path)
    assert [r.pdb for r in numbered(df).orderBy("ordinal").collect()][:3] == ["5FUO", "5FUO", "1AAA"]
    kept = build.complexes(df, build.Options())
    assert sorted(r.pdb for r in kept.collect()) == ["2BBB", "4DDD", "5FUO", "6EEE"]
    assert [r.Hchain for r in kept.where("pdb = '5FUO'").collect()] == ["H"]
    chains = spark.createDataFrame([("5fuo", "A", "U1", 0), ("2bbb", "C", "U2", 0), ("4ddd", "E", "U4", 0)], "pdb string, chain string, accession string, rank int")
    schema = "accession string, gene_name string, taxon_id int, sequence string, protein_name string, reviewed boolean"
    proteins = spark.createDataFrame(
        [("U1", "A1", 9606, "ACDE", "Alpha", True), ("U2", "B1", 9606, "ACDE", "Beta", True), ("U4", "D1", 9606, "AAAA", "Delta", True)]
        + [("M2", "B1", 10090, "ACDF", "Beta", True), ("M4", "d1x", 10090, "GGGA", "Delta", False)],
        schema,
    )
    structures = spark.createDataFrame([("M2", "9ZZZ", "1", 0)], "accession string, pdb string, entity string, rank int")
    entity = spark.createDataFrame([("9zzz", "1", [])], "pdb string, entity string, chains array<string>")
    got = {r.id: r for r in build.data_points(df, chains, proteins, structures, entity, build.Options()).collect()}
    assert set(got) == {"DP_5fuo_A", "DP_2bbb_C", "DP_4ddd_E", "DP_6eee_F"}
    a, b, d, e = (got[k] for k in ("DP_5fuo_A", "DP_2bbb_C", "DP_4ddd_E", "DP_6eee_F"))
    assert (a.status, a.mouse_structure_source, a.pdb_id_mouse, a.mouse_antigen_chain, a.sequence_identity) == ("success", "SAbDab", "7MMM", "M", 100.0)
    assert (b.status, b.mouse_structure_source, b.pdb_id_mouse, b.mouse_antigen_chain, b.sequence_identity) == ("success", "RCSB", "9ZZZ", "A", 60.0)
    assert (d.status, d.error_message) == ("failed", "Sequence identity 14.3% below threshold 50.0%")
    assert (d.pdb_id_mouse, d.mouse_antigen_chain, d.mouse_gene_name, d.mouse_uniprot) == (None, None, None, "M4")
    assert e.error_message == "Could not map antigen chain to UniProt" and e.mouse_antigen_chain is None
    assert (a.mouse_gene_name, b.mouse_gene_name) == ("alpha one ", "B1")
    pairs = build.pairs(build.data_points(df, chains, proteins, structures, entity, build.Options()))
    assert len(pairs.columns) == 23
    assert {(r.pair_name, r.human_antigen_chains, r.mouse_antigen_file) for r in pairs.collect()} == {
        ("A1_alpha_one_", "A,B", "MouseAntigen/alpha_one_.cif"),
        ("B1_B1", "C", "MouseAntigen/B1.cif"),
    }
    dry = build.data_points(df, chains, proteins, structures, entity, build.Options(dry_run=True))
    assert {r.status for r in dry.collect()} == {"failed", "dry_run"}
    best = build.library(dry.withColumn("status", F.lit("success")).withColumn("alignment_rmsd", F.lit(1.0)))
    assert best.count() == len({r.mouse_gene_name for r in best.collect()})


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c.tsv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    out = stream.filtered(stream.read_stream(spark, str(tmp_path / "in")))
    query = out.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.pdb for r in spark.table("kept").collect()) == ["2BBB", "4DDD", "5FUO", "6EEE"]


def test_hits_are_limited_and_ordered(spark):
    schema = "accession string, gene_name string, taxon_id int, sequence string, protein_name string, reviewed boolean, hit_rank int"
    human = [("U1", "A1", 9606, "ACDE", "x", True, 0), ("U2", "B1", 9606, "ACDE", "x", True, 0)]
    exact = [(f"M{9 - i}", "A1", 10090, "ACDF" if i else "AAAA", "x", True, i) for i in range(4)]
    broad = [(f"N{i:02}", f"b1{i}", 10090, "ACDE" if i == 12 else "ACDD" if i == 9 else "AAAA", "x", False, i) for i in range(13)]
    got = {r.uniprot: (r.ortholog, r.identity) for r in build.orthologs(spark.createDataFrame(human + exact + broad, schema), build.Options()).collect()}
    assert got["U1"][0] == "M9"  # the first hit, not the first accession or the most identical one
    assert got["U2"][0] == "N09"  # the most identical of the first ten hits
    plan = build.orthologs(spark.createDataFrame(human + exact + broad, schema), build.Options())._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
