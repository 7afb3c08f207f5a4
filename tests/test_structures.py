"""Small structure files through the parsers, chain operators, sequence documents and epitopes."""

import json


from foldlake.operators import chains, epitopes, sequences
from foldlake.plans import contacts
from foldlake.sources import payloads, sinks, structures

CIF = """data_TEST
_refine.ls_d_res_high 2.10
loop_
_entity_poly.entity_id
_entity_poly.type
_entity_poly.pdbx_seq_one_letter_code
_entity_poly.pdbx_strand_id
1 'polypeptide(L)'
;A(MSE)C
(ABC)G
;
A,B
2 polydeoxyribonucleotide 'ACGT' C
loop_
_struct_conn.conn_type_id
_struct_conn.ptnr1_label_asym_id
_struct_conn.ptnr1_label_seq_id
_struct_conn.ptnr1_label_comp_id
_struct_conn.ptnr2_label_asym_id
_struct_conn.ptnr2_label_seq_id
_struct_conn.ptnr2_label_comp_id
disulf A 1 CYS A 3 CYS
disulf A 1 CYS A ? CYS
covale A 1 CYS A 2 CYS
loop_
_atom_site.group_PDB
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.label_seq_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.occupancy
_atom_site.auth_seq_id
_atom_site.auth_asym_id
_atom_site.pdbx_PDB_model_num
ATOM CA A ALA A 1 0.0 0.0 0.0 0.4 11 H 1
ATOM CA B ALA A 1 9.0 0.0 0.0 0.6 11 H 1
ATOM CA . GLY A 2 1.0 0.0 0.0 1.0 12 H 1
ATOM CA . VAL A 3 2.0 0.0 0.0 1.0 13 H 1
HETATM O . HOH W . 5.0 5.0 5.0 1.0 99 H 1
ATOM CA . ALA A 1 0.0 0.0 0.0 1.0 11 H 2
"""
PDB = "REMARK   2 RESOLUTION.    1.80 ANGSTROMS.\nATOM      1  CA  GLY A   7      10.000  11.000  12.500  1.00 20.00           C\nEND\n"


def texts(spark, **files):
    return spark.createDataFrame([(f"file:/x/{k.replace('__', '.')}", bytearray(v.encode())) for k, v in files.items()], "path string, content binary")


def test_parsers(spark):
    found = texts(spark, a__cif=CIF, b__pdb=PDB, c__cif="")
    atoms = structures.atom_site(found)
    assert atoms.where("structure_id = 'a' AND error IS NULL").count() == 6
    assert [tuple(r) for r in atoms.where("structure_id = 'b'").select("x", "y", "z", "auth_seq_id", "atom_name").collect()] == [(10.0, 11.0, 12.5, "7", "CA")]
    assert atoms.where("structure_id = 'c'").first().error == "no atoms"
    best = structures.main_atoms(atoms).where("structure_id = 'a' AND model_num = 1 AND label_seq_id = '1'").collect()
    assert [r.altloc for r in best] == ["B"]
    assert {r.structure_id: r.ls_d_res_high for r in structures.refine(found).collect()} == {"a": 2.1, "b": 1.8, "c": None}
    text = sinks.structure_files(atoms.where("structure_id = 'b'")).first().text
    assert [r[13:16] for r in structures.pdb_atoms("b", text)] == [r[13:16] for r in structures.pdb_atoms("b", PDB)]


def test_chain_selection(spark):
    atoms = structures.atom_site(texts(spark, a__cif=CIF)).where("error IS NULL")
    assert chains.select_author_chains(atoms, ["H"]).count() == 5
    assert chains.select_author_chains(atoms, []).count() == 5
    assert chains.clean(atoms, ["A"]).count() == 5
    assert chains.clean(atoms, ["W"]).count() == 0
    assert chains.first_model(atoms).count() == 5
    assert chains.residues(atoms).count() == 3
    motion = spark.createDataFrame([("a", [0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0])], "structure_id string, rotation array<double>, shift array<double>")
    assert [(r.x, r.y) for r in chains.move(atoms.where("label_seq_id = '2'"), motion).collect()] == [(1.0, 1.0)]


def test_sequence_documents(spark):
    found = texts(spark, a__cif=CIF, b__pdb=PDB)
    atoms = structures.atom_site(found)
    seqs = sequences.sequences(structures.entity_poly(found.where("path LIKE '%cif'")), atoms)
    got = {(r.structure_id, r.entity_rank): (r.chains, r.sequence) for r in seqs.collect()}
    assert got == {("a", 0): (["A", "B"], "AMCXG"), ("a", 1): (["C"], "ACGT"), ("b", 0): (["A"], "G")}
    bonds = sequences.bonds(sequences.disulfides(structures.struct_conn(found.where("path LIKE '%cif'"))), sequences.residue_index(atoms), seqs)
    assert [tuple(r) for r in bonds.collect()] == [("a", 0, 0, 2)]
    docs = {r.structure_id: r.yaml for r in sequences.yaml_text(sequences.documents(seqs, bonds)).collect()}
    assert docs["a"] == "version: 1\nsequences:\n- protein:\n    id: 'A,B'\n    sequence: 'AMCXG'\nbonds:\n- - 0\n  - 2\n"
    assert "bonds" not in docs["b"]


def residues(spark, rows):
    return spark.createDataFrame(rows, "structure_id string, chain string, number int, comp string")


def test_epitope_sequence(spark):
    rows = [("a", "A", 1, "ALA"), ("a", "A", 2, "GLY"), ("a", "A", 3, "VAL"), ("b", "A", 1, "ALA"), ("b", "A", 2, "XXX"), ("b", "A", 3, "GLY")]
    got = {r.structure_id: r.sequence for r in epitopes.epitope_sequence(residues(spark, rows)).collect()}
    assert got == {"a": "AGV", "b": "AG"}
    assert epitopes.epitope_sequence(residues(spark, [])).count() == 0


def test_epitope_validation(spark):
    schema = "structure_id string, model_num int, group_pdb string, auth_asym_id string, auth_seq_id string, ins_code string, label_comp_id string, atom_name string, atom_serial int, x double, y double, z double"

    def atoms(comps, shift=0.0):
        return spark.createDataFrame([("p", 1, "ATOM", "A", str(i + 1), None, c, "CA", i, float(i), shift, 0.0) for i, c in enumerate(comps)], schema)

    human, antibody = atoms(["ALA", "GLY", "VAL", "SER"]), atoms(["TRP"], 1.0)
    got = epitopes.validate(human, antibody, atoms(["ALA", "GLY", "VAL", "SER"], 0.5), distance=1.5).first()
    assert (got.num_contacts, got.epitope_identity, got.epitope_rmsd, got.is_consistent) == (2, 100.0, 0.5, True)
    got = epitopes.validate(human, antibody, atoms(["ALA", "GLY", "VAL", "SER"], 2.5), distance=1.5).first()
    assert got.epitope_rmsd == 2.5 and not got.is_consistent
    assert epitopes.validate(human, atoms(["TRP"], 90.0), human).count() == 0


def test_contact_folders(spark):
    good = json.dumps({"id": "DP_1", "files": {"antibody_pdb": "ab.pdb", "human_ag_pdb": "ag.pdb"}})
    found = spark.createDataFrame([("DP_1", "x/DP_1/ab.pdb"), ("DP_1", "x/DP_1/ag.pdb"), ("DP_2", "x/DP_2/ab.pdb"), ("other", "x/o/ab.pdb"), ("DP_5", "y/ab.pdb")], "dp_id string, path string")
    meta = spark.createDataFrame([("DP_1", good), ("DP_3", "{broken"), ("DP_4", '{"id": "x", "files": {"antibody_pdb": ""}}'), ("DP_5", good)], "dp_id string, text string")
    points = "dp_id string, atom_serial int, x double, y double, z double"
    antigen = spark.createDataFrame([("DP_1", i, float(i), 0.0, 0.0) for i in range(4)], points)
    antibody = spark.createDataFrame([("DP_1", i, float(i), 1.0, 0.0) for i in range(4)], points)
    rows = contacts.filter_contacts(contacts.folders(found, meta), antibody, antigen, distance=1.5, least=4).collect()
    got = {r.id: (r.contact_count, r.contact_count_full, r.passed, r.reason) for r in rows}
    assert got["DP_1"] == (5, 10, True, "")
    assert {k: v[3] for k, v in got.items()} == {"DP_1": "", "DP_2": "metadata.json not found", "DP_3": "metadata load error", "DP_4": "missing antibody or antigen file", "DP_5": "PDB files not found"}


def test_payloads(spark):
    protein = {"primaryAccession": "P12345", "genes": [{"geneName": {"value": "TEST_GENE"}}], "organism": {"taxonId": 9606, "scientificName": "Homo sapiens"}, "sequence": {"value": "MKTESTSEQUENCE"}, "uniProtKBCrossReferences": [{"database": "Ensembl", "id": "E1"}, {"database": "PDB", "id": "x"}]}
    df = spark.createDataFrame([(json.dumps(protein),)], "payload string")
    got = payloads.proteins(df).first()
    assert (got.accession, got.gene_name, got.taxon_id, got.sequence_length, got.protein_name, got.ensembl_ids) == ("P12345", "TEST_GENE", 9606, 14, "Unknown", ["E1"])
    chain = {"4ABC": {"UniProt": {"P1": {"mappings": [{"chain_id": "A"}]}, "P2": {"mappings": [{"chain_id": "A"}, {"chain_id": "B"}]}}}}
    rows = payloads.chain_map(spark.createDataFrame([(json.dumps(chain),)], "payload string"))
    assert {(r.pdb, r.accession, r.chain) for r in rows.collect()} == {("4abc", "P1", "A"), ("4abc", "P2", "A"), ("4abc", "P2", "B")}
    hits = payloads.structures(spark.createDataFrame([("P1", '{"result_set":[{"identifier":"bad"},{"identifier":"1abc_2"}]}')], "accession string, payload string"))
    assert [(r.pdb, r.entity) for r in hits.collect()] == [("1ABC", "2")]
    strands = payloads.entity_chains(spark.createDataFrame([("1abc", '{"entity_poly":{"pdbx_strand_id":"A, B,"}}')], "pdb string, payload string"))
    assert strands.select("chains").first()[0] == ["A", "B"]


def test_cif_texts(spark):
    turn, shift = [0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0]
    rows = [("file:/x/a.cif", bytearray(CIF.encode()), ["H"], turn, shift), ("file:/x/b.cif", bytearray(CIF.encode()), ["Z"], None, None)]
    df = spark.createDataFrame(rows, "path string, content binary, chains array<string>, rotation array<double>, shift array<double>")
    got = {r.structure_id: structures.cif_tables(r.text) for r in structures.cif_texts(df).collect()}
    before = structures.cif_tables(CIF)
    assert [(r["Cartn_x"], r["Cartn_y"]) for r in got["a"]["_atom_site"]] == [("1.000", "0.000"), ("1.000", "9.000"), ("1.000", "1.000"), ("1.000", "2.000"), ("1.000", "0.000")]
    assert got["a"]["_entity_poly"] == before["_entity_poly"] and got["a"]["_struct_conn"] == before["_struct_conn"]
    assert "_atom_site" not in got["b"] and got["b"]["_refine"] == before["_refine"]


def test_cif_cells_round_trip():
    values = ["a", "a b", "it's", 'say "x"', "both ' and \" here", "two\nlines", None, "_tag", "?", "loop_", "#x", "data_1", ""]
    text = structures.cif_text("x", {"_t": [{"v": v, "w": str(i)} for i, v in enumerate(values)]})
    assert [r["v"] for r in structures.cif_tables(text)["_t"]] == values
