import json

import pytest

from foldlake import cli
from tests.test_structures import CIF, PDB


def test_commands(spark, tmp_path):
    (tmp_path / "cif").mkdir()
    (tmp_path / "cif" / "a.cif").write_text(CIF)
    args = cli.parser().parse_args(["to-yaml", "--input", str(tmp_path / "cif"), "--output", str(tmp_path / "yaml")])
    assert cli.run_yaml(spark, args).count() == 1
    assert "bonds:" in (tmp_path / "yaml" / "a.yaml").read_text()

    folder = tmp_path / "in" / "DP_1"
    folder.mkdir(parents=True)
    (folder / "metadata.json").write_text(json.dumps({"id": "DP_1", "files": {"antibody_pdb": "ab.pdb", "human_ag_pdb": "ag.pdb"}}))
    (folder / "ab.pdb").write_text(PDB)
    (folder / "ag.pdb").write_text(PDB)
    options = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--min-contacts", "1"]
    args = cli.parser().parse_args(["filter-interactions", *options])
    assert [tuple(r) for r in cli.run_filter(spark, args).collect()] == [("DP_1", 1, 1, True, "")]
    same = cli.parser().parse_args(["filter-interactions", "--input", "x", "--output", "x"])
    with pytest.raises(SystemExit):
        cli.run_filter(spark, same)

    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "pairs.csv").write_text("pair_name,human_antigen_file,mouse_antigen_file,antibody_file\nx,h.cif,m.cif,a.cif\ny,h.cif,no.cif,a.cif\n")
    for name in ("h.cif", "m.cif", "a.cif"):
        (tmp_path / "p" / name).write_text("data_x\n")
    args = cli.parser().parse_args(["triplet", "--data-dir", str(tmp_path / "p")])
    assert {(r.pair_name, r.complete) for r in cli.run_triplet(spark, args).collect()} == {("x", True), ("y", False)}
