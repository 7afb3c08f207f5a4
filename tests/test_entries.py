"""Fetching entries over HTTP into a cache, and the data source of atoms with pushed filters."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from foldlake.sources import entries, payloads, structures
from tests.test_structures import CIF, PDB


@pytest.fixture
def server():
    asked, flaky = Counter(), {"/2BBB.cif": 1}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            body = {"cif": CIF, "pdb": PDB}[self.path[-3:]]
            code = 404 if "BAD" in self.path else 503 if asked[self.path] <= flaky.get(self.path, 0) else 200
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    web = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{web.server_port}/{{id}}.{{kind}}", asked
    web.shutdown()


def test_fetch(spark, tmp_path, server):
    url, asked = server
    folder = f"file://{tmp_path}/files"
    wanted = spark.createDataFrame([("1aaa",), ("1AAA ",), ("2bbb",), ("bad1",), (None,), ("",)], "structure_id string")
    got = {(r.structure_id, r.kind): (r.path is not None, r.error is None) for r in entries.fetch(wanted, folder, url, wait=0.05).collect()}
    assert got == {(i, k): (ok, ok) for i, ok in (("1AAA", True), ("2BBB", True), ("BAD1", False)) for k in ("cif", "pdb")}
    assert asked["/2BBB.cif"] == 2 and asked["/1AAA.cif"] == 1
    entries.fetch(wanted, folder, url, wait=0.05).collect()
    assert asked["/1AAA.cif"] == 1 and asked["/2BBB.pdb"] == 1 and asked["/BAD1.cif"] == 2
    assert sorted(p.name for p in (tmp_path / "files").iterdir()) == ["1AAA.cif", "1AAA.pdb", "2BBB.cif", "2BBB.pdb"]
    assert structures.atom_site(structures.files(spark, str(tmp_path / "files"), "*.cif")).where("error IS NULL").count() == 12


def test_source_takes_filters(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.cif").write_text(CIF)
    (tmp_path / "sub" / "b.pdb").write_text(PDB)
    (tmp_path / "c.cif").write_text("nothing")
    (tmp_path / "note.txt").write_text("x")
    folder = f"file://{tmp_path}"
    reader = entries.AtomReader(folder, 1)
    left = list(reader.pushFilters([EqualTo(("auth_asym_id",), "H"), In(("model_num",), (1, 7)), EqualTo(("structure_id",), "a"), GreaterThan(("x",), 0.5), EqualTo(("atom_name",), "CA")]))
    assert [f.attribute for f in left] == [("x",), ("atom_name",)]
    parts = reader.partitions()
    assert [p.paths[0].rpartition("/")[2] for p in parts] == ["a.cif"]
    assert len([r for p in parts for r in reader.read(p)]) == 5
    own = [structures.parsed(structures.files(spark, str(tmp_path), p)) for p in ("*.cif", "*.pdb")]
    want = Counter(map(tuple, own[0].unionByName(own[1]).collect()))
    key, before = entries.PUSHDOWN, spark.conf.get(entries.PUSHDOWN)
    for on in ("true", "false"):
        spark.conf.set(key, on)
        atoms = entries.read_atoms(spark, folder)
        assert Counter(map(tuple, atoms.collect())) == want
        some = atoms.where("auth_asym_id = 'H' AND model_num = 1 AND x > 0.5")
        assert sorted(r.x for r in some.collect()) == [1.0, 2.0, 5.0, 9.0]
        assert atoms.where("error IS NOT NULL").count() == 1
    spark.conf.set(key, before)
    (tmp_path / "none").mkdir()
    assert entries.read_atoms(spark, f"{folder}/none").count() == 0


def test_payload_log(spark, tmp_path):
    """A failure that passes is fetched again, an answer is not, and a later failure hides none."""
    asked, down = Counter(), {"b"}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            key = self.path[1:]
            asked[key] += 1
            code = {"none": 404, "empty": 204}.get(key, 503 if key in down else 200)
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(b'{"k": "%s"}' % key.encode())

        def log_message(self, *args):
            pass

    web = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    url, log = f"http://127.0.0.1:{web.server_port}/{{key}}", str(tmp_path / "log")
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("none",), ("empty",), (None,)], "key string")
    first = {r.key: r.payload for r in payloads.refresh(keys, log, url, tries=2, wait=0.02).collect()}
    assert first == {"a": '{"k": "a"}', "none": None, "empty": None} and asked == {"a": 1, "b": 2, "none": 1, "empty": 1}
    assert [r.key for r in payloads.unanswered(keys, spark.read.parquet(log)).collect()] == ["b"]
    down.clear()
    second = {r.key: r.payload for r in payloads.refresh(keys, log, url, tries=2, wait=0.02).collect()}
    assert second == first | {"b": '{"k": "b"}'} and asked == {"a": 1, "b": 3, "none": 1, "empty": 1}
    web.shutdown()
    later = spark.read.parquet(log).selectExpr("key", "fetched_at + INTERVAL 1 DAY AS fetched_at", "string(NULL) AS payload", "false AS gone", "'HTTP 500' AS error")
    assert {r.key: r.payload for r in payloads.answers(spark.read.parquet(log).unionByName(later)).collect()} == second
