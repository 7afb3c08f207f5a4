"""The jobs over growing and repeated input, against brute force and SQL, and from the command line."""

import hashlib
import json
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

from jobs import candidate_release, registry, sequence_library, settings

ROOT = Path(__file__).resolve().parents[2]
TEXTS = "doc_id long, text string, lang string, source string, batch string, sequence string"
FIRST = [(5, "acde fghi klmn pqrs tvwy aa", "en", "s0"), (3, "ACDEFGHIKLMNPQRSTVWYAA", "de", "s1"), (7, "(MSE)" + "gg" * 12 + "xx", "", "s0"), (8, "short", "en", "s0"), (9, None, "en", "s0"), (9, "", None, None)]
SECOND = [(1, "ACDE\nFGHIKLMNPQRSTVWYAA", "en", "s2"), (11, "W" * 30 + "1é", None, None), (None, "w" * 30 + "É", "fr", "s1"), (12, "Z" * 50_000, "en", "s0"), (12, "Z" * 50_000, "en", "s0")]


def put(spark, rows, path, name):
    """Adds a file of texts, with columns whose names clash with those that the job makes."""
    spark.createDataFrame([(*r, "x", "y") for r in rows], TEXTS).coalesce(1).write.parquet(f"{path}/{name}.dir")
    part = next(Path(f"{path}/{name}.dir").glob("*.parquet"))
    part.rename(f"{path}/{name}.parquet")


def brute(*runs):
    """sequence to (doc_id, lang, source, residues, standard letters, run) of the first text with it."""
    out = {}
    for number, rows in enumerate(runs):
        for doc, text, lang, source in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2] or "und", r[3] or "")):
            whole = re.sub(r"[\n\r ]", "", (text or "").upper()).replace("(MSE)", "M")
            whole = "".join(c for c in re.sub(r"\([A-Z]{3}\)", "X", whole) if c.isupper())
            if len(whole) >= 20:
                out.setdefault(whole, (doc, lang or "und", source, len(whole), sum(c in sequence_library.LETTERS for c in whole), number))
    return out


def found(result):
    return {r.sequence: (r.doc_id, r.lang, r.source, r.n_residues, r.n_standard, r.batch) for r in result.collect()}


def test_library_takes_only_what_is_new(spark, tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    paths = (str(at / "*.parquet"), str(tmp_path / "out"), str(tmp_path / "cp"))
    put(spark, FIRST, at, "a")
    one = sequence_library.run(spark, *paths)
    assert (one.read, one.written) == (6, 2) and found(one.library) == brute(FIRST)
    files = sorted(p.relative_to(tmp_path) for p in (tmp_path / "out").rglob("*.parquet"))
    same = sequence_library.run(spark, *paths)
    assert (same.read, same.written) == (0, 0) and found(same.library) == brute(FIRST)
    assert files == sorted(p.relative_to(tmp_path) for p in (tmp_path / "out").rglob("*.parquet"))
    put(spark, SECOND, at, "b")
    two = sequence_library.run(spark, *paths)
    assert (two.read, two.written) == (5, 2) and found(two.library) == brute(FIRST, SECOND)
    assert all(r.sequence_key == hashlib.sha256(r.sequence.encode()).hexdigest() for r in two.library.collect())
    want = defaultdict(list)
    for _, lang, source, size, _, _ in brute(FIRST, SECOND).values():
        want[lang, source].append(size)
    report = sequence_library.read_back(spark, f"{paths[1]}/report", sequence_library.REPORT).collect()
    assert {(r.lang, r.source): (r.n_sequences, r.n_residues, r.shortest, r.longest) for r in report} == {k: (len(v), sum(v), min(v), max(v)) for k, v in want.items()}


def test_a_batch_repeated_after_a_failure_writes_the_same(spark, tmp_path):
    config, out = sequence_library.Config(), str(tmp_path / "out")
    frames = [spark.createDataFrame(rows, sequence_library.SOURCE) for rows in (FIRST, SECOND)]
    for number in (0, 0, 1, 1):
        sequence_library.take(frames[number], number, out, config)
    assert found(sequence_library.read_back(spark, f"{out}/library", sequence_library.LIBRARY)) == brute(FIRST, SECOND)


def test_files_in_batches_and_an_empty_source(spark, tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    put(spark, [], at, "none")
    paths = (str(at / "*.parquet"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sequence_library.run(spark, *paths).library.count() == 0
    put(spark, FIRST, at, "a")
    put(spark, SECOND, at, "b")
    out = sequence_library.run(spark, *paths, sequence_library.Config(least_residues=1, files_a_batch=1))
    got = [r.sequence for r in out.library.collect()]
    assert len(got) == len(set(got)) and "SHORT" in got and out.read == 11


LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, status string"


def tables(spark, path, lines):
    spark.createDataFrame([(*r, "x") for r in lines], LINES).write.mode("overwrite").parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(i, f"part {i}/é", f"B{i % 2}") for i in range(1, 7)], "p_partkey long, p_name string, p_brand string").write.mode("overwrite").parquet(f"{path}/part.parquet")
    spark.createDataFrame([(1, "one", 1), (2, "two", 9), (3, "three", 2)], "s_suppkey long, s_name string, s_nationkey int").write.mode("overwrite").parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(1, "N1", 1), (2, "N2", 5)], "n_nationkey int, n_name string, n_regionkey int").write.mode("overwrite").parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(1, "R1")], "r_regionkey int, r_name string").write.mode("overwrite").parquet(f"{path}/region.parquet")


ROWS = [
    (1, 1, 1, 1, 5.0, 900.0, "R", "O"), (1, 1, 1, 1, 5.0, 900.0, "R", "O"), (2, 1, 1, 1, 5.0, 950.0, "A", "O"),
    (3, 2, 2, 1, 5.0, 10.0, "A", "O"), (4, 3, 3, 1, 5.0, 60_000.0, "A", "O"), (5, 4, 3, 1, 5.0, None, "A", "O"), (6, 5, 3, 1, 99.0, 1.0, "A", "O"),
    (7, None, 1, 1, 5.0, 1.0, "A", "O"), (8, 6, 3, 2, 5.0, 70.0, None, "O"), (8, 6, 3, 3, 5.0, 1.0, None, "NA"),
]


def test_release(spark, tmp_path):
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables(spark, at, ROWS)
    first = candidate_release.run(spark, at, out)
    got = {r.target: (r.order_key, r.status, r.region, r.error_message) for r in first.points.collect()}
    assert got == {
        1: (2, "success", "R1", ""), 2: (3, "failed", "none", "No supplier with a nation"), 3: (4, "failed", "none", "Price 60000.00 above 50000.00"),
        4: (5, "failed", "none", "Price unknown above 50000.00"), 5: (None, "failed", "none", "No candidate passes the filter"), 6: (8, "success", "none", ""),
    }
    assert (first.read, first.written) == (len(ROWS), 6)
    assert {r.brand: r.target for r in spark.read.parquet(f"{out}/library/release=current").collect()} == {"B1": 1, "B0": 6}
    report = spark.read.json(f"{out}/summary/release=current").first()
    assert (report.n_total, report.n_success, report.n_failed, report.mean_rmsd) == (6, 2, 4, 510.0)
    before = Counter(map(tuple, first.points.collect()))
    again = candidate_release.run(spark, at, out)
    assert Counter(map(tuple, again.points.collect())) == before
    tables(spark, at, [ROWS[0]])
    other = candidate_release.run(spark, at, out, candidate_release.Config(release="next"))
    assert {r.target for r in other.points.where("status = 'success'").collect()} == {1}
    kept = spark.read.schema(candidate_release.POINTS).parquet(f"{out}/points").groupBy("release", "status").count().collect()
    assert {(r["release"], r["status"]): r["count"] for r in kept} == {("current", "success"): 2, ("current", "failed"): 4, ("next", "success"): 1, ("next", "failed"): 5}
    once_more = candidate_release.run(spark, at, out)  # a partition that has no rows any more goes with its release
    assert {r.region for r in once_more.points.where("status = 'success'").collect()} == {"R1"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for file in os.listdir(data):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{data}/{file}'")
    before = dict(spark.sparkContext.getConf().getAll())
    got = registry.QUERIES[name](spark, data)
    want = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall())
    assert before == dict(spark.sparkContext.getConf().getAll())


def test_command_lines(spark, data, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"least_residues": 5000}))
    env = os.environ | {"PYTHONPATH": str(ROOT)}
    args = ["jobs.sequence_library", "--source", f"{data}/documents.parquet", "--output", f"{tmp_path}/o1", "--checkpoint", f"{tmp_path}/c1", "--config", f"{tmp_path}/c.json"]
    for module in (args, ["jobs.candidate_release", "--tables", data, "--output", f"{tmp_path}/o2"]):
        ran = subprocess.run([sys.executable, "-m", *module], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert ran.returncode == 0, ran.stderr[-2000:]
        assert re.search(r"INFO jobs .*read \d+", ran.stderr)
    assert sequence_library.read_back(spark, f"{tmp_path}/o1/library", sequence_library.LIBRARY).where("n_residues < 5000").count() == 0
    assert spark.read.parquet(f"{tmp_path}/o2/points").count() == spark.read.parquet(f"{data}/part.parquet").count()


def test_config_files(tmp_path):
    assert settings.load(sequence_library.Config, settings.beside(sequence_library.__file__)) == sequence_library.Config()
    assert settings.load(candidate_release.Config, settings.beside(candidate_release.__file__)) == candidate_release.Config()
    (tmp_path / "c.json").write_text('{"least": 1}')
    with pytest.raises(ValueError):
        settings.load(sequence_library.Config, str(tmp_path / "c.json"))


def test_jobs_stand_apart_from_the_corpus_operators():
    for path in (ROOT / "jobs").glob("*.py"):
        assert not re.search(r"foldlake\.llm|foldlake import llm|corpus_pipeline", path.read_text())
