"""Queries cover the whole of their tables, also where those are larger than the smallest test data."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from foldlake.plans import catalogue


@pytest.fixture(scope="module")
def points(spark, tmp_path_factory):
    """A folder with 1,300 embeddings, and their ids, labels and scaled coordinates."""
    at = str(tmp_path_factory.mktemp("points"))
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 6).astype("float32")], i % 3) for i in range(1300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at, [(i, label, np.array(e[:3])) for i, e, label in rows]


def near(rows):
    """Pairs of the sides that the middle of the ids parts, by brute force."""
    return {(label, a, b) for a, label, p in rows if a < 650 for b, other, q in rows if b >= 650 and label == other and ((10 * p - 10 * q) ** 2).sum() <= 1.5 * 1.5}


def test_pairs_cover_all_embeddings(spark, points):
    at, rows = points
    want = near(rows)
    assert any(a >= 500 or b >= 500 for _, a, b in want)
    assert {tuple(r) for r in catalogue.QUERIES["contact_pairs"](spark, at).collect()} == want
    assert {tuple(r) for r in catalogue.QUERIES["epitope_semi"](spark, at).collect()} == {(label, a) for label, a, _ in want}
    full = {r["label"]: r["contact_count_full"] for r in catalogue.QUERIES["contact_filter"](spark, at).collect()}
    assert full == dict(Counter(label for label, *_ in want))


def test_paired_rmsd_covers_all_embeddings(spark, points):
    at, rows = points
    sides = defaultdict(lambda: ([], []))
    for i, label, p in rows:
        sides[label][i >= 650].append(p)
    got = {r["label"]: (r["n_pairs"], r["rmsd"]) for r in catalogue.QUERIES["paired_rmsd"](spark, at).collect()}
    for label, (a, b) in sides.items():
        n = min(len(a), len(b))
        assert got[label][0] == n
        assert got[label][1] == pytest.approx(np.sqrt(((np.array(a[:n]) - np.array(b[:n])) ** 2).sum(1).mean()), abs=2e-6)


def test_tiered_match_covers_all_parts(spark, tmp_path):
    names = [f"{a} {b}{i % 40}" for i, (a, b) in enumerate([("red", "bolt"), ("Blue", "nut"), ("old", "RED ring")] * 120)] + [None, " ", "bolt"]
    spark.createDataFrame(list(enumerate(names, 1)), "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = Counter(tuple(r) for r in catalogue.QUERIES["tiered_match"](spark, str(tmp_path)).collect())
    want = Counter()
    low = [(k, n.strip().lower()) for k, n in enumerate(names, 1) if n is not None]
    for q in {n for n in names if n is not None} | {n.split(" ")[0] for n in names if n is not None}:
        key = q.strip().lower()
        exact = [k for k, n in low if n == key]
        want.update((q, k, 1) for k in exact)
        want.update((q, k, 2) for k, n in low if not exact and key and key in n)
    assert got == want and max(k for _, k, _ in got) > 200


def test_clean_sequence_covers_whole_texts_of_all_languages(spark, tmp_path):
    texts = [("en", "Ab c\n" * 100 + "END"), ("de", "Große Wörter " * 30 + "Ä"), (None, "(ABC)x"), ("fr", ""), ("en", None)]
    spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["sequence"] for r in catalogue.QUERIES["clean_sequence"](spark, str(tmp_path)).collect()}
    assert got == {0: "ABC" * 100 + "ENDMX", 1: "GROSEWÖRTER" * 30 + "ÄMX", 2: "XXMX", 3: "MX", 4: None}


def test_clean_sequence_equals_sql_of_whole_texts(spark, data):
    duck = pytest.importorskip("duckdb")
    sql = rf"""SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(upper(replace(text, 'ß', 's')) || '(MSE)(ABC)', '[\n\r ]', '', 'g'), '(MSE)', 'M'), '\([A-Z]{{3}}\)', 'X', 'g'), '[^\p{{Lu}}]', '', 'g') AS sequence FROM '{data}/documents.parquet'"""
    want = Counter(duck.sql(sql).fetchall())
    assert Counter(tuple(r) for r in catalogue.QUERIES["clean_sequence"](spark, data).collect()) == want
