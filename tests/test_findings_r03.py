"""Cases of round 3's findings."""

import random
import time

from pyspark.sql import functions as F

from foldlake.functions import alignment, text
from foldlake.llm import common, mixing_rates, quality
from foldlake.plans import catalogue, structural  # noqa: F401  structural registers its queries with catalogue


def test_decimals_are_those_of_the_binary_value(spark):
    values = [14.25, 14.35, 14.15, 0.05, 0.25, 0.45, 9.95, 19.95, -0.25, -2.35, 0.0, -0.04, 1.0005, 2.0015, 1234567.85, 1e15 + 0.5, 1e300, 99.9995]
    values += [random.Random(3).randrange(10**7) / 400 for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[text.fixed("v", d).alias(f"d{d}") for d in (1, 2, 3)])
    for row in rows.collect():
        for d in (1, 2, 3):
            if abs(row.v) < 1e12:
                assert row[f"d{d}"] == f"{row.v:.{d}f}", row


def test_chains_of_more_than_9999_numbers_keep_every_residue(spark, tmp_path):
    """Ids beyond 9999 give residues of their own, in the order of the file."""
    rng = random.Random(5)
    rows = [(k + 19998 * r, [rng.uniform(0, 0.3) for _ in range(3)], 0) for r in range(3) for k in range(20)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    ran = {name: catalogue.QUERIES[name](spark, str(tmp_path)).collect() for name in ("residue_counterparts", "epitope_verdict", "pair_measures")}
    own = [v for v, _, _ in rows if v % 2 == 0]
    assert sorted((r.number, r.m_number) for r in ran["residue_counterparts"]) == sorted((v % 9999, v % 9999) for v in own)
    place = {v: [round(x * 10, 3) for x in e] for v, e, _ in rows}
    near = sum(any(sum((a - b) ** 2 for a, b in zip(place[v], place[w])) <= 1.0 for w in place if w % 2) for v in own)
    (verdict,), (pair,) = ran["epitope_verdict"], ran["pair_measures"]
    assert (verdict.num_contacts, verdict.epitope_identity, verdict.epitope_rmsd, verdict.is_consistent) == (near, 100.0, 0.5, True)
    assert (pair.n_pairs, pair.alignment_rmsd, pair.num_contacts, pair.epitope_rmsd) == (len(own), 0.0, near, 0.0)


def test_identities_of_many_pairs_are_those_of_one(spark):
    """Texts of all lengths, among them empty and equal ones, swept together; a batch of short names takes no time for each."""
    rng = random.Random(7)
    some = lambda most: "".join(rng.choice("ACDé") for _ in range(rng.randrange(most)))
    pairs = [(some(most), some(most)) for most in (3, 12, 40, 90) for _ in range(150)]
    pairs += pairs[:50] + [("ACDE" * 300, "DEAC" * 250)]
    assert alignment.identities_of_epitopes(*map(list, zip(*pairs, strict=True))) == [alignment.identity_of_epitopes(a, b) for a, b in pairs]
    names = [("".join(rng.choices("abcdefgh ", k=rng.randrange(6, 13))), "".join(rng.choices("abcdefgh ", k=8))) for _ in range(20000)]
    began = time.process_time()
    alignment.identities_of_epitopes(*map(list, zip(*names, strict=True)))
    together = time.process_time() - began
    began = time.process_time()
    for a, b in names[:500]:
        alignment.identity_of_epitopes(a, b)
    assert together / len(names) < (time.process_time() - began) / 500 / 4


def test_pipeline_fits_to_all_labelled_documents(spark, monkeypatch):
    """Neither the references of keep_good() nor the classifier leave out a labelled document, also beyond one partition's."""
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a b").otherwise("c d").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    assert quality.labelled_good(labels.withColumn("quality", F.lit(1))).count() == 9000
    refs = quality.references(docs, labels.withColumn("quality", F.lit(1))).first()
    assert dict(zip(refs.ref_words, refs.ref_share)) == {w: 0.25 for w in "abcd"}
    assert mixing_rates.labelled_texts(docs, labels).count() == 9000
    p = mixing_rates.posteriors(docs, labels).select("doc_id", F.get("p", F.lit(0)).alias("good")).collect()
    assert len(p) == 9000 and all((r.good > 0.5) == (r.doc_id % 2 == 0) for r in p)
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    assert mixing_rates.labelled_texts(docs, labels).count() == 9000 and quality.references(docs, labels).count() == 1
