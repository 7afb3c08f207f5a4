"""Each stage of the pipeline against brute force over its own input, and on odd rows."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from foldlake.llm import mixing_rates, quality, token_records
from tests.llm.test_jaccard import brute

STAGES = dict(cp.STAGES)


def words(rng, n):
    return [rng.choice("bdfgklmnprst") + rng.choice("aeiou") + rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents, labels and benchmark: near copies, junk, leaks, nulls, repeated ids, and columns whose names clash."""
    at, rng = str(tmp_path_factory.mktemp("pipeline")), random.Random(4)
    items = [" ".join(words(rng, 24)) for _ in range(3)]
    rows, kinds = [], {}
    for i in range(60):
        text = words(rng, 90)
        kind = ("clean", "copy", "junk", "leak", "short")[i % 5]
        if kind == "junk":
            text = ["zz zz zz"] * 40
        if kind == "leak":
            text[30:30] = items[i % 3].split()
        rows.append((i, " ".join(text[:20] if kind == "short" else text), "en", "s"))
        kinds[i] = kind
        if kind == "copy":
            rows.append((100 + i, " ".join([*text[:-2], "other", "end"]), "en", "s"))
            kinds[100 + i] = "copied"
    odd = [(900, None, None, None), (901, "", "en", None), (None, " ".join(words(rng, 70)), "en", "s"), rows[0], (902, " ".join(words(rng, 4000)), None, "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    for name in ("kept", "node", "label", "p", "words", "id", "_leak", "n_chars"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{at}/documents.parquet")
    labels = [(i, int(kinds[i] != "junk"), 0) for i in range(60)]
    spark.createDataFrame([*labels, (None, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, kinds, items


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def run(spark, folder, stage, docs=None):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet") if docs is None else docs
    return docs, STAGES[stage](spark, docs, folder[0])


def test_quality_rules(spark, folder):
    docs, out = run(spark, folder, "quality_rules")
    assert out.columns == docs.columns

    def good(text):
        found = (text or "").split()
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        twice = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
        return len(found) >= 50 and 100 * len(twice) <= 50 * len(found)

    assert rows_of(out) == [x for x in rows_of(docs) if good(x[1])]  # the junk fails the base rules; nothing else strays


def test_quality_rules_by_distance(spark, tmp_path):
    """Texts that pass the base rules but are far from the references of their language go, as the rules' SQL says."""
    rng, at = random.Random(8), str(tmp_path)
    common_words = "the of and to in that is was he for it with as his on be at by had not".split()
    good = [(i, " ".join(rng.choice((rng.choice(common_words), words(rng, 1)[0])) for _ in range(120)), "en", "s") for i in range(30)]
    shouted = [(100 + i, " ".join(w.upper() + str(rng.randint(10, 999)) for w in words(rng, 90)), "en", "s") for i in range(6)]
    marked = [(200 + i, " ".join(f"#{w}|${rng.randint(1, 99)}" for w in words(rng, 90)), "en", "s") for i in range(6)]
    other = [(300, shouted[0][1], "xx", "s"), (301, shouted[1][1], None, "s"), (302, " ".join(words(rng, 90)), "en", "s"), (303, None, "en", "s")]
    spark.createDataFrame(good + shouted + marked + other, "doc_id long, text string, lang string, source string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality long, toxic long").write.parquet(f"{at}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
    want = con.sql(f"SELECT doc_id, base_failed, kept FROM ({quality.OP4_SQL})").fetchall()
    _, out = run(spark, [at], "quality_rules", spark.read.parquet(f"{at}/documents.parquet"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, _, kept in want if kept)
    by_distance = {i for i, failed, kept in want if not failed and not kept}
    assert by_distance == {r[0] for r in shouted + marked}


def test_near_duplicates(spark, folder):
    docs, out = run(spark, folder, "near_duplicates")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    first = {(a, c) for a, _, c in brute(rows, cp.SHINGLE, cp.PERCENT)}
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    assert out.columns == docs.columns
    assert ids == sorted({a for a, c in first if a is not None and a == c} | {None}, key=str)


def test_decontamination(spark, folder):
    docs, out = run(spark, folder, "decontamination")
    leaks = {i for i, kind in folder[1].items() if kind == "leak"}
    assert rows_of(out) == [x for x in rows_of(docs) if x[0] not in leaks]


def brute_rates(tokens, p):
    """Rates of the mixture without repetition by projected gradient over the documents themselves, without cells."""
    mass = tokens @ p
    share = np.array([mixing_rates.WEIGHTS[d] for d in mixing_rates.DOMAINS])
    target = np.minimum(mass[0] / share[0] * share, mass) * [mixing_rates.SLACK, 1, 1]
    gram = (p * tokens[:, None]).T @ p
    scale = np.maximum(np.diag(gram), 1)
    step = 1 / (gram / np.sqrt(np.outer(scale, scale))).sum(1).max()
    rate, last = np.ones(len(p)), np.inf
    for _ in range(mixing_rates.ITERATIONS):
        gap = (tokens * rate) @ p - target
        error = (gap**2 / scale).sum()
        if last - error <= 1e-6 * last < np.inf:
            break
        rate, last = np.clip(rate - p @ (step * gap / scale), 0, 1), error
    return rate


def test_mixing(spark, folder):
    docs, out = run(spark, folder, "mixing")
    labels = spark.read.parquet(f"{folder[0]}/labels.parquet")
    scored = mixing_rates.posteriors(docs, labels).withColumn("u", mixing_rates.uniform()).collect()
    tokens, p = np.array([r.n_tokens for r in scored], float), np.array([r.p for r in scored])
    assert sorted(r.n_tokens for r in scored) == sorted(len((r.text or "").split()) for r in docs.collect())
    told = [(r.doc_id, x - r.u) for r, x in zip(scored, brute_rates(tokens, p), strict=True)]
    near = 3 / mixing_rates.GRID
    surely_lost = {i for i, above in told if above < -near}
    surely_kept = {i for i, above in told if above > near} - {i for i, above in told if above <= near}
    got = {r.doc_id for r in out.collect()}
    assert surely_lost and not got & surely_lost and surely_kept <= got
    assert len(surely_lost | surely_kept) >= 0.95 * len({i for i, _ in told})  # next to all decisions are told by brute force
    assert [x for x in rows_of(docs) if x[0] in got] == rows_of(out)  # rows of one id share their fate
    assert sum(x is not None for x in got) >= 40  # most text is clean, and clean text stays


def test_tokens(spark, folder):
    docs, out = run(spark, folder, "tokens")
    plain, start, want = Tokenizer.from_file(token_records.default_tokenizer()), 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "tokens" or out.columns == docs.columns)
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_stages_follow_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, folder[0])
        docs = out.persist() if name != "tokens" else docs
    assert sorted(map(tuple, cp.run(spark, folder[0]).collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_stages_leave_short_plans_with_the_driver(spark, folder):
    """The driver keeps a plan's text for each job that a stage runs; it may not grow with the steps that the mixture takes."""
    kept, names = spark._jsparkSession.sharedState().statusStore(), ("spark.sql.maxPlanStringLength", "spark.sql.adaptive.enabled")
    settings = [spark.conf.get(name, None) for name in names]
    for stage in ("near_duplicates", "mixing"):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        last = max((x.executionId() for x in executions(kept)), default=-1)
        run(spark, folder, stage)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        sizes = [len(x.physicalPlanDescription()) for x in executions(kept) if x.executionId() > last]
        assert len(sizes) > 5 and max(sizes) < 10_000
    assert [spark.conf.get(name, None) for name in names] == settings


def executions(store):
    found = store.executionsList()
    return [found.apply(i) for i in range(found.size())]
