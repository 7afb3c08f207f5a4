"""Mixing sources to target weights with soft membership.

A classifier trained on labelled documents predicts, for every document, the posterior of each domain. Projected-gradient
least squares then fits a nonnegative rate for each document so that the expected tokens of the domains, sums of rate *
tokens * posterior, match the targets. As a rate depends on the posteriors only, the fit runs over cells of a fixed grid of
posteriors, with their tokens and mean posteriors, so documents are read once; each document then goes through the same
steps with its own posteriors. Everything is DataFrame functions and Spark's own DataFrame estimators, and the driver
sees only sums over domains.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

DOMAINS = ("good", "poor", "toxic")
#: Shares of the mixture's expected tokens: mostly good text; a little poor text, as it is what users write; of toxic text
#: no more than what lets a model recognise it.
WEIGHTS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}
#: Labelled documents in a partition of the classifier's input, which is all of them. One partition gives the same model in
#: every run, several may add up in another order, so that posteriors differ in their last digits.
LABELLED_TOGETHER = 8192
FEATURES, LEAST_TEXTS = 512, 5
ITERATIONS, TOLERANCE = 60, 1e-7
#: Gradient steps after which the driver may collect the garbage of their plans.
SPARED = 8
#: Steps of the grid of posteriors along each domain; its cells number (GRID + 1) * (GRID + 2) / 2 at most.
GRID = 512
#: In sampling without repetition, the main domain's target is set so far above its tokens that its rates reach 1.
SLACK = 1.02
_BREAK = r"[ \t\n\x0B\f\r]+"


def domain() -> Column:
    """A label row's domain, as its place in DOMAINS."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)


def telling_words(sample: DataFrame, most: int = FEATURES) -> list[str]:
    """The words of the labelled texts (words, label) whose presence says most about the domain (by the G statistic),
    of those in LEAST_TEXTS texts or more; at most FEATURES."""
    k = range(len(DOMAINS))
    texts = dict(sample.groupBy(F.col("label").cast("int")).count().collect())
    each = sample.select(F.col("label").cast("int").alias("label"), F.explode(F.array_distinct("words")).alias("word"))
    counts = each.groupBy("word").agg(*[F.sum((F.col("label") == i).cast("long")).alias(f"n{i}") for i in k])
    total, found, gain = sum(texts.values()), F.col("n0") + F.col("n1") + F.col("n2"), F.lit(0.0)
    for i in k:
        if texts.get(i):
            share = texts[i] / total
            for seen, wanted in ((F.col(f"n{i}"), found * share), (F.lit(texts[i]) - F.col(f"n{i}"), (F.lit(total) - found) * share)):
                gain = gain + F.when(seen > 0, seen * F.log(seen / wanted)).otherwise(0.0)
    rows = counts.where(found >= LEAST_TEXTS).select("word", gain.alias("gain")).orderBy(F.desc("gain"), "word").limit(most)
    return [r.word for r in rows.collect()]


def with_words(docs: DataFrame) -> DataFrame:
    """docs with words, n_tokens and share (of capitals and marks in the text) instead of text."""
    text = common.text_or_empty()
    marks = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z#*$%&|<>!]+", ""))
    docs = docs.withColumn("words", F.array_remove(F.split(text, _BREAK), "")).withColumn("n_tokens", F.size("words").cast("long"))
    return docs.withColumn("share", marks / F.greatest(F.char_length(text), F.lit(1))).drop("text")


def featurize(rows: DataFrame, words: list[str]) -> DataFrame:
    """rows with features (presence of words, and share) instead of words and share."""
    found = CountVectorizerModel.from_vocabulary(words or ["\n"], inputCol="words", outputCol="present").setBinary(True)
    df = VectorAssembler(inputCols=["present", "share"], outputCol="features").transform(found.transform(rows))
    return df.drop("words", "share", "present")


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, label, place for all labelled documents. Of several labels of a document the toxic, then the poor one counts."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    known = known.select(F.col("doc_id").alias("l_id"), domain().cast("double").alias("label")).where("label IS NOT NULL")
    known = common.materialize(known, "labels-known")
    rows = docs.select("doc_id", "text").join(common.small_side(known, known.count()), F.col("doc_id") == F.col("l_id"))
    return rows.select("text", "label", F.md5(common.text_or_empty()).alias("place"))


def posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, p (posteriors in the order of DOMAINS) for every row of docs.

    If labels have one domain only, it has all the mass; if there are none, the mass is equal. Null texts are empty.
    """
    sample = common.materialize(with_words(labelled_texts(docs, labels)), "labelled")
    counted = sample.groupBy("label").count().collect()
    found, parts = [int(r.label) for r in counted], -(-sum(r["count"] for r in counted) // LABELLED_TOGETHER)
    rows = docs.select("doc_id", "text")
    if len(found) < 2:
        mass = [1.0 / len(DOMAINS) if not found else float(k in found) for k in range(len(DOMAINS))]
        words = F.size(F.array_remove(F.split(common.text_or_empty(), _BREAK), "")).cast("long")
        return rows.select("doc_id", words.alias("n_tokens"), F.array(*map(F.lit, mass)).alias("p"))
    words = telling_words(sample)
    # In one order, as sums of another order would lead to another model.
    in_order = common.materialize(featurize(sample, words).select("place", "features", "label"), "labelled-features")
    in_order = in_order.coalesce(1) if parts == 1 else in_order.repartition(parts, "place", "label")
    in_order = in_order.sortWithinPartitions("place", "label").select("features", "label")
    learner = LogisticRegression(maxIter=60, regParam=1e-3, family="multinomial", standardization=False)
    model = learner.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_p").fit(in_order)
    scored = model.transform(featurize(with_words(rows), words)).select("doc_id", "n_tokens", vector_to_array("_p").alias("p"))
    lacking = F.lit(0.0)
    return scored.withColumn("p", F.transform(F.sequence(F.lit(0), F.lit(len(DOMAINS) - 1)), lambda k: F.coalesce(F.get("p", k), lacking)))


def targets_of(totals: list[float], weights: dict[str, float], budget: float | None, most: float | None) -> list[float]:
    """Expected tokens wanted of each domain. Without a budget, it is what lets the domain of most weight keep all its
    tokens; with a largest rate, no target is above what that rate can give, but for the main domain's SLACK."""
    shares = [weights[d] / sum(weights.values()) for d in DOMAINS]
    main = max(range(len(shares)), key=shares.__getitem__)
    budget = totals[main] / shares[main] if budget is None else budget
    out = [budget * share for share in shares]
    if most is not None:
        out = [min(t, most * total) for t, total in zip(out, totals, strict=True)]
        out[main] = min(out[main] * SLACK, budget * shares[main] * SLACK)
    return out


def _rate(p: list[Column], moves: list[list[float]], most: float | None) -> Column:
    """The rate after the gradient steps, from 1 on: each moves it along the posteriors, and back to 0 (to most)."""
    if not moves:
        return F.lit(1.0)
    steps = F.array(*[F.array(*map(F.lit, move)) for move in moves])

    def stepped(rate: Column, move: Column) -> Column:
        moved = rate - sum((F.get(move, F.lit(i)) * p[i] for i in range(len(p))), F.lit(0.0))
        moved = F.greatest(moved, F.lit(0.0))
        return moved if most is None else F.least(moved, F.lit(float(most)))

    return F.aggregate(steps, F.lit(1.0), stepped)


def cells_of(scored: DataFrame) -> DataFrame:
    """tokens, q0, q1...: tokens and mean posteriors, weighted by tokens, of each cell of the grid that holds documents."""
    k = range(len(DOMAINS))
    tokens = F.col("n_tokens").cast("double")
    places = [F.round(F.get("p", F.lit(i)) * GRID).alias(f"at{i}") for i in k]
    sums = [F.sum(tokens * F.get("p", F.lit(i))).alias(f"q{i}") for i in k]
    found = scored.where("n_tokens > 0").groupBy(*places).agg(F.sum(tokens).alias("tokens"), *sums)
    return found.select("tokens", *[(F.col(f"q{i}") / F.col("tokens")).alias(f"q{i}") for i in k])


def fit_rates(scored: DataFrame, weights: dict[str, float], budget: float | None = None, most: float | None = None) -> DataFrame:
    """scored (doc_id, n_tokens, p) with rate: minimises the squared gaps to the targets, each domain's scaled by its
    tokens, from rate 1 on by projected gradient steps onto rates of 0 (to most).

    Expected totals are exact while no rate is cut off. Where rates are, a cell's documents count as if all had its mean
    posteriors; within a cell these differ by 1 / GRID at most.
    """
    k = range(len(DOMAINS))
    scored = common.materialize(scored, "posteriors")
    cells = common.materialize(cells_of(scored), "cells")
    q, tokens = [F.col(f"q{i}") for i in k], F.col("tokens")

    def sums(columns: list[Column]) -> list[float]:
        return [float(x or 0.0) for x in common.small_sums(cells, [F.sum(c) for c in columns])]

    totals = sums([tokens * q[i] for i in k])
    gram = sums([tokens * q[i] * q[j] for i in k for j in k])
    scale = [max(gram[i * len(k) + i], 1.0) for i in k]
    # The scaled Gram matrix has nonnegative entries, so its largest row sum bounds its eigenvalues.
    step = 1.0 / max(1e-9, max(sum(gram[i * len(k) + j] / (scale[i] * scale[j]) ** 0.5 for j in k) for i in k))
    wanted = targets_of(totals, weights, budget, most)
    moves: list[list[float]] = []
    last = None
    while len(moves) < ITERATIONS:
        if len(moves) % SPARED == 0:
            common.spare_driver(scored.sparkSession)
        rate = _rate(q, moves, most)
        gaps = [a - b for a, b in zip(sums([tokens * q[i] * rate for i in k]), wanted, strict=True)]
        error = sum(g * g / s for g, s in zip(gaps, scale, strict=True))
        if error <= TOLERANCE**2 * sum(scale) or last is not None and last - error <= 1e-6 * last:
            break
        last = error
        moves.append([step * gaps[i] / scale[i] for i in k])
    common.drop(cells)
    return scored.withColumn("rate", _rate([F.get("p", F.lit(i)) for i in k], moves, most))


def uniform() -> Column:
    """A number in [0, 1) that the doc_id determines."""
    return F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 53)).cast("double") / float(1 << 53)


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, budget: float | None = None, most: float | None = None) -> DataFrame:
    """doc_id, n_tokens, p_good, p_poor, p_toxic, rate, copies for every row of docs.

    copies is the rate rounded up or down at random, by the doc_id, so that its expectation is the rate; rows with the
    same doc_id, and those without, are rounded alike. Other columns are ignored. Empty tables give an empty result.
    """
    fitted = fit_rates(posteriors(docs, labels), weights, budget, most)
    shares = [F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return fitted.select("doc_id", "n_tokens", *shares, "rate", F.floor(F.col("rate") + uniform()).cast("long").alias("copies"))


def sample(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The rows of docs that a mixture without repetition draws, with their columns unchanged.

    Rates are at most 1, the main domain keeps all it can, and a row is drawn if its rate exceeds the number that its
    doc_id determines. Rows without doc_id, and rows with the same, share their fate by doc_id and lowest rate.
    """
    fitted = fit_rates(posteriors(docs, labels), weights, most=1.0)
    name = common.free_name(docs, "_gone")
    gone = fitted.where(F.col("rate") <= uniform()).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti").select(*docs.columns)


def op10_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents at the default weights; mix() says what odd rows give."""
    return mix(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
