"""Known values of the scalar functions and kernels, and properties of them."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldlake.functions import alignment, residues, text
from foldlake.functions.superpose import kabsch, refined, superpose
from foldlake.operators import contacts
from foldlake.operators.contacts import counts_within, pairs_within, rows_within
from foldlake.operators.summary import paired_rmsd

SEQ = st.text(alphabet="ACDG", max_size=9)


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("ACDEFGHIKLMNPQRSTVWY", "ACDEFGHIKLMNPQRSTVWY", 100.0), ("AAAAA", "GGGGG", 0.0), ("AAAA", "AAGA", 75.0), ("", "AA", 0.0), ("AA", "", 0.0), ("", "", 0.0), ("AAAAAA", "AAAA", 100.0)],
)
def test_epitope_identity(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(alignment.affine_identity("a", "b")).first()[0] == want


@given(SEQ, SEQ)
@settings(max_examples=60, deadline=None)
def test_lcs_is_symmetric_and_bounded(a, b):
    n = alignment.lcs_length(a, b)
    assert n == alignment.lcs_length(b, a) <= min(len(a), len(b))
    assert alignment.lcs_length(a, a) == len(a)


@given(SEQ, SEQ)
@settings(max_examples=60, deadline=None)
def test_affine_pairs_ascend(a, b):
    pairs = alignment.affine(a, b, 2.0, -1.0, -10.0, -0.5)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("A | B", "1.5", "ab/c d-é_1", "x/1_Antibody.cif", "4abc_2", "(MSE)AC\n(ABC)d", "12"), (None, "2.5d", "", "x/a.b.cif", "4abc", None, "x")],
        "c string, n string, s string, f string, e string, q string, i string",
    )
    got = df.select(
        text.chain_list("c").alias("chains"),
        text.first_chain("c").alias("first"),
        text.number_or_null("n").alias("n"),
        text.sanitize("s").alias("s"),
        text.component_label("f").alias("f"),
        text.entity_parts("e").alias("e"),
        residues.clean_sequence("q").alias("q"),
        text.sequence_number("i").alias("i"),
    ).collect()
    assert tuple(got[0]) == (["A", "B"], "A", 1.5, "ab_c_d-é_1", "antibody", ["4abc", "2"], "MACX", 11)
    assert tuple(got[1]) == (None, None, None, "Human", "a.b", None, None, None)


def test_positional_identity(spark):
    df = spark.createDataFrame([("AAAA", "AAGA"), ("AB", "ABCD"), ("", "A"), (None, "A")], "a string, b string")
    assert [r[0] for r in df.select(residues.positional_identity("a", "b")).collect()] == [75.0, 50.0, 0.0, 0.0]


def test_superposition_recovers_a_motion(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(12, 3))
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    moved = points @ q.T + [1.0, -2.0, 3.0]
    rotation, shift, rmsd = kabsch(points, moved)
    assert np.allclose(rotation, q) and np.allclose(shift, [1, -2, 3]) and rmsd < 1e-9
    df = spark.createDataFrame([("p", *map(float, a), *map(float, b)) for a, b in zip(points, moved)] + [("few", 0.0, 0.0, 0.0, 1.0, None, 0.0)], "k string, x double, y double, z double, fx double, fy double, fz double")
    got = {r.k: r for r in superpose(df, "k").collect()}
    assert got["p"].n == 12 and got["p"].rmsd < 1e-9
    assert got["few"].n == 0 and got["few"].rmsd is None


@pytest.mark.parametrize("distance", [0.4, 1.0, 3.0])
def test_grid_join_equals_brute_force(spark, distance):
    rng = np.random.default_rng(3)
    a, b = rng.uniform(-2, 2, (60, 3)), rng.uniform(-2, 2, (50, 3))
    left = spark.createDataFrame([(int(i % 2), int(i), *map(float, p)) for i, p in enumerate(a)] + [(0, 999, None, 0.0, 0.0)], "k int, i int, ax double, ay double, az double")
    right = spark.createDataFrame([(int(i % 2), int(i), *map(float, p)) for i, p in enumerate(b)], "k int, j int, bx double, by double, bz double")
    want = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if i % 2 == j % 2 and ((p - q) ** 2).sum() <= distance**2}
    args = ("k", ("ax", "ay", "az"), ("bx", "by", "bz"), distance)
    assert {(r.i, r.j) for r in pairs_within(left, right, *args).collect()} == want
    near = [r.i for r in rows_within(left, right, *args).collect()]
    assert sorted(near) == sorted({i for i, _ in want})
    counts = {r.i: r.n for r in counts_within(left, right, "k", "i", *args[1:]).collect()}
    assert counts[999] == 0 and all(counts[i] == sum(x == i for x, _ in want) for i in range(60))


def test_grid_at_its_edges(spark):
    """Pairs at the very distance and on the borders of cells, coordinates that are no numbers, and a distance of 0."""
    step = [i * 0.1 for i in range(-25, 26)]
    left = spark.createDataFrame([("s", i, x, 0.0, 0.0) for i, x in enumerate(step)] + [("s", 900 + i, x, 0.0, 0.0) for i, x in enumerate((math.inf, -math.inf, math.nan, 1e300))], "k string, i int, ax double, ay double, az double")
    right = left.withColumnsRenamed({"i": "j", "ax": "bx", "ay": "by", "az": "bz"})
    for distance in (0.1, 0.5, 0.7):
        want = {(i, j) for i, x in enumerate(step) for j, y in enumerate(step) if (x - y) ** 2 <= distance**2}
        args = ("k", ("ax", "ay", "az"), ("bx", "by", "bz"), distance)
        assert {(r.i, r.j) for r in pairs_within(left, right, *args).collect()} == want
        assert {r.i for r in rows_within(left, right, *args).collect()} == {i for i, _ in want}
    none = ("k", ("ax", "ay", "az"), ("bx", "by", "bz"), 0.0)
    assert {(r.i, r.j) for r in pairs_within(left, right, *none).collect()} == {(i, i) for i in (*range(51), 903)}
    assert rows_within(left, right, *none).count() == 52


def test_grid_leaves_out_far_corners_and_stands_a_crowded_cell(spark):
    points = spark.range(40000).select(F.lit("s").alias("k"), F.col("id").alias("i"), *[F.rand(n).alias(c) for n, c in enumerate(("ax", "ay", "az"))])
    far = points.select("k", *[F.col(c).alias(d) for c, d in (("ax", "bx"), ("ay", "by"), ("az", "bz"))])
    _, copied, on = contacts._gridded(points, far, "k", ("ax", "ay", "az"), ("bx", "by", "bz"), 1.0)
    assert copied.count() <= 21 * 40000 and len(on) == 4
    assert rows_within(points, far, "k", ("ax", "ay", "az"), ("bx", "by", "bz"), 0.5).count() == 40000


def test_rmsd_of_same_point_is_zero(spark):
    df = spark.createDataFrame([("s", 1, 1.0, 2.0, 3.0)], "k string, o int, x double, y double, z double")
    assert paired_rmsd(df, df, "k", "o", ("x", "y", "z")).first().rmsd == 0.0
    far = df.withColumn("x", F.lit(2.0))
    assert math.isclose(paired_rmsd(df, far, "k", "o", ("x", "y", "z")).first().rmsd, 1.0)


def best_score(a, b, match, mismatch, opening, extending):
    """The greatest score of a global alignment, by its three states."""
    low = -1e9
    last = {(0, 0): (0.0, low, low)}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if (i, j) == (0, 0):
                continue
            both = max(last[i - 1, j - 1]) + (match if a[i - 1] == b[j - 1] else mismatch) if i and j else low
            up = max(last[i - 1, j][0] + opening, last[i - 1, j][1] + extending, last[i - 1, j][2] + opening) if i else low
            left = max(last[i, j - 1][0] + opening, last[i, j - 1][2] + extending, last[i, j - 1][1] + opening) if j else low
            last[i, j] = (both, up, left)
    return max(last[len(a), len(b)])


def score_of(a, b, pairs, match, mismatch, opening, extending):
    """The score of an alignment given by its pairs; between two pairs stand at most one gap of each side."""
    total, ends = 0.0, [(-1, -1), *pairs, (len(a), len(b))]
    for (i, j), (k, m) in zip(ends, ends[1:]):
        for gap in (k - i - 1, m - j - 1):
            total += opening + extending * (gap - 1) if gap else 0.0
    return total + sum(match if a[i] == b[j] else mismatch for i, j in pairs)


@given(st.text("ACD", max_size=9), st.text("ACD", max_size=9), st.sampled_from([(2.0, -1.0, -10.0, -0.5), (1.0, 0.0, -1.0, -0.5), (2.0, -1.0, -1.5, -0.25)]))
@settings(max_examples=300, deadline=None)
def test_affine_alignment_is_a_best_one(a, b, scores):
    if a and b:
        pairs = alignment.affine(a, b, *scores)
        assert abs(score_of(a, b, pairs, *scores) - best_score(a, b, *scores)) < 1e-6


def test_outliers_are_rejected(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(0, 5, (60, 3))
    turn = np.array([[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]])
    moved = points @ turn.T + [1.0, 2.0, 3.0] + rng.normal(0, 0.05, (60, 3))
    moved[::9] += rng.normal(0, 20, (7, 3))
    whole = kabsch(points, moved)[2]
    rotation, shift, rmsd, kept = refined(points, moved, 20, 3.0)
    assert whole > 3 and rmsd < 0.15 and not kept[::9].any() and kept.sum() == 53
    assert np.allclose(rotation, turn, atol=0.02) and np.allclose(shift, [1, 2, 3], atol=0.1)
    assert refined(points, moved, 0, 2.0)[3].all()
    few = refined(points[:3], moved[:3], 9, 0.1)
    assert few[3].all()  # three pairs always stay
    df = spark.createDataFrame([("p", *map(float, a), *map(float, b)) for a, b in zip(points, moved)], "k string, x double, y double, z double, fx double, fy double, fz double")
    row = superpose(df, "k", 20, 3.0).first()
    assert (row.n, row.kept) == (60, 53) and row.rmsd < 0.15


@given(st.text("ACDE", max_size=40), st.text("ACDE", max_size=40), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_alignment_in_blocks_is_the_same(a, b, size):
    before = alignment.ONE_BLOCK
    once = alignment.affine(a, b, 2.0, -1.0, -3.0, -0.5)
    try:
        alignment.ONE_BLOCK = -1 if size else before
        assert alignment.affine(a, b, 2.0, -1.0, -3.0, -0.5) == once
    finally:
        alignment.ONE_BLOCK = before


def test_long_alignment_in_little_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    a = "".join(rng.choice(list("ACDEFGHIKL"), 9000))
    b = a[:4000] + "W" * 50 + a[4100:]
    tracemalloc.start()
    pairs = alignment.affine(a, b, 2.0, -1.0, -10.0, -0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 and sum(a[i] == b[j] for i, j in pairs) >= 8900
