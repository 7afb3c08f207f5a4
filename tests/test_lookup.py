import random

from pyspark.sql import functions as F

from foldlake.operators import lookup


def test_holding_equals_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    names = [text(rng.randint(0, 20)) for _ in range(120)] + [None]
    keys = [text(rng.randint(0, 11)) for _ in range(80)] + [None, "not there at all", names[3], "ab"]
    out = lookup.holding(spark.createDataFrame([(k,) for k in keys], "k string"), spark.createDataFrame([(n,) for n in names], "n string"), "k", "n")
    want = {(k, n) for k in keys if k for n in names if n and k in n}
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_tiers_meet_in_equi_joins(spark):
    left = spark.createDataFrame([("Alpha",), ("beta chain",), ("zeta",), ("",), (None,)], "k string")
    right = spark.createDataFrame([(1, "alpha "), (2, "alphabet"), (3, "the beta chain of x"), (4, None)], "i int, n string")
    out = lookup.tiered(left, right, "k", "n")
    assert sorted((r.k, r.i, r.tier) for r in out.collect()) == [("Alpha", 1, 1), ("beta chain", 3, 2)]
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names_that_begin_alike_are_met_by_their_rarest_piece(spark):
    names = spark.range(3000).selectExpr("concat('receptor protein ', id, ' chain') AS n")
    keys = spark.createDataFrame([("protein 17 chain",), ("receptor protein 2999",), ("receptor protein x",), ("receptor",)], "k string")
    out = lookup.holding(keys, names, "k", "n")
    got = {}
    for r in out.collect():
        got[r.k] = got.get(r.k, 0) + 1
    assert got == {"protein 17 chain": 1, "receptor protein 2999": 1, "receptor": 3000}
