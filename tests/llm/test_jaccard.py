import random

import pytest

from foldlake.llm import jaccard_join as jj
from foldlake.llm.components import components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None:
                continue
            both = len(sets[i] & sets[j])
            if a == b or sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[find(i)] = min(least.get(find(i), a), a)
    return sorted(((a, len(s), None if a is None else least[find(i)]) for i, ((a, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, groups, copies, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice(words))] + (passage if rng.random() < 0.3 else [])
        for _ in range(rng.randint(1, copies)):
            text = [rng.choice(vocabulary) if rng.random() < rng.choice([0.0, 0.01, 0.03]) else w for w in base]
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize(("seed", "words", "size", "percent"), [(1, [40, 90, 300], 4, 85), (2, [4, 6, 9, 14, 22, 26], 4, 85), (3, [3, 8, 12, 60], 2, 80)])
def test_equals_brute_force(spark, documents, seed, words, size, percent):
    rows = corpus(seed, 30, 6, words)
    got = sorted(map(tuple, jj.link(documents(rows), size, percent).collect()), key=str)
    assert got == brute(rows, size, percent)


def test_large_group_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 16)
    rows = corpus(5, 3, 90, [80])
    got = sorted(map(tuple, jj.link(documents(rows), 4, 85).collect()), key=str)
    assert got == brute(rows, 4, 85)


def test_cases(spark, documents):
    long = " ".join(f"l{i}" for i in range(20_000))
    rows = [(1, "a b"), (2, "A  b"), (3, None), (4, ""), (5, " \n"), (None, "a b"), (6, "a b c"), (7, long), (8, long + " end"), (7, long), (9, "x y z w v"), (9, "other words stand here now")]
    got = sorted(map(tuple, jj.link(documents(rows)).collect()), key=str)
    assert got == brute(rows, 4, 85)
    assert jj.link(documents([])).count() == 0
    kept = jj.keep_one(documents(rows))
    assert kept.columns == documents([]).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, 5, 6, 7, 9, None]


def test_boundary_follows_cost():
    assert 13 <= jj.choose_boundary({8: 1000, 13: 1000}, 2.0, 85) <= 16  # 14 subsets cost less than two scans
    assert jj.choose_boundary({24: 1000}, 1.0, 85) < 24  # 301 subsets cost more than scans of lists without others
    assert jj.choose_boundary({8: 1000}, 50.0, 85) >= 8 > jj.choose_boundary({8: 1000}, 1.0, 85)
    assert jj.subset_sizes(5, 10, 85) == {5} and jj.subset_sizes(7, 13, 85) == {6, 7} and jj.subset_sizes(13, 13, 85) == {12}


def test_subset_sizes_are_what_the_threshold_asks():
    for one in range(1, 25):
        for other in range(one, 25):
            asked = jj.shared_of(one, other, 85)
            for shared in range(one + 1):
                assert (100 * shared >= 85 * (one + other - shared)) == (shared >= asked)


def sets_of(rng, count):
    """Small sets as nodes: groups of equal size with one shingle changed, and of which one shingle was left out."""
    out = []
    for _ in range(count):
        base = [rng.getrandbits(60) for _ in range(rng.choice([6, 7, 9, 12, 13]))]
        changed = [rng.getrandbits(60) if i == 0 else x for i, x in enumerate(base)]
        out += [base, changed, base[1:], base[2:]]
    return [(i, len(v), sorted(v)) for i, v in enumerate(out)]


def test_light_half_links_near_copies(spark):
    nodes = sets_of(random.Random(3), 40)
    got = {tuple(r) for r in jj.light_links(spark.createDataFrame(nodes, "node long, n int, small array<long>"), 13, 85).collect()}
    want = {
        (a, b) for a, na, va in nodes for b, nb, vb in nodes if a < b and 100 * len(set(va) & set(vb)) >= 85 * len(set(va) | set(vb))
    }
    assert want and all(set(nodes[a][2]) != set(nodes[b][2]) for a, b in want)
    assert {(min(p), max(p)) for p in got} <= want
    grouped = lambda pairs: sorted(tuple(sorted(c)) for c in groups_of(pairs))
    assert grouped(got) == grouped(want)


def groups_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    out = {}
    for x in parent:
        out.setdefault(find(x), []).append(x)
    return out.values()


def test_long_lists_make_rows_in_proportion(spark, monkeypatch):
    """One label of 200 and eight others: the 200 meet the others only."""
    monkeypatch.setattr(jj, "BLOCK", 16)
    rows = [(5, i, 100, 208, 1 if i < 200 else 1000 + i) for i in range(208)]
    out = jj.in_blocks(spark.createDataFrame(rows, "key long, node long, n int, c long, label long")).collect()
    met = {(a.node, b.node) for a in out for b in out if (a.i, a.j) == (b.i, b.j) and (a.own, b.own) in ((a.i, a.j), (a.j, a.i))}
    assert all((a, b) in met for a in range(200, 208) for b in range(208) if a != b)
    assert len(out) < 2 * 208


def test_working_tables_are_dropped(spark, documents):
    import os

    from foldlake.llm import common

    at = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(at))
    jj.link(documents(corpus(8, 20, 5, [30, 60]))).count()
    left = {x.split("-")[0] for x in set(os.listdir(at)) - before}
    assert left <= {"assigned", "edges"}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (8, 9), (9, 8)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in parent if find(x) != x}
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
