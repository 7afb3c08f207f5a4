"""Repeated passages against brute force over all strings of a length, and the query against SQL."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foldlake.llm import repeats


def brute(rows, length):
    """doc_id, n_bytes, n_removed, n_spans and digest of each row, from a count of all strings."""
    texts = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, *_), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, alphabet, words, length):
    """Texts with passages near the length, edited copies, exact copies and runs of few bytes."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(words)]
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [fresh(60)[: length + rng.randint(-3, length)] for _ in range(12)]
    rows = []
    for _ in range(60):
        parts = [fresh(rng.randint(0, 60)) for _ in range(rng.randint(1, 4))]
        for at in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            if rng.random() < 0.4:
                i = rng.randrange(len(passage))
                passage = passage[:i] + rng.choice(alphabet) + passage[i + rng.randint(0, 1) :]
            parts.insert(rng.randrange(len(parts) + 1), passage)
        text = rng.choice(("", " ", "\n")).join(parts)
        rows += [(len(rows), text)] * rng.choice((1, 1, 1, 1, 2, 3))
    rows += [(900, "a" * (5 * length)), (901, "x" + "a" * (length - 1)), (902, "ab" * (2 * length)), (903, "a" * length), (904, "abc" * length + "-" + "abc" * length)]
    return rows


@pytest.mark.parametrize(("seed", "alphabet", "words", "length"), [(1, "abcdefgh", 300, 40), (2, "ab", 30, 25), (3, "aé√bcde", 400, 60), (4, "abcdefghijkl", 500, 13), (5, "abcdefgh", 800, 400)])
def test_equals_brute_force(spark, documents, monkeypatch, seed, alphabet, words, length):
    monkeypatch.setattr(repeats, "SHARD", 500)
    rows = corpus(seed, alphabet, words, length)
    assert result(repeats.summarize(documents(rows).repartition(5), length)) == brute(rows, length)


def test_blocks_that_are_not_followed_to_their_end(spark, documents, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_PHRASES", 2)
    rows = corpus(6, "abcdef", 200, 90)
    assert result(repeats.summarize(documents(rows).repartition(3), 90)) == brute(rows, 90)


def test_odd_rows(spark, documents):
    long = " ".join(f"word{i * 7919 % 10007}" for i in range(40_000))
    rows = [(1, None), (2, ""), (None, "short"), (None, None), (3, long), (3, long[100_000:101_000] + "!"), (4, "x" * 399), (5, "x" * 400), (5, "x" * 400), (None, "y" * 401)]
    got = result(repeats.summarize(documents(rows)))
    assert got == brute(rows, 400)
    assert repeats.summarize(documents([])).count() == 0
    spans = {r.n_removed: [tuple(s) for s in r.spans] for r in repeats.find(documents(rows)).collect()}
    assert spans[1000] in ([(100_000, 101_000)], [(0, 1000)]) and spans[400] == [(0, 400)]


def test_recovers_after_any_order_of_texts(spark, documents):
    rows = corpus(7, "abcdefgh", 250, 50)
    once = result(repeats.summarize(documents(rows).repartition(7), 50))
    random.Random(1).shuffle(rows)
    assert once == result(repeats.summarize(documents(rows).coalesce(1), 50))


@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_steps_follow_the_transform(symbols, cut):
    """Blocks that grow by their transform count the same phrases as a search of the texts does."""
    texts = [symbols[i : i + 7] for i in range(0, len(symbols), 7)]
    ring = np.array([x for t in texts for x in (*t, 0)], np.uint64)
    order = repeats.transform(ring)
    shard = repeats.Shard(np.roll(ring, 1)[order], np.ones(len(ring), np.int32))
    now, depth = shard.phrases(), 1
    while len(now[0]):
        want = Counter(tuple(t[i : i + depth]) for t in texts for i in range(len(t) - depth + 1))
        assert sorted(now[3] - now[2]) == sorted(want.values())
        now, depth = shard.extended(*now), depth + 1


def test_anchors_depend_on_content_only():
    rng = np.random.default_rng(3)
    span, gram = repeats.shape(90)
    passage = rng.integers(97, 100, 300).astype(np.uint8)
    found = []
    for before in (0, 13, 200):
        data = np.concatenate([rng.integers(97, 100, before).astype(np.uint8), passage, rng.integers(97, 100, 50).astype(np.uint8)])
        found.append(repeats.least_places(data, span, gram)[before : before + 300 - span - gram + 1] - before)
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


def test_slices_change_nothing(monkeypatch):
    data = np.random.default_rng(4).integers(97, 101, 5000).astype(np.uint8)
    starts = np.arange(0, 4900, 3)
    once = repeats.least_places(data, 30, 8), repeats.hashes(data, starts, starts + 77)
    monkeypatch.setattr(repeats, "SLICE", 777)
    again = repeats.least_places(data, 30, 8), repeats.hashes(data, starts, starts + 77)
    assert all((a == b).all() for a, b in zip(once, again))
    assert len(np.unique(once[1])) == len({data[i : i + 77].tobytes() for i in starts})
    grams = [data[i : i + 8].tobytes() for i in range(4993)]
    assert all(grams[p] in grams[i : i + 30] and i <= p < i + 30 for i, p in enumerate(once[0][:500]))


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = repeats.op12_repeat_removal(spark, data)
    want = con.execute(repeats.OP12_SQL)
    assert [x[0] for x in want.description] == got.columns
    assert result(got) == sorted(want.fetchall(), key=str)


def test_rows_lists_are_arrays():
    """Lists come to Python as arrays, not as lists of objects; null and empty ones have no rows, and slices are kept."""
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    whole = pa.RecordBatch.from_pydict(
        {
            "k1": pa.array([1, 2, 3]),
            "places": pa.array([[9], [1, 2], None], pa.list_(pa.int32())),
            "wide": pa.array([None, [{"start": 3, "end": 4}, {"start": 5, "end": 6}], []], pa.list_(pair)),
        }
    )
    got = list(repeats._rows(iter([whole.slice(1)])))
    assert [r["k1"] for r in got] == [2, 3]
    assert got[0]["places"].tolist() == [1, 2] and got[1]["places"].tolist() == []
    assert got[0]["wide"].tolist() == [[3, 4], [5, 6]] and got[1]["wide"].shape == (0, 2)


def test_anchors_of_a_text_are_sought_only_where_windows_are_asked_for():
    row = {"copies": 1, "text": b"some words " * 60, "places": np.array([0]), "reach": np.array([450])}
    own = repeats.Windows(row, 400)
    own.remove(np.array([500]), np.array([510]))
    assert own.removed.sum() == 460 and "least" not in vars(own)
    assert len(own.first) == 660 - 399


def test_judged_cells_equal_their_definition(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(6)), [None, 0, 1, 2, 3][rng.integers(5)], int(rng.integers(2)), 1, i, 0, 7, 0, i, i + 9, bool(rng.integers(2))) for i in range(120)]
    names = "core long, hull long, inner long, copies long, k1 long, k2 long, anchor int, low int, start int, end int, doubt boolean"
    hulls, cores = Counter((r[1], r[2]) for r in rows), Counter((r[0], r[2]) for r in rows)
    sure = {r[4] for r in rows if r[10] and r[1] is not None and hulls[r[1], r[2]] > 1}
    left = {(r[0], r[2]) for r in rows if r[10] and r[4] not in sure}
    opened = {r[4] for r in rows if cores[r[0], r[2]] > 1 and (r[0], r[2]) in left}
    got = repeats.judged_cells(spark.createDataFrame(rows, names)).collect()
    assert {r.k1 for r in got if r.sure} == sure and {r.k1 for r in got if r.open} == opened
    assert len(got) == len(sure | opened)
