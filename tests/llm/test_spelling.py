"""Spelling variants against brute force over all pairs of words, and the query against SQL."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foldlake.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced letter parts two words."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio):
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(((-words[x], x) for x in others), default=None)
        out[w] = (best[1] if best and -best[0] >= ratio * n else None, len(others))
    rows = set()
    for w, n in words.items():
        form, root = out[w][0], w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, out[w][1], words[form] if form else None))
    return rows


def made(seed, alphabet, count, sizes):
    rng = random.Random(seed)
    words = {}
    while len(words) < count:
        w = "".join(rng.choice(alphabet) for _ in range(rng.choice(sizes)))
        for _ in range(rng.choice((0, 0, 1, 3))):
            i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            other = w[:i] + (rng.choice(alphabet) if kind else "") + w[i + (kind < 2) :]
            if other:
                words[other] = rng.choice((2, 3, 20, 30, 200, 300, 4000))
        words[w] = rng.choice((2, 20, 200, 2000, 30000))
    return words


@pytest.mark.parametrize(("seed", "alphabet", "count", "sizes"), [(1, "ab", 150, (1, 2, 3, 5, 8)), (2, "abcdeé", 250, (6, 7, 8)), (3, "aàäbcÀÄzß÷", 250, (4, 7, 12, 30)), (4, "a", 12, (1, 2, 3, 4, 9, 10, 11, 60))])
def test_variants_equal_brute_force(spark, seed, alphabet, count, sizes):
    words = made(seed, alphabet, count, sizes) if alphabet != "a" else {"a" * k: 2 * 11 ** (k % 4) for k in sizes}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df).collect()} == brute(words, spelling.RATIO)


def test_each_pair_comes_once(spark):
    words = made(5, "abc", 200, (3, 4, 5, 7))
    pairs = [(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame(list(words.items()), "word string, n long")).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs}) == sum(near(a, b) for a in words for b in words if a < b)


def parity(word):
    mask = 0
    for letter in word:
        code = ord(letter)
        mask ^= 1 << (code % 3 * 21 + code // 3 % 21)
    return mask


@given(st.text("abcxyzéÀÿ", min_size=1, max_size=12), st.integers(0, 12), st.sampled_from("abzéÿ"))
@settings(max_examples=200, deadline=None)
def test_an_edit_flips_two_bits_at_most(word, at, letter):
    at %= len(word)
    assert (parity(word) ^ parity(word[:at] + letter + word[at + 1 :])).bit_count() <= 2
    assert (parity(word) ^ parity(word[:at] + letter + word[at:])).bit_count() == 1
    assert (parity(word) ^ parity(word[:at] + word[at + 1 :])).bit_count() == 1


def counted(rows):
    import re

    out = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def test_words_of_odd_texts(spark, documents):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdÉéÿ×") for _ in range(rng.choice((3, 6, 7, 8, 9)))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words).title() for _ in range(60))) for i in range(40)]
    rows += [(1, None), (2, ""), (None, "Straßenbahn straßenbahn ŒUVRESS œuvress"), (3, "x" * 100_000), (3, "x" * 100_000), (None, None), (7, "abcdefg1abcdefg_ABCDEFG")]
    found = spelling.count_words(spelling.with_deletions(spelling.runs(documents(rows), 7)))
    assert {r.word: r.n for r in found.collect()} == counted(rows)
    assert spelling.variants(spelling.count_words(spelling.with_deletions(spelling.runs(documents([]), 7)))).count() == 0


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = spelling.op11_spelling_variants(spark, data)
    want = con.execute(spelling.OP11_SQL)
    assert [x[0] for x in want.description] == got.columns
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got.collect())
