"""Global alignment of two sequences, as Arrow UDFs.

`lcs_identity` counts only matches: its optimum is the longest common subsequence. `affine_pairs` and `affine_identity`
score matches, mismatches and affine gaps (Gotoh's three-state recurrence). Rows of the recurrence are numpy vectors;
the way back is found in blocks of rows, so that memory grows with the length times its root. `affine_identity` needs no
way back and sweeps many pairs at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW = -1e18
#: Bytes of the way back that are held at once; longer ones go in blocks.
ONE_BLOCK = 1 << 24
#: Cells of a row of the recurrence, over all pairs that are swept at once.
BLOCK_CELLS = 1 << 16
_PLACES = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors over the columns of a."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, letter in enumerate(a):
        masks[letter] = masks.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & masks.get(letter, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _sweep(left: np.ndarray, right: np.ndarray, scores: tuple[float, float, float, float], state: tuple, back: np.ndarray | None) -> tuple:
    """The states (pair, letter of a alone, letter of b alone) after the rows of left, from those before; back, if given, takes
    for each row and state the one that it comes from."""
    match, mismatch, opening, extending = scores
    pair, up, side = state
    m = len(right)
    steps = np.arange(m + 1) * extending
    for i, letter in enumerate(left):
        states = np.stack([pair[:-1], up[:-1], side[:-1]])
        best = states.argmax(axis=0)
        now = np.full(m + 1, _LOW)
        now[1:] = states[best, np.arange(m)] + np.where(right == letter, match, mismatch)
        states = np.stack([pair + opening, up + extending, side + opening])
        best_up = states.argmax(axis=0)
        now_up = states[best_up, np.arange(m + 1)]
        # side[j] = max over k < j of max(now, now_up)[k] + opening + (j - k - 1) * extending, a running maximum
        start = np.maximum(now, now_up)
        run = np.maximum.accumulate(start - steps)
        now_side = np.full(m + 1, _LOW)
        now_side[1:] = run[:-1] + opening + steps[1:] - extending
        if back is not None:
            back[0, i, 1:], back[1, i] = best, best_up
            opened = start[:-1] + opening >= now_side[1:] - 1e-9
            back[2, i, 1:] = np.where(opened, np.where(now[:-1] >= now_up[:-1], 0, 1), 2)
        pair, up, side = now, now_up, now_side
    return pair, up, side


def affine(a: str, b: str, match: float, mismatch: float, opening: float, extending: float) -> list[tuple[int, int]]:
    """Pairs of places of a best global alignment; opening is the score of a gap's first letter, ends included.

    Rows are swept in blocks. Only the states before each block stay; on the way back a block is swept again for where its
    states come from. So memory is 3 * m bytes for each row of one block and 24 * m for each block: with blocks of about
    the root of n rows 200 MB serve for 30,000 letters a side.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return []
    scores = (match, mismatch, opening, extending)
    left, right = np.frombuffer(a.encode("utf-32-le"), np.uint32), np.frombuffer(b.encode("utf-32-le"), np.uint32)
    block = n if 3 * n * m <= ONE_BLOCK else max(1, int((8 * n) ** 0.5))
    pair, up, side = np.full(m + 1, _LOW), np.full(m + 1, _LOW), np.full(m + 1, _LOW)
    pair[0] = 0.0
    side[1:] = opening + extending * np.arange(m)
    before = []
    for at in range(0, n, block):
        before.append((pair, up, side))
        if at + block < n:
            pair, up, side = _sweep(left[at : at + block], right, scores, before[-1], None)
    i, j, state, out = n, m, None, []
    for at in range((len(before) - 1) * block, -1, -block):
        back = np.zeros((3, min(block, n - at), m + 1), np.uint8)
        ends = _sweep(left[at : at + block], right, scores, before.pop(), back)
        if state is None:
            state = int(np.argmax([e[m] for e in ends]))
        while i > at:
            came = int(back[state, i - 1 - at, j])
            if state == 0:
                i, j = i - 1, j - 1
                out.append((i, j))
            elif state == 1:
                i -= 1
            else:
                j -= 1
            state = came
    return out[::-1]


def _letters(texts: list[str]) -> np.ndarray:
    """A row of code points for each text, filled up with zeros."""
    out = np.zeros((len(texts), max(map(len, texts))), np.uint32)
    for row, text in zip(out, texts, strict=True):
        row[: len(text)] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return out


def _matches(lefts: list[str], rights: list[str], scores: tuple[float, float, float, float]) -> np.ndarray:
    """Equal letters in the alignment that affine() finds of each pair of texts, none of them empty.

    The sweep of _sweep() for all pairs at once. Instead of the way back, each state takes along the matches of the way to
    it, which is the one that affine() goes back. Cells beyond a pair's ends come from it and do not reach it.
    """
    match, mismatch, opening, extending = scores
    left, right = _letters(lefts), _letters(rights)
    rows, m = right.shape
    n_of, m_of = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    steps, places = np.arange(m + 1) * extending, np.arange(m)
    out = np.zeros(rows, np.int64)
    states, counts = np.full((3, rows, m + 1), _LOW), np.zeros((3, rows, m + 1), np.int32)
    states[0, :, 0] = 0.0
    states[2, :, 1:] = opening + extending * places
    to_up = np.array([opening, extending, opening])[:, None, None]
    for i in range(left.shape[1]):
        new, seen = np.full_like(states, _LOW), np.zeros_like(counts)
        same = right == left[:, i : i + 1]
        best = states[:, :, :-1].argmax(axis=0)[None]
        new[0, :, 1:] = np.take_along_axis(states[:, :, :-1], best, 0)[0] + np.where(same, match, mismatch)
        seen[0, :, 1:] = np.take_along_axis(counts[:, :, :-1], best, 0)[0] + same
        states += to_up
        best = states.argmax(axis=0)[None]
        new[1], seen[1] = np.take_along_axis(states, best, 0)[0], np.take_along_axis(counts, best, 0)[0]
        start = np.maximum(new[0], new[1])
        new[2, :, 1:] = np.maximum.accumulate(start - steps, axis=1)[:, :-1] + opening + steps[1:] - extending
        opened = start[:, :-1] + opening >= new[2, :, 1:] - 1e-9
        since = np.maximum.accumulate(np.where(opened, places, 0), axis=1)
        seen[2, :, 1:] = np.take_along_axis(np.where(new[0] >= new[1], seen[0], seen[1]), since, 1)
        states, counts = new, seen
        at = np.flatnonzero(n_of == i + 1)
        out[at] = counts[states[:, at, m_of[at]].argmax(axis=0), at, m_of[at]]
    return out


def identities_of_epitopes(a: list[str], b: list[str]) -> list[float]:
    """identity_of_epitopes() of each pair, each distinct pair once, in blocks of pairs of about the same lengths."""
    found = dict.fromkeys(zip(a, b, strict=True), 0.0)
    todo = sorted((pair for pair in found if pair[0] and pair[1]), key=lambda p: (len(p[0]).bit_length(), len(p[1])))
    at = 0
    while at < len(todo):
        most, to = len(todo[at][0]).bit_length(), at + 1
        while to < len(todo) and len(todo[to][0]).bit_length() == most and (to + 1 - at) * (len(todo[to][1]) + 1) <= BLOCK_CELLS:
            to += 1
        lefts, rights = map(list, zip(*todo[at:to], strict=True))
        for x, y, n in zip(lefts, rights, _matches(lefts, rights, (1.0, 0.0, -1.0, -0.5)).tolist(), strict=True):
            found[x, y] = n * 100.0 / min(len(x), len(y))
        at = to
    return [found[pair] for pair in zip(a, b, strict=True)]


def _identity(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    common = lcs_length(a, b)
    return common * 100.0 / (len(a) + len(b) - common)


def identity_of_epitopes(a: str, b: str) -> float:
    """Percent of matches over the shorter length, aligned with scores 1, 0 and gaps of -1, -0.5."""
    if not a or not b:
        return 0.0
    pairs = affine(a, b, 1.0, 0.0, -1.0, -0.5)
    return sum(a[i] == b[j] for i, j in pairs) * 100.0 / min(len(a), len(b))


@F.pandas_udf(T.DoubleType())
def lcs_identity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Percent of matches over the aligned length (matches and single letters); 0 if either side is empty or null."""
    return pd.Series([_identity(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def affine_identity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Percent of matches over the shorter length, aligned with scores 1, 0 and gaps of -1, -0.5; 0 for an empty side."""
    return pd.Series(identities_of_epitopes([x or "" for x in a], [y or "" for y in b]), dtype="float64")


@F.pandas_udf(_PLACES)
def affine_pairs(a: pd.Series, b: pd.Series) -> pd.Series:
    """0-based places that correspond, aligned with scores 2, -1 and gaps of -10, -0.5."""
    out = []
    for x, y in zip(a, b, strict=True):
        out.append([{"a": i, "b": j} for i, j in affine(x or "", y or "", 2.0, -1.0, -10.0, -0.5)])
    return pd.Series(out)
