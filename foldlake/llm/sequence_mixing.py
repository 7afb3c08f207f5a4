"""A bit-level model of whole texts: hashed-context predictors, gated logistic mixing learned online, adaptive refinement.

A text is coded as its words, each with a space behind it, and one newline. Every byte of every occurrence is coded, in two
halves of four bits. Contexts run across word ends, up to the start of the text: the last byte, three, four and six bytes,
and the word so far. Each context, with the first half when the second is coded,
hashes to a line of 16 counters, one for each value that the half may have; sums of them are the zeros and ones that
followed each beginning of a value. Their stretched probabilities are mixed by weights that a gate selects (how often the
last six bytes and the word so far were seen, half and bit). Weights are learned online, each bit's own occurrence left out
of the counts, and the mix is refined by an adaptive map from gate and mixed probability to what really followed.

Texts come one after the other and are coded in pieces of any size; a coder carries the contexts from piece to piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

HISTORY = 6
END = 10
#: Predictors: the last byte, three, four, six bytes, and the word so far.
ORDERS = (3, 4, 6)
ORDER6, WORD = 3, 4
#: Lines of each predictor; those of the last byte are not hashed.
LINES = (256 * 17, 1 << 15, 1 << 16, 1 << 17, 1 << 18)
_FIRST = np.cumsum((0, *LINES[:-1]))
SLOTS = 16 * sum(LINES)
INPUTS = len(LINES) + 1
#: Counts of a line that gates tell apart, and the parts of one that stretched predictions are stored in.
SEEN = (0.5, 7.5, 127.5)
PARTS = 1024
LEVELS = len(SEEN) + 1
SETS = LEVELS * LEVELS * 2
STEPS = 33
DELTA, RATE, BIAS, REACH = 0.05, 2.0, 0.3, 12.0
#: Weight that the refinement map gets beside the mixed probability, and the count at which a cell of it is trusted half.
REFINED, TRUST = 0.5, 20.0
#: Most bytes that are coded in one piece, and bytes of one step of learning, at first and later on.
PIECE, FIRST_STEP, FIRST_STEPS, STEP = 8192, 1024, 64, 8192

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.array([1] + [_P] * PIECE, np.uint64))
_INVERSES = np.cumprod(np.array([1] + [pow(_P, -1, 1 << 64)] * PIECE, np.uint64))
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(HISTORY + 1)], np.uint64)
_SALT, _MIX, _HALF = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)


class Coder:
    """Turns a sequence of coded texts, piece by piece, into slots and values of the halves of its bytes."""

    def __init__(self) -> None:
        self._last, self._inside = np.zeros(HISTORY, np.uint64), 0
        self._word = _U(0)

    def halves(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For the halves of each byte: their slots (a row for each predictor), and values."""
        now = np.frombuffer(piece, np.uint8)
        n = len(now)
        places = np.arange(n + 1)
        ends = now == END
        breaks = ends | (now == 32)
        start = np.empty(n + 1, np.int64)
        start[0], start[1:] = -self._inside, np.where(ends, places[1:], -self._inside)
        np.maximum.accumulate(start, out=start)
        word = np.zeros(n + 1, np.int64)
        word[1:] = np.where(breaks, places[1:], 0)
        np.maximum.accumulate(word, out=word)

        wide = np.concatenate((self._last, now.astype(np.uint64)))
        past = np.zeros(n, np.uint64)
        for k in range(1, HISTORY + 1):
            past |= wide[HISTORY - k : HISTORY - k + n] << _U(8 * (k - 1))
        past &= _MASKS[np.minimum(places[:n] - start[:n], HISTORY)]

        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((wide[HISTORY:] + _U(1)) * _INVERSES[:n], out=sums[1:])
        so_far = (sums - sums[word]) * _POWERS[: n + 1]
        carried = int(np.searchsorted(word, 1))
        so_far[:carried] += self._word * _POWERS[:carried]

        contexts = np.empty((len(LINES) - 1, n), np.uint64)
        for row, order in enumerate(ORDERS):
            np.bitwise_and(past, _MASKS[order], out=contexts[row])
        contexts[WORD - 1] = so_far[:n]
        contexts += _SALT
        contexts *= _MIX
        contexts ^= contexts >> _U(29)

        high = now >> 4
        slots = np.empty((len(LINES), n, 2), np.int64)
        last = (past & _U(255)).astype(np.int64) * 17
        slots[0, :, 0], slots[0, :, 1] = last, last + 1 + high
        second = contexts ^ (high.astype(np.uint64) + _U(1)) * _HALF
        for half, some in enumerate((contexts, second)):
            some *= _MIX
            for row, lines in enumerate(LINES[1:]):
                slots[row + 1, :, half] = some[row] >> _U(65 - lines.bit_length())
        values = np.empty((n, 2), np.uint8)
        values[:, 0], values[:, 1] = high, now & 15
        slots *= 16
        slots += values
        slots += 16 * _FIRST[:, None, None]

        if n:
            self._last, self._inside = wide[-HISTORY:], int(min(n - start[n], HISTORY))
            self._word = so_far[n]
        return slots.reshape(len(LINES), -1), values.reshape(-1)


def keep_memory() -> None:
    """Lets the C library keep what arrays of a piece leave: a large block that was freed raises the size from which it asks
    the system for new pages each time, which took as long as the work on them."""
    np.empty(24 << 20, np.uint8)


def coded(words: list[bytes]) -> bytes:
    """A text as it is coded; words end with the end token."""
    return b" ".join(words)


def pieces(texts: Iterator[bytes], most: int = 0) -> Iterator[bytes]:
    """The texts one after the other, cut into pieces of as many bytes each, the last one shorter."""
    most, held, size = most or PIECE, [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            whole = b"".join(held)
            cut = size - size % most
            for at in range(0, cut, most):
                yield whole[at : at + most]
            held, size = [whole[cut:]], size - cut
    if size:
        yield b"".join(held)


def count(counts: np.ndarray, slots: np.ndarray) -> None:
    """Adds halves to counts (SLOTS)."""
    np.add.at(counts, slots.reshape(-1), counts.dtype.type(1))


def first_weights() -> np.ndarray:
    weights = np.full((SETS, 4, INPUTS), 0.2, np.float32)
    weights[:, :, -1] = 0.0
    return weights


def no_refinement() -> np.ndarray:
    return np.zeros((SETS, 4, STEPS, 2))


def predictions(counts: np.ndarray, own: bool) -> np.ndarray:
    """What a half's slot predicts for its four bits (SLOTS x 4): stretched, in PARTS, each given the bits before it. The
    lowest two bits of the first tell how often the line was seen. With own, the half's own occurrence is left out."""
    out = np.empty((SLOTS // 16, 16, 4), np.int16)
    for at in range(0, len(out), 8192):
        _predict(counts[16 * at : 16 * (at + 8192)], np.float32(own), out[at : at + 8192])
    return out.reshape(SLOTS, 4)


def _predict(counts: np.ndarray, own: np.float32, out: np.ndarray) -> None:
    lines = len(out)
    sums = counts.reshape(lines, 16).astype(np.float32)
    for bit in (3, 2, 1, 0):
        pairs = sums.reshape(lines, 1 << bit, 2)
        every = [pairs[:, :, k] for k in range(2)]
        left = [np.maximum(x - own, np.float32(0)) for x in every]
        of = np.empty((lines, 1 << bit, 2, 8 >> bit), np.int16)
        for value, (zeros, ones) in enumerate(((left[0], every[1]), (every[0], left[1]))):
            stretched = np.log(ones + np.float32(DELTA)) - np.log(zeros + np.float32(DELTA))
            of[:, :, value, :] = np.rint(stretched * np.float32(PARTS)).astype(np.int16)[:, :, None]
        out[:, :, bit] = of.reshape(lines, 16)
        sums = pairs.sum(axis=2)
    level = sum((sums - own >= np.float32(limit)).astype(np.int16) for limit in SEEN)
    out[:, :, 0] = out[:, :, 0] & np.int16(-4) | level


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class _Grouped:
    """Halves in the order of their sets of weights. Their four bits (the first axis) have weights of their own, so one step
    takes all four."""

    def __init__(self, table: np.ndarray, slots: np.ndarray, values: np.ndarray):
        found = np.take(table.view(np.int64).reshape(-1), slots)  # one read a slot
        chosen = (found[ORDER6] & 3) * (2 * LEVELS) + (found[WORD] & 3) * 2
        chosen[1::2] += 1
        chosen = chosen.astype(np.uint8)
        self.order = np.argsort(chosen, kind="stable")
        sizes = np.bincount(chosen, minlength=SETS)
        stops = np.cumsum(sizes)
        self.groups = [(g, slice(stops[g] - sizes[g], stops[g])) for g in np.flatnonzero(sizes).tolist()]
        self.bits = np.take(values, self.order) >> np.array([[3], [2], [1], [0]], np.uint8) & 1
        self._cells = np.repeat(np.arange(SETS) * (4 * STEPS), sizes) + np.arange(4)[:, None] * STEPS
        self.inputs = np.empty((4, INPUTS, len(values)), np.float32)
        stored = np.take(found, self.order, axis=1).view(np.int16).reshape(len(LINES), -1, 4)
        np.multiply(stored.transpose(2, 0, 1), np.float32(1 / PARTS), out=self.inputs[:, :-1])
        self.inputs[:, -1] = BIAS

    def mix(self, mixer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mixed predictions of the bits, and their cells of the refinement map."""
        mixed = np.empty((4, 1, len(self.order)), np.float32)
        for g, some in self.groups:
            np.matmul(mixer[g][:, None, :], self.inputs[:, :, some], out=mixed[:, :, some])
        np.clip(mixed, -REACH, REACH, out=mixed)
        near = np.rint((mixed[:, 0] + np.float32(REACH)) * np.float32((STEPS - 1) / (2 * REACH)))
        return mixed[:, 0], self._cells + near.astype(np.int64)


class Learner:
    """One online pass over halves in order. Weights take a step after so many bytes, and refined gathers what followed
    each mixed prediction."""

    def __init__(self, table: np.ndarray):
        self.table, self.mixer, self.refined, self.seen, self._steps = table, first_weights(), no_refinement(), 0, 0

    def learn(self, slots: np.ndarray, values: np.ndarray) -> None:
        at = 0
        while at < len(values):
            some = slice(at, at + 2 * (FIRST_STEP if self._steps < FIRST_STEPS else STEP))
            self._step(slots[:, some], values[some])
            at, self._steps = some.stop, self._steps + 1
        self.seen += len(values) // 2

    def _step(self, slots: np.ndarray, values: np.ndarray) -> None:
        grouped = _Grouped(self.table, slots, values)
        mixed, cells = grouped.mix(self.mixer)
        error = grouped.bits - _squash(mixed)
        for g, some in grouped.groups:
            inputs = grouped.inputs[:, :, some]
            power = np.einsum("bkn,bkn->b", inputs, inputs)[:, None]
            self.mixer[g] += np.float32(RATE) * np.matmul(inputs, error[:, some, None])[:, :, 0] / (power + np.float32(10.0))
        found = np.bincount((cells * 2 + grouped.bits).reshape(-1), minlength=self.refined.size)
        self.refined += found.reshape(self.refined.shape)


def refinement(refined: np.ndarray) -> np.ndarray:
    """Probability of a one in each cell of the map; cells seen seldom stay near their own mixed probability."""
    own = _squash(np.linspace(-REACH, REACH, STEPS))
    return ((refined[..., 1] + TRUST * own) / (refined.sum(axis=-1) + TRUST)).astype(np.float32).reshape(-1)


def score(table: np.ndarray, mixer: np.ndarray, refined: np.ndarray, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
    """log10 of the probability of each byte; refined is the result of refinement()."""
    grouped = _Grouped(table, slots, values)
    mixed, cells = grouped.mix(mixer)
    ones = np.float32(1.0 - REFINED) * _squash(mixed)
    ones += np.float32(REFINED) * np.take(refined, cells)
    each = np.abs(np.float32(1.0) - grouped.bits - ones)
    out = np.empty(len(values))
    out[grouped.order] = np.log10(each.prod(axis=0))  # of four bits, more than 1e-22
    return out[::2] + out[1::2]
