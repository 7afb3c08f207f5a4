"""A bit-level model of word spellings: hashed-context predictors, gated logistic mixing and adaptive refinement.

A word is coded as its bytes and a space, the end of a text as one newline. The bits of each byte are predicted from
contexts inside the word: its position, the last one to four bytes, the last six. Each context and the bits of the byte
so far hash to a slot that counts zeros and ones over the distinct words of the training texts. The stretched
probabilities of the slots are mixed by weights that a gate selects (how often the longest contexts were seen). The
weights are learned online, bit by bit, each word's own occurrence being left out of the counts; and the mix is refined by
an adaptive map from gate and mixed probability to what really followed.

As contexts do not leave the word, a word's log-probability is the same wherever it stands, and is computed once for
each distinct word. In words longer than LANE bytes positions begin anew after so many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LANE = 48
HISTORY = 6
END = b"\n"
#: Slots of each predictor: position, orders 1 to 4, order 6.
SIZES = (1 << 11, 1 << 16, 1 << 18, 1 << 19, 1 << 20, 1 << 20)
STARTS = tuple(np.cumsum((0, *SIZES[:-1])).tolist())
SLOTS = sum(SIZES)
_MASKS = np.array(SIZES[2:], np.uint32)[:, None] - np.uint32(1)
_FIRST_SLOTS = np.array(STARTS)[:, None]
INPUTS = len(SIZES) + 1
GATES = 6 * 4 * 2
#: Counts of the two longest contexts that gates tell apart.
_ORDER4, _ORDER6 = (0.5, 3.5, 63.5), (0.5, 1.5, 3.5, 15.5, 255.5)
STEPS = 33
DELTA = 0.25
RATE = 0.3
BIAS = 0.3
REACH = 12.0
#: Weight that the refinement map gets beside the mixed probability, and the count at which a cell of it is trusted half.
REFINED, TRUST = 0.5, 20.0

#: Bytes that are counted or scored in one step.
SIDE_BY_SIDE = 16_384

_CONTEXT, _NODE = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


class Lanes:
    """The bytes of a batch of words in lanes sorted by length, longest first: the model written out byte position by byte
    position, which tests hold Coded against."""

    def __init__(self, words: list[bytes]):
        pieces, before, word, last = [], [], [], []
        for at, text in enumerate(words):
            coded = text if text == END else text + b" "
            for start in range(0, len(coded), LANE):
                pieces.append(coded[start : start + LANE])
                before.append(coded[max(0, start - HISTORY) : start])
                word.append(at)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-lengths, kind="stable")
        self.word = np.array(word, np.int64)[order]
        self.lengths = lengths[order]
        wide = int(lengths.max(initial=0))
        self.bytes = np.zeros((len(pieces), HISTORY + wide), np.uint8)
        filled = np.arange(wide)[None, :] < self.lengths[:, None]
        self.bytes[:, HISTORY:][filled] = np.frombuffer(b"".join(pieces[i] for i in order.tolist()), np.uint8)
        for row, i in enumerate(order.tolist()):
            if before[i]:
                self.bytes[row, HISTORY - len(before[i]) : HISTORY] = np.frombuffer(before[i], np.uint8)
        self.active = [int(np.searchsorted(-self.lengths, -p, side="left")) for p in range(wide)]

    def bits(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For each byte position and bit: position, number of lanes that have it (the first ones), slots, bits."""
        for position, n in enumerate(self.active):
            past = [self.bytes[:n, HISTORY + position - k].astype(np.uint32) for k in range(1, HISTORY + 1)]
            order2 = past[0] | past[1] << np.uint32(8)
            order3 = order2 | past[2] << np.uint32(16)
            order4 = order3 | past[3] << np.uint32(24)
            order6 = _hash(order4, past[4] | past[5] << np.uint32(8) | np.uint32(1 << 16))
            contexts = np.stack((order2, order3, order4, order6))
            now = self.bytes[:n, HISTORY + position].astype(np.uint32)
            node = np.ones(n, np.uint32)
            slots = np.empty((len(SIZES), n), np.int64)
            for bit in range(8):
                slots[0] = np.uint32(min(position, 7) << 8) | node
                slots[1] = past[0] << np.uint32(8) | node
                slots[2:] = _hash(contexts, node) & _MASKS
                slots += _FIRST_SLOTS
                value = now >> np.uint32(7 - bit) & np.uint32(1)
                yield position, n, slots, value
                node = node << np.uint32(1) | value


def _hash(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return _mixed(context * _CONTEXT + node * _NODE)


def _mixed(value: np.ndarray) -> np.ndarray:
    value ^= value >> np.uint32(16)
    value *= np.uint32(0x2C1B3C6D)
    value ^= value >> np.uint32(13)
    return value


class Coded:
    """The bytes of a batch of words one after the other, with the slots of their bits. Bits of different bytes need no
    order, as their contexts are known, so one step takes many bytes, however long the words are."""

    def __init__(self, words: list[bytes]):
        pieces = [text if text == END else text + b" " for text in words]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(lengths) - lengths
        now = np.frombuffer(b"".join(pieces), np.uint8)
        inside = np.arange(len(now)) - np.repeat(self.starts, lengths)
        past = np.zeros((HISTORY, len(now)), np.uint32)
        for k in range(1, HISTORY + 1):
            past[k - 1, k:] = np.where(inside[k:] >= k, now[:-k], 0)
        self.now = now.astype(np.uint32)
        order2 = past[0] | past[1] << np.uint32(8)
        order3 = order2 | past[2] << np.uint32(16)
        order4 = order3 | past[3] << np.uint32(24)
        order6 = _hash(order4, past[4] | past[5] << np.uint32(8) | np.uint32(1 << 16))
        self._contexts = np.stack((order2, order3, order4, order6)) * _CONTEXT
        self._near = np.stack((np.minimum(inside % LANE, 7), past[0])) * 256 + _FIRST_SLOTS[:2]
        self.later = (inside % LANE > 0).astype(np.int64)

    def bits(self, side_by_side: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For so many bytes at a time and each of their bits: the bytes' places, slots, bits."""
        for at in range(0, len(self.now), side_by_side):
            some = slice(at, min(at + side_by_side, len(self.now)))
            now, near, contexts = self.now[some], self._near[:, some], self._contexts[:, some]
            slots = np.empty((len(SIZES), len(now)), np.int64)
            for bit in range(8):
                node = np.uint32(1 << bit) | now >> np.uint32(8 - bit)
                np.add(near, node, out=slots[:2])
                np.add(_mixed(contexts + node * _NODE) & _MASKS, _FIRST_SLOTS[2:], out=slots[2:])
                yield some, slots, now >> np.uint32(7 - bit) & np.uint32(1)


def count(counts: np.ndarray, words: list[bytes]) -> None:
    """Adds the words, each once, to counts (SLOTS x 2)."""
    flat, one = counts.reshape(-1), counts.dtype.type(1)
    for _, slots, value in Coded(words).bits(SIDE_BY_SIDE):
        np.add.at(flat, (slots * 2 + value).reshape(-1), one)


def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def first_weights() -> np.ndarray:
    weights = np.full((GATES, INPUTS), 0.2, np.float32)
    weights[:, -1] = 0.0
    return weights


def _inputs(counts: np.ndarray, slots: np.ndarray, value: np.ndarray | None, position: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretched predictions (with a bias) and gates. With value, each bit's own occurrence is left out of its counts."""
    pairs = np.take(np.ascontiguousarray(counts, np.uint32).reshape(-1).view(np.uint64), slots)  # one read a slot
    seen = pairs.view(np.uint32).reshape(*slots.shape, 2).astype(np.float32)
    if value is not None:
        seen -= np.stack((1 - value, value), axis=1).astype(np.float32)
        np.maximum(seen, 0.0, out=seen)
    inputs = np.empty((INPUTS, n), np.float32)
    logs = np.log(seen + np.float32(DELTA))
    np.subtract(logs[:, :, 1], logs[:, :, 0], out=inputs[:-1])
    inputs[-1] = BIAS
    whole = seen[5, :, 0] + seen[5, :, 1]
    order4 = seen[4, :, 0] + seen[4, :, 1]
    gate = _reached(whole, _ORDER6) * 4 + _reached(order4, _ORDER4)
    return inputs, gate * 2 + (position > 0)


def _reached(x: np.ndarray, limits: tuple[float, ...], kind: type = np.int64) -> np.ndarray:
    """How many of the limits each value reaches."""
    out = np.zeros(len(x), kind)
    for limit in limits:
        out += x >= np.float32(limit)
    return out


class Predictors:
    """What slots predict, made once from their counts: stretched, as 32-bit floats. The lowest three bits of those of the two
    longest contexts hold what their counts add to the gate, so that one read gives both. With own, each slot has two,
    for a zero and for a one that is predicted, whose own occurrence is left out of the counts."""

    def __init__(self, counts: np.ndarray, own: bool):
        self.own = own
        seen = counts.astype(np.float32)
        table = np.empty((SLOTS, 2 if own else 1), np.float32)
        for value in range(table.shape[1]):
            zeros, ones = (np.maximum(seen[:, k] - np.float32(own and k == value), np.float32(0.0)) for k in range(2))
            table[:, value] = np.log(ones + np.float32(DELTA)) - np.log(zeros + np.float32(DELTA))
            for at, size, limits in zip(STARTS[4:], SIZES[4:], (_ORDER4, _ORDER6)):
                part = table[at : at + size, value].view(np.uint32)
                part &= np.uint32(0xFFFFFFF8)
                part |= _reached(zeros[at : at + size] + ones[at : at + size], limits, np.uint32)
        self.table = table.reshape(-1)

    def of(self, slots: np.ndarray, value: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """_inputs() without the bias."""
        inputs = np.take(self.table, slots * 2 + value if self.own else slots)
        order4, order6 = inputs[4:].view(np.uint32) & np.uint32(7)
        return inputs, (order6 * np.uint32(8) + order4 * np.uint32(2)) + later


def _mix(inputs: np.ndarray, gate: np.ndarray, mixer: np.ndarray) -> np.ndarray:
    weights = np.take(mixer, gate, axis=0)
    mixed = np.einsum("kn,nk->n", inputs, weights[:, :-1])
    mixed += weights[:, -1] * np.float32(BIAS)
    return np.clip(mixed, -REACH, REACH, out=mixed)


def learn(counts: np.ndarray | Predictors, words: list[bytes], mixer: np.ndarray, refined: np.ndarray, rate: float = RATE) -> None:
    """One online pass: mixer's weights (GATES x INPUTS) take a step after each bit of as many bytes as there are words in the
    batch, and refined (GATES x STEPS x 2) gathers what followed each mixed probability. Counts may be Predictors of them."""
    predictors = counts if isinstance(counts, Predictors) else Predictors(counts, True)
    coded = Coded(words)
    for some, slots, value in coded.bits(max(1, len(words))):
        inputs, gate = predictors.of(slots, value, coded.later[some])
        mixed = _mix(inputs, gate, mixer)
        error = value.astype(np.float32) - squash(mixed)
        sums = np.empty((INPUTS + 1, len(error)))
        np.multiply(inputs, error, out=sums[: INPUTS - 1])
        np.multiply(error, BIAS, out=sums[INPUTS - 1])
        np.einsum("kn,kn->n", inputs, inputs, out=sums[INPUTS])
        sums[INPUTS] += BIAS * BIAS
        places = np.arange(0, (INPUTS + 1) * GATES, GATES)[:, None] + gate
        *steps, power = np.bincount(places.reshape(-1), sums.reshape(-1), (INPUTS + 1) * GATES).reshape(-1, GATES)
        mixer += (rate * np.array(steps) / (power + 10.0)).T.astype(np.float32)
        cell = (gate * STEPS + _step(mixed)) * 2 + value
        refined += np.bincount(cell, minlength=refined.size).reshape(refined.shape)


def _step(mixed: np.ndarray) -> np.ndarray:
    return np.rint((mixed + REACH) * ((STEPS - 1) / (2 * REACH))).astype(np.int64)


def refinement(refined: np.ndarray) -> np.ndarray:
    """Probability of a one in each cell of the map; cells seen seldom stay near their own mixed probability."""
    own = squash(np.linspace(-REACH, REACH, STEPS))[None, :]
    return (refined[:, :, 1] + TRUST * own) / (refined.sum(axis=2) + TRUST)


def score(counts: np.ndarray | Predictors, words: list[bytes], mixer: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """log10 of the probability of each word. Counts may be Predictors of them."""
    predictors = counts if isinstance(counts, Predictors) else Predictors(counts, False)
    if not words:
        return np.zeros(0)
    coded = Coded(words)
    product = np.ones(len(coded.now))  # of the eight bits of a byte, more than 1e-45
    table = refinement(refined).astype(np.float32).reshape(-1)
    for some, slots, value in coded.bits(SIDE_BY_SIDE):
        inputs, gate = predictors.of(slots, value, coded.later[some])
        mixed = _mix(inputs, gate, mixer)
        p = np.float32(1.0 - REFINED) * squash(mixed) + np.float32(REFINED) * np.take(table, gate * STEPS + _step(mixed))
        product[some] *= np.where(value, p, np.float32(1.0) - p)
    return np.add.reduceat(np.log10(product), coded.starts)
