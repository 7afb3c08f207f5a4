import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from foldlake.llm import lm_scoring as lm
from foldlake.llm import sequence_mixing as sequences

M = (1 << 64) - 1


def toks(text):
    return (text or "").encode().lower().split() + [b"\n"]


def written(text):
    return b"".join(w + b" " for w in toks(text)[:-1]) + b"\n"


def lines_of(text, at, high):
    """The lines of a half of byte at (the second one if high is not None), each context written out from the text itself."""
    past, words = text[:at], text[:at].split(b" ")
    spelled = lambda word: sum((b + 1) * pow(0x9E3779B97F4A7C15, len(word) - i, 1 << 64) for i, b in enumerate(word)) & M
    keys = [int.from_bytes(past[::-1][:k], "little") for k in (3, 4, 6)] + [spelled(words[-1])]
    out = [(past[-1] if past else 0) * 17 + (0 if high is None else 1 + high)]
    first = sequences.LINES[0]
    for key, lines in zip(keys, sequences.LINES[1:], strict=True):
        key = (key + 0xD6E8FEB86659FD93) * 0xA0761D6478BD642F & M
        key ^= key >> 29
        if high is not None:
            key ^= (high + 1) * 0xE7037ED1A0B428DB & M
        out.append(first + ((key * 0xA0761D6478BD642F & M) >> (65 - lines.bit_length())))
        first += lines
    return out


def halves_of(text):
    for at, byte in enumerate(text):
        yield lines_of(text, at, None), byte >> 4, 0
        yield lines_of(text, at, byte >> 4), byte & 15, 1


class Model:
    """The model bit by bit, with dictionaries."""

    def __init__(self, texts):
        self.seen = defaultdict(int)
        halves = [h for text in texts for h in halves_of(text)]
        for lines, value, _ in halves:
            for line in lines:
                for bit in range(4):
                    self.seen[line, bit, value >> (3 - bit)] += 1
        self.w = np.full((32, 4, 6), 0.2)
        self.w[:, :, -1] = 0
        self.map = np.zeros((32, 4, 33, 2))
        at = done = 0
        while at < len(halves):
            size = 2 * (sequences.FIRST_STEP if done < sequences.FIRST_STEPS else sequences.STEP)
            steps = defaultdict(lambda: [np.zeros(6), 0.0])
            for lines, value, half in halves[at : at + size]:
                for bit in range(4):
                    g, x, p, cell = self.bit(lines, value, half, bit, 1)
                    b = value >> (3 - bit) & 1
                    steps[g, bit][0] += x * (b - 1 / (1 + math.exp(-p)))
                    steps[g, bit][1] += x @ x
                    self.map[g, bit, cell, b] += 1
            for (g, bit), (step, power) in steps.items():
                self.w[g, bit] += 2.0 * step / (power + 10)
            at, done = at + size, done + 1

    def bit(self, lines, value, half, bit, own):
        stretched = []
        for line in lines:
            n = [self.seen.get((line, bit, value >> (4 - bit) << 1 | b), 0) for b in (0, 1)]
            n[value >> (3 - bit) & 1] -= own if n[value >> (3 - bit) & 1] else 0
            stretched.append(math.log((n[1] + 0.05) / (n[0] + 0.05)))
        often = [self.seen.get((line, 0, 0), 0) + self.seen.get((line, 0, 1), 0) - own for line in lines[3:5]]
        levels = [sum(n >= limit for limit in (1, 8, 128)) for n in often]
        g = (levels[0] * 4 + levels[1]) * 2 + half
        x = np.array([*stretched, 0.3])
        p = min(12.0, max(-12.0, float(self.w[g, bit] @ x)))
        return g, x, p, round((p + 12) * 32 / 24)

    def score(self, text):
        total = 0.0
        for lines, value, half in halves_of(text):
            for bit in range(4):
                g, _, p, cell = self.bit(lines, value, half, bit, 0)
                zero, one = self.map[g, bit, cell]
                own = 1 / (1 + math.exp(12 - cell * 24 / 32))
                p = 0.5 / (1 + math.exp(-p)) + 0.5 * (one + 20 * own) / (zero + one + 20)
                total += math.log10(p if value >> (3 - bit) & 1 else 1 - p)
        return total


def test_scores_equal_a_model_written_out_bit_by_bit(spark, documents, data, monkeypatch):
    """Every occurrence is coded, with contexts across word ends; texts are learned from in the order of the table."""
    texts = [r.text[:400] for r in spark.read.parquet(f"{data}/documents.parquet").where("length(text) > 400").limit(8).collect()]
    texts += [None, "", "the the THE", " x\ty\r\nz é \U0001f600", "w" * 300 + " the"]
    rows = [(i, text, "en", "x") for i, text in enumerate(texts * 2, 1)]
    held = [zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    monkeypatch.setattr(sequences, "FIRST_STEPS", 2)
    monkeypatch.setattr(sequences, "STEP", 1500)
    monkeypatch.setattr(sequences, "PIECE", 6000)
    model = Model([written(r[1]) for r, h in zip(rows, held) if not h])
    counts, coder = np.zeros(sequences.SLOTS, np.uint32), sequences.Coder()
    coded = [sequences.coded(toks(r[1])) for r, h in zip(rows, held) if not h]
    assert b"".join(coded) == b"".join(written(r[1]) for r, h in zip(rows, held) if not h)
    halves = [coder.halves(piece) for piece in sequences.pieces(iter(coded), 6000)]
    for slots, _ in halves:
        sequences.count(counts, slots)
    learner = sequences.Learner(sequences.predictions(counts, True))
    learner.learn(np.concatenate([s for s, _ in halves], axis=1), np.concatenate([v for _, v in halves]))
    assert learner.refined.sum() == 8 * sum(map(len, coded))
    table = sequences.predictions(counts, False)
    got = lm._text_scores([sequences.coded(toks(r[1])) for r in rows], table, learner.mixer, sequences.refinement(learner.refined))
    want = [model.score(written(r[1])) for r in rows]
    assert np.abs(got - want).max() < 0.01 * max(map(abs, want)) and all(abs(a - b) < 0.02 * abs(b) + 0.02 for a, b in zip(got, want))


def test_query_scores_as_the_kernel_does(spark, documents, data):
    """The operator over partitions, words looked up and joined: the kernel's scores, the base score by brute force."""
    rows = [(r.doc_id, r.text, r.lang, "x") for r in spark.read.parquet(f"{data}/documents.parquet").limit(60).collect()]
    rows += [(1_000_001, "", None, "x"), (1_000_002, None, "zz", "x"), (None, "null id", "en", "x"), (1_000_003, "y" * 40_000 + " the", "en", "x")]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    train = [toks(r[1]) for r, h in zip(rows, held) if not h]
    c = Counter(w for words in train for w in words)
    n = sum(c.values())
    counts, coder = np.zeros(sequences.SLOTS, np.uint32), sequences.Coder()
    for piece in sequences.pieces(map(sequences.coded, train)):
        sequences.count(counts, coder.halves(piece)[0])
    learner, coder = sequences.Learner(sequences.predictions(counts, True)), sequences.Coder()
    for piece in sequences.pieces(map(sequences.coded, train)):
        learner.learn(*coder.halves(piece))
    model = sequences.predictions(counts, False), learner.mixer, sequences.refinement(learner.refined)
    want = {r[0]: s for r, s in zip(rows, lm._text_scores([sequences.coded(toks(r[1])) for r in rows], *model))}
    docs = documents(rows).coalesce(1)
    for head in (200_000, 20):
        lm.HEAD, before = head, lm.HEAD
        try:
            got = {r.doc_id: r for r in lm.score_sequences(docs).collect()}
        finally:
            lm.HEAD = before
        assert len(got) == len(rows)
        for r, h in zip(rows, held):
            one, words = got[r[0]], toks(r[1])
            assert abs(one.score - want[r[0]]) < 1e-5 * abs(want[r[0]])
            base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in words)
            assert abs(one.base_score - base) < 1e-6 * abs(base)
            assert (one.held_out, one.n_tokens, one.n_known, one.train_tokens) == (h, len(words), sum(c[w] > 0 for w in words), n)


def test_contexts_cross_word_ends_and_every_occurrence_counts(spark, documents):
    """The same words in another order, or more often in the training texts, have another score; pieces make no difference."""
    rows = [(i, "one two three four five six seven", "en", "x") for i in range(1, 40)]
    both = [(1001, "one two three four five six seven", "en", "x"), (1002, "seven six five four three two one", "en", "x")]
    score = {r.doc_id: r.score for r in lm.score_sequences(documents(rows + both)).collect()}
    assert score[1001] > score[1002] + 1
    fewer = {r.doc_id: r.score for r in lm.score_sequences(documents(rows[:4] + both)).collect()}
    assert score[1001] > fewer[1001]


def test_pieces_of_any_size_give_the_same_slots():
    texts = [b"ab cd \n", b"\n", b"x" * 50 + b" y \n"] * 3
    whole = sequences.Coder().halves(b"".join(texts))
    for most in (1, 3, 7, 64):
        coder = sequences.Coder()
        found = [coder.halves(piece) for piece in sequences.pieces(iter(texts), most)]
        assert (np.concatenate([s for s, _ in found], axis=1) == whole[0]).all()
        assert (np.concatenate([v for _, v in found]) == whole[1]).all()


def test_probabilities_of_a_byte_sum_to_one():
    texts = [b"the then there \n", b"a the \n"] * 5
    counts = np.zeros(sequences.SLOTS, np.uint32)
    slots, values = sequences.Coder().halves(b"".join(texts))
    sequences.count(counts, slots)
    learner = sequences.Learner(sequences.predictions(counts, True))
    learner.learn(slots, values)
    table, refined = sequences.predictions(counts, False), sequences.refinement(learner.refined)
    for start in (b"", b"the the", b"zz"):
        each = [sequences.score(table, learner.mixer, refined, *sequences.Coder().halves(start + bytes([b])))[-1] for b in range(256)]
        assert abs(sum(10**x for x in each) - 1) < 0.02


def test_empty_and_untrained(spark, documents):
    assert lm.score_sequences(documents([])).count() == 0
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = lm.score_sequences(documents([(i, "some words") for i in ids])).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_runs_are_averaged_by_bytes(spark, documents, data, monkeypatch):
    """Three runs of unlike sizes: weights are their average by bytes, the refinement map is their sum."""
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").limit(20).collect()]
    parts = [texts[:12], texts[12:13], texts[13:]]
    train = spark.createDataFrame(spark.sparkContext.parallelize([[(t,) for t in part] for part in parts], 3).flatMap(list), "text string")
    counts = lm.sequence_counts(train)
    own = sequences.predictions(counts, True)
    learners = []
    for part in parts:
        learner, coder = sequences.Learner(own), sequences.Coder()
        for piece in sequences.pieces(sequences.coded(toks(t)) for t in part):
            learner.learn(*coder.halves(piece))
        learners.append(learner)
    monkeypatch.setattr(lm, "RUN_BYTES", 1)
    mixer, refined = lm.learn_sequences(train, 1_000_000, lm._Made("runs", lm._own_predictions, spark.sparkContext.broadcast(counts)))
    want = np.average([x.mixer for x in learners], axis=0, weights=[x.seen for x in learners])
    assert np.abs(mixer - want).max() < 1e-4
    assert (refined == sum(x.refined for x in learners)).all()
