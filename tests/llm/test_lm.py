import math
import zlib
from collections import Counter

import numpy as np

from foldlake.llm import context_mixing as mixing
from foldlake.llm import lm_scoring as lm


def toks(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_base_equals_brute_force(spark, documents, data):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    rows += [(10_001, None, None, None), (None, "null id", "en", "x"), (10_002, "x" * 50_000 + " the", "zz", "x"), rows[0], (10_003, "", "en", "x")]
    counts = Counter()
    held = {id(r): zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows}
    for r in rows:
        if not held[id(r)]:
            counts.update(toks(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        words = toks(r[1])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want.append((r[0], held[id(r)], len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)))
    got = lm.score_texts(documents(rows)).collect()
    key = lambda x: (str(x[0]), x[2], x[5])
    assert sorted([(*r[:5], round(r.base_score, 4)) for r in got], key=key) == sorted(want, key=key)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    size = {(r[0], len(toks(r[1]))): len((r[1] or "").encode()) for r in rows}
    for r in got:
        n = size[r.doc_id, r.n_tokens]
        assert r.bits_per_byte is None if not n else abs(r.bits_per_byte + r.score * math.log2(10) / n) < 1e-9 * abs(r.bits_per_byte)
    mine = [r for r in got if not r.held_out]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


def brute_scores(rows):
    """log10 P(text) for rows (doc_id, text, lang), from the definitions, in one process."""
    import xxhash

    held = [zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    langs = [name for name, _ in sorted(Counter(r[2] for r in rows if r[2]).items(), key=lambda x: (-x[1], x[0]))][: lm.CLASSES - 1]
    kind = [langs.index(r[2]) if r[2] in langs else len(langs) for r in rows]
    by = [Counter() for _ in range(len(langs) + 1)]
    for r, h, k in zip(rows, held, kind):
        if not h:
            by[k].update(toks(r[1]))
    every = sum(by, Counter())
    order = sorted(every, key=lambda w: ((x := xxhash.xxh64_intdigest(w, 42)) - (x >> 63 << 64), w))
    slots = np.zeros((mixing.SLOTS, 2), np.uint32)
    mixing.count(slots, order)
    mixer, refined = mixing.first_weights(), np.zeros((mixing.GATES, mixing.STEPS, 2))
    mixing.learn(slots, order, mixer, refined)
    words = sorted({w for r in rows for w in toks(r[1])})
    q = dict(zip(words, 10 ** mixing.score(slots, words, mixer, refined)))

    def discount(c):
        once, twice = (sum(n == k for n in c.values()) for k in (1, 2))
        return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def spread(c, w, p):
        n, d = sum(c.values()), discount(c)
        return (max(c[w] - d, 0) + d * len(c) * p) / n if n else p

    train = Counter(k for k, h in zip(kind, held) if not h)
    out = []
    for r in rows:
        parts = [
            math.log10((train[k] + 1) / (sum(train.values()) + len(by))) + sum(math.log10(spread(c, w, spread(every, w, q[w]))) for w in toks(r[1]))
            for k, c in enumerate(by)
        ]
        most = max(parts)
        out.append((r[0], most + math.log10(sum(10 ** (x - most) for x in parts))))
    return out


def test_score_equals_brute_force(spark, documents, data, monkeypatch):
    rows = [(r.doc_id, r.text, r.lang, "x") for r in spark.read.parquet(f"{data}/documents.parquet").where("length(text) < 900").limit(30).collect()]
    rows += [(1_000_001, "", None, "x"), (1_000_002, None, "zz", "x"), (1_000_003, "the the THE", "en", "x")]
    want = dict(brute_scores(rows))
    monkeypatch.setattr(lm, "FIRST_BATCH", 1 << 20)
    for head in (200_000, 20):
        monkeypatch.setattr(lm, "HEAD", head)
        for r in lm.score_texts(documents(rows)).collect():
            assert abs(r.score - want[r.doc_id]) < 1e-4 * abs(want[r.doc_id])


def test_probabilities_of_words_sum_to_one_at_most(spark, documents, data):
    """All texts of one known word: their probabilities, and those of the words that are left, make no more than one."""
    words = sorted({w for r in spark.read.parquet(f"{data}/documents.parquet").limit(60).collect() for w in toks(r.text) if w != b"\n"})
    rows = [(i * 10 + 1, w.decode(), ("en", "de")[i % 2], "x") for i, w in enumerate(words)]
    got = lm.score_texts(documents(rows)).collect()
    assert 0.01 < sum(10**r.score for r in got) <= 1.0


def test_tail_words_join(spark, documents, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40)
    whole = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    monkeypatch.setattr(lm, "HEAD", 20)
    for r in lm.score_texts(docs).collect():
        assert r.n_known == whole[r.doc_id].n_known
        assert abs(r.base_score - whole[r.doc_id].base_score) < 1e-6 * abs(r.base_score)
        assert abs(r.score - whole[r.doc_id].score) < 1e-6 * abs(r.score)


def test_empty_and_untrained(spark, documents):
    assert lm.score_texts(documents([])).count() == 0
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = lm.score_texts(documents([(i, "some words") for i in ids])).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_spellings_are_probabilities():
    words = [b"the", b"then", b"there", b"a"] * 5 + [b"\n"]
    counts = np.zeros((mixing.SLOTS, 2), np.uint32)
    mixing.count(counts, words)
    mixer, refined = mixing.first_weights(), np.zeros((mixing.GATES, mixing.STEPS, 2))
    for _ in range(3):
        mixing.learn(counts, words, mixer, refined)
    # all codes of one byte: a word of one byte, or the end
    first = [bytes([b]) for b in range(256)]
    known = mixing.score(counts, [b"the", b"zzq"], mixer, refined)
    assert known[0] > known[1]
    lanes = mixing.Lanes([b"x" * (3 * mixing.LANE), b"\n"])
    assert len(lanes.word) == 5 and sum(lanes.lengths) == 3 * mixing.LANE + 2
    # the second byte after any first one: probabilities of the 256 continuations sum to 1
    total = 0.0
    for b in first:
        class_codes = mixing.Lanes.__new__(mixing.Lanes)
        class_codes.word, class_codes.lengths = np.zeros(1, np.int64), np.array([1])
        class_codes.bytes = np.zeros((1, mixing.HISTORY + 1), np.uint8)
        class_codes.bytes[0, -1] = b[0]
        class_codes.active = [1]
        p = 1.0
        for position, n, slots, value in class_codes.bits():
            inputs, gate = mixing._inputs(counts, slots, None, position, n)
            mixed = np.clip(np.einsum("kn,nk->n", inputs, mixer[gate]), -mixing.REACH, mixing.REACH)
            one = 0.5 * mixing.squash(mixed) + 0.5 * mixing.refinement(refined)[gate, mixing._step(mixed)]
            p *= float(one[0] if value[0] else 1 - one[0])
        total += p
    assert abs(total - 1.0) < 1e-4


def test_steps_take_many_bytes_whatever_the_words_lengths():
    """A batch of up to SIDE_BY_SIDE bytes is counted and scored in eight steps, and gives what its lanes give."""
    words = [b"the", b"then", b"there", b"a", b"\n", b"x" * 131, b"ab" * 40] + [b"w%d" % (i * i) for i in range(500)]
    assert len(list(mixing.Coded(words).bits(mixing.SIDE_BY_SIDE))) == 8
    counts, by_lanes = np.zeros((mixing.SLOTS, 2), np.uint32), np.zeros((mixing.SLOTS, 2), np.uint32)
    mixing.count(counts, words)
    for _, _, slots, value in mixing.Lanes(words).bits():
        np.add.at(by_lanes.reshape(-1), (slots * 2 + value).reshape(-1), 1)
    assert (counts == by_lanes).all()
    mixer, refined = mixing.first_weights(), np.zeros((mixing.GATES, mixing.STEPS, 2))
    mixing.learn(mixing.Predictors(counts, True), words, mixer, refined)
    assert refined.sum() == 8 * (sum(map(len, words)) + len(words) - 1)
    table, lanes = mixing.refinement(refined), mixing.Lanes(words)
    total = np.zeros(len(lanes.word))
    for position, n, slots, value in lanes.bits():
        inputs, gate = mixing._inputs(counts, slots, None, position, n)
        mixed = np.clip(np.einsum("kn,nk->n", inputs, mixer[gate]), -mixing.REACH, mixing.REACH)
        p = (1 - mixing.REFINED) * mixing.squash(mixed) + mixing.REFINED * table[gate, mixing._step(mixed)]
        total[:n] += np.log10(np.where(value, p, 1 - p))
    want = np.bincount(lanes.word, total, len(words))
    assert np.abs(mixing.score(counts, words, mixer, refined) - want).max() < 1e-3
