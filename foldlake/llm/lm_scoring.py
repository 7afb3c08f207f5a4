"""LM scoring: log-probabilities of whole texts under a model trained on the other texts.

score_sequences, which op2_lm_scoring returns, codes every occurrence of whole texts (sequence_mixing): slot counts of all
training texts, then one online pass of the mixer over them, in runs of at least RUN_BYTES whose weights are averaged, then
the scores. Words are counted for the base score only. score_texts is a cheaper model, of distinct words:

Spellings are modelled by logistic context mixing (context_mixing). The final refinement joins that with word counts:
a word's probability in a text of class l is

    (max(c_l - d_l, 0) + d_l * v_l * p) / n_l,   p = (max(c - d, 0) + d * v * q) / n

with q the mixing model's probability, c counts of the word, n of all tokens, v of distinct tokens in the training texts
(with index l: of the class), and d absolute discounts set from the words seen once and twice. Classes are the languages
of the training texts. The probability of a text, whose language is not used, is the sum over the classes of a class's
share of the training texts times the probability of the text in it.

Everything that is gathered (word counts, slot counts, the mixer's weights and refinement) comes from all training texts
and grows with them; the mixer learns from each distinct training word, in runs whose results are averaged. Frequent
words, HEAD at most, are known to every task; a text sends only its other words to be joined with the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common
from foldlake.llm import context_mixing as mixing
from foldlake.llm import sequence_mixing as sequences

#: Texts whose remainder is HELD_OUT are not learned from.
FOLDS, HELD_OUT = 10, 0
#: Classes of the mixture that a text's probability is summed over: the most frequent languages, and all other texts.
CLASSES = 8
#: Most words that tasks know by heart, and most distinct words that a task counts before it sends them on.
HEAD, COUNTED = 200_000, 250_000
#: Distinct words that one run of the mixer's learning takes, words that are coded side by side, at first and later on.
LEARNED_IN_RUN, FIRST_BATCH, BATCH = 400_000, 1024, 4096
#: Distinct words for each task that fills the slots, and slots in a block of them.
WORDS_PER_TASK, SLOT_BLOCK = 400_000, 16_384
#: Fewest bytes of text that one run of learning from whole texts takes, if there are as many, and counters in a block of them.
RUN_BYTES, COUNTER_BLOCK = 8_000_000, 65_536


def _languages(docs: DataFrame) -> list[str]:
    top = docs.where("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES - 1)
    return [r.lang for r in top.collect()]


def _class(languages: list[str]) -> Column:
    out = F.lit(len(languages))
    for at, name in enumerate(languages):
        out = F.when(F.col("lang") == name, at).otherwise(out)
    return out.cast("int")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def tokens(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    words.append(mixing.END)
    return words


def count_words(rows: DataFrame, classes: int) -> DataFrame:
    """word, c (occurrences in training texts), by_class: a row for each distinct word of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Counter() for _ in range(classes)]
        others: set[bytes] = set()

        def flush() -> Iterator[pa.RecordBatch]:
            for at, words in enumerate(found):
                if words:
                    yield _counts(list(words), at, list(words.values()))
                    words.clear()
            if others:
                yield _counts(list(others), 0, [0] * len(others))
                others.clear()

        for batch in batches:
            for text, held, at in zip(*(batch[c].to_pylist() for c in ("text", "held_out", "class")), strict=True):
                if held:
                    others.update(tokens(text))
                else:
                    found[at].update(tokens(text))
                if sum(map(len, found)) + len(others) > COUNTED:
                    yield from flush()
        yield from flush()

    each = rows.select("text", "held_out", "class").mapInArrow(count, "word binary, class int, c long")
    sums = [F.sum(F.when(F.col("class") == at, F.col("c")).otherwise(0)) for at in range(classes)]
    return each.groupBy("word").agg(F.sum("c").alias("c"), F.array(*sums).alias("by_class"))


def _counts(words: list[bytes], at: int, counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"word": pa.array(words, pa.binary()), "class": pa.array([at] * len(words), pa.int32()), "c": pa.array(counts, pa.int64())}
    )


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


class Totals:
    """The few numbers of the training texts that scores need."""

    def __init__(self, vocabulary: DataFrame, rows: DataFrame, classes: int):
        def four(c: Column, name: str) -> list[Column]:
            one = [F.sum(c), F.sum((c > 0).cast("long")), F.sum((c == 1).cast("long")), F.sum((c == 2).cast("long"))]
            return [F.coalesce(x, F.lit(0)).alias(f"{name}{i}") for i, x in enumerate(one)]

        columns = four(F.col("c"), "all")
        for at in range(classes):
            columns += four(F.get("by_class", F.lit(at)), f"k{at}_")
        self.steps = sorted({int(1.25**i) for i in range(120)})
        columns += [F.sum((F.col("c") >= step).cast("long")).alias(f"s{i}") for i, step in enumerate(self.steps)]
        got = [int(x or 0) for x in vocabulary.agg(*columns).first()]
        self.tokens, self.types = got[0], got[1]
        self.discount = _discount(got[2], got[3])
        self.by_class = [(n, v, _discount(a, b)) for n, v, a, b in (got[4 + 4 * k : 8 + 4 * k] for k in range(classes))]
        sizes = got[4 + 4 * classes :]
        #: Words that occur so often are known to every task.
        self.frequent = next((step for step, n in zip(self.steps, sizes) if n <= HEAD), self.steps[-1])
        texts = dict(rows.where(~F.col("held_out")).groupBy("class").count().collect())
        self.share = [np.log10((texts.get(k, 0) + 1) / (sum(texts.values()) + classes)) for k in range(classes)]

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def model(self, at: int, c: np.ndarray, c_class: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of the probability of words in a text of a class."""
        p = 10.0**spelled
        if self.tokens:
            p = (np.maximum(c - self.discount, 0.0) + self.discount * self.types * p) / self.tokens
        n, v, d = self.by_class[at]
        if n:
            p = (np.maximum(c_class - d, 0.0) + d * v * p) / n
        return np.log10(np.maximum(p, 1e-300))


def slot_counts(words: DataFrame, types: int) -> np.ndarray:
    """The counters of the mixing model's slots over all training words, added up in blocks."""
    blocks = -(-mixing.SLOTS // SLOT_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((blocks * SLOT_BLOCK, 2), np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                mixing.count(counts, batch["word"].slice(at, 8192).to_pylist())
        parts = counts.reshape(blocks, -1)
        some = [i for i in range(blocks) if parts[i].any()]
        for i in some:
            yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()), "counts": [zlib.compress(parts[i].tobytes(), 1)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                more = np.frombuffer(zlib.decompress(counts), np.uint32)
                sums[block] = sums[block] + more if block in sums else more.astype(np.uint64)
        for block, counts in sums.items():
            packed = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": [zlib.compress(packed, 1)]})

    spread = words.select("word").repartition(max(1, -(-types // WORDS_PER_TASK)))
    found = spread.mapInArrow(count, "block int, counts binary").repartition(common.partitions(words.sparkSession), "block")
    total = np.zeros((blocks, SLOT_BLOCK * 2), np.uint32)
    for row in found.mapInArrow(add, "block int, counts binary").toLocalIterator():
        total[row.block] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return total.reshape(-1, 2)[: mixing.SLOTS]


def learn_mixer(words: DataFrame, types: int, counts) -> tuple[np.ndarray, np.ndarray]:
    """The mixer's weights, averaged over runs that together learn from every word, and the refinement map, added up.
    What runs found is added up by Spark, and only the sums, of fixed size, come to the driver."""
    runs = max(1, -(-types // LEARNED_IN_RUN))
    cells = max(mixing.GATES * mixing.INPUTS, mixing.GATES * mixing.STEPS * 2)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, refined, seen = mixing.first_weights(), np.zeros((mixing.GATES, mixing.STEPS, 2)), 0
        table = mixing.Predictors(counts.value, True)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                some = batch["word"].slice(start, FIRST_BATCH if seen < 64 * FIRST_BATCH else BATCH).to_pylist()
                mixing.learn(table, some, mixer, refined)
                seen, start = seen + len(some), start + len(some)
        if seen:
            weights = np.zeros(cells)
            weights[: mixer.size] = mixer.reshape(-1).astype(np.float64) * seen
            map_cells = np.zeros(cells)
            map_cells[: refined.size] = refined.reshape(-1)
            columns = {"cell": pa.array(np.arange(cells), pa.int32()), "weight": weights, "refined": map_cells, "words": np.full(cells, float(seen))}
            yield pa.RecordBatch.from_pydict(columns)

    dealt = words.select("word").repartition(runs, F.xxhash64("word")).sortWithinPartitions(F.xxhash64("word"), "word")
    found = dealt.mapInArrow(learn, "cell int, weight double, refined double, words double")
    got = found.groupBy("cell").agg(F.sum("weight"), F.sum("refined"), F.sum("words")).orderBy("cell").collect()
    if not got:
        return mixing.first_weights(), np.zeros((mixing.GATES, mixing.STEPS, 2))
    weight, refined, words_seen = (np.array(x, np.float64) for x in list(zip(*got))[1:])
    mixer = (weight / words_seen)[: mixing.GATES * mixing.INPUTS].reshape(mixing.GATES, mixing.INPUTS)
    return mixer.astype(np.float32), refined[: mixing.GATES * mixing.STEPS * 2].reshape(mixing.GATES, mixing.STEPS, 2)


def spell(vocabulary: DataFrame, counts, mixer: np.ndarray, refined: np.ndarray) -> DataFrame:
    """vocabulary with spelled: log10 of the mixing model's probability of each word."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = mixing.Predictors(counts.value, False)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                spelled = mixing.score(table, part["word"].to_pylist(), mixer, refined)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spelled)], names=[*part.schema.names, "spelled"])

    return vocabulary.select("word", "c", "by_class").mapInArrow(score, "word binary, c long, by_class array<long>, spelled double")


class Head:
    """The frequent words: their places, and for each the base score, whether it is known, and the score by class."""

    def __init__(self, table: pa.Table, totals: Totals):
        words = table["word"].to_pylist()
        self.place = dict(zip(words, range(len(words))))
        c, spelled = table["c"].to_numpy().astype(float), table["spelled"].to_numpy()
        by_class = np.array(table["by_class"].to_pylist(), float).reshape(len(words), len(totals.by_class))
        self.base = np.append(totals.base(c), 0.0)
        self.known = np.append(c > 0, False).astype(np.int64)
        self.model = np.array([np.append(totals.model(k, c, by_class[:, k], spelled), 0.0) for k in range(len(totals.by_class))])
        self.rest = len(words)


@lru_cache(1)
def _head(key: str, load) -> Head:
    return Head(*load())


class _Load:
    """What Head is built from, equal to others for the same key, so that a worker builds it once."""

    def __init__(self, key: str, shared):
        self.key, self.shared = key, shared

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return self.key == other.key

    def __call__(self) -> tuple[pa.Table, Totals]:
        data, totals = self.shared.value
        return pa.ipc.open_stream(data).read_all(), totals


_TEXTS = pa.schema(
    [("row", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("bytes", pa.int64())]
    + [("base", pa.float64()), ("scores", pa.list_(pa.float64())), ("rest", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))]
)


def score_heads(rows: DataFrame, load: _Load) -> DataFrame:
    """For each text: its number in the table, sums over its frequent words (of the score for each class), and the rest
    of its words with their counts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _head(load.key, load)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            out, held, size = [], batch["held_out"].to_pylist(), batch["bytes"].to_pylist()
            for at, text in enumerate(batch["text"].to_pylist()):
                words = tokens(text)
                place = np.fromiter((head.place.get(w, head.rest) for w in words), np.int64, len(words))
                rest = Counter(words[i] for i in np.flatnonzero(place == head.rest).tolist())
                known, base = int(head.known[place].sum()), float(head.base[place].sum())
                scores = [float(one[place].sum()) for one in head.model]
                out.append((number, held[at], len(words), known, size[at], base, scores, list(rest), list(rest.values())))
                number += 1
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _TEXTS)] if out else [pa.array([], f.type) for f in _TEXTS]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *_TEXTS.names])

    kind = dict(rows.dtypes)["doc_id"]
    schema = "row long, held_out boolean, n_tokens long, n_known long, bytes long, base double, scores array<double>, rest array<binary>, times array<int>"
    sized = rows.select("doc_id", "text", "held_out", F.octet_length("text").cast("long").alias("bytes"))
    return sized.mapInArrow(score, f"doc_id {kind}, {schema}")


def _log_model(totals: Totals) -> list[Column]:
    """Totals.model() for each class as a column of c, by_class and spelled."""
    p = F.pow(F.lit(10.0), F.col("spelled"))
    if totals.tokens:
        p = (F.greatest(F.col("c") - F.lit(totals.discount), F.lit(0.0)) + F.lit(totals.discount * totals.types) * p) / F.lit(float(totals.tokens))
    out = []
    for at, (n, v, d) in enumerate(totals.by_class):
        own = (F.greatest(F.get("by_class", F.lit(at)) - F.lit(d), F.lit(0.0)) + F.lit(d * v) * p) / F.lit(float(n)) if n else p
        out.append(F.log10(F.greatest(own, F.lit(1e-300))))
    return out


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs.

    A null text counts as empty and has one token, the end, and no bytes, so its bits_per_byte is null; a null doc_id
    counts as the text '' in choosing the held-out rows; a null or rare language is in the class of all others. Repeated
    rows are learned from and scored each time. If no text is learned from, counts are zero and the mixing model is its
    first weights. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), common.text_or_empty().alias("text"))
    languages = _languages(docs)
    classes = len(languages) + 1
    rows = docs.select("doc_id", "text", held_out().alias("held_out"), _class(languages).alias("class"))
    vocabulary = common.materialize(count_words(rows, classes), "vocabulary")
    totals = Totals(vocabulary, rows, classes)
    seen = vocabulary.where("c > 0")
    counts = spark.sparkContext.broadcast(slot_counts(seen, totals.types))
    mixer, refined = learn_mixer(seen, totals.types, counts)
    spelled = common.materialize(spell(vocabulary, counts, mixer, refined), "spelled")
    common.drop(vocabulary)

    frequent = spelled.where(F.col("c") >= totals.frequent).select("word", "c", "by_class", "spelled").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, frequent.schema) as stream:
        stream.write_table(frequent)
    key = common.work_path(spark, "head")
    texts = score_heads(rows, _Load(key, spark.sparkContext.broadcast((sink.getvalue().to_pybytes(), totals))))
    texts = common.materialize(texts, "texts")

    rest = texts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w"))
    rest = rest.select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("times"))
    rare = spelled.where(F.col("c") < totals.frequent).select("word", "c", "by_class", "spelled")
    found = rest.join(rare, "word")
    base = F.log10((F.col("c") + 0.1) / F.lit(totals.tokens + 0.1 * (totals.types + 1)))
    sums = found.groupBy("row").agg(
        F.sum(F.col("times") * (F.col("c") > 0).cast("long")).alias("more_known"),
        F.sum(F.col("times") * base).alias("more_base"),
        *[F.sum(F.col("times") * one).alias(f"more{k}") for k, one in enumerate(_log_model(totals))],
    )
    out = texts.drop("rest", "times").join(sums, "row", "left")
    each = [F.get("scores", F.lit(k)) + F.coalesce(f"more{k}", F.lit(0.0)) + F.lit(float(share)) for k, share in enumerate(totals.share)]
    out = out.withColumn("each", F.array(*each)).withColumn("most", F.array_max("each"))
    over = F.aggregate("each", F.lit(0.0), lambda total, one: total + F.pow(F.lit(10.0), one - F.col("most")))
    out = out.withColumn("score", F.col("most") + F.log10(over))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
        F.when(F.col("bytes") > 0, -F.col("score") * float(np.log2(10.0)) / F.col("bytes")).alias("bits_per_byte"),
    )


def sequence_counts(train: DataFrame) -> np.ndarray:
    """The counters of the sequence model over all bytes of the training texts, added up in blocks."""
    blocks = -(-sequences.SLOTS // COUNTER_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(blocks * COUNTER_BLOCK, np.uint32)
        for slots, _ in _halves(batches):
            sequences.count(counts, slots)
        parts = counts.reshape(blocks, -1)
        for i in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()), "counts": [zlib.compress(parts[i].tobytes(), 1)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                more = np.frombuffer(zlib.decompress(counts), np.uint32)
                sums[block] = sums[block] + more if block in sums else more.astype(np.uint64)
        for block, counts in sums.items():
            packed = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": [zlib.compress(packed, 1)]})

    found = train.mapInArrow(count, "block int, counts binary").repartition(common.partitions(train.sparkSession), "block")
    total = np.zeros((blocks, COUNTER_BLOCK), np.uint32)
    for row in found.mapInArrow(add, "block int, counts binary").collect():  # of fixed size
        total[row.block] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return total.reshape(-1)[: sequences.SLOTS]


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of the texts of all batches, one after the other."""
    sequences.keep_memory()
    coder = sequences.Coder()
    texts = (sequences.coded(tokens(text)) for batch in batches for text in batch["text"].to_pylist())
    for piece in sequences.pieces(texts):
        yield coder.halves(piece)


class _Made:
    """What a worker makes once from a broadcast; equal to others for the same key."""

    def __init__(self, key: str, make, shared):
        self.key, self.make, self.shared = key, make, shared

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other) -> bool:
        return self.key == other.key


@common.remembered
def _made(of: _Made):
    return of.make(of.shared.value)


def _own_predictions(counts: np.ndarray) -> np.ndarray:
    return sequences.predictions(counts, True)


def learn_sequences(train: DataFrame, size: int, table: _Made) -> tuple[np.ndarray, np.ndarray]:
    """The mixer's weights, averaged over runs that together learn from every byte of the training texts, and the
    refinement map, added up. A run takes whole partitions, at least RUN_BYTES. Spark adds up what runs found."""
    shapes = sequences.first_weights().shape, sequences.no_refinement().shape
    sizes = [int(np.prod(shape)) for shape in shapes]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = sequences.Learner(_made(table))
        for slots, values in _halves(batches):
            learner.learn(slots, values)
        if learner.seen:
            found = np.concatenate((learner.mixer.reshape(-1).astype(np.float64) * learner.seen, learner.refined.reshape(-1)))
            columns = {"cell": pa.array(np.arange(len(found)), pa.int32()), "found": found, "seen": np.full(len(found), float(learner.seen))}
            yield pa.RecordBatch.from_pydict(columns)

    dealt = train.coalesce(max(1, -(-size // RUN_BYTES)))
    found = dealt.mapInArrow(learn, "cell int, found double, seen double")
    got = found.groupBy("cell").agg(F.sum("found"), F.sum("seen")).orderBy("cell").collect()
    if not got:
        return sequences.first_weights(), sequences.no_refinement()
    sums, seen = (np.array(x, np.float64) for x in list(zip(*got))[1:])
    return (sums / seen)[: sizes[0]].reshape(shapes[0]).astype(np.float32), sums[sizes[0] :].reshape(shapes[1])


def _for_scores(shared: tuple) -> tuple:
    """The frequent words with their counts, and what the model's score of bytes needs."""
    data, counts, mixer, refined = shared
    frequent = pa.ipc.open_stream(data).read_all()
    known = dict(zip(frequent["word"].to_pylist(), frequent["c"].to_pylist()))
    return known, (sequences.predictions(counts, False), mixer, sequences.refinement(refined))


_SCORED = pa.schema(
    [("row", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("bytes", pa.int64())]
    + [("base", pa.float64()), ("score", pa.float64()), ("rest", pa.list_(pa.binary())), ("times", pa.list_(pa.int32()))]
)


def score_whole(rows: DataFrame, made: _Made, base: tuple[float, int]) -> DataFrame:
    """For each text: its number in the table, its score, the base score's sum over its frequent words, and the rest of
    its words with their counts."""
    all_tokens, types = base

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = _made(made)
        sequences.keep_memory()
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            out, texts = [], []
            for text, held, size in zip(*(batch[c].to_pylist() for c in ("text", "held_out", "bytes")), strict=True):
                words = tokens(text)
                c = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                rest = Counter(words[i] for i in np.flatnonzero(c < 0).tolist())
                c = c[c >= 0]
                total = float(np.log10((c + 0.1) / (all_tokens + 0.1 * (types + 1))).sum())
                out.append((number, held, len(words), int((c > 0).sum()), size, total, 0.0, list(rest), list(rest.values())))
                texts.append(sequences.coded(words))
                number += 1
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _SCORED)] if out else [pa.array([], f.type) for f in _SCORED]
            columns[6] = pa.array(_text_scores(texts, *model))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *_SCORED.names])

    kind = dict(rows.dtypes)["doc_id"]
    schema = "row long, held_out boolean, n_tokens long, n_known long, bytes long, base double, score double, rest array<binary>, times array<int>"
    sized = rows.select("doc_id", "text", "held_out", F.octet_length("text").cast("long").alias("bytes"))
    return sized.mapInArrow(score, f"doc_id {kind}, {schema}")


def _text_scores(texts: list[bytes], table: np.ndarray, mixer: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """log10 of the probability of each coded text."""
    scores, done, coder = np.zeros(len(texts)), 0, sequences.Coder()
    for piece in sequences.pieces(iter(texts)):
        ends = np.frombuffer(piece, np.uint8) == sequences.END
        found = np.bincount(np.cumsum(ends) - ends, sequences.score(table, mixer, refined, *coder.halves(piece)))
        scores[done : done + len(found)] += found
        done += int(ends.sum())
    return scores


def score_sequences(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs.

    score is that of the sequence model. Odd rows are treated as in score_texts(); languages are not used.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    rows = docs.select("doc_id", common.text_or_empty().alias("text")).withColumn("held_out", held_out())
    counted = count_words(rows.withColumn("class", F.lit(0)), 1).select("word", "c")
    vocabulary = common.materialize(counted, "vocabulary")
    steps = sorted({int(1.25**i) for i in range(120)})
    sizes = [F.sum((F.col("c") >= step).cast("long")) for step in steps]
    size = F.sum(F.col("c") * (F.octet_length("word") + 1))
    got = [int(x or 0) for x in vocabulary.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), size, *sizes).first()]
    all_tokens, types, size = got[:3]
    frequent_from = next((step for step, n in zip(steps, got[3:]) if n <= HEAD), steps[-1])

    train = rows.where(~F.col("held_out")).select("text")
    counts = sequence_counts(train)
    shared = spark.sparkContext.broadcast(counts)
    mixer, refined = learn_sequences(train, size, _Made(common.work_path(spark, "own"), _own_predictions, shared))
    shared.unpersist()

    frequent = vocabulary.where(F.col("c") >= frequent_from).toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, frequent.schema) as stream:
        stream.write_table(frequent)
    shared = spark.sparkContext.broadcast((sink.getvalue().to_pybytes(), counts, mixer, refined))
    made = _Made(common.work_path(spark, "scores"), _for_scores, shared)
    texts = common.materialize(score_whole(rows, made, (all_tokens, types)), "texts")

    rest = texts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w"))
    rest = rest.select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("times"))
    base = F.log10((F.col("c") + 0.1) / F.lit(all_tokens + 0.1 * (types + 1)))
    sums = rest.join(vocabulary.where(F.col("c") < frequent_from), "word").groupBy("row").agg(
        F.sum(F.col("times") * (F.col("c") > 0).cast("long")).alias("more_known"),
        F.sum(F.col("times") * base).alias("more_base"),
    )
    return texts.drop("rest", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
        F.when(F.col("bytes") > 0, -F.col("score") * float(np.log2(10.0)) / F.col("bytes")).alias("bits_per_byte"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole texts; score_sequences() says what odd rows give."""
    return score_sequences(common.table(spark, sf_dir, "documents"))
