"""N-gram Jaccard self-join by sizes: subsets of small sets, inverted lists of large ones, exact for every pair.

A document's set holds the 64-bit hashes of its distinct shingles. Documents with equal sets are one node. Two sets with
Jaccard similarity t or more share t times the larger size at least, so

- sets up to a boundary size enumerate their subsets of the few sizes that the threshold asks of them and a partner:
  sets with an equal subset of that size link at once, without being compared;
- larger sets share one of the first `size - ceil(t * size) + 1` shingles of each in any common order. The order puts
  shingles first whose counter in a fixed-size count sketch of all documents is low, so the inverted lists of passages
  that many documents share are rarely scanned. The sketch only steers the order; any order finds every pair.

The boundary is the size at which enumerating costs least in all, given the sizes of the sets and the mean length of the
inverted lists. Of inverted lists with the same members one is scanned. Within a list a set first proposes those that
look most similar before and after it, in blocks of about OWN_BLOCK that meet themselves; only in lists of three and
more whose members these links leave apart, all pairs are proposed that the size and bitmap bounds allow. So groups of
copies of any size take a number of rows near their size, and still no link between components is lost. Proposed pairs
are verified on the whole sets. Tables are dropped once their successors are written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldlake.llm import common
from foldlake.llm.components import components
from foldlake.llm.sketch import Marks, count_sketch

SHINGLE = 4
PERCENT = 85
SKETCH_BITS = 22
SMALL_MOST = 24
#: What comparing a posting with another member of its list costs, in postings.
COMPARED = 8
#: Members of a list that meet each other first, and members of a block of what is compared afterwards.
OWN_BLOCK, BLOCK = 512, 2048
BITMAP_BYTES = 128
WIDEST_BITS = 1 << 17

_SUBSET = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("k", pa.int32())])
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    MOST = 150_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.MOST:
            self.clear()
        words = text.encode().lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@common.remembered
def word_hashes() -> WordHashes:
    """One memory for each Python worker, which runs many tasks."""
    return WordHashes()


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hashes of the shingles of a text's word hashes, in order; of all its words together if they are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    value = words[:n] * _M1
    for at in range(1, size):
        value ^= value >> np.uint64(31)
        value = (value + words[at : at + n]) * _M2
    value ^= value >> np.uint64(29)
    value *= _M3
    value ^= value >> np.uint64(32)
    return value


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingles(words, size))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def least_shared(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def shared_of(one: int, other: int, percent: int) -> int:
    """How many elements two sets of these sizes share at least if they link."""
    return -(-percent * (one + other) // (100 + percent))


def subset_sizes(size: int, most: int, percent: int) -> set[int]:
    """Sizes of the subsets that a set of this size enumerates to meet all sets of up to most elements: what it and each
    of them share at least."""
    partners = range(least_shared(size, percent), min(most, 100 * size // percent) + 1)
    return {k for k in (shared_of(size, other, percent) for other in partners) if k <= size}


def levels(counts: np.ndarray) -> np.ndarray:
    """Counters on a logarithmic scale of one byte."""
    return np.minimum(255, 4 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)


def bitmap(values: np.ndarray) -> bytes:
    """For each of the bits whether an odd number of values falls on it: two sets differ in as many values at least.
    There are about as many bits as values, and BITMAP_BYTES at least."""
    bits = max(8 * BITMAP_BYTES, min(WIDEST_BITS, 1 << max(0, len(values) - 1).bit_length()))
    odd = np.bincount((values >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap (as bytes) of the same values with fewer bits."""
    return bits if len(bits) == size else np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def describe(docs: DataFrame, order: np.ndarray, size: int, percent: int) -> DataFrame:
    """doc_id, n, fp (128-bit hash of the set), prefix, wide (the set's bitmap), small (the set, if it has SMALL_MOST
    elements at most)."""
    spark = docs.sparkSession
    shared, mask = spark.sparkContext.broadcast(order), np.uint64(len(order) - 1)

    def describe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = word_hashes(), shared.value
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                values = shingle_set(known.of(text), size)
                n = len(values)
                take = n - least_shared(n, percent) + 1 if n else 0
                first = values[np.lexsort((values, rank[(values & mask).astype(np.int64)]))[:take]]
                small = values.view(np.int64) if n <= SMALL_MOST else None
                out.append((n, xxhash.xxh128_digest(values.tobytes()), first.view(np.int64), bitmap(values), small))
            kinds = (pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", "n", "fp", "prefix", "wide", "small"])

    return docs.mapInArrow(describe_batches, "doc_id long, n int, fp binary, prefix array<long>, wide binary, small array<long>")


def choose_boundary(sizes: dict[int, int], mean_list: float, percent: int) -> int:
    """The largest size whose sets enumerate subsets: where subsets of sets up to it and scans of sets above it, and of
    those just below that large sets can match, cost least in all.

    The unit is one posting. An equal subset is a link at once; of a scanned list each other member costs COMPARED, as
    bitmaps travel with its posting and whole sets are fetched to verify a pair.
    """

    def scan(size: int) -> float:
        return (size - least_shared(size, percent) + 1) * (1 + COMPARED * (mean_list - 1))

    def cost(most: int) -> float:
        total = 0.0
        for size, count in sizes.items():
            if size <= most:
                total += count * sum(math.comb(size, k) for k in subset_sizes(size, most, percent))
            if size >= least_shared(most + 1, percent):
                total += count * scan(size)
        return total

    return min(range(SMALL_MOST + 1), key=cost)


def subsets(nodes: DataFrame, most: int, percent: int) -> DataFrame:
    """key, node, n, k for each enumerated subset (of k elements) of the sets of up to most elements."""

    def enumerate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, values in zip(batch["node"].to_pylist(), batch["small"].to_pylist(), strict=True):
                array = np.array(values, np.int64)
                for k in sorted(subset_sizes(len(values), most, percent)):
                    keys = [
                        _signed(xxhash.xxh64_intdigest(array[list(some)].tobytes(), seed=k))
                        for some in combinations(range(len(values)), k)
                    ]
                    rows = len(keys)
                    columns = [keys, [node] * rows, [len(values)] * rows, [k] * rows]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SUBSET.types)], schema=_SUBSET)

    return nodes.where(F.col("n") <= most).select("node", "small").mapInArrow(enumerate_batches, "key long, node long, n int, k int")


def light_links(nodes: DataFrame, most: int, percent: int) -> DataFrame:
    """a, b: links between sets of up to most elements, as many as join all that such links join.

    Sets that share a subset of the size that the threshold asks of the two link, without more ado. The smallest member
    of a subset's list asks least of each other member, so links to it alone leave nothing out: rows in proportion to the
    list, and a partial minimum before the shuffle.
    """
    found = subsets(nodes, most, percent)
    least = found.groupBy("key").agg(F.min(F.struct("n", "node")).alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    both = found.join(least, "key").where(F.col("node") != F.col("least.node"))
    total = F.col("n") + F.col("least.n")
    enough = F.col("k") * (100 + percent) >= percent * total
    return both.where(enough).select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct()


def lists(nodes: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """The inverted lists of prefixes as postings key, node, n, c (members), and the boundary.

    Of lists with the same members one stays: near copies share most of their prefixes, and meet in one list then. Lists
    of sets that all lie below the sizes that large sets can match are not made.
    """
    scanned = nodes.select(F.explode("prefix").alias("key"))
    counts = common.materialize(scanned.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    postings = nodes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    several, squares = counts.agg(F.sum("c"), F.sum(F.col("c") * F.col("c"))).first()
    mean_list = (postings - (several or 0) + (squares or 0)) / max(1, postings)
    sizes = {r.n: r["count"] for r in nodes.where(F.col("n") <= SMALL_MOST).groupBy("n").count().collect()}
    most = choose_boundary(sizes, mean_list, percent)
    marks = Marks(counts, "key")
    common.drop(counts)

    large = nodes.where(F.col("n") >= least_shared(most + 1, percent)).select("node", "n", "prefix")
    large = common.materialize(large.mapInArrow(_postings(marks), "key long, node long, n int"), "scanned")
    members = [F.count("*").alias("c"), F.sum(F.xxhash64("node")).alias("s"), F.expr("bit_xor(xxhash64(node, 1))").alias("x")]
    with common.setting(nodes.sparkSession, "spark.sql.ansi.enabled", "false"):  # the sum of hashes may wrap
        each = large.groupBy("key").agg(*members).where("c > 1").groupBy("c", "s", "x").agg(F.min("key").alias("key"))
        kept = common.materialize(each.select("key", "c"), "kept")
    few = large.mapInArrow(_marked(Marks(kept, "key")), "key long, node long, n int")
    out = common.materialize(few.join(kept, "key").select("key", "node", "n", "c"), "lists")
    common.drop(large, kept)
    return out, most


def _postings(marks: Marks):
    """Of each node's prefix the marked keys: key, node, n."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths = pa.compute.list_flatten(batch["prefix"]), pa.compute.list_value_length(batch["prefix"])
            at = np.repeat(np.arange(batch.num_rows), lengths.to_numpy(zero_copy_only=False))
            found = np.flatnonzero(marks.of(keys.to_numpy(zero_copy_only=False)))
            rows = pa.array(at[found])
            columns = [keys.take(pa.array(found)), batch["node"].take(rows), batch["n"].take(rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "n"])

    return repeated


def _marked(marks: Marks):
    """The rows whose first column is marked."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(np.flatnonzero(marks.of(batch[0].to_numpy(zero_copy_only=False)))))

    return keep


def bitmaps(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, n, bitmap (of BITMAP_BYTES) for the nodes that stand in wanted."""
    marks = Marks(wanted, "node")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _marked(marks)(batches):
            bits = [fold(np.frombuffer(w, np.uint8), BITMAP_BYTES).tobytes() for w in batch["wide"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], pa.array(bits, pa.binary())], names=["node", "n", "bitmap"])

    return nodes.select("node", "n", "wide").mapInArrow(folded, "node long, n int, bitmap binary")


def in_blocks(postings: DataFrame) -> DataFrame:
    """Adds i, j (the pair of blocks that meet) and own (the posting's block) to postings with label.

    A list of up to BLOCK members is one block that meets itself. Of a longer one, the members of the label that most
    have, which need not meet each other, are cut into blocks that meet only the blocks of all others. So a list of
    which nearly all are linked makes rows in proportion to its length.
    """
    long = postings.where(F.col("c") > BLOCK)
    by_label = long.groupBy("key", "label").agg(F.count("*").alias("size"), F.first("c").alias("c"))
    bulk = by_label.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"), F.first("c").alias("c"))
    blocks = lambda x: F.ceil(x / BLOCK).cast("int")
    bulk = bulk.select("key", F.col("top.label").alias("most"), blocks(F.col("top.size")).alias("p"), blocks(F.col("c") - F.col("top.size")).alias("q"))
    df = long.join(bulk, "key").withColumn("h", F.xxhash64("node", "key"))
    first = F.col("label") == F.col("most")
    df = df.withColumn("own", F.when(first, F.expr("int(pmod(h, p))")).otherwise(F.col("p") + F.expr("int(pmod(h, greatest(q, 1)))")))
    df = df.withColumn("other", F.explode(F.when(first, F.expr("sequence(p, p + q - 1)")).otherwise(F.expr("sequence(0, p + q - 1)"))))
    df = df.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    zero = F.lit(0)
    short = postings.where(F.col("c") <= BLOCK).select("*", zero.alias("own"), zero.alias("i"), zero.alias("j"))
    return short.unionByName(df.select(*short.columns))


def own_blocks(postings: DataFrame) -> DataFrame:
    """Adds i, j and own so that each block of a list meets itself only: one row for each posting."""
    own = F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("c") / OWN_BLOCK)).cast("int")
    return postings.select("*", own.alias("own"), own.alias("i"), own.alias("j"))


def _pairs(columns: dict[str, np.ndarray], percent: int, rest: bool) -> list[tuple[int, int]]:
    """Pairs of one group, in which two blocks meet, or one with itself. rest: all allowed pairs of different
    components; else for each member those that its bitmap calls most similar among the members before and after it.
    So a member that any other fits is in some pair."""
    node, n, own, label, bits = (columns[k] for k in ("node", "n", "own", "label", "bits"))
    order = np.lexsort((node, own))
    node, n, own, label, bits = node[order], n[order], own[order], label[order], bits[order]
    cut = int(np.searchsorted(own, own[-1]))  # 0 if one block meets itself
    out = []
    for at in range(len(node)):
        sides = [slice(0, at), slice(at + 1, None)] if not cut else [slice(0, cut) if at >= cut else slice(cut, None)]
        for side in sides[:1] if rest and (not cut or at >= cut) else () if rest else sides:
            sizes = n[side] + n[at]
            most = (100 - percent) * sizes // (100 + percent)  # sets that differ in more are below the threshold
            bound = np.maximum(np.bitwise_count(bits[side] ^ bits[at]).sum(axis=1, dtype=np.int64), np.abs(n[side] - n[at]))
            fits = (bound <= most) & (node[side] != node[at])
            if rest:
                fits &= label[side] != label[at]
                out += [(int(node[at]), int(other)) for other in node[side][fits]]
            elif fits.any():
                out.append((int(node[at]), int(node[side][np.where(fits, (most - bound) / sizes, -1.0).argmax()])))
    return out


def propose(postings: DataFrame, percent: int, rest: bool) -> DataFrame:
    """Distinct pairs a > b of nodes that may be linked, from postings with bitmap and label, in blocks."""
    names = ["key", "i", "j", "node", "n", "own", "label", "bitmap"]
    # Dealt out by an expression of its own: a plain repartition by a join's keys would be planned away, and adaptive
    # execution could then split a group of the join over tasks.
    dealt = postings.select(*names).repartition(common.partitions(postings.sparkSession), F.xxhash64("key", "i", "j"))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {k: batch[k].to_numpy(zero_copy_only=False) for k in names[:-1]}
            now["bits"] = np.frombuffer(b"".join(batch["bitmap"].to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            if held:
                now = {k: np.concatenate([held[0][k], now[k]]) for k in now}
            change = np.flatnonzero((np.diff(now["key"]) != 0) | (np.diff(now["i"]) != 0) | (np.diff(now["j"]) != 0)) + 1
            starts = [0, *change.tolist()]
            for a, b in zip(starts, starts[1:]):
                yield {k: v[a:b] for k, v in now.items()}
            held = [{k: v[starts[-1] :] for k, v in now.items()}]
        yield from held

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for group in groups(batches):
            found.update(_pairs(group, percent, rest))
            if len(found) > 100_000:
                yield _pair_batch(found)
                found = set()
        if found:
            yield _pair_batch(found)

    return dealt.sortWithinPartitions("key", "i", "j").mapInArrow(pair, "a long, b long").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _pair_batch(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def sieve(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the sizes and the whole bitmaps allow; of a node's sets under one id, any may allow it."""
    ends_of = ends(pairs)
    wanted = nodes.select("node", "n", "wide").mapInArrow(_marked(Marks(ends_of, "node")), "node long, n int, wide binary")
    sides = [wanted.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at, (na, nb, wa, wb) in enumerate(zip(*(batch[c].to_pylist() for c in ("na", "nb", "wa", "wb")), strict=True)):
                size = min(len(wa), len(wb))
                one, two = (fold(np.frombuffer(w, np.uint8), size) for w in (wa, wb))
                if int(np.bitwise_count(one ^ two).sum()) <= (100 - percent) * (na + nb) // (100 + percent):
                    keep.append(at)
            yield pa.RecordBatch.from_arrays([batch[c].take(pa.array(keep, pa.int64())) for c in "ab"], names=["a", "b"])

    out = common.materialize(both.mapInArrow(allowed, "a long, b long").distinct(), "sieved")
    common.drop(ends_of)
    return out


def whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """doc_id, values for the documents whose id is in wanted (node). Ids pass a bitmap first, so that texts need not be
    shuffled to find them."""
    marks = Marks(wanted, "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in _marked(marks)(batches):
            for cut in range(0, batch.num_rows, 64):
                part = batch.slice(cut, 64)
                values = [shingle_set(known.of(t), size).view(np.int64) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "values"])

    found = docs.where("doc_id IS NOT NULL").mapInArrow(sets, "doc_id long, values array<long>")
    return found.join(wanted.select(F.col("node").alias("doc_id")), "doc_id")


def ends(pairs: DataFrame) -> DataFrame:
    """node: the nodes of pairs, each once, in a written table."""
    return common.materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("values").alias("va"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("values").alias("vb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("va", "vb"))
    both = both.select("a", "b", (F.size("va") + F.size("vb")).alias("sizes"), shared.alias("shared"))
    return both.where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b").distinct()


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text), over whole texts.

    Two documents link when 100 * shared >= percent * (all distinct shingles of both); component_id is the smallest
    doc_id reachable by links. A null or empty text has no shingles and links with nothing; nor do rows without doc_id,
    whose component_id is null. Rows with the same doc_id are one document and share a component_id. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        known = word_hashes()
        for text in batch["text"].to_pylist():
            yield shingles(known.of(text), size)

    order = count_sketch(docs, hashes, SKETCH_BITS, levels)
    described = common.materialize(describe(docs, order, size, percent), "described")
    linked = described.where("n > 0 AND doc_id IS NOT NULL")
    nodes = common.materialize(linked.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    known = nodes.select(F.col("fp").alias("k_fp"), "node")
    can_link = (F.col("fp") == F.col("k_fp")) & F.col("doc_id").isNotNull()
    assigned = common.materialize(described.select("doc_id", "n", "fp").join(known, can_link, "left").drop("fp", "k_fp"), "assigned")
    ids = assigned.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
    same = assigned.join(ids, "doc_id").where("node <> x").select(F.col("node").alias("a"), F.col("x").alias("b"))
    firsts = linked.dropDuplicates(["doc_id", "fp"]).join(nodes.select("fp", F.col("node").alias("doc_id")), ["fp", "doc_id"])
    firsts = common.materialize(firsts.select(F.col("doc_id").alias("node"), "n", "prefix", "wide", "small"), "firsts")
    common.drop(described, nodes)

    postings, most = lists(firsts, percent)
    maps = common.materialize(bitmaps(firsts, postings), "bitmaps")
    pairs = propose(own_blocks(postings.withColumn("label", F.lit(0).cast("long"))).join(maps, ["node", "n"]), percent, rest=False)
    pairs = common.materialize(pairs, "pairs")
    sieved = sieve(pairs, firsts, percent)
    wanted = ends(sieved)
    sets = common.materialize(whole_sets(docs, wanted, size), "sets")
    light = light_links(firsts, most, percent)
    first = components(verify(sieved, sets, percent).union(light).union(same))
    common.drop(pairs, sieved, wanted)

    # All members of a list of two have met; of longer ones those that are still apart.
    labels = first.select(F.col("a").alias("node"), F.col("b").alias("to"))
    labelled = postings.where("c > 2").join(labels, "node", "left").withColumn("label", F.coalesce("to", "node")).drop("to")
    apart = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    labelled = common.materialize(labelled.join(apart.select("key"), "key"), "labelled")
    more = common.materialize(propose(in_blocks(labelled).join(maps, ["node", "n"]), percent, rest=True), "pairs")
    common.drop(postings)
    sieved = sieve(more, firsts, percent)
    wanted = ends(sieved)
    lacking = common.materialize(wanted.join(sets.select(F.col("doc_id").alias("node")), "node", "left_anti"), "lacking")
    both = sets
    if lacking.limit(1).count():
        later = common.materialize(whole_sets(docs, lacking, size), "sets")
        both = sets.unionByName(later)
    found = components(first.union(verify(sieved, both, percent)))
    common.drop(first, firsts, maps, labelled, more, sieved, wanted, lacking, sets, *([later] if both is not sets else []))
    to = found.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = assigned.join(to, "node", "left").select("doc_id", "n", F.coalesce("component", "node", "doc_id").alias("component_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs with the smallest doc_id of each group of linked documents, with their columns unchanged.

    Of rows with the same doc_id the one with the smallest text stays. Rows without doc_id and rows without words are no
    copies of anything and stay.
    """
    found = common.materialize(link(docs, size, percent).where("doc_id IS NOT NULL"), "links")
    copy, place = common.free_name(docs, "_copy"), common.free_name(docs, "_place")
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias(copy)).distinct()
    out = docs.join(copies, F.col("doc_id").cast("long") == F.col(copy), "left_anti").select(*docs.columns)
    if found.groupBy("doc_id").count().where("count > 1").limit(1).count():
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
        several = out.where("doc_id IS NOT NULL").select("*", first.alias(place)).where(F.col(place) == 1).select(*docs.columns)
        out = several.unionByName(out.where("doc_id IS NULL"))
    return out


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of linked documents over all whole texts; link() says what odd rows give."""
    return link(common.table(spark, sf_dir, "documents"))
