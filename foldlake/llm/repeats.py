"""Repeated passages: every byte that a string of some length covers which also starts somewhere else in the corpus.

Texts are cut into phrases at places that their content alone decides: of any SPAN grams in a row the least one (by hash,
then by place) is an anchor, and a phrase runs from an anchor to the next. Equal strings of the length have the same
phrases inside, with a part of a phrase at either end. So suffixes that begin at anchors are enough, one for each 60 or so
bytes, and their alphabet is that of phrases.

1. Each task builds shards from the texts that it reads: the Burrows-Wheeler transform of the phrases of some texts,
   sorted as deep as it is followed. No suffix is sorted again, and none leaves its shard.
2. The shards are merged by refining their interleave. It is kept as blocks, of suffixes that agree in their first phrases,
   each with its run of rows in every shard. At first a block is one phrase; each round puts the phrase before it in front,
   by the step from a row of the last column to its row of the first one, so that runs stay runs, and adds up the rows
   of equal blocks over all shards. A block with a single row differs from all others from there on and is dropped: where a
   suffix leaves the last block is its longest common prefix with any other. Blocks of the full length are repeated
   intervals and are not followed further. Only blocks and counts move, in joins on their hashes.
3. What a repeated interval covers is removed. Strings that reach beyond the whole phrases are left: those windows whose
   whole phrases are repeated and that are not covered yet. They meet windows with the same inner bytes and the same place
   of their first anchor, first in cells of CELL neighbours: where the bytes that all windows of a cell share are found
   once, none of them is repeated; where all bytes of the cell are found twice, every one is. The windows of what is left
   are compared by the hash of all their bytes. Texts with copies need no such check, as they are covered.

Rounds are bounded by MOST_PHRASES; windows in blocks that are shorter than the length by then (phrases of few bytes, as in
runs of one character) are all compared by their bytes, first those of one text, so nothing is lost. Hashes of 64 bits stand for phrases, blocks
and windows, the latter two of them for each comparison. A shard holds SHARD phrases, or one text; a text meets its own
marks only. Texts are known by two hashes of 64 bits, so copies are treated once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldlake.llm import common
from foldlake.llm.sketch import Marks

LENGTH = 400
#: Phrases of a shard, and bytes that are looked at in one step.
SHARD, SLICE = 150_000, 1 << 20
#: Phrases that blocks are followed for, phrases that each round puts before them, and how deep shards are sorted.
MOST_PHRASES, STEPS, DEPTH = 13, 3, 16
#: Windows that lie next to each other and are first compared together, at most.
CELL = 16
#: Rows of a batch that goes back to Spark, about.
BATCH_ROWS = 20_000
#: The reach of a suffix whose blocks were not followed to their end.
OPEN = 1 << 30

_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_KEY = ["k1", "k2"]
_BASE = 0x9E3779B97F4A7C15
_MIX, _STEP, _LENGTH = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25))
_BLOCK = pa.schema([("shard", pa.int64()), ("id", pa.int64()), ("size", pa.int32()), ("depth", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
_BLOCK_DDL = "shard long, id long, size int, depth int, lo int, hi int"


def shape(length: int) -> tuple[int, int]:
    """Grams of a span and bytes of a gram: a window of the length holds two spans with different anchors at least."""
    span = max(1, length // 3)
    return span, min(8, span)


def cell_size(length: int) -> int:
    return max(1, min(CELL, shape(length)[0] // 4))


@lru_cache(4)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        values = np.full(count, base, np.uint64)
        values[:1] = 1
        out.append(np.cumprod(values, dtype=np.uint64))
    return out[0], out[1]


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return value ^ (value >> np.uint64(32))


def least_places(data: np.ndarray, span: int, gram: int) -> np.ndarray:
    """For each place with a whole span behind it: the place of the first of the least grams of that span."""
    many = len(data) - span - gram + 2
    out = np.empty(max(0, many), np.int32)
    mask = np.uint64((1 << 8 * gram) - 1)
    for at in range(0, many, SLICE):
        last = min(many, at + SLICE)
        part = np.concatenate([data[at : last + span + gram - 2], np.zeros(8 - gram, np.uint8)])
        grams = np.ndarray((last - at + span - 1,), "<u8", part.tobytes(), strides=(1,)) & mask
        best = (mixed(grams * _STEP + _LENGTH) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < span:
            best = np.minimum(best[: width - span], best[span - width :])
        out[at:last] = (best & np.uint64(0xFFFFFFFF)).astype(np.int64) + at
    return out


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of data[start:end] for each start, in ascending order, and its end. No interval is empty."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + SLICE, SLICE))
    for at, first, last in zip(range(0, len(data), SLICE), cuts[:-1], cuts[1:]):
        if first < last:
            a, b = starts[first:last] - at, ends[first:last] - at
            out[first:last] = hashes_by_sums(sums_of(data[at : at + int(b.max())]), a, b)
    return out


def sums_of(data: np.ndarray) -> np.ndarray:
    """Running sums of the bytes, each times the power of its place."""
    sums = np.zeros(len(data) + 1, np.uint64)
    power = _powers(1 << max(21, len(data).bit_length()))[0]
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return sums


def hashes_by_sums(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers(1 << max(21, (len(sums) - 1).bit_length()))[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _LENGTH)


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the runs, and for each the number of its run."""
    sizes = (hi - lo).astype(np.int64)
    owner = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner], owner


class Shard:
    """The Burrows-Wheeler transform of the phrases of some texts, each text followed by the symbol 0."""

    def __init__(self, bwt: np.ndarray, sizes: np.ndarray):
        self.bwt, self.sizes = bwt, sizes
        order = np.argsort(bwt, kind="stable")
        self.first = bwt[order]
        self.before = np.empty(len(bwt), np.int64)
        self.before[order] = np.arange(len(bwt))

    def phrases(self) -> tuple[np.ndarray, ...]:
        """id, size, lo, hi of the blocks of one phrase."""
        at = _changes(self.first)
        ends = np.append(at[1:], len(self.first))
        some = self.first[at] != 0
        lo, hi = at[some], ends[some]
        return mixed(self.first[lo] * _STEP), self.sizes[lo], lo, hi

    def extended(self, ids: np.ndarray, sizes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """id, size, lo, hi of the blocks that each phrase before the given blocks makes of them."""
        rows, owner = _ranges(lo, hi)
        some = self.bwt[rows] != 0
        to, owner = self.before[rows[some]], owner[some]
        order = np.argsort(to)
        to, owner = to[order], owner[order]
        at = _changes(self.first[to] ^ (owner.astype(np.uint64) * _LENGTH + np.uint64(1)) * _MIX)
        lo, whose = to[at], owner[at]
        hi = to[np.append(at[1:], len(to)) - 1] + 1 if len(to) else to
        return mixed(ids[whose] * _STEP + self.first[lo]), sizes[whose] + self.sizes[lo], lo, hi


def transform(symbols: np.ndarray) -> np.ndarray:
    """The order of the suffixes of symbols, taken as a ring, by their first DEPTH symbols, then by place."""
    rank, near = np.unique(symbols, return_inverse=True)[1].astype(np.int64), 1
    while near < DEPTH and len(symbols):
        both = rank * len(symbols) + np.roll(rank, -near)
        rank = np.unique(both, return_inverse=True)[1].astype(np.int64)
        near *= 2
    return np.argsort(rank, kind="stable")


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def _texts(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch's texts, and where each begins; the end comes last."""
    values = batch[column].to_pylist()
    data = np.frombuffer(b"".join(values), np.uint8)
    return data, np.cumsum([0, *map(len, values)])


def shards(texts: DataFrame, length: int) -> DataFrame:
    """The shards of texts (k1, k2, text as binary, of the length at least): for each row of the transform the phrase
    before it (bwt), the bytes of its phrase (sizes), the number of its text (docs) and its place in there (places);
    keys holds k1 and k2 of each text. All are packed numbers."""
    (span, gram), most = shape(length), SHARD
    fields = [(x, pa.binary()) for x in ("bwt", "sizes", "docs", "places", "keys")]
    schema = pa.schema([("shard", pa.int64()), *fields])

    def packed(shard: int, parts: list[tuple]) -> pa.RecordBatch:
        symbols, sizes, docs, places = (np.concatenate([p[k] for p in parts]) for k in range(4))
        known = np.concatenate([p[4] for p in parts])
        docs = docs + np.repeat(np.cumsum([0, *[len(p[4]) for p in parts[:-1]]]), [len(p[0]) for p in parts])
        order = transform(symbols)
        columns = [np.roll(symbols, 1)[order], sizes[order].astype(np.int32), docs[order].astype(np.int32), places[order].astype(np.int32), known]
        return pa.RecordBatch.from_arrays([pa.array([shard]), *[pa.array([c.tobytes()], pa.binary()) for c in columns]], schema=schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, parts, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            data, bounds = _texts(batch)
            starts, ends = bounds[:-1], bounds[1:]
            inside = np.zeros(len(data) + 1, np.int64)
            np.add.at(inside, starts, 1)
            np.add.at(inside, ends - span - gram + 2, -1)
            least = least_places(data, span, gram)
            found = least[np.cumsum(inside[: len(least)]) > 0]
            anchors = found[_changes(found)].astype(np.int64)
            owner = np.searchsorted(bounds, anchors, "right") - 1
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            named = np.zeros(len(anchors), np.uint64)
            named[inner] = np.maximum(hashes(data, anchors[inner], anchors[inner + 1]), np.uint64(1))
            sizes = np.zeros(len(anchors), np.int64)
            sizes[inner] = anchors[inner + 1] - anchors[inner]
            keys = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in _KEY], axis=1)
            for at in range(0, len(starts), 256):  # the last anchor of a text begins no phrase and has the symbol 0
                last = min(len(starts), at + 256)
                a, b = np.searchsorted(owner, [at, last])
                if a < b:
                    parts.append((named[a:b], sizes[a:b], owner[a:b] - at, anchors[a:b] - starts[owner[a:b]], keys[at:last]))
                    held += b - a
                if held >= most:
                    yield packed(task << 32 | made, parts)
                    parts, held, made = [], 0, made + 1
        if parts:
            yield packed(task << 32 | made, parts)

    return texts.select(*_KEY, "text").mapInArrow(build, "shard long, bwt binary, sizes binary, docs binary, places binary, keys binary")


def _blocks(shard: int, depth: int, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    ids, sizes, lo, hi = found
    columns = [np.full(len(ids), shard), ids.view(np.int64), sizes.astype(np.int32), np.full(len(ids), depth, np.int32), lo.astype(np.int32), hi.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOCK.types)], schema=_BLOCK)


def _shard(row: dict) -> Shard:
    return Shard(np.frombuffer(row["bwt"], np.uint64), np.frombuffer(row["sizes"], np.int32))


def first_blocks(made: DataFrame) -> DataFrame:
    """shard, id, size, depth, lo, hi of the blocks of one phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _blocks(row["shard"], 1, _shard(row).phrases())

    return made.select("shard", "bwt", "sizes").mapInArrow(run, _BLOCK_DDL)


def next_blocks(alive: DataFrame, made: DataFrame, length: int, steps: int) -> DataFrame:
    """The blocks that up to so many phrases before the given ones make of them; a block of the length goes no further."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _BLOCK.empty_table()
        row = right.slice(0, 1).to_pylist()[0]
        shard, out = _shard(row), []
        found = [left[c].to_numpy() for c in ("id", "size", "lo", "hi")]
        now, depth = (found[0].view(np.uint64), *found[1:]), int(left["depth"][0].as_py())
        for step in range(1, steps + 1):
            some = now[1] < length
            now = shard.extended(*(x[some] for x in now))
            out.append(_blocks(row["shard"], depth + step, now))
        return pa.Table.from_batches(out, _BLOCK)

    both = alive.groupBy("shard").cogroup(made.select("shard", "bwt", "sizes").groupBy("shard"))
    return both.applyInArrow(run, _BLOCK_DDL)


def merged(blocks: DataFrame) -> DataFrame:
    """The blocks that have two rows at least in all shards together."""
    rows = blocks.groupBy("id", "size").agg(F.sum(F.col("hi") - F.col("lo")).alias("_rows")).where("_rows > 1")
    return blocks.join(rows.drop("_rows"), ["id", "size"]).select(*_BLOCK.names)


def interleave(made: DataFrame, length: int) -> list[DataFrame]:
    """Tables of all blocks with two suffixes at least, of one phrase up to the length or MOST_PHRASES phrases."""
    tables = [common.materialize(merged(first_blocks(made)), "repeat-blocks")]
    depth = 1
    while depth < MOST_PHRASES:
        alive = tables[-1].where((F.col("depth") == depth) & (F.col("size") < length))
        if not alive.limit(1).count():
            break
        steps = min(STEPS, MOST_PHRASES - depth)
        tables.append(common.materialize(merged(next_blocks(alive, made, length, steps)), "repeat-blocks"))
        depth += steps
    return tables


def reaches(blocks: DataFrame, made: DataFrame, length: int) -> DataFrame:
    """k1, k2, places, reach of each text that may hold repeated windows: anchors and how many bytes of whole phrases from
    there are repeated; OPEN where that is not known. Anchors whose reach ends before the last whole phrase of every
    window that they are the first anchor of are left out."""
    (span, gram), most = shape(length), MOST_PHRASES
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("places", pa.list_(pa.int32())), ("reach", pa.list_(pa.int32()))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        row = right.slice(0, 1).to_pylist()[0]
        docs, places = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["places"], np.int32)
        keys = np.frombuffer(row["keys"], np.int64).reshape(-1, 2)
        size, depth, lo, hi = (left[c].to_numpy() for c in ("size", "depth", "lo", "hi"))
        size = np.where((size < length) & (depth >= most), OPEN, size).astype(np.int32)
        rows, owner = _ranges(lo, hi)
        reach = np.zeros(len(docs), np.int32)
        np.maximum.at(reach, rows, size[owner])
        order = np.lexsort((places, docs))
        at = places[order].astype(np.int64)
        some = order[(reach[order] > 0) & (at + reach[order] >= np.maximum(at - span + 1, 0) + length - span - gram + 1)]
        at = _changes(docs[some])
        offsets = pa.array(np.append(at, len(some)).astype(np.int32))
        own = keys[docs[some[at]]]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[some])) for x in (places, reach)]
        return pa.Table.from_arrays([pa.array(own[:, 0]), pa.array(own[:, 1]), *lists], schema=schema)

    both = blocks.groupBy("shard").cogroup(made.select("shard", "docs", "places", "keys").groupBy("shard"))
    return both.applyInArrow(run, "k1 long, k2 long, places array<int>, reach array<int>")


class Windows:
    """The windows of one text, given its anchors' reach."""

    def __init__(self, row: dict, length: int):
        self.length, self.copies, self._sums = length, row["copies"], None
        self.data = np.frombuffer(row["text"], np.uint8)
        self.places, self.reach = row["places"], row["reach"]
        whole = (self.reach >= length) & (self.reach < OPEN)
        self.removed = self._cover(self.places[whole], self.places[whole] + self.reach[whole])
        if self.copies > 1:
            self.removed[:] = True
        elif (self.reach >= OPEN).any():
            self._remove_own_repeats()

    @cached_property
    def least(self) -> np.ndarray:
        return least_places(self.data, *shape(self.length)).astype(np.int64)

    @cached_property
    def first(self) -> np.ndarray:
        """The first anchor of each window."""
        return self.least[: len(self.data) - self.length + 1]

    @cached_property
    def possible(self) -> np.ndarray:
        """Windows whose whole phrases are repeated."""
        span, gram = shape(self.length)
        ends = np.arange(len(self.data) + 1)
        ends[self.places] += self.reach
        return ends[self.first] >= self.least[self.length - span - gram + 1 :][: len(self.first)]

    @cached_property
    def doubtful(self) -> np.ndarray:
        """Those of them with bytes that no repeated interval covers."""
        gaps = np.concatenate([[0], np.cumsum(~self.removed)])
        return self.possible & (gaps[self.length :] > gaps[: len(self.first)])

    def _cover(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        marks = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(marks, starts, 1)
        np.add.at(marks, ends, -1)
        return np.cumsum(marks[:-1]) > 0

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """hashes() of the text; its sums are kept unless it is very long."""
        if len(self.data) > SLICE:
            order = np.argsort(starts, kind="stable")
            out = np.empty(len(starts), np.uint64)
            out[order] = hashes(self.data, starts[order], ends[order])
            return out
        self._sums = sums_of(self.data) if self._sums is None else self._sums
        return hashes_by_sums(self._sums, starts, ends)

    def _remove_own_repeats(self) -> None:
        """Removes windows that start twice in this text, as those of runs of few bytes do."""
        some = np.flatnonzero(self.possible)
        _, group, count = np.unique(self.hashes(some, some + self.length), return_inverse=True, return_counts=True)
        twice = some[count[group] > 1]
        self.remove(twice, twice + self.length)

    def inner(self, anchors: np.ndarray) -> np.ndarray:
        """The hash of the bytes that every window with this first anchor holds behind it."""
        return self.hashes(anchors, anchors + self.length - shape(self.length)[0] + 1)

    def remove(self, starts: np.ndarray, ends: np.ndarray) -> None:
        self.removed |= self._cover(starts, ends)


def _values(column: pa.Array) -> list:
    """The rows of a column; of lists of numbers as arrays, of lists of structs of numbers as arrays of a row each."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    inside, bounds = column.values, column.offsets.to_pylist()
    if pa.types.is_struct(inside.type):
        fields = [inside.field(i).to_numpy(zero_copy_only=False) for i in range(inside.type.num_fields)]
        numbers = np.stack(fields, axis=1).astype(np.int64)
    else:
        numbers = inside.to_numpy(zero_copy_only=False).astype(np.int64)
    return [numbers[a:b] for a, b in zip(bounds, bounds[1:])]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches; a null list is an empty one."""
    for batch in batches:
        for values in zip(*map(_values, batch.columns), strict=True):
            yield dict(zip(batch.schema.names, values))


def _together(parts: Iterator[list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_ROWS rows of parts, each a list of columns: arrays, or pairs of an array and where it is null."""

    def batch() -> pa.RecordBatch:
        arrays = []
        for field, pieces in zip(schema, zip(*held)):
            if isinstance(pieces[0], tuple):
                values, mask = (np.concatenate(x) for x in zip(*pieces))
            else:
                values, mask = np.concatenate(pieces), None
            arrays.append(pa.array(values.astype(field.type.to_pandas_dtype(), copy=False), field.type, mask=mask))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= BATCH_ROWS:
            yield batch()
            held, rows = [], 0
    if held:
        yield batch()


def anchor_groups(touched: DataFrame, length: int) -> DataFrame:
    """inner, k1, k2, anchor for each first anchor of windows whose whole phrases are repeated; low, high are the distances
    from the anchor of the first and last of its doubtful windows, null without any."""
    schema = pa.schema([("inner", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("anchor", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for row in _rows(batches):
            own = Windows(row, length)
            some = np.flatnonzero(own.possible)
            if not len(some):
                continue
            at = _changes(own.first[some])
            anchors = own.first[some[at]]
            doubt = np.flatnonzero(own.doubtful)
            group = np.searchsorted(anchors, own.first[doubt])
            far = own.first[doubt] - doubt
            low, high = np.full(len(anchors), OPEN), np.full(len(anchors), -1)
            np.minimum.at(low, group, far)
            np.maximum.at(high, group, far)
            none = high < 0
            keys = [np.full(len(at), row[k]) for k in _KEY]
            yield [own.inner(anchors).view(np.int64), *keys, anchors, (low, none), (high, none)]

    return touched.mapInArrow(lambda batches: _together(run(batches), schema), "inner long, k1 long, k2 long, anchor int, low int, high int")


def _asked(own: Windows, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the windows with repeated whole phrases that are asked for, in order, and their first anchors."""
    wanted = asks[np.lexsort((asks[:, 2], asks[:, 1], asks[:, 0]))]
    since = np.maximum(wanted[:, 0] - wanted[:, 2], 0)
    starts, owner = _ranges(since, np.maximum(wanted[:, 0] - wanted[:, 1] + 1, since))
    inside = starts < len(own.first)
    starts, anchors = starts[inside], wanted[owner[inside], 0]
    right = (own.first[starts] == anchors) & own.possible[starts]
    return starts[right], anchors[right]


def cells(asked: DataFrame, length: int) -> DataFrame:
    """core, hull, inner, copies, k1, k2, anchor, low, start, end, doubt of the cells of the windows asked for: asks lists
    anchors and distances low to high.

    A cell holds the windows low to low + cell_size() - 1 before their first anchor. core is the hash of the bytes that all of them
    share, hull of all their bytes, start to end, null if the text ends before; doubt is whether one is doubtful.
    """
    size = cell_size(length)
    longs = [(x, pa.int64()) for x in ("core", "hull", "inner", "copies", "k1", "k2")]
    schema = pa.schema([*longs, *[(x, pa.int32()) for x in ("anchor", "low", "start", "end")], ("doubt", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for row in _rows(batches):
            own = Windows(row, length)
            starts, anchors = _asked(own, row["asks"])
            if not len(starts):
                continue
            low = (anchors - starts) // size * size
            at = np.unique(np.concatenate([_changes(anchors), _changes(low)]))
            doubt = np.logical_or.reduceat(own.doubtful[starts], at)
            anchors, low = anchors[at], low[at]
            last, first = anchors - low, anchors - low - size + 1
            whole = (first >= 0) & (last + length <= len(own.data))
            core, hull = own.hashes(last, first + length), np.zeros(len(at), np.uint64)
            hull[whole] = own.hashes(first[whole], last[whole] + length)
            inner = own.inner(anchors)
            keys = [np.full(len(at), row[k]) for k in ("copies", *_KEY)]
            yield [core.view(np.int64), (hull.view(np.int64), ~whole), inner.view(np.int64), *keys, anchors, low, first, last + length, doubt]

    return asked.mapInArrow(lambda batches: _together(run(batches), schema), "core long, hull long, inner long, copies long, k1 long, k2 long, anchor int, low int, start int, end int, doubt boolean")


def window_hashes(asked: DataFrame, length: int) -> DataFrame:
    """hash, inner, copies, k1, k2, at of the windows asked for, as cells() takes them. The place `at` is null for windows
    that are not doubtful."""
    schema = pa.schema([("hash", pa.int64()), ("inner", pa.int64()), ("copies", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for row in _rows(batches):
            own = Windows(row, length)
            starts, anchors = _asked(own, row["asks"])
            if not len(starts):
                continue
            whole, inner, doubtful = own.hashes(starts, starts + length), own.inner(anchors), own.doubtful[starts]
            keys = [(np.full(len(starts), row[k]), ~doubtful) for k in _KEY]
            yield [whole.view(np.int64), inner.view(np.int64), np.full(len(starts), own.copies), *keys, (starts, ~doubtful)]

    return asked.mapInArrow(lambda batches: _together(run(batches), schema), "hash long, inner long, copies long, k1 long, k2 long, at int")


def cut(touched: DataFrame, length: int) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept_sha256, spans (array<struct<start, end>>, in bytes) of texts with their reach, the
    spans of repeated cells and the places of repeated windows (wide and hits, both may be null)."""
    schema = pa.schema(
        [("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
        + [("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    )
    none = hashlib.sha256().hexdigest()

    def one(row: dict) -> tuple:
        if row["copies"] > 1:
            return row["k1"], row["k2"], len(row["text"]), 1, none, np.array([[0, len(row["text"])]])
        own = Windows(row, length)
        starts, wide = row["hits"], row["wide"]
        own.remove(np.concatenate([starts, wide[:, 0]]), np.concatenate([starts + length, wide[:, 1]]))
        spans = np.flatnonzero(np.diff(np.concatenate([[False], own.removed, [False]]).astype(np.int8))).reshape(-1, 2)
        return row["k1"], row["k2"], int(own.removed.sum()), len(spans), hashlib.sha256(own.data[~own.removed]).hexdigest(), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                *plain, spans = zip(*map(one, _rows(iter([batch]))))
                ends = pa.StructArray.from_arrays([pa.array(x) for x in np.concatenate(spans).astype(np.int64).T], ["start", "end"])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, spans)]), pa.int32()), ends)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(plain, schema.types)), lists], schema=schema)

    kind = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return touched.mapInArrow(run, kind)


def judged_cells(near: DataFrame) -> DataFrame:
    """The cells that are sure, doubtful ones whose bytes are all found twice, and those that are open: whose common bytes are
    found twice, in one at least that is doubtful and not sure. One pass over the cells of equal hulls, one over those of
    equal cores."""
    hulls, cores = Window.partitionBy("hull", "inner"), Window.partitionBy("core", "inner")
    sure = F.col("doubt") & F.col("hull").isNotNull() & (F.sum("copies").over(hulls) > 1)
    some = near.select("core", "inner", "copies", *_KEY, "anchor", "low", "start", "end", "doubt", sure.alias("sure"))
    left = F.max(F.col("doubt") & ~F.col("sure")).over(cores)
    both = some.withColumn("open", (F.sum("copies").over(cores) > 1) & left)
    return both.where("sure OR open").select(*_KEY, "anchor", "low", "start", "end", "sure", "open")


def _filtered(texts: DataFrame, marks: Marks) -> DataFrame:
    """The texts whose k1 a bitmap of fixed size may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marks.of(batch["k1"].to_numpy(zero_copy_only=False))))

    return texts.mapInArrow(run, "k1 long, k2 long, text binary")


def _with_asks(touched: DataFrame, asks: DataFrame) -> DataFrame:
    """The texts with asks, a list of the anchors and distances (anchor, low, high) that are asked of each."""
    return touched.join(asks.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "low", "high")).alias("asks")), _KEY)


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept_sha256, spans for each distinct text with bytes to remove, and for some without.

    text_keys() gives k1 and k2 of a text. Null texts are empty; texts shorter than the length have no row. Only the
    column text is read. Rows that repeat are copies. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    text = common.text_or_empty()
    texts = docs.where(F.octet_length(text) >= length).select(*text_keys(text), text.cast("binary").alias("text"))
    with common.setting(spark, _ARROW_BYTES, "4m"):
        made = common.materialize(shards(texts, length), "repeat-shards")
        tables = interleave(made, length)
        blocks = tables[0]
        for more in tables[1:]:
            blocks = blocks.unionByName(more)
        reach = common.materialize(reaches(blocks, made, length).dropDuplicates(_KEY), "repeat-reach")
        common.drop(made, *tables)
        own = _filtered(texts, Marks(reach, "k1")).groupBy(*_KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
        touched = common.materialize(own.join(reach, _KEY), "repeat-texts")
        common.drop(reach)

        groups = common.materialize(anchor_groups(touched, length), "repeat-anchors")
        doubt = groups.where("low IS NOT NULL").groupBy("inner").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        asks = groups.select("inner", *_KEY, "anchor").join(doubt, "inner")
        near = common.materialize(cells(_with_asks(touched, asks), length), "repeat-cells")
        common.drop(groups)
        judged = common.materialize(judged_cells(near), "repeat-judged")
        common.drop(near)
        sure = judged.where("sure")
        asks = judged.where("open").select(*_KEY, "anchor", "low", (F.col("low") + cell_size(length) - 1).alias("high"))
        windows = common.materialize(window_hashes(_with_asks(touched, asks), length), "repeat-windows")
        found = windows.withColumn("_n", F.sum("copies").over(Window.partitionBy("hash", "inner"))).where("_n > 1 AND at IS NOT NULL")
        hits = found.groupBy(*_KEY).agg(F.collect_list("at").alias("hits"))
        wide = sure.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "end")).alias("wide"))
        out = common.materialize(cut(touched.join(hits, _KEY, "left").join(wide, _KEY, "left"), length), "repeat-spans")
        common.drop(touched, windows, judged)
    return out


def summarize(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs, null texts as empty ones."""
    text = common.text_or_empty()
    own = docs.select("doc_id", *text_keys(text), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("_whole"))
    both = own.join(find(docs, length).drop("spans"), _KEY, "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")]
    return both.select("doc_id", "n_bytes", *zero, F.coalesce("kept_sha256", "_whole").alias("kept_sha256"))


def op12_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without bytes covered by strings of 400 bytes that start elsewhere too. Null texts are
    empty; repeated rows are copies of each other; a null doc_id is kept as it is; other columns are not read."""
    return summarize(common.table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT k, i, hash(b[i:i + {LENGTH - 1}]) AS h FROM (SELECT k, b, unnest(range(1, octet_length(b) - {LENGTH - 2})) AS i FROM d WHERE octet_length(b) >= {LENGTH})),
s AS (SELECT k, i, coalesce(i - lag(i) OVER (PARTITION BY k ORDER BY i) > {LENGTH}, true) AS fresh FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
r AS (SELECT k, run, min(i) AS a, max(i) + {LENGTH - 1} AS z FROM (SELECT k, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY k ORDER BY i) AS run FROM s) GROUP BY k, run),
p AS (SELECT k, a, z, coalesce(lag(z) OVER (PARTITION BY k ORDER BY a), 0) AS before FROM r),
t AS (SELECT k, sum(z - a + 1) AS n_removed, count(*) AS n_spans, string_agg(hex(b[before + 1:a - 1]), '' ORDER BY a) AS kept, max(z) AS z FROM p JOIN d USING (k) GROUP BY k)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN t.k IS NULL THEN sha256(b) ELSE sha256(unhex(kept || hex(b[z + 1:octet_length(b)]))) END AS kept_sha256
FROM d LEFT JOIN t USING (k)
"""
