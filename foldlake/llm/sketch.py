"""Counters and bitmaps of fixed size over columns of hashes, filled by all tasks and added up in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foldlake.llm import common

SKETCH_BLOCK = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def count_sketch(
    rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, finish: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """finish() of how often each value of `hash mod 2**bits` occurs, counted over all rows; at most 255 for each task.

    Tasks send their counters in blocks, which are added up in a stream, so no task holds more than its counters. finish
    makes bytes of the sums of a block, and only these come to the driver.
    """
    blocks = max(1, (1 << bits) // SKETCH_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for values in hashes(batch):
                np.add.at(counts, (values & np.uint64((1 << bits) - 1)).astype(np.int64), 1)
        parts = np.minimum(counts, 255).astype(np.uint8).reshape(blocks, -1)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int32()), "counts": [parts[i].tobytes() for i in some]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                more = np.frombuffer(counts, np.uint8)
                sums[block] = sums[block] + more if block in sums else more.astype(np.uint64)
        if sums:
            yield pa.RecordBatch.from_pydict({"block": pa.array(sums, pa.int32()), "counts": [finish(v).tobytes() for v in sums.values()]})

    spark = rows.sparkSession
    found = rows.mapInArrow(count, "block int, counts binary").repartition(common.partitions(spark), "block")
    got = {row.block: np.frombuffer(row.counts, np.uint8) for row in found.mapInArrow(add, "block int, counts binary").collect()}
    none = finish(np.zeros((1 << bits) // blocks, np.uint64))
    return np.concatenate([got.get(block, none) for block in range(blocks)])


def _mixed(ids: np.ndarray) -> np.ndarray:
    value = ids.astype(np.int64).view(np.uint64) * _ODD
    return value ^ (value >> np.uint64(32))


class Marks:
    """A bitmap of the values of a column of longs, of at most 2**26 bits: it may name a few others, but misses none."""

    def __init__(self, rows: DataFrame, column: str):
        bits = min(26, max(16, (16 * rows.count()).bit_length()))

        def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            yield _mixed(batch[0].to_numpy(zero_copy_only=False))

        marked = count_sketch(rows.select(column), hashes, bits, lambda counts: np.packbits(counts > 0))
        self.mask, self.shared = np.uint64((1 << bits) - 1), rows.sparkSession.sparkContext.broadcast(marked)

    def of(self, values: np.ndarray) -> np.ndarray:
        at = (_mixed(values) & self.mask).astype(np.int64)
        return (self.shared.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)

    def has(self, value: int) -> bool:
        """of() for a single value."""
        mixed = value * int(_ODD) & 0xFFFFFFFFFFFFFFFF
        at = (mixed ^ (mixed >> 32)) & int(self.mask)
        return bool(self.shared.value[at >> 3] >> (7 - (at & 7)) & 1)
