"""Minimal perfect hashing of 64-bit keys, and sums of count vectors indexed by it.

Keys are hashed into a bit array of twice their number; those that are alone at
their place stay there, the others go on to the next, smaller array. A key's index
is the number of set bits before its own, so n keys get the indexes 0 to n - 1. The
keys are kept in that order, and every lookup is compared with them: a key that
isn't there gets -1, not another one's index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from planledger.llm.storage import saved
from planledger.llm.textbytes import mix

#: Counts of a vector that travel in one row.
CHUNK = 1 << 13
#: Vectors that one task adds up at a time.
FAN = 16


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + mix(np.array([2 * level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, keys: np.ndarray, spare: float = 2.0) -> None:
        left, levels = np.unique(np.asarray(keys, np.int64)), []
        whole = left
        while len(left):
            size = int(spare * len(left)) + 8
            at = _places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        self.sizes = [len(x) for x in levels]
        self.set = np.concatenate([np.zeros(0, bool), *levels])
        self.rank = np.cumsum(self.set, dtype=np.int32) - np.int32(1)
        self.keys = np.zeros(len(whole), np.int64)
        self.keys[self._index(whole)] = whole

    def __len__(self) -> int:
        return len(self.keys)

    def _index(self, keys: np.ndarray) -> np.ndarray:
        """The index that a key would have; -1 where no array has it alone."""
        out = np.full(len(keys), -1, np.int64)
        rows, begin = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = begin + _places(keys[rows], level, size)
            here = self.set[at]
            out[rows[here]] = self.rank[at[here]]
            rows, begin = rows[~here], begin + size
            if not len(rows):
                break
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for keys that aren't there."""
        out = self._index(keys)
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        out[~known] = -1
        return out


def count_vectors(counts: DataFrame, index: PerfectHash) -> DataFrame:
    """(chunk, part, counts): a dense vector for each task's rows (key, n), cut into chunks."""
    shared = counts.sparkSession.sparkContext.broadcast(index)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(shared.value), np.int64)
        seen = False
        for batch in batches:
            at = shared.value.find(batch.column(0).to_numpy())
            if (at < 0).any():
                raise ValueError("a key isn't in the index")
            np.add.at(vector, at, batch.column(1).to_numpy())
            seen = seen or len(at) > 0
        if seen:
            part = TaskContext.get().partitionId()
            for k, low in enumerate(range(0, len(vector), CHUNK)):
                row = [[k], [part], [vector[low : low + CHUNK].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["chunk", "part", "counts"])

    return counts.select("key", "n").mapInArrow(add, "chunk long, part long, counts binary")


def tree_sum(vectors: DataFrame) -> np.ndarray:
    """The sum of the vectors: FAN of them at a time, chunk by chunk, until one is left.
    Only that one goes to the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(0, np.int64)
        for row in table["counts"]:
            own = np.frombuffer(row.as_buffer(), np.int64)
            total = own + total if len(total) else own
        first = table.slice(0, 1)
        return pa.table([first["chunk"], first["part"], pa.array([total.tobytes()], pa.binary())], names=["chunk", "part", "counts"])

    vectors = saved(vectors, "vectors")
    width = (vectors.agg(F.max("part")).first()[0] or 0) + 1
    while width > 1:
        width = -(-width // FAN)
        together = vectors.withColumn("part", F.col("part") % width).groupBy("chunk", "part")
        vectors = saved(together.applyInArrow(add, "chunk long, part long, counts binary"), "vectors")
    rows = sorted(vectors.collect())
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in rows)])


def counted_index(counts: DataFrame) -> tuple[PerfectHash, np.ndarray]:
    """The index of the distinct keys of (key, n) rows, and each key's sum at its index.

    For keys whose number has a bound that a driver and each task can hold; ``counts``
    were saved before and may have any number of rows per key.
    """
    keys = counts.select("key").distinct().toArrow()["key"].to_numpy()
    index = PerfectHash(keys)
    return index, tree_sum(count_vectors(counts, index))
