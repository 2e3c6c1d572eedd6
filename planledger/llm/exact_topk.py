"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments; a segment of length l with mean m and deviation s
stands for it. For two vectors the squared distance is at least
sum(l * ((m - m')**2 + (s - s')**2)), and as their norms are known, the inner
product is at most sum(l * (m * m' + s * s')). Bounds are taken with few segments
first, then with more; what a bound can't exclude is computed exactly. The
threshold of a query is its k-th best score so far, and a bound that equals it
excludes nothing.

Components x become floor(scale * x) and scores are exact integers; those beyond
64 bits become the nearest 64-bit one. Rows without id, with a null vector, or
with a null or non-finite component take no part. Vectors meet only vectors of
the same length. Rows that share a query's id are its own; other repeated rows
count each, and a repeated query id is asked once (with its smallest vector).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from planledger.llm.vectors import by_width, merge_best, search_in_blocks, usable

#: Segments per level, coarse to fine.
LEVELS = (4, 16, 32)
#: Candidates looked at together.
CHUNK = 2048
#: Survivors whose scores are computed together.
PAIRS = 1 << 16
_LEAST = np.iinfo(np.int64).min
#: Above this share of pairs left, a level's bounds are computed for all pairs at once.
_DENSE = 0.05


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector sqrt(l) * mean and sqrt(l) * deviation of each segment: inner products
    of these bound inner products of the vectors from above."""
    parts = np.array_split(x, min(segments, max(x.shape[1], 1)), axis=1)
    means = [p.mean(axis=1) * np.sqrt(p.shape[1]) if p.shape[1] else np.zeros(len(x)) for p in parts]
    spreads = [p.std(axis=1) * np.sqrt(p.shape[1]) if p.shape[1] else np.zeros(len(x)) for p in parts]
    return np.column_stack(means + spreads)


class QueryBlock:
    """The queries of one length, their statistics and the best found so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.x = ids, queries
        self.norms = np.linalg.norm(queries, axis=1)
        self.levels = [segment_statistics(queries, n) for n in LEVELS]
        self.scores = np.full((len(ids), k), _LEAST)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.taken = np.zeros(len(ids), np.int64)

    def look(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Take a chunk of candidates into account."""
        k = self.scores.shape[1]
        norms = np.linalg.norm(x, axis=1)
        exact_floats = self.norms.max(initial=0) * norms.max(initial=0) < 2**52
        full = self.taken >= k
        if exact_floats and full.all():
            rows, cols = self._survivors(x, norms)
        else:
            rows, cols = (a.ravel() for a in np.indices((len(self.ids), len(ids))))
        own = self.ids[rows] != ids[cols]
        rows, cols = rows[own], cols[own]
        for low in range(0, len(rows), PAIRS):
            r, c = rows[low : low + PAIRS], cols[low : low + PAIRS]
            if exact_floats:
                score = np.einsum("ij,ij->i", self.x[r], x[c]).astype(np.int64)
            else:
                whole = [sum(int(a) * int(b) for a, b in zip(self.x[i], x[j], strict=True)) for i, j in zip(r, c, strict=True)]
                score = np.array([min(max(s, _LEAST), np.iinfo(np.int64).max) for s in whole], np.int64)
            good = (score >= self.scores[r, -1]) | (self.taken[r] < k)
            np.add.at(self.taken, r[good], 1)
            merge_best(self.scores, self.found, r[good], score[good], ids[c[good]])

    def _survivors(self, x: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Bounds are rounded; give way by far more than that.
        least = self.scores[:, -1] - 1e-9 * self.norms * norms.max(initial=0) - 1e-6
        rows = cols = None
        for own, n in zip(self.levels, LEVELS, strict=True):
            other = segment_statistics(x, n)
            if rows is None or len(rows) > _DENSE * len(self.ids) * len(x):
                hit = own @ other.T >= least[:, None]
                if rows is not None:
                    before = np.zeros_like(hit)
                    before[rows, cols] = True
                    hit &= before
                rows, cols = np.nonzero(hit)
            else:
                keep = np.einsum("ij,ij->i", own[rows], other[cols]) >= least[rows]
                rows, cols = rows[keep], cols[keep]
        return rows, cols


def exact_top_k(
    df: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` highest scores among
    all other rows, ties to the smaller id. ``is_query`` is over the column ``id``."""
    rows = usable(df, key, vector)

    def search(held: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(held)  # QUERY_BLOCK vectors

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = {w: QueryBlock(ids, np.floor(x * scale), k) for w, (ids, x) in shared.value.items()}
            for batch in batches:
                for ids, x in by_width(batch.column(0), batch.column(1)):
                    if block := blocks.get(x.shape[1]):
                        whole = np.floor(x * scale)
                        for low in range(0, len(ids), CHUNK):
                            block.look(ids[low : low + CHUNK], whole[low : low + CHUNK])
            for block in blocks.values():
                some = np.arange(k) < block.taken[:, None]
                row, _ = np.nonzero(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids[row]), pa.array(block.found[some]), pa.array(block.scores[some])],
                    names=["query_id", "vec_id", "score"],
                )

        return rows.mapInArrow(scan, "query_id long, vec_id long, score long")

    return search_in_blocks(rows.filter(is_query), k, search, "long")
