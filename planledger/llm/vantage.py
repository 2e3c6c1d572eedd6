"""Approximate nearest neighbours by inner product: vantage-point trees per shard.

With one more component sqrt(M**2 - |x|**2), M the largest norm, nearness by inner
product becomes nearness by distance. A shard is a run of up to ``SHARD`` rows of
one task; its tree splits rows at the median distance from a vantage point and
remembers each side's least and greatest distance. The triangle inequality bounds
how near a side can come to a query; a side is left out when that bound, times
``factor``, is beyond the k-th best distance so far. Factor 1 is exact search.
Trees of all shards are written as one table, a row each, and searched by blocks
of queries. Every row is in a tree.

Rows without id, with a null or zero vector, or with a null or non-finite
component take no part. Vectors meet only vectors of the same length. Rows that
share a query's id are its own; other repeated rows count each, and a repeated
query id is asked once (with its smallest vector). Equal vectors at the median go
to either side, so many copies of one vector still make a balanced tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from planledger.llm.storage import saved
from planledger.llm.vectors import by_width, merge_best, search_in_blocks, usable

SHARD = 8192
LEAF = 64
INDEX = "width int, ids binary, vectors binary, nodes binary, bounds binary"


def build_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, nodes, bounds). Node rows: vantage row, left, right, start, end in ``order``
    (left is -1 in a leaf). Bounds: least and greatest distance of the left, then right side."""
    order = np.arange(len(x))
    nodes, bounds, todo = [], [], [(0, len(x))]
    rows = [-1]
    while todo:
        start, end = todo.pop(0)
        at = rows.pop(0)
        me = len(nodes)
        if at >= 0:
            nodes[at // 2][1 + at % 2] = me
        own = order[start:end]
        nodes.append([own[0], -1, -1, start, end])
        bounds.append([0.0] * 4)
        if end - start > LEAF:
            # The row farthest from the middle sees the others at the most varied distances.
            vantage = own[int(np.argmax(np.linalg.norm(x[own] - x[own].mean(axis=0), axis=1)))]
            far = np.linalg.norm(x[own] - x[vantage], axis=1)
            rank = np.argsort(far, kind="stable")
            order[start:end], far = own[rank], far[rank]
            half = (end - start) // 2
            nodes[me][0] = vantage
            bounds[me] = [far[0], far[half - 1], far[half], far[-1]]
            todo += [(start, start + half), (start + half, end)]
            rows += [2 * me, 2 * me + 1]
    return order, np.array(nodes, np.int64), np.array(bounds)


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, summed component by component: equal vectors get equal scores."""
    out = np.zeros((len(q), len(x)))
    for k in range(q.shape[1]):
        out += q[:, k, None] * x[:, k]
    return out


class Searcher:
    """The queries of one length and the best found so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, largest: float, factor: float) -> None:
        self.ids, self.x, self.largest, self.factor = ids, queries, largest, factor
        self.squares = (queries**2).sum(axis=1)
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """The distance of the k-th best so far."""
        return np.sqrt(np.maximum(self.squares[rows] + self.largest**2 - 2 * self.scores[rows, -1], 0))

    def _leaf(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        score = inner_products(self.x[rows], x)
        r, c = np.nonzero((score >= self.scores[rows, -1][:, None]) & (self.ids[rows][:, None] != ids))
        if len(r):
            merge_best(self.scores, self.found, rows[r], score[r, c], ids[c])

    def search(self, ids: np.ndarray, x: np.ndarray, nodes: np.ndarray, bounds: np.ndarray) -> None:
        """``ids`` and ``x`` are in the tree's order."""
        rise = np.sqrt(np.maximum(self.largest**2 - (x**2).sum(axis=1), 0))
        far: dict[int, np.ndarray] = {}

        def distances(node: int) -> np.ndarray:
            if node not in far:
                v = nodes[node, 0]
                far[node] = np.sqrt(((self.x - x[v]) ** 2).sum(axis=1) + rise[v] ** 2)
            return far[node]

        # First each query's nearest leaf, so that there is something to compare with.
        seen = np.zeros(len(self.ids), np.int64)
        todo = [(0, np.arange(len(self.ids)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            _, left, right, start, end = nodes[node]
            if left < 0:
                seen[rows] = node
                self._leaf(rows, ids[start:end], x[start:end])
                continue
            d = distances(node)[rows]
            near = d * 2 <= bounds[node, 1] + bounds[node, 2]
            todo += [(left, rows[near]), (right, rows[~near])]
        # Then every side that may hold something better.
        todo = [(0, np.arange(len(self.ids)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            _, left, right, start, end = nodes[node]
            if left < 0:
                self._leaf(rows[seen[rows] != node], ids[start:end], x[start:end])
                continue
            d = distances(node)[rows]
            reach = self._reach(rows) + 1e-9 * (1 + self.largest)
            for side, low, high in ((right, *bounds[node, 2:]), (left, *bounds[node, :2])):
                gap = np.maximum(np.maximum(low - d, d - high), 0)
                todo.append((side, rows[gap * self.factor <= reach]))


def build_index(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, float]:
    """The saved table of trees, and the largest norm."""
    rows = usable(df, key, vector).filter(F.exists("v", lambda x: x != 0))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = float(np.sqrt(rows.agg(F.max(square)).first()[0] or 0.0))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}

        def tree(width: int) -> pa.RecordBatch:
            ids, x = (np.concatenate(a) for a in zip(*kept.pop(width), strict=True))
            rise = np.sqrt(np.maximum(largest**2 - (x**2).sum(axis=1), 0))
            order, nodes, bounds = build_tree(np.column_stack([x, rise]))
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            nodes[:, 0] = place[nodes[:, 0]]
            parts = [ids[order].tobytes(), x[order].tobytes(), nodes.tobytes(), bounds.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)],
                names=["width", "ids", "vectors", "nodes", "bounds"],
            )

        for batch in batches:
            for ids, x in by_width(batch.column(0), batch.column(1)):
                for low in range(0, len(ids), SHARD):
                    kept.setdefault(x.shape[1], []).append((ids[low : low + SHARD], x[low : low + SHARD]))
                    if sum(len(a) for a, _ in kept[x.shape[1]]) >= SHARD:
                        yield tree(x.shape[1])
        for width in list(kept):
            yield tree(width)

    return saved(rows.mapInArrow(grow, INDEX), "trees"), largest


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, factor: float = 5.0, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` other rows found with
    the largest inner products, ties to the smaller id. ``is_query`` is over the column ``id``."""
    index, largest = build_index(df, key, vector)
    queries = usable(df, key, vector).filter(F.exists("v", lambda x: x != 0)).filter(is_query)

    def search(held: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(held)  # QUERY_BLOCK vectors

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searchers = {w: Searcher(ids, x, k, largest, factor) for w, (ids, x) in shared.value.items()}
            for batch in batches:
                for row in batch.to_pylist():
                    if s := searchers.get(row["width"]):
                        ids = np.frombuffer(row["ids"], np.int64)
                        x = np.frombuffer(row["vectors"]).reshape(len(ids), row["width"])
                        nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 5)
                        s.search(ids, x, nodes, np.frombuffer(row["bounds"]).reshape(-1, 4))
            for s in searchers.values():
                some = np.isfinite(s.scores)
                at, _ = np.nonzero(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.ids[at]), pa.array(s.found[some]), pa.array(s.scores[some])], names=["query_id", "vec_id", "score"]
                )

        return index.mapInArrow(look, "query_id long, vec_id long, score double")

    return search_in_blocks(queries, k, search, "double")
