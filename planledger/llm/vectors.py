"""What the vector searches share: which rows take part, and query blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from planledger.llm.storage import new_folder, saved

#: Queries per block; a block goes to every task, so its size is what bounds a task's memory.
QUERY_BLOCK = 4096


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of rows with an id and a vector of finite numbers."""
    own = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)


def by_width(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) per vector length in a batch."""
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy()
    widths, ids = np.diff(offsets), ids.to_numpy()
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield ids[rows], flat[offsets[rows][:, None] + np.arange(width)]


def search_in_blocks(
    queries: DataFrame, k: int, search: Callable[[dict[int, tuple[np.ndarray, np.ndarray]]], DataFrame], score: str
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` of what ``search`` finds for each query.

    Queries, one for each id, are read once, and dealt by hash into blocks of about
    QUERY_BLOCK, each in a folder of its own. Each block in turn is handed to ``search`` as
    {length: (ids, matrix)}, and its result written; nothing else of the queries is held.
    """
    spark = queries.sparkSession
    one = saved(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    blocks = max(1, -(-one.count() // QUERY_BLOCK))
    asked, folder = new_folder(spark, "blocks"), new_folder(spark, "found")
    dealt = one.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    dealt.repartition("block").write.partitionBy("block").parquet(asked)
    held_queries = spark.read.schema("id long, v array<double>, block long").parquet(asked)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    schema = f"query_id long, rank int, vec_id long, score {score}"
    for block in range(blocks):
        rows = held_queries.filter(F.col("block") == block).collect()  # the block's own folder only
        widths: dict[int, list] = {}
        for row in rows:
            widths.setdefault(len(row["v"]), []).append(row)
        held = {w: (np.array([r["id"] for r in x]), np.array([r["v"] for r in x], np.float64).reshape(len(x), w)) for w, x in widths.items()}
        found = search(held).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def merge_best(
    top_scores: np.ndarray, top_ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray
) -> None:
    """Merge (row, score, id) into each row's best, in place: higher scores, then smaller ids."""
    k = top_scores.shape[1]
    touched, back = np.unique(rows, return_inverse=True)
    all_rows = np.concatenate([np.repeat(np.arange(len(touched)), k), back])
    all_scores = np.concatenate([top_scores[touched].ravel(), scores])
    all_ids = np.concatenate([top_ids[touched].ravel(), ids])
    # Smaller is better for both keys; ~score turns the order of integers around without overflow.
    key = ~all_scores if all_scores.dtype.kind == "i" else -all_scores
    order = np.lexsort((all_ids, key, all_rows))
    first = np.searchsorted(all_rows[order], np.arange(len(touched)))
    picked = order[first[:, None] + np.arange(k)]
    top_scores[touched], top_ids[touched] = all_scores[picked], all_ids[picked]
