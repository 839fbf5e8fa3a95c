"""Similarity search over embedding tables (C9, E5, E6), with both sides as tables.

Queries and index rows are dealt into slices of at most about ``SLICE_ROWS`` rows by hash. Every pair of a query slice and an
index slice is one cell: a shuffle brings both slices of a cell to one task, which scores them with matrix
products and keeps the best ``k`` of each query (ties trimmed exactly); the cells' winners are merged by a second
ranking of at most ``k`` rows per query and index slice. Nothing passes through the driver but two row counts, and a cell's
memory is fixed by ``SLICE_ROWS``. Each side is sent once per slice of the other side; the smaller it is, the
less the larger side moves.

Vectors that are null or hold null or non-finite components match nothing; only vectors of one length are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 16_384
TILE = 1024  # index rows, and query rows, scored at once


def usable(vec: Column) -> Column:
    """Whether a vector can be compared."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & finite, F.lit(False))


def _side(df: DataFrame, id_col: str, vec_col: str, rows: int) -> tuple[DataFrame, int]:
    """``(id, vec, dim, slice)`` of one side, and its number of slices."""
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    n = max(1, math.ceil(df.count() / rows))
    return own.where(usable(F.col("vec"))).withColumn("dim", F.size("vec")).withColumn("slice", F.pmod(F.xxhash64("id", "vec"), F.lit(n))), n


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim) if dim else flat.reshape(0, 0)


def best_of_cell(Q: np.ndarray, X: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, index id, score)``: the best ``k`` index rows of every query by (score in millionths, id). Scores are held
    for ``TILE`` queries and index rows at a time."""
    parts = [_best_of_tile(Q[at : at + TILE], X, x_ids, k) for at in range(0, len(Q), TILE)]
    row = np.concatenate([np.repeat(np.arange(len(s)) + at * TILE, s.shape[1]) for at, (_, s) in enumerate(parts)])
    return row, np.concatenate([i.ravel() for i, _ in parts]), np.concatenate([s.ravel() for _, s in parts]) / 1e6


def _best_of_tile(Q: np.ndarray, X: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    pool_s = np.empty((len(Q), 0))
    pool_i = np.empty((len(Q), 0), np.int64)
    for at in range(0, len(X), TILE):
        s = np.rint(Q @ X[at : at + TILE].T * 1e6)
        i = np.broadcast_to(x_ids[at : at + TILE], s.shape)
        pool_s, pool_i = np.concatenate([pool_s, s], 1), np.concatenate([pool_i, i], 1)
        order = np.lexsort((pool_i, -pool_s), axis=1)[:, :k]
        pool_s, pool_i = np.take_along_axis(pool_s, order, 1), np.take_along_axis(pool_i, order, 1)
    return pool_i, pool_s


def cell_winners(index: DataFrame, queries: DataFrame, k: int, index_id: str, query_id: str, index_vec: str, query_vec: str, rows: int | None = None) -> DataFrame:
    """``(query, id, score)``: the best ``k`` index rows of every query in each cell, scores in millionths."""
    rows = rows or SLICE_ROWS
    x, n_x = _side(index, index_id, index_vec, rows)
    q, n_q = _side(queries, query_id, query_vec, rows)
    across = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    x = x.withColumnRenamed("slice", "xs").withColumn("qs", across(n_q))
    q = q.withColumnRenamed("slice", "qs").withColumn("xs", across(n_x))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dim = left.column("dim")[0].as_py()
        ids = left.column("id").to_numpy()
        row, i, s = best_of_cell(_matrix(left.column("vec"), dim), _matrix(right.column("vec"), dim), right.column("id").to_numpy(), k)
        return pa.table({"query": ids[row], "id": i, "score": s})

    cells = ["dim", "qs", "xs"]
    return q.groupBy(*cells).cogroup(x.groupBy(*cells)).applyInArrow(score, "query long, id long, score double")


def topk(
    index: DataFrame, queries: DataFrame, k: int, index_id: str = "vec_id", query_id: str = "query_id", vec_col: str = "embedding", rows: int | None = None
) -> DataFrame:
    """E5: for every query, the k index rows with the largest dot product
    (score rounded to 6 decimals, ties by index id ascending)."""
    cand = cell_winners(index, queries, k, index_id, query_id, vec_col, vec_col, rows)
    # k rows per query and index slice at most, cut to k per task before the shuffle
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    r = cand.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    return r.select(F.col("query").alias(query_id), "rank", F.col("id").alias(index_id), "score")


def top1(
    index: DataFrame,
    queries: DataFrame,
    threshold: float | None,
    index_id: str = "vec_id",
    query_id: str = "query_id",
    vec_col: str = "embedding",
    rows: int | None = None,
) -> DataFrame:
    """For every index row, the best query (first in id order on equal scores); a score below ``threshold`` means no match
    (the threshold itself matches). Rows without a comparable vector have no match and no score."""
    cand = cell_winners(queries, index, 1, query_id, index_id, vec_col, vec_col, rows)
    best = cand.groupBy("query").agg(F.max_by(F.struct("score", "id"), F.struct("score", -F.col("id"))).alias("b"))
    match = F.col("b.score") >= threshold if threshold is not None else F.lit(True)
    own = index.select(F.col(index_id).cast("long").alias(index_id))
    out = own.join(best, F.col(index_id) == F.col("query"), "left")
    return out.select(index_id, F.when(match, F.col("b.id")).alias(query_id), F.col("b.score").alias("score"))


def centroids(df: DataFrame, group_col: str, vec_col: str = "embedding") -> DataFrame:
    """Unit-normalised mean vector per group. ``Summarizer.mean`` aggregates whole
    vectors with a map-side partial step (one buffer per group per task), so
    nothing is exploded to one row per dimension."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = df.select(group_col, array_to_vector(F.col(vec_col)).alias("_v"))
    m = v.groupBy(group_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    a = m.select(group_col, vector_to_array("_m", "float64").alias("_a"))
    norm = F.sqrt(F.aggregate("_a", F.lit(0.0), lambda acc, x: acc + x * x))
    return a.select(group_col, F.transform("_a", lambda x: x / norm).alias(vec_col))
