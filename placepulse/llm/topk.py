"""Exact top-k search by inner product, in tiles.

Queries and candidates are dealt into blocks of bounded size. Every pair of a query block and a
candidate shard is one tile: a matrix product of which only the best k per query leave the task.
The lists of all tiles are merged in two steps, first within bundles of tiles, then per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
QUERY_ROWS = 8_192
PRODUCT_ROWS = 512
BUNDLE = 16

_TOP = "query_id BIGINT, vec_id BIGINT, score BIGINT, tile INT"


def quantised(vectors: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of equally long vectors, as whole numbers in a matrix."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in vectors.chunks] or [np.empty(0)])
    return np.floor(flat.astype(np.float64) * scale).reshape(-1, width)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every sum is below 2**53, else in whole numbers."""
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(1, queries.shape[1])
    if bound < 2**53:
        return (queries @ shard.T).astype(np.int64)
    if bound < 2**63:
        return queries.astype(np.int64) @ shard.astype(np.int64).T
    exact = np.array([[int(x) for x in row] for row in queries], object).dot(
        np.array([[int(x) for x in row] for row in shard], object).T
    )
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k highest allowed scores, ties to the smaller column.

    All scores above the k-th are taken, then its ties in column order as far as there is room.
    """
    rows, columns = scores.shape
    if columns > k:
        floor = np.where(allowed, scores, np.iinfo(np.int64).min)
        kth = np.partition(floor, columns - k, axis=1)[:, columns - k, None]
        above = allowed & (scores > kth)
        ties = allowed & (scores == kth)
        room = k - above.sum(axis=1, keepdims=True)
        allowed = above | (ties & (np.cumsum(ties, axis=1) <= room))
    return np.nonzero(allowed)


def _tile(k: int, scale: int, rows_at_once: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("tile", pa.int32())])

    def tile(key, queries: pa.Table, shard: pa.Table) -> pa.Table:
        found = [np.empty((3, 0), np.int64)]
        if len(queries) and len(shard):
            shard = shard.sort_by("_id")
            lengths = [np.array(pa.compute.list_value_length(t["_vector"]).to_numpy(), np.int64) for t in (queries, shard)]
            for width in np.intersect1d(*lengths):
                mine = [t.filter(pa.array(n == width)) for t, n in zip((queries, shard), lengths, strict=True)]
                (ids, left), (others, right) = (
                    (t["_id"].to_numpy(), quantised(t["_vector"], int(width), scale)) for t in mine
                )
                for at in range(0, len(ids), rows_at_once):
                    own = ids[at : at + rows_at_once]
                    scores = products(left[at : at + rows_at_once], right)
                    row, column = best(scores, own[:, None] != others[None, :], k)
                    found.append(np.stack([own[row], others[column], scores[row, column]]))
        query, vec, score = np.concatenate(found, axis=1)
        number = pa.array(np.full(len(query), key[0].as_py()), pa.int32())
        return pa.Table.from_arrays([pa.array(query), pa.array(vec), pa.array(score), number], schema=schema)

    return tile


def _merged(lists: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("query_id", *by).orderBy(F.desc("score"), F.asc("vec_id"))
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best vectors other than its own.

    The score is the inner product of ``floor(scale * x)`` per component, as a whole number (held
    within 64 bits). Ties go to the smaller id; fewer than ``k`` candidates are all returned.
    Rows without an id, and vectors null or with null or non-finite components, take no part.
    Only vectors of equal length are compared. A row is a query's own if it has its id. An id
    repeated among the queries asks once, with the smallest of its vectors; a candidate repeated
    is a candidate each time. Empty tables give an empty result; other columns are not read.
    """
    usable = F.col("_vector").isNotNull() & ~F.exists(
        "_vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )

    def clean(df: DataFrame) -> DataFrame:
        named = df.select(
            F.col(id_column).cast("bigint").alias("_id"), F.col(vector_column).cast("array<double>").alias("_vector")
        )
        return named.where(F.col("_id").isNotNull() & usable)

    asked = clean(queries).groupBy("_id").agg(F.min("_vector").alias("_vector"))
    shards = max(16, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    # Rows are dealt to shards by their place, so equal ids fill no shard beyond its size.
    dealt = clean(vectors).select(
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("_shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), "_id", "_vector",
    )
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
        F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int").alias("_block"), "_id", "_vector",
    )
    tiles = asked.groupBy("_shard", "_block").cogroup(dealt.groupBy("_shard", "_block"))
    lists = tiles.applyInArrow(_tile(k, scale, PRODUCT_ROWS), _TOP)
    bundles = _merged(lists.withColumn("_bundle", F.floor(F.col("tile") / BUNDLE)), k, "_bundle")
    return _merged(bundles, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
