"""Exact cosine top-k (the reference declares COSINE vector indexes).

Queries and items are cut into blocks of bounded size, dealt by hash; a task gets one block of each (a cogroup
by the pair of block numbers), scores them with one matrix product, and keeps k rows per query. A window that keeps
k rows per query in every task before its shuffle merges the blocks. Neither side is collected, broadcast or
held whole by any task, whatever its size; items are shuffled once per block of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries and items of a block, about.
QUERY_BLOCK, ITEM_BLOCK = 1024, 8192
#: Scores of a matrix product are this close to those computed pair by pair.
NEAR = 1e-9


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(rows), -1)


def _top(queries: pa.Table, items: pa.Table, k: int) -> pa.Table:
    """The k nearest items of each query among those of one block; ties go to the smaller id."""
    out: dict[str, list] = {"q": [], "query_id": [], "item_id": [], "score": []}
    if queries.num_rows and items.num_rows:
        q, x = _matrix(queries.column("vector")), _matrix(items.column("vector"))
        if q.shape[1] != x.shape[1]:
            raise ValueError(f"vectors of {q.shape[1]} and {x.shape[1]} components")
        qn, xn = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
        number, names = queries.column("q").to_pylist(), queries.column("id").to_pylist()
        ids = np.array(items.column("id").to_pylist(), object)
        scores = q @ x.T / np.outer(qn, xn)
        for i, row in enumerate(scores):
            least = np.partition(row, -k)[-k] if len(row) > k else -np.inf
            at = np.flatnonzero(row >= least - NEAR)
            # pair by pair, so that a score does not depend on the block that its item is in
            exact = (x[at] * q[i]).sum(axis=1) / (qn[i] * xn[at])
            first = sorted(zip(-exact, ids[at]))[:k]
            out["q"] += [number[i]] * len(first)
            out["query_id"] += [names[i]] * len(first)
            out["item_id"] += [j for _, j in first]
            out["score"] += [-s for s, _ in first]
    kinds = {"q": pa.string(), "query_id": pa.string(), "item_id": pa.string(), "score": pa.float64()}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})


def _usable(df: DataFrame) -> DataFrame:
    """Rows with a vector that has a direction; null, zero and not finite ones take no part."""
    v = F.col("vector").cast("array<double>")
    norm = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    return df.select(F.col("id").cast("string").alias("id"), v.alias("vector")).where(
        (norm > 0) & (norm < float("inf")))  # false for null and NaN


def cosine_topk(queries: DataFrame, items: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK,
                item_block: int = ITEM_BLOCK) -> DataFrame:
    """(query_id, rank, item_id, score) for every query; ties by smaller item id.

    Rows of equal id and vector are one query; of equal id and another vector, each is ranked on its own. Item rows
    are ranked one by one. A null, zero or not finite vector takes no part.
    """
    q = _usable(queries).distinct().withColumn("q", F.concat_ws(":", F.coalesce("id", F.lit("")), F.md5(F.to_json("vector"))))
    x = _usable(items)
    n_q, n_x = max(1, -(-queries.count() // query_block)), max(1, -(-items.count() // item_block))
    q = q.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(n_q)).cast("int")).withColumn(
        "xb", F.explode(F.sequence(F.lit(0), F.lit(n_x - 1))))
    x = x.withColumn("xb", F.pmod(F.xxhash64("id", "vector", F.monotonically_increasing_id()), F.lit(n_x)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    found = q.groupBy("qb", "xb").cogroup(x.groupBy("qb", "xb")).applyInArrow(
        lambda a, b: _top(a, b, k), "q string, query_id string, item_id string, score double")
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("item_id"))
    return (found.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
            .select("query_id", "rank", "item_id", "score"))
