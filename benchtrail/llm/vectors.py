"""Helpers of the searches over integer vectors.

Rows are placed in cells by their position in space; cells are cut by hash
into blocks of at most ``BLOCK`` rows. A query is sent to the blocks of the
cells that it can't exclude; a block meets its queries in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.functions import blocks

#: rows of a block, queries that meet it at a time, cells at most, sampled rows that shape the cells
BLOCK, QUERY_BLOCK, CELLS, SAMPLE = 16_384, 16_384, 512, 8_192
LONG = 2**63 - 1


def integer_rows(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label: Column | None = None) -> DataFrame:
    """(id, label, v: array<bigint>): the rows that take part, one per id.

    A component x becomes floor(scale * x), held to the range of long. Rows
    without an id, and vectors that are null or hold null or non-finite
    components, take no part. A repeated id counts once, with the smallest of
    its (label, vector). Shorter vectors count as padded with zeros.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), (F.lit(0) if label is None else label).cast("long").alias("label"), v.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                       & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def without_dominated(rows: DataFrame, k: int) -> DataFrame:
    """Rows that can be among the k first of a search. Rows of one label and
    vector score alike and rank by id, so more than k + 1 of them never do (one may be
    the query itself). The limit applies before the shuffle."""
    order = Window.partitionBy("label", "v").orderBy("id")
    return rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1).drop("nth")


def matrix(column, dim: int) -> np.ndarray:
    """The vectors of a column as rows of one matrix of integers, padded with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def for_products(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type whose inner products are exact: doubles where every sum
    of products stays below 2**53, Python's integers beyond."""
    top = lambda m: max(int(m.max()), -int(m.min()), 1) if m.size else 1
    kind = np.float64 if top(x) * top(y) * max(x.shape[-1], 1) < 2**53 else object
    return x.astype(kind), y.astype(kind)


def held(scores: np.ndarray) -> np.ndarray:
    """Scores, or bounds of scores, held to the range of long (doubles of ``for_products`` never leave it)."""
    return np.clip(scores, -LONG - 1, LONG) if scores.dtype == object else scores


def sample(rows: DataFrame, dim: int) -> np.ndarray:
    """``SAMPLE`` vectors at most: those with the smallest hash of their id."""
    picked = rows.select(F.xxhash64("id").alias("h"), "id", "v").orderBy("h", "id").limit(SAMPLE).collect()
    return matrix([r.v for r in picked], dim)


def cell_count(spark, n: int) -> int:
    """Cells for n rows: blocks' worth of rows, but enough for every core."""
    return min(CELLS, max(-(-n // BLOCK), min(spark.sparkContext.defaultParallelism, -(-n // 1024)), 1))


def meet(placed: DataFrame, sizes: dict[int, int], queries: DataFrame, n_queries: int, search: Callable, schema: str) -> DataFrame:
    """``blocks.meet`` with the sizes of this module; ``sizes`` has at most ``CELLS`` cells."""
    return blocks.meet(placed, sizes, queries, n_queries, search, schema, BLOCK, QUERY_BLOCK)


def first(df: DataFrame, keys: list[str], k: int, score: str = "score", id_col: str = "vec_id") -> DataFrame:
    """The k highest scores of each key, ties to the smaller id, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), id_col)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
