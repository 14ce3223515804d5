"""Incremental principal components (M13) from mergeable moments.

A chunk of rows becomes its moments: the number of rows, the mean and the
co-moments (sums of products of deviations from the mean). The moments of two chunks
combine into those of both, so a model takes in new chunks without reading old
ones, and chunks are combined in any order, ``FAN`` at a time up a tree. The
components are the eigenvectors of one matrix of features x features.

Rows whose vector is null, of another length, or holds null or non-finite
components take no part; a model of no rows has no components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchtrail.session import materialize

#: moments combined in one task, chunks that a task sums up side by side
FAN, OPEN = 64, 64
MOMENTS = "chunk string, n long, mean array<double>, comoment array<double>"


def combine(a: tuple, b: tuple) -> tuple:
    """Moments (n, mean, co-moments) of the rows of both."""
    n = a[0] + b[0]
    delta = b[1] - a[1]
    return n, a[1] + delta * (b[0] / n), a[2] + b[2] + np.outer(delta, delta) * (a[0] * b[0] / n)


def of_rows(x: np.ndarray) -> tuple:
    mean = x.mean(axis=0)
    d = x - mean
    return len(x), mean, d.T @ d


def _rows(chunk: str, slot: int, m: tuple) -> tuple:
    return chunk, slot, m[0], m[1].tolist(), m[2].ravel().tolist()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["chunk", "slot", "n", "mean", "comoment"])


def moments(df: DataFrame, vector_col: str, dim: int, chunk_col: str | None = None) -> DataFrame:
    """(chunk, n, mean, comoment): one row per value of ``chunk_col`` (one chunk in all if not given)."""
    v = F.col(vector_col).cast("array<double>")
    chunk = F.lit("") if chunk_col is None else F.coalesce(F.col(chunk_col).cast("string"), F.lit(""))
    rows = df.select(chunk.alias("chunk"), v.alias("v"), F.spark_partition_id().alias("p")).filter(
        F.col("v").isNotNull() & (F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, slot = {}, 0
        for b in batches:
            for chunk, part in b.groupby("chunk"):
                slot = int(part["p"].iat[0])
                if chunk not in held and len(held) == OPEN:
                    yield _frame([_rows(c, slot, m) for c, m in held.items()])
                    held = {}
                m = of_rows(np.stack(part["v"].to_numpy()))
                held[chunk] = combine(held[chunk], m) if chunk in held else m
        if held:
            yield _frame([_rows(c, slot, m) for c, m in held.items()])

    return combined(rows.mapInPandas(partial, MOMENTS.replace("n long", "slot long, n long")))


def combined(parts: DataFrame, keep_chunks: bool = True) -> DataFrame:
    """Rows of moments combined: one per chunk, or one in all."""
    if not keep_chunks:
        parts = parts.withColumn("chunk", F.lit(""))
    if "slot" not in parts.columns:
        parts = parts.withColumn("slot", F.lit(0).cast("long"))

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        d = len(rows["mean"].iat[0])
        m = None
        for n, mean, comoment in zip(rows["n"], rows["mean"], rows["comoment"]):
            one = n, np.array(mean), np.array(comoment).reshape(d, d)
            m = one if m is None else combine(m, one)
        return _frame([_rows(rows["chunk"].iat[0], int(rows["slot"].iat[0]), m)])

    schema = MOMENTS.replace("n long", "slot long, n long")
    parts = materialize(parts.select("chunk", "slot", "n", "mean", "comoment"), "moments")
    while True:
        most = parts.groupBy("chunk").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts.drop("slot")
        groups = -(-most // FAN)
        place = F.pmod(F.xxhash64("slot", "n", "mean"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long")
        parts = materialize(parts.withColumn("slot", place).groupBy("chunk", "slot").applyInPandas(join, schema), "moments")


def update(model: DataFrame | None, new: DataFrame) -> DataFrame:
    """A model (one row of moments) with the moments of new chunks taken in."""
    return combined(new if model is None else model.unionByName(new), keep_chunks=False)


def covariances(model: DataFrame) -> DataFrame:
    """(chunk, i, j, n, covariance) for i <= j, with n - 1 as divisor (null for one row)."""
    d = F.size("mean")
    cells = model.select("chunk", "n", d.alias("d"), F.posexplode("comoment").alias("at", "c"))
    return (cells.select("chunk", F.expr("cast(at div d as int)").alias("i"), F.expr("cast(at % d as int)").alias("j"), "n",
                         F.try_divide("c", (F.col("n") - 1).cast("double")).alias("covariance")).filter("i <= j"))


def components(model: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, axes, variances): the k axes of largest variance; the largest loading of each is positive."""
    rows = model.collect()  # one row of features x features
    if not rows:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    n, mean = rows[0].n, np.array(rows[0].mean)
    value, vector = np.linalg.eigh(np.array(rows[0].comoment).reshape(len(mean), -1) / max(n - 1, 1))
    order = np.argsort(-value, kind="stable")[:k]
    axes = vector[:, order].T
    signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
    return mean, axes * signs[:, None], np.maximum(value[order], 0)


def project(df: DataFrame, vector_col: str, model: DataFrame, k: int, out: str = "pca") -> DataFrame:
    """The rows with their coordinates along the k axes (null for a vector that takes no part)."""
    mean, axes, _ = components(model, k)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def along(v: pd.Series) -> pd.Series:
        fits = lambda x: x is not None and len(x) == len(mean) and np.isfinite(np.array(x, float)).all()
        return pd.Series([axes @ (np.array(x, float) - mean) if fits(x) else None for x in v])

    return df.withColumn(out, along(F.col(vector_col).cast("array<double>")))
