"""Multinomial naive Bayes (M3) from sufficient statistics.

Training is one aggregation: rows and feature sums of each class, and the range
of each feature. All of them add up (or take the extremes), so a day's rows
update a stored model without its old rows. Features are brought to 0..1 by their range; the
scaled sums follow from the plain ones.

Rows with a null label, or a vector that is null, of another length, or holds null or
non-finite components, take no part. A feature that doesn't vary counts as 0; a value
outside the range of the training rows counts as its nearest end from below.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMOOTHING = 0.01


def statistics(df: DataFrame, vector_col: str, label_col: str, dim: int) -> DataFrame:
    """(label, feature, n, total, low, high): one row per class and feature."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(label_col).cast("long").alias("label"), v.alias("v")).filter(
        F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") == dim)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("label", F.posexplode("v").alias("feature", "x")).groupBy("label", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high"))


def merged(*parts: DataFrame) -> DataFrame:
    """Statistics of all parts together."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("label", "feature").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def model(stats: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(label, feature, low, high, log_prior, log_prob): windows over classes x features only."""
    feature, label = Window.partitionBy("feature"), Window.partitionBy("label")
    low, high = F.min("low").over(feature), F.max("high").over(feature)
    s = stats.select("label", "feature", "n", "total", low.alias("low"), high.alias("high"), F.sum("n").over(feature).alias("rows"))
    s = s.withColumn("scaled", F.when(F.col("high") > F.col("low"), (F.col("total") - F.col("n") * F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0))
    whole = F.sum("scaled").over(label) + smoothing * F.count(F.lit(1)).over(label)
    return s.select("label", "feature", "low", "high", F.log(F.col("n") / F.col("rows")).alias("log_prior"),
                    (F.log(F.greatest(F.col("scaled"), F.lit(0.0)) + smoothing) - F.log(whole)).alias("log_prob"))


def classify(df: DataFrame, trained: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, prediction): the class of largest posterior, ties to the smaller label; null for a vector that takes no part."""
    rows = trained.orderBy("label", "feature").collect()  # classes x features
    labels = sorted({r.label for r in rows})
    dim = len(rows) // max(len(labels), 1)
    theta = np.array([r.log_prob for r in rows]).reshape(len(labels), dim) if rows else np.zeros((0, 0))
    prior = np.array([rows[i * dim].log_prior for i in range(len(labels))])
    low, high = np.array([r.low for r in rows[:dim]]), np.array([r.high for r in rows[:dim]])

    @F.pandas_udf("long")
    def best(v: pd.Series) -> pd.Series:
        out = []
        for x in v:
            x = np.array([] if x is None else x, float)
            if not len(labels) or len(x) != dim or not np.isfinite(x).all():
                out.append(None)
                continue
            scaled = np.where(high > low, np.maximum((x - low) / np.where(high > low, high - low, 1), 0), 0)
            out.append(labels[int((theta @ scaled + prior).argmax())])
        return pd.Series(out, dtype="Int64")

    return df.select(F.col(id_col).alias("id"), best(F.col(vector_col).cast("array<double>")).alias("prediction"))
