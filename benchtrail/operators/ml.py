"""Classifier bake-off over tables (M1-M3, M5-M16, W11) with Spark ML.

Estimators are Spark ML pipelines trained on the whole (distributed) frame;
there is no chunked / incremental reading. Where Spark has no twin of the
original estimator the nearest one is used and named as such:
kernel SVM -> random Fourier features + linear SVM (approximate),
extra-trees importances -> random-forest importances.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import MinMaxScaler, PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 5


# --- M1 / M2 / M16 / W11 ------------------------------------------------------------

def feature_table(df: DataFrame, id_col: str, feature_cols: Sequence[str], label: Column,
                  label_name: str = "up") -> DataFrame:
    """M1: id, the named feature columns (as double) and a boolean label."""
    return df.select(id_col, *[F.col(c).cast("double").alias(c) for c in feature_cols], label.alias(label_name))


def assemble(df: DataFrame, feature_cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out).transform(df)


def vectorize(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """An array<float> column as an ML vector."""
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def is_test_row(id_col: str) -> Column:
    """M2: deterministic 80/20 split: a row is in the test set when the first
    two hex digits of md5(id) are below '33' (51 of 256 values)."""
    return F.substring(F.md5(F.col(id_col).cast("string")), 1, 2) < F.lit("33")


def split(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    t = is_test_row(id_col)
    return df.filter(~t), df.filter(t)


def dataset_info(df: DataFrame, id_col: str, label_col: str, dim: int | Column) -> DataFrame:
    """Training / test counts, dimension and whether the label is binary."""
    t = is_test_row(id_col)
    d = dim if isinstance(dim, Column) else F.lit(int(dim))
    return df.agg(F.count_if(~t).cast("bigint").alias("n_train"), F.count_if(t).cast("bigint").alias("n_test"),
                  F.max(d).cast("int").alias("dimension"),
                  (F.count_distinct(F.col(label_col)) == 2).alias("is_binary"))


def head_sample(df: DataFrame, order_col: str, n: int = 64000) -> DataFrame:
    """The first ``n`` rows by ``order_col`` -- a sampling operator, so
    the limit is the feature. Positions come from a distributed dense index,
    so no single task merges per-partition top-n lists."""
    from benchtrail.functions.ranking import dense_index
    return dense_index(df, order_col, "_pos").filter(F.col("_pos") < n).drop("_pos")


# --- M9: random Fourier features --------------------------------------------------

def rff_transform(df: DataFrame, features: str, dim: int, gamma: float, n_components: int = 256,
                  out: str = "rff", seed: int = SEED) -> DataFrame:
    """Random Fourier features approximating the RBF kernel exp(-gamma |x-y|^2):
    z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).
    Arrow-batched (numpy matmul per batch); W and b are a few KB."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, n_components))
    b = rng.uniform(0.0, 2 * np.pi, size=n_components)
    scale = np.sqrt(2.0 / n_components)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(x: pd.Series) -> pd.Series:
        m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, dim))
        z = scale * np.cos(m @ w + b)
        return pd.Series(list(z))

    arr = vector_to_array(F.col(features)) if dict(df.dtypes)[features] != "array<double>" else F.col(features)
    return df.withColumn(out, array_to_vector(rff(arr)))


class NonNegative(Transformer):
    """Rows outside the range that a scaler was fitted on can come out below 0; naive Bayes counts them as 0."""

    def __init__(self, column: str):
        super().__init__()
        self.column = column

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = F.transform(vector_to_array(self.column), lambda x: F.greatest(x, F.lit(0.0)))
        return df.withColumn(self.column, array_to_vector(kept))


# --- estimators -------------------------------------------------------------------

def estimators(n_features: int, n_classes: int, features: str = "features", label: str = "label",
               gbt_rounds: int = 200) -> dict[str, Callable[[], object]]:
    """The bake-off's estimators (constructors, so each fit starts fresh)."""
    binary = n_classes == 2

    def nb():
        scaled = f"{features}_scaled"
        return Pipeline(stages=[MinMaxScaler(inputCol=features, outputCol=scaled), NonNegative(scaled),
                                NaiveBayes(featuresCol=scaled, labelCol=label, smoothing=0.01, modelType="multinomial")])

    def gbt():
        g = GBTClassifier(featuresCol=features, labelCol=label, maxIter=gbt_rounds, seed=SEED)
        return g if binary else OneVsRest(classifier=g, featuresCol=features, labelCol=label, parallelism=8)  # classes at a time

    return {
        "NB": nb,
        "LR": lambda: LogisticRegression(featuresCol=features, labelCol=label, elasticNetParam=0.0, regParam=0.01),
        "RF": lambda: RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=8, seed=SEED),
        "DT": lambda: DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=SEED),
        "GBDT": gbt,
        "MLP": lambda: MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, seed=SEED,
                                                      layers=[n_features, 10, 20, 10, n_classes], maxIter=100),
    }


def svm_rbf(features: str, label: str, binary: bool, reg: float = 0.01, max_iter: int = 50):
    """M9: linear SVM over random Fourier features (approximate kernel SVM);
    one-vs-rest for several classes."""
    svc = LinearSVC(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter)
    return svc if binary else OneVsRest(classifier=svc, featuresCol=features, labelCol=label)


def svm_grid_search(train: DataFrame, features: str, label: str, dim: int, binary: bool,
                    cs=(1e-3, 1e-2, 1e-1, 1, 10, 100, 1000), gammas=(0.001, 0.0001),
                    folds: int = 3, max_iter: int = 10, parallelism: int = 4) -> DataFrame:
    """C x gamma grid with k-fold cross validation. gamma changes the
    feature map, so each gamma is its own cross-validated fit over C
    (regParam = 1/C). Returns one row per (gamma, C) with the mean metric."""
    rows = []
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    for g in gammas:
        z = rff_transform(train, features, dim, g, out="_rff")
        est = svm_rbf("_rff", label, binary, max_iter=max_iter)
        svc = est.getClassifier() if isinstance(est, OneVsRest) else est
        grid = ParamGridBuilder().addGrid(svc.regParam, [1.0 / c for c in cs]).build()
        cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=SEED,
                            parallelism=parallelism)
        model = cv.fit(z)
        for c, m in zip(cs, model.avgMetrics):
            rows.append((float(g), float(c), float(m)))
    return train.sparkSession.createDataFrame(rows, "gamma double, c double, accuracy double")


# --- M11 / M13 / M14 / M15 ------------------------------------------------------------

def feature_importances(train: DataFrame, features: str, label: str) -> DataFrame:
    """M11 (nearest Spark twin of extra-trees importances): random-forest
    feature importances, one row per feature index."""
    model = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=8, seed=SEED).fit(train)
    imp = model.featureImportances.toArray()
    return train.sparkSession.createDataFrame([(int(i), float(v)) for i, v in enumerate(imp)],
                                              "feature int, importance double")


def pca_project(df: DataFrame, features: str, k: int, out: str = "pca") -> tuple[DataFrame, list[float]]:
    """PCA fitted on the whole frame; returns the projected frame and
    the explained variance of each component."""
    model = PCA(k=k, inputCol=features, outputCol=out).fit(df)
    return model.transform(df), [float(v) for v in model.explainedVariance.toArray()]


def confusion_metrics(df: DataFrame, truth: str, pred: str, positive=1) -> DataFrame:
    """Precision, recall and accuracy from confusion counts (SQL)."""
    t = F.col(truth) == F.lit(positive)
    p = F.col(pred) == F.lit(positive)
    agg = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                 F.count_if(t & ~p).alias("fn"), F.count_if(F.col(truth) == F.col(pred)).alias("hit"),
                 F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("tp").cast("bigint"), F.col("fp").cast("bigint"), F.col("fn").cast("bigint"),
                      F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"),
                      F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6).alias("recall"),
                      F.round(F.try_divide(F.col("hit"), F.col("n")), 6).alias("accuracy"))


def bake_off(train: DataFrame, test: DataFrame, makers: dict[str, Callable[[], object]], label: str = "label",
             binary: bool = False, save_dir: str | None = None, train_scores: bool = False) -> DataFrame:
    """Train each estimator, time it, score it on the test split; an
    estimator that fails is recorded with its error instead of skipped
    silently. Models are saved under ``save_dir`` when given; with
    ``train_scores`` they are scored on the rows they were fitted on, too."""
    rows = []
    for name, make in makers.items():
        t0 = time.time()
        try:
            model = make().fit(train)
            secs = time.time() - t0
            pred = model.transform(test).select(F.col(label).cast("double").alias("_t"),
                                                F.col("prediction").cast("double").alias("_p"))
            m = confusion_metrics(pred, "_t", "_p", 1.0).withColumn("n", F.lit(pred.count())).first()
            if save_dir:
                model.write().overwrite().save(f"{save_dir.rstrip('/')}/{name}")
            on_train = None
            if train_scores:
                on_train = float(confusion_metrics(model.transform(train).select(F.col(label).cast("double").alias("_t"), F.col("prediction").alias("_p")), "_t", "_p", 1.0).first()["accuracy"])
            rows.append((name, float(secs), float(m["accuracy"] or 0.0),
                         float(m["precision"]) if binary and m["precision"] is not None else None,
                         float(m["recall"]) if binary and m["recall"] is not None else None, m["n"], None, on_train))
        except Exception as e:  # recorded, not swallowed
            rows.append((name, float(time.time() - t0), None, None, None, None, f"{type(e).__name__}: {e}", None))
    schema = "model string, seconds double, accuracy double, precision double, recall double, n_scored long, error string, train_accuracy double"
    return train.sparkSession.createDataFrame(rows, schema)


def component_summary(projected: DataFrame, k: int, column: str = "pca") -> DataFrame:
    """M13 summary of a projection: rows, components, whether their variances
    don't increase and whether no two of them are correlated."""
    at = F.col(column) if dict(projected.dtypes)[column].startswith("array") else vector_to_array(column)
    parts = projected.select(*[at[i].alias(f"c{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i)]
    s = parts.agg(F.count(F.lit(1)).alias("n_rows"), *[F.variance(f"c{i}").alias(f"v{i}") for i in range(k)],
                  *[F.abs(F.corr(f"c{i}", f"c{j}")).alias(f"r{i}_{j}") for i, j in pairs])
    ordered = [F.col(f"v{i}") <= F.col(f"v{i - 1}") * (1 + 1e-9) for i in range(1, k)]
    return s.select("n_rows", F.lit(k).alias("n_components"), F.forall(F.array(*ordered), lambda x: x).alias("ordered"),
                    (F.greatest(*[F.col(f"r{i}_{j}") for i, j in pairs]) < 1e-6).alias("uncorrelated"))
