"""ML operators on the embeddings table (small settings)."""

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from benchtrail.fixtures import raw
from benchtrail.operators import ml as M
from conftest import SMOKE


def emb(spark):
    return M.vectorize(raw(spark, SMOKE, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))


def test_split_is_deterministic_and_disjoint(spark):
    d = emb(spark)
    tr, te = M.split(d, "vec_id")
    a, b = {r.vec_id for r in tr.collect()}, {r.vec_id for r in te.collect()}
    assert not (a & b) and len(a | b) == d.count()
    assert 0.1 < len(b) / (len(a) + len(b)) < 0.3


def test_bake_off_records_failures(spark):
    tr, te = M.split(emb(spark), "vec_id")
    makers = {"LR": lambda: LogisticRegression(featuresCol="features", labelCol="label", maxIter=5),
              "BROKEN": lambda: LogisticRegression(featuresCol="no_such_column", labelCol="label")}
    res = {r.model: r for r in M.bake_off(tr, te, makers).collect()}
    assert res["LR"].error is None and 0.0 <= res["LR"].accuracy <= 1.0
    assert res["BROKEN"].accuracy is None and res["BROKEN"].error


def test_rff_grid_search_small(spark):
    d = emb(spark).withColumn("label", (F.col("label") >= 5).cast("double"))
    tr, _ = M.split(d, "vec_id")
    g = M.svm_grid_search(tr, "features", "label", 64, binary=True, cs=(0.1, 10), gammas=(0.001,), folds=2, max_iter=3)
    assert g.count() == 2 and all(0 <= r.accuracy <= 1 for r in g.collect())


def test_head_sample_and_info(spark):
    e = raw(spark, SMOKE, "events")
    ids = sorted(r.event_id for r in e.select("event_id").collect())
    got = sorted(r.event_id for r in M.head_sample(e, "event_id", 37).collect())
    assert got == ids[:37]
    info = M.dataset_info(raw(spark, SMOKE, "embeddings"), "vec_id", "label", F.size("embedding")).first()
    assert info.dimension == 64 and info.is_binary is False
