"""Machine-learning queries: feature table and split (events), metrics
(labels), dataset info and estimator bake-off (embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import raw
from benchtrail.operators import bayes as B
from benchtrail.operators import forest as X
from benchtrail.operators import kernel as S
from benchtrail.operators import ml as M
from benchtrail.operators import moments as I
from benchtrail.operators import neighbours as N
from benchtrail.registry import query

FEATURES = ["user_id", "value", "c7"]


def events_features(spark, sf_dir):
    e = raw(spark, sf_dir, "events").withColumn("c7", F.col("event_id") % 7)
    return M.feature_table(e, "event_id", FEATURES, F.col("value") > F.col("c7"))


def embedded(spark, sf_dir):
    e = raw(spark, sf_dir, "embeddings")
    return M.vectorize(e, "embedding").withColumn("label", F.col("label").cast("double"))


@query("m1_feature_table", """
select event_id, cast(user_id as double) as user_id, value, cast(event_id % 7 as double) as c7, value > event_id % 7 as up from events
""")
def m1_feature_table(spark, sf_dir):
    return events_features(spark, sf_dir)


@query("m2_split", """
select substr(md5(cast(event_id as varchar)), 1, 2) < '33' as is_test, count(*) as n, count(*) filter (where value > event_id % 7) as n_up
from events group by 1
""")
def m2_split(spark, sf_dir):
    f = events_features(spark, sf_dir)
    return f.groupBy(M.is_test_row("event_id").alias("is_test")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if("up").cast("bigint").alias("n_up"))


@query("m14_confusion_metrics", """
select count(*) filter (where quality = 1 and toxic = 1) as tp, count(*) filter (where quality <> 1 and toxic = 1) as fp,
       count(*) filter (where quality = 1 and toxic <> 1) as fn,
       round(count(*) filter (where quality = 1 and toxic = 1) / nullif(count(*) filter (where toxic = 1), 0), 6) as precision,
       round(count(*) filter (where quality = 1 and toxic = 1) / nullif(count(*) filter (where quality = 1), 0), 6) as recall,
       round(count(*) filter (where quality = toxic) / count(*), 6) as accuracy
from labels
""")
def m14_confusion_metrics(spark, sf_dir):
    return M.confusion_metrics(raw(spark, sf_dir, "labels"), "quality", "toxic", 1)


@query("m16_dataset_info", """
select count(*) filter (where not (substr(md5(cast(vec_id as varchar)), 1, 2) < '33')) as n_train,
       count(*) filter (where substr(md5(cast(vec_id as varchar)), 1, 2) < '33') as n_test,
       cast(max(len(embedding)) as int) as dimension, count(distinct label) = 2 as is_binary
from embeddings
""")
def m16_dataset_info(spark, sf_dir):
    e = raw(spark, sf_dir, "embeddings")
    return M.dataset_info(e, "vec_id", "label", F.size("embedding"))


@query("w11_head_sample", "select event_id, ts, user_id, event_type, value from events order by event_id limit 64000")
def w11_head_sample(spark, sf_dir):
    e = raw(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return M.head_sample(e, "event_id", 64000)


@query("w11_head_sample_cut", "select event_id, ts, user_id, event_type, value from events order by ts, event_id limit 777")
def w11_head_sample_cut(spark, sf_dir):
    e = raw(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return M.head_sample(e, ["ts", "event_id"], 777)


TEST_ROWS = "(select count(*) from embeddings where substr(md5(cast(vec_id as varchar)), 1, 2) < '33')"


def _models(*names):
    return "select unnest([" + ", ".join(f"'{n}'" for n in names) + f"]) as model, {TEST_ROWS} as n_scored, false as failed"


# what a trained model predicts has no SQL form: the oracle has the models that must train and the rows they must score
def _scored(results):
    return results.select("model", "n_scored", F.col("error").isNotNull().alias("failed"))


# a model that learned anything beats the largest class on the rows it was fitted on
FITTED = """(select cast(count(distinct label) as bigint) from embeddings where not (substr(md5(cast(vec_id as varchar)), 1, 2) < '33')) as n_classes, true as above_majority"""


@query("m15_bake_off", _models("NB", "LR", "RF", "DT", "GBDT", "MLP").replace(" as failed", f" as failed, {FITTED}"))
def m15_bake_off(spark, sf_dir):
    train, test = M.split(embedded(spark, sf_dir), "vec_id")
    train = train.coalesce(spark.sparkContext.defaultParallelism)
    classes = train.groupBy("label").count().agg(F.count(F.lit(1)).alias("n_classes"), (F.max("count") / F.sum("count")).alias("majority")).first()
    results = M.bake_off(train, test, M.estimators(64, 10), train_scores=True)
    return results.select("model", "n_scored", F.col("error").isNotNull().alias("failed"), F.lit(classes.n_classes).cast("bigint").alias("n_classes"),
                          F.coalesce(F.col("train_accuracy") > classes.majority, F.lit(False)).alias("above_majority"))


@query("m8_gbt_binary", _models("GBDT"))
def m8_gbt_binary(spark, sf_dir):
    d = embedded(spark, sf_dir).withColumn("label", (F.col("label") >= 5).cast("double"))
    train, test = M.split(d, "vec_id")
    return _scored(M.bake_off(train, test, {"GBDT": M.estimators(64, 2)["GBDT"]}, binary=True))


TRAIN_ROWS = TEST_ROWS.replace("where substr", "where not substr")


@query("m9_svm_rbf", f"select 'SVM_RBF' as model, {TEST_ROWS} as n_scored, true as known_labels")
def m9_svm_rbf(spark, sf_dir):
    train, test = M.split(raw(spark, sf_dir, "embeddings"), "vec_id")
    machines = S.fit(train, [(0.5, 1.0)], "vec_id", "embedding", "label")
    found = S.predict(machines, test, "vec_id", "embedding")
    return found.agg(F.lit("SVM_RBF").alias("model"), F.count(F.lit(1)).alias("n_scored"), F.every(F.col("prediction").isin(machines.labels)).alias("known_labels"))


@query("m10_svm_grid", f"""
select g.gamma, c.c, {TRAIN_ROWS} as n_scored, true as scored from (select unnest([0.001::double, 0.0001::double]) as gamma) g
cross join (select unnest([0.001::double, 0.01, 0.1, 1, 10, 100, 1000]) as c) c
""")
def m10_svm_grid(spark, sf_dir):
    return m10_svm_accuracies(spark, sf_dir).select("gamma", "c", "n_scored", F.col("accuracy").between(0, 1).alias("scored"))


@query("m10_svm_accuracies")
def m10_svm_accuracies(spark, sf_dir):
    return S.grid(M.split(raw(spark, sf_dir, "embeddings"), "vec_id")[0], "vec_id", "embedding", "label")


TREES, DEPTH, TRIED = 10, 4, 8


def _forest_sql() -> str:
    """The trees of ``forest.grow`` in SQL, one block of CTEs per level."""
    draw = lambda kind, f: f"md5(concat('5:{kind}:', tree, ':', node, ':', {f}))"
    ctes = [f"""e as (select label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings where not (substr(md5(cast(vec_id as varchar)), 1, 2) < '33')),
rows0 as (select v, label, cast(t.tree as int) as tree, cast(1 as bigint) as node from e cross join (select unnest(range({TREES})) as tree) t)"""]
    for d in range(DEPTH):
        ctes.append(f"""nodes{d} as (select tree, node, count(*) as n from rows{d} group by 1, 2 having count(*) >= 2 and count(distinct label) > 1),
picks{d} as (select tree, node, n, feature from nodes{d} cross join (select unnest(range(64)) as feature) f
  qualify row_number() over (partition by tree, node order by {draw("f", "feature")}) <= {TRIED}),
values{d} as (select p.tree, p.node, p.n, p.feature, r.label, r.v[p.feature + 1] as x from rows{d} r join picks{d} p on r.tree = p.tree and r.node = p.node),
cuts{d} as (select tree, node, feature, min(x) + (cast(concat('0x', substr({draw("c", "feature")}, 1, 12)) as bigint) / 281474976710656.0e0) * (max(x) - min(x)) as cut
  from values{d} group by 1, 2, 3 having min(x) < max(x)),
counts{d} as (select v.tree, v.node, v.feature, c.cut, v.n, v.x > c.cut as is_right, v.label, count(*) as c from values{d} v
  join cuts{d} c on v.tree = c.tree and v.node = c.node and v.feature = c.feature group by 1, 2, 3, 4, 5, 6, 7),
sides{d} as (select tree, node, feature, cut, n, is_right, cast(sum(c * c) as double) / cast(sum(c) as double) as s from counts{d} group by 1, 2, 3, 4, 5, 6),
whole{d} as (select tree, node, cast(sum(c * c) as double) as s from (select tree, node, label, count(*) as c from rows{d} group by 1, 2, 3) group by 1, 2),
best{d} as (select l.tree, l.node, {d} as depth, l.feature, l.cut, l.s + r.s - w.s / cast(l.n as double) as gain, l.n from sides{d} l
  join sides{d} r on l.tree = r.tree and l.node = r.node and l.feature = r.feature and not l.is_right and r.is_right
  join whole{d} w on w.tree = l.tree and w.node = l.node
  qualify row_number() over (partition by l.tree, l.node order by l.s + r.s - w.s / cast(l.n as double) desc, l.feature) = 1),
rows{d + 1} as (select r.v, r.label, r.tree, r.node * 2 + case when r.v[b.feature + 1] > b.cut then 1 else 0 end as node
  from rows{d} r join best{d} b on r.tree = b.tree and r.node = b.node)""")
    return "with " + ",\n".join(ctes) + ",\nsplits as (" + " union all ".join(f"select * from best{d}" for d in range(DEPTH)) + ")\n"


def _forest(spark, sf_dir):
    train, _ = M.split(raw(spark, sf_dir, "embeddings"), "vec_id")
    return X.grow(train, "embedding", "label", TREES, DEPTH, TRIED)


@query("m11_extra_trees", _forest_sql() + "select tree, node, depth, cast(feature as int) as feature, round(cut, 9) as cut, round(gain, 6) as gain, n from splits")
def m11_extra_trees(spark, sf_dir):
    return _forest(spark, sf_dir).withColumn("cut", F.round("cut", 9)).withColumn("gain", F.round("gain", 6))


@query("m11_feature_importances", _forest_sql() + """
select cast(f.feature as int) as feature, round(coalesce(g.s, 0) / (select count(distinct tree) from splits), 6) as importance
from (select unnest(range(64)) as feature) f left join (
  select s.feature, sum(s.g / t.g) as s from (select tree, feature, sum(gain) as g from splits group by 1, 2) s
  join (select tree, sum(gain) as g from splits group by 1) t on s.tree = t.tree group by 1) g on f.feature = g.feature
""")
def m11_feature_importances(spark, sf_dir):
    return X.importances(_forest(spark, sf_dir), 64).withColumn("importance", F.round("importance", 6))


@query("m13_pca", "select count(*) as n_rows, 8 as n_components, true as ordered, true as uncorrelated from embeddings")
def m13_pca(spark, sf_dir):
    e = raw(spark, sf_dir, "embeddings")
    projected = I.project(e, "embedding", _chunked_model(spark, sf_dir), 8)
    return M.component_summary(projected, 8)


def _chunked_model(spark, sf_dir):
    """The rows as seven chunks that arrive one after the other: three at first, then two and two."""
    chunks = raw(spark, sf_dir, "embeddings").withColumn("chunk", F.col("vec_id") % 7)
    model = None
    for low, high in ((0, 2), (3, 4), (5, 6)):
        model = I.update(model, I.moments(chunks.filter(F.col("chunk").between(low, high)), "embedding", 64, "chunk"))
    return model


@query("m13_covariance", """
with e as (select vec_id, unnest(range(64)) as i, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
p as (select vec_id, i, unnest(range(i, 64)) as j, v from e)
select cast(i as int) as i, cast(j as int) as j, count(*) as n, round(covar_samp(v[i + 1], v[j + 1]), 9) as covariance from p group by 1, 2
""")
def m13_covariance(spark, sf_dir):
    return I.covariances(_chunked_model(spark, sf_dir)).select("i", "j", "n", F.round("covariance", 9).alias("covariance"))


BAYES = """with x as (select vec_id, label, i, embedding[i + 1]::double as x, substr(md5(cast(vec_id as varchar)), 1, 2) < '33' as is_test
  from (select vec_id, label, embedding, unnest(range(64)) as i from embeddings) u),
f as (select i, min(x) as low, max(x) as high from x where not is_test group by i),
s as (select x.label, x.i, count(*) as n, sum((x.x - f.low) / (f.high - f.low)) as s, any_value(f.low) as low, any_value(f.high) as high from x join f using (i) where not x.is_test group by 1, 2),
m as (select label, i, low, high, ln(cast(n as double) / sum(n) over (partition by i)) as log_prior, ln(s + 0.01e0) - ln(sum(s) over (partition by label) + 0.64e0) as log_prob from s)
"""


def _bayes(spark, sf_dir):
    train, test = M.split(raw(spark, sf_dir, "embeddings"), "vec_id")
    days = [B.statistics(train.filter(F.col("vec_id") % 3 == d), "embedding", "label", 64) for d in range(3)]
    return B.model(B.merged(B.merged(days[0], days[1]), days[2])), test


@query("m3_bayes_model", BAYES + "select label, cast(i as int) as feature, round(log_prior, 8) as log_prior, round(log_prob, 8) as log_prob from m")
def m3_bayes_model(spark, sf_dir):
    return _bayes(spark, sf_dir)[0].select(F.col("label").cast("int").alias("label"), "feature", F.round("log_prior", 8).alias("log_prior"), F.round("log_prob", 8).alias("log_prob"))


@query("m3_bayes_predictions", BAYES + """
select vec_id as id, cast(label as bigint) as prediction from (select x.vec_id, m.label, any_value(m.log_prior) + sum(greatest((x.x - m.low) / (m.high - m.low), 0) * m.log_prob) as score
  from x join m on x.i = m.i where x.is_test group by 1, 2)
qualify row_number() over (partition by vec_id order by score desc, label) = 1
""")
def m3_bayes_predictions(spark, sf_dir):
    trained, test = _bayes(spark, sf_dir)
    return B.classify(test, trained, "vec_id", "embedding")


PAIRS = """with e as (select vec_id, label, substr(md5(cast(vec_id as varchar)), 1, 2) < '33' as is_test, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
near as (select q.vec_id as query_id, t.vec_id, t.label, list_distance(q.v, t.v) as d,
    row_number() over (partition by q.vec_id order by list_distance(q.v, t.v), t.vec_id) as rank
  from e q join e t on q.is_test and not t.is_test qualify rank <= 5)
"""


def _nearest(spark, sf_dir):
    train, test = M.split(raw(spark, sf_dir, "embeddings"), "vec_id")
    return N.nearest_rows(train, test, 5, "vec_id", "embedding"), train


@query("m4_nearest_rows", PAIRS + "select query_id, cast(rank as int) as rank, vec_id, round(d, 6) as distance from near")
def m4_nearest_rows(spark, sf_dir):
    return _nearest(spark, sf_dir)[0].select("query_id", "rank", F.col("id").alias("vec_id"), F.round("distance", 6).alias("distance"))


@query("m4_knn_predictions", PAIRS + """select query_id, label as prediction from (select query_id, label, count(*) as n from near group by 1, 2)
qualify row_number() over (partition by query_id order by n desc, label) = 1""")
def m4_knn_predictions(spark, sf_dir):
    near, train = _nearest(spark, sf_dir)
    return N.vote(near, train, "vec_id", "label")
