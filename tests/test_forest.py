"""Extremely randomised trees (M11): a planted feature, the counts behind the gains, odd rows."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from benchtrail.operators import forest as X

SCHEMA = "id long, v array<double>, label int"


def planted(n=600, dim=6, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    return [(i, x[i].tolist(), int(x[i][2] > 0.3) + int(x[i][2] > 1)) for i in range(n)]


def gini_mass(labels):
    return len(labels) - sum(labels.count(c) ** 2 for c in set(labels)) / len(labels) if labels else 0.0


def test_planted_feature_ranks_first_and_reruns_agree(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    splits = X.grow(df, "v", "label", trees=3, depth=2, tried=3)
    imp = {r.feature: r.importance for r in X.importances(splits, 6).collect()}
    assert max(imp, key=imp.get) == 2 and imp[2] > 0.5 and abs(sum(imp.values()) - 1) < 1e-9 and min(imp.values()) >= 0
    again = X.grow(df.repartition(7), "v", "label", trees=3, depth=2, tried=3)
    assert sorted(map(tuple, splits.collect())) == sorted(map(tuple, again.collect()))


def test_every_split_has_the_counts_of_its_rows(spark):
    rows = planted(200)
    splits = X.grow(spark.createDataFrame(rows, SCHEMA), "v", "label", trees=2, depth=3, tried=2).collect()
    by = {(s.tree, s.node): s for s in splits}
    for tree in range(2):
        todo = [(1, rows)]
        while todo:
            node, here = todo.pop()
            s = by.get((tree, node))
            if s is None:
                assert node >= 2**3 or len({r[2] for r in here}) < 2 or len(here) < 2
                continue
            left, right = [r for r in here if r[1][s.feature] <= s.cut], [r for r in here if r[1][s.feature] > s.cut]
            assert left and right and s.n == len(here) and s.depth == int(math.log2(node))
            labels = lambda part: [r[2] for r in part]
            assert abs(s.gain - (gini_mass(labels(here)) - gini_mass(labels(left)) - gini_mass(labels(right)))) < 1e-9
            todo += [(2 * node, left), (2 * node + 1, right)]


def test_predictions_of_held_out_rows(spark):
    train, test = spark.createDataFrame(planted(800), SCHEMA), spark.createDataFrame(planted(200, seed=2), SCHEMA)
    splits = X.grow(train, "v", "label", trees=4, depth=3, tried=6)
    got = X.predict(test, splits, train, "id", "v", "label", 3).join(test, "id")
    assert got.count() == 200 and got.filter(F.col("prediction") == F.col("label")).count() > 170


def test_odd_rows(spark):
    rows = planted(50) + [(100, None, 1), (101, [1.0] * 6, None), (102, [math.nan] * 6, 1), (103, [None] * 6, 1)]
    splits = X.grow(spark.createDataFrame(rows, SCHEMA), "v", "label", trees=1, depth=1, tried=6)
    assert splits.filter("node = 1").agg(F.max("n")).first()[0] == 50
    same = spark.createDataFrame([(i, [1.0, 2.0], i % 2) for i in range(20)], SCHEMA)
    one_class = spark.createDataFrame([(i, [float(i)], 1) for i in range(20)], SCHEMA)
    for df in (same, one_class, spark.createDataFrame([], SCHEMA)):
        grown = X.grow(df, "v", "label", trees=1, depth=1)
        assert grown.count() == 0 and [r.importance for r in X.importances(grown, 2).collect()] == [0.0, 0.0]


def defined_predictions(train, asked, trees, depth, seed=X.SEED):
    """The definition in numpy, with every feature drawn in every node: {id: label}."""
    x, y = np.array([r[1] for r in train]), np.array([r[2] for r in train])
    ids, v, votes = [r[0] for r in asked], np.array([r[1] for r in asked]), np.zeros((len(asked), y.max() + 1))
    mass = lambda part: float((np.bincount(part) ** 2).sum()) / len(part)

    def leaf(tree, node, here, there, left):
        cuts = []
        for f in range(x.shape[1]) if left and len(set(y[here])) > 1 else ():
            low, high = x[here, f].min(), x[here, f].max()
            cut = low + int(hashlib.md5(f"{seed}:c:{tree}:{node}:{f}".encode()).hexdigest()[:X.DIGITS], 16) / 16**X.DIGITS * (high - low)
            right = x[here, f] > cut
            if right.any() and not right.all():
                cuts.append((mass(y[here[~right]]) + mass(y[here[right]]) - mass(y[here]), -f, cut))
        if not cuts:
            votes[there] += np.bincount(y[here], minlength=votes.shape[1]) / len(here)
            return
        _, f, cut = max(cuts)
        for child, side in ((2 * node, lambda a: a <= cut), (2 * node + 1, lambda a: a > cut)):
            leaf(tree, child, here[side(x[here, -f])], there[side(v[there, -f])], left - 1)

    for tree in range(trees):
        leaf(tree, 1, np.arange(len(x)), np.arange(len(v)), depth)
    return dict(zip(ids, votes.round(9).argmax(1).tolist()))


def test_predictions_are_those_of_the_definition(spark):
    train, asked = planted(800), planted(200, seed=2)
    df = spark.createDataFrame(train, SCHEMA)
    splits = X.grow(df, "v", "label", trees=4, depth=3, tried=6)
    got = X.predict(spark.createDataFrame(asked, SCHEMA), splits, df, "id", "v", "label", 3).collect()
    assert len(got) == 200 and {r.id: r.prediction for r in got} == defined_predictions(train, asked, 4, 3)
