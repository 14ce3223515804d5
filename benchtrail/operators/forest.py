"""Extremely randomised trees and their importances (M11), grown level by level.

All trees grow together. A node draws some features and, for each, one cut
uniformly between the least and largest value of its own rows; the draws are
hashes of (seed, tree, node, feature), so a rerun grows the same trees. A
level takes two aggregations over the rows, both combined map-side: the range of
each drawn feature in each node, then the rows by (tree, node, feature, side,
class) for all trees at once. The best cut by Gini impurity splits the node.
What the driver and the broadcasts see has at most ``trees * 2**depth`` rows.

Rows with a null label, or a vector that is null or holds null or non-finite
components, take no part. A node is a leaf when it has one class, fewer than
``min_rows`` rows or no feature that varies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.session import materialize

SEED = 5
#: hex digits of a hash that make a number in [0, 1)
DIGITS = 12
SPLITS = "tree int, node long, depth int, feature int, cut double, gain double, n long"


def drawn(*parts):
    """Text hash of a draw."""
    return F.md5(F.concat_ws(":", *[p if not isinstance(p, (int, str)) else F.lit(str(p)) for p in parts]))


def uniform(digest):
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def usable(df: DataFrame, vector_col: str, label_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    return df.select(v.alias("v"), F.col(label_col).cast("long").alias("label")).filter(
        F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _level(rows: DataFrame, n_features: int, tried: int, seed: int, depth: int, min_rows: int) -> DataFrame:
    """The best cut of every node: rows are (tree, node, v, label)."""
    nodes = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("a"), F.max("label").alias("b"))
    nodes = materialize(nodes.filter((F.col("n") >= min_rows) & (F.col("a") < F.col("b"))), "forest-nodes")
    features = nodes.select("tree", "node", "n", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))).alias("feature"))
    order = Window.partitionBy("tree", "node").orderBy(drawn(seed, "f", F.col("tree"), F.col("node"), F.col("feature")))  # one row per feature
    picks = features.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= tried).groupBy("tree", "node", "n").agg(F.collect_list("feature").alias("picks"))
    here = rows.join(F.broadcast(picks), ["tree", "node"])  # one row per open node
    values = here.select("tree", "node", "n", "label", "v", F.explode("picks").alias("feature")).withColumn("x", F.expr("v[feature]")).drop("v")
    ranges = values.groupBy("tree", "node", "feature").agg(F.min("x").alias("low"), F.max("x").alias("high")).filter("low < high")
    u = uniform(drawn(seed, "c", F.col("tree"), F.col("node"), F.col("feature")))
    cuts = materialize(ranges.select("tree", "node", "feature", (F.col("low") + u * (F.col("high") - F.col("low"))).alias("cut")), "forest-cuts")
    sides = (values.join(F.broadcast(cuts), ["tree", "node", "feature"])
             .groupBy("tree", "node", "feature", "cut", "n", (F.col("x") > F.col("cut")).alias("right"), "label").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("tree", "node", "feature", "cut", "n", "right").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("squares")))
    whole = rows.groupBy("tree", "node", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("tree", "node").agg(F.sum(F.col("c") * F.col("c")).alias("all_squares"))
    part = lambda right: F.max(F.when(F.col("right") == right, F.col("squares").cast("double") / F.col("m")))
    scored = sides.groupBy("tree", "node", "feature", "cut", "n").agg(part(False).alias("l"), part(True).alias("r")).filter("l is not null and r is not null")
    # rows times the fall of the Gini impurity
    gain = (F.col("l") + F.col("r")) - F.col("all_squares").cast("double") / F.col("n")
    scored = scored.join(whole, ["tree", "node"]).withColumn("gain", gain)
    best = scored.groupBy("tree", "node").agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), "cut", "n")).alias("b"))
    return best.select("tree", "node", F.lit(depth).alias("depth"), (-F.col("b.f")).alias("feature"), "b.cut", "b.gain", "b.n")


def grow(df: DataFrame, vector_col: str, label_col: str, trees: int = 10, depth: int = 6, tried: int | None = None, min_rows: int = 2, seed: int = SEED) -> DataFrame:
    """(tree, node, depth, feature, cut, gain, n): the inner nodes. The root is node 1, the
    children of a node are 2 * node (x <= cut) and 2 * node + 1."""
    data = materialize(usable(df, vector_col, label_col), "forest-rows")
    n_features = data.agg(F.min(F.size("v"))).first()[0] or 0  # features that all rows have
    empty = df.sparkSession.createDataFrame([], SPLITS)
    if not n_features:
        return empty
    tried = tried or max(1, int(n_features**0.5))
    rows = data.select("v", "label", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(1).cast("long"))
    levels: list[DataFrame] = []
    for d in range(depth):
        level = materialize(_level(rows, n_features, tried, seed, d, min_rows), "forest-level")
        if level.isEmpty():
            break
        levels.append(level)
        below = F.broadcast(level.select("tree", "node", "feature", "cut"))
        rows = rows.join(below, ["tree", "node"]).select(
            "v", "label", "tree", (F.col("node") * 2 + F.when(F.expr("v[feature]") > F.col("cut"), 1).otherwise(0)).alias("node"))  # leaves drop out
    return reduce(DataFrame.unionByName, levels, empty)


def importances(splits: DataFrame, n_features: int) -> DataFrame:
    """(feature, importance): each tree's falls of impurity as shares of its sum, averaged over the trees that split."""
    share = splits.groupBy("tree", "feature").agg(F.sum("gain").alias("g"))
    total = splits.groupBy("tree").agg(F.sum("gain").alias("t")).filter("t > 0")
    trees = total.count()
    found = share.join(total, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    every = splits.sparkSession.range(n_features).select(F.col("id").cast("int").alias("feature"))
    return every.join(found, "feature", "left").select("feature", F.coalesce(F.col("s") / max(trees, 1), F.lit(0.0)).alias("importance"))


def predict(df: DataFrame, splits: DataFrame, train: DataFrame, id_col: str, vector_col: str, label_col: str, depth: int = 6) -> DataFrame:
    """(id, prediction): each tree's leaf gives the class shares of its training rows; the largest mean wins, ties to the smaller label."""
    trees = [r.tree for r in splits.select("tree").distinct().collect()]

    def leaves(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in trees or [0]]))).withColumn("node", F.lit(1).cast("long"))
        for d in range(depth):
            level = F.broadcast(splits.filter(F.col("depth") == d).select("tree", "node", "feature", "cut"))
            rows = rows.join(level, ["tree", "node"], "left").withColumn("node", F.when(F.col("cut").isNull(), F.col("node")).otherwise(
                F.col("node") * 2 + F.when(F.expr("v[feature]") > F.col("cut"), 1).otherwise(0))).drop("feature", "cut")
        return rows
    shares = leaves(usable(train, vector_col, label_col)).groupBy("tree", "node", "label").agg(F.count(F.lit(1)).alias("c"))
    shares = materialize(shares.withColumn("share", F.col("c") / F.sum("c").over(Window.partitionBy("tree", "node"))).drop("c"), "forest-leaves")
    asked = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("v is not null")
    votes = leaves(asked).select("id", "tree", "node").join(F.broadcast(shares), ["tree", "node"]).groupBy("id", "label").agg(F.round(F.sum("share"), 9).alias("s"))  # leaves x classes
    return votes.groupBy("id").agg(F.max(F.struct("s", (-F.col("label")).alias("l"))).alias("b")).select("id", (-F.col("b.l")).alias("prediction"))
