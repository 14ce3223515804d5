"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): its smallest node within reach.

    In a round every node points to its smallest neighbour or itself, chains
    of pointers are shortened until they end at roots, and the links between
    different roots are the next round's graph. Each step is a stored table;
    the driver sees counts only.
    """
    edges = stored(links.select("a", "b").filter("a != b").distinct(), "links")
    reached = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "pointers")
        while True:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            shorter = stored(step.join(up, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "pointers")
            step = shorter.select("node", "root")
            if shorter.filter("moved").isEmpty():
                break
        if reached is None:
            reached = step
        else:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            reached = stored(reached.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "reached")
        edges = stored(edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                       .join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                       .filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return reached
