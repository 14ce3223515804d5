"""Ordering helpers that stay distributed.

``dense_index`` gives every row its 0-based position in a total order without
a window over one partition: the rows are range-partitioned, sorted inside the
partitions and written once. Offsets (one row per partition) and local
positions both come from that one table, so they always fit each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.session import materialize


def _before(parts: DataFrame, size: str, out: str) -> DataFrame:
    """(_part, out): the sum of ``size`` over earlier partitions; one row per partition."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", F.coalesce(F.sum(size).over(w), F.lit(0)).alias(out))


def dense_index(df: DataFrame, order_col, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """Position of each row of ``df`` in the order of ``order_col`` (a column
    name or a list of names). Rows that tie are ordered by a hash of the whole
    row, so a value that most rows share still spreads over partitions."""
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns))
    # the id counts the rows of a partition in its lower 33 bits
    laid = materialize(keyed.repartitionByRange(n, *cols, "_tie").sortWithinPartitions(*cols, "_tie")
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "positions")
    offsets = _before(laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_n", "_off")
    return (laid.join(F.broadcast(offsets), "_part")  # as many rows as partitions
                .select(*df.columns, (F.col("_off") + F.col("_local")).cast("bigint").alias(out)))


def group_median(df: DataFrame, keys, value: str, out: str = "median", partitions: int | None = None) -> DataFrame:
    """Exact median of ``value`` per group (the mean of the two middle values
    for an even count, as ``percentile(0.5)``) without holding a group in
    one task.

    Equal values are counted first, so a value repeated in most rows is one
    row. The distinct values get the running count before them in (keys,
    value) order over range partitions; a group's middle ranks then lie in at
    most two of its values.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    counted = (df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
                 .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    laid = materialize(counted.repartitionByRange(n, *keys, "_v").withColumn("_part", F.spark_partition_id()), "median")
    offsets = _before(laid.groupBy("_part").agg(F.sum("_c").alias("_n")), "_n", "_off")
    inside = Window.partitionBy("_part").orderBy(*keys, "_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = (laid.withColumn("_in", F.coalesce(F.sum("_c").over(inside), F.lit(0))).join(F.broadcast(offsets), "_part")
                  .withColumn("_from", F.col("_off") + F.col("_in")))
    groups = placed.groupBy(*keys).agg(F.min("_from").alias("_s"), F.sum("_c").alias("_n"))
    low = F.col("_s") + F.expr("(_n - 1) div 2")
    high = F.col("_s") + F.expr("_n div 2")
    held = placed.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_v", "_from", "_c")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    holds = lambda rank: (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_c"))
    return (held.join(groups, on).groupBy(*keys)
                .agg(F.max(F.when(holds(low), F.col("_v"))).alias("_a"), F.max(F.when(holds(high), F.col("_v"))).alias("_b"))
                .select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(out)))
