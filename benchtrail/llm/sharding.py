"""Contiguous shards of equal byte size.

Rows are laid out by (id, size, checksum) over range partitions; every
partition gives one total, the prefix sums of these totals place each
partition on the global byte axis, a running sum inside the partition places
each row, and the axis is cut at equal targets. Equal rows are counted (per
input partition) before the layout and expanded after it, so a key that is
repeated in a third of all rows still spreads over partitions. DataFrame
functions only.

Defined results: a null text counts as empty; a null id sorts first; repeated
rows get slots of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, stored

ROW_OVERHEAD = 8
ORDER = ["id", "size", "crc", "salt"]


def row_sizes(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    """Slim rows (id, size, crc, salt, copies); the salt is the input partition.

    Rows that differ in the salt only are interchangeable, so the result does
    not depend on how the input was split.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                        F.crc32(F.encode(text, "utf-8")).alias("crc"), F.spark_partition_id().alias("salt"))
            .groupBy(*ORDER).agg(F.count(F.lit(1)).alias("copies")))


def byte_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                overhead: int = ROW_OVERHEAD) -> DataFrame:
    """(id, size, crc, shard, slot) per document.

    A document goes to the shard in whose equal part of the byte axis its
    middle byte lies, so a shard is off its target by at most half a document
    at either end. Slots count from 0 in layout order.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored once: the totals and the rows below must see the same partitions
    laid = stored(row_sizes(docs, id_col, text_col, overhead).repartitionByRange(parts, *ORDER)
                  .withColumn("part", F.spark_partition_id()), "shards-laid")
    totals = laid.groupBy("part").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
    # one row per range partition: as many as the shuffle setting says, whatever the input
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("byte0", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
               .withColumn("row0", F.coalesce(F.sum("rows").over(before), F.lit(0)))
               .withColumn("total", F.sum("bytes").over(Window.partitionBy())).select("part", "byte0", "row0", "total"))
    inside = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    placed = (laid.withColumn("b", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
              .withColumn("r", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
              .join(F.broadcast(offsets), "part")
              .select("id", "size", "crc", "total", (F.col("byte0") + F.col("b")).alias("b"), (F.col("row0") + F.col("r")).alias("r"),
                      F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy")))
    rows = stored(placed.select(
        "id", "size", "crc", (F.col("r") + F.col("copy")).alias("row"),
        F.expr(f"cast(((2 * (b + copy * size) + size) * {n_shards}) div (2 * total) as int)").alias("shard")), "shards-rows")
    first = rows.groupBy("shard").agg(F.min("row").alias("row0"))  # n_shards rows
    return (rows.join(F.broadcast(first), "shard")
            .select("id", "size", "crc", "shard", (F.col("row") - F.col("row0")).alias("slot")))


def op8_byte_prefix_shards(spark, sf_dir):
    out = byte_shards(documents(spark, sf_dir), 24)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
