"""Running (prefix) aggregates over ordered lines that stay parallel inside
one very large file.

A window ``partition by file order by line_no`` puts a whole file in one task.
Here every file is cut into chunks of ``chunk`` consecutive lines. One
exchange by (file, chunk) serves the window inside the chunk and the join with
the carry, which comes from the chunk table: one row per chunk with its total,
summed up over the earlier chunks.

The chunks are dealt over as many tasks as hold ``TASK_ROWS`` rows each, so what
a task sorts does not grow with the input.

The input is read three times (row count, chunk totals, rows): pass a stored table, not a plan
that parses text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 16
#: rows that a task sorts at a time, about; a chunk is not cut
TASK_ROWS = 500_000


def _chunked(df: DataFrame, part: list[str], order: str, chunk: int) -> tuple[DataFrame, Window, Window]:
    """(rows with their chunk, window over earlier chunks, window inside the chunk)."""
    d = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    earlier = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return d, earlier, Window.partitionBy(*part, "_chunk").orderBy(order)


def _dealt(d: DataFrame, part: list[str]) -> DataFrame:
    """Rows with their chunk, chunk by chunk over tasks of about ``TASK_ROWS`` rows; few rows are left to the planner."""
    tasks = -(-d.count() // TASK_ROWS)
    return d.repartition(tasks, *part, "_chunk") if tasks > d.sparkSession.sparkContext.defaultParallelism else d


def running_max(df: DataFrame, part: Sequence[str], order: str, value: Column, out: str,
                chunk: int = DEFAULT_CHUNK, inclusive: bool = True) -> DataFrame:
    """``out`` = max(value) over rows of the same ``part`` whose ``order`` is
    <= this row's (nulls ignored; null before the first non-null); with
    ``inclusive=False`` over the rows strictly before it.

    ``order`` must be an integral position (a line number), unique within
    ``part``. ``value`` may be a struct: the max of ``struct(line_no, name)``
    carries the latest header's name forward.
    """
    part = list(part)
    d, earlier, inside = _chunked(df.withColumn("_v", value), part, order, chunk)
    totals = d.groupBy(*part, "_chunk").agg(F.max("_v").alias("_t"))
    carry = totals.select(*part, "_chunk", F.max("_t").over(earlier).alias("_carry"))
    here = F.max("_v").over(inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    j = _dealt(d, part).withColumn("_here", here).join(carry, [*part, "_chunk"], "left")
    both = (F.when(F.col("_carry").isNull(), F.col("_here")).when(F.col("_here").isNull(), F.col("_carry"))
             .otherwise(F.greatest("_here", "_carry")))
    return j.withColumn(out, both).drop("_v", "_chunk", "_here", "_carry")


def previous_max(df: DataFrame, part: Sequence[str], order: str, value: Column, out: str,
                 chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``running_max`` over the rows strictly before this one."""
    return running_max(df, part, order, value, out, chunk, inclusive=False)


def running_count(df: DataFrame, part: Sequence[str], order: str, flag: Column, out: str,
                  chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``out`` = number of rows of the same ``part`` with ``flag`` true and
    ``order`` <= this row's."""
    part = list(part)
    d, earlier, inside = _chunked(df.withColumn("_f", F.when(flag, 1).otherwise(0)), part, order, chunk)
    totals = d.groupBy(*part, "_chunk").agg(F.sum("_f").alias("_t"))
    carry = totals.select(*part, "_chunk", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_carry"))
    here = F.sum("_f").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (_dealt(d, part).withColumn("_here", here).join(carry, [*part, "_chunk"], "left")
             .withColumn(out, (F.col("_carry") + F.col("_here")).cast("bigint")).drop("_f", "_chunk", "_here", "_carry"))
