"""Queries against rows placed in cells, block by block.

Rows lie in cells by their position in space; a cell is cut by hash into
blocks of bounded size, and the queries sent to a cell are cut into parts. One
task holds one block and one part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: tasks of a meeting, at most
TASKS = 10_000


def meet(placed: DataFrame, sizes: dict[int, int], queries: DataFrame, n_queries: int, search: Callable, schema: str,
         block: int, query_block: int, id_col: str = "id", sent: dict[int, int] | None = None) -> DataFrame:
    """``search(rows, queries)`` (two pandas frames) of every block with the queries sent to its cell.

    ``placed`` has a column cell, ``queries`` one row per (query, cell to be
    searched). ``sizes`` has the number of rows of each cell; it is broadcast,
    so the number of cells must be bounded by the caller. ``sent`` has the number of queries sent to
    each cell: rows are then copied for as many parts as these need, else for those of all queries.
    """
    spark = placed.sparkSession
    parts = max(1, -(-n_queries // query_block))
    cut = [(c, -(-n // block), parts if sent is None else -(-sent.get(c, 0) // query_block)) for c, n in sizes.items()]
    cells = lambda: F.broadcast(spark.createDataFrame([x for x in cut if x[2]], "cell int, blocks int, parts int"))
    place = F.xxhash64(id_col)
    rows = (placed.join(cells(), "cell").withColumn("block", F.pmod(place, "blocks").cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    asked = (queries.join(cells(), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("part", F.pmod(place, F.col("parts")).cast("int")))
    keys = ["cell", "block", "part"]
    # about one block and one part a task: the planner would merge tasks by their bytes, and searching takes the time
    tasks = min(2 * parts * sum(-(-n // block) for n in sizes.values()), TASKS)
    return rows.repartition(max(1, tasks), *keys).groupBy(keys).cogroup(asked.repartition(max(1, tasks), *keys).groupBy(keys)).applyInPandas(search, schema)
