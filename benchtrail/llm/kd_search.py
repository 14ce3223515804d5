"""Exact top-k search by inner product with KD-trees per shard.

A tree over a bounded sample cuts space into cells; a cell's rows are cut into
shards of bounded size. Each shard has a KD-tree of its own: median splits in
the widest dimension, and every node keeps the tight box of its vectors. The
largest inner product of a query with a box is a sum of one product per
dimension, an upper bound for all vectors inside. A query visits nodes best
bound first and ends when the best bound left is below its k-th score.

The k-th score is propagated: a query first searches its home cell, the one
whose box has the best bound. It then goes only to cells whose bound reaches the k-th
score found there, and starts in each shard with that score.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part (a zero vector does); a repeated id
counts once, with the smallest of its vectors; shorter vectors count as
padded with zeros; scaled components and scores are held to the range of long; ties go
to the smaller id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import stored
from benchtrail.llm.vectors import cell_count, first, for_products, held, integer_rows, matrix, meet, sample, without_dominated

TOP, SCALE, LEAF = 10, 1024, 128
FOUND = "query_id long, vec_id long, score long"


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(query, box): the largest inner product of the query with a point of the box."""
    zero = queries * 0
    return held(np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T)


class Tree:
    """KD-tree over vectors; ``leaf_of`` of a tree of a sample places any vector."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order, self.nodes, todo = np.arange(len(points)), [], [(0, len(points), -1)]
        low, high = [], []
        while todo:  # a node: [first point, end, dimension, split value, left, right]
            start, stop, parent = todo.pop()
            inside = points[self.order[start:stop]]
            low.append(inside.min(axis=0))
            high.append(inside.max(axis=0))
            node, here = [start, stop, -1, 0, -1, -1], len(self.nodes)
            self.nodes.append(node)
            if parent >= 0:
                self.nodes[parent][4 if start == self.nodes[parent][0] else 5] = here
            spread = high[-1].astype(float) - low[-1].astype(float)
            axis = int(spread.argmax())
            if stop - start <= leaf or spread[axis] <= 0:
                continue
            along = inside[:, axis]
            value = np.partition(along, len(along) // 2)[len(along) // 2]
            left = along < value
            if not left.any():  # the median is the smallest value: it goes left
                left = along <= value
                value = along[~left].min()
            node[2:4] = axis, value
            cut = start + int(left.sum())
            self.order[start:stop] = np.concatenate([self.order[start:stop][left], self.order[start:stop][~left]])
            todo += [(cut, stop, here), (start, cut, here)]
        self.low, self.high = np.array(low), np.array(high)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """Number of the leaf that each point falls into."""
        leaves = {n: i for i, n in enumerate(i for i, node in enumerate(self.nodes) if node[2] < 0)}
        out, todo = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while todo:
            n, rows = todo.pop()
            _, _, axis, value, left, right = self.nodes[n]
            if axis < 0:
                out[rows] = leaves[n]
                continue
            goes = points[rows, axis] < value
            todo += [(left, rows[goes]), (right, rows[~goes])]
        return out


class Shard:
    """The vectors of one shard with their tree."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.tree = Tree(points, LEAF)
        self.ids, self.points = ids[self.tree.order], points[self.tree.order]
        self.scored = 0  # vectors whose product was computed

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: list, k: int) -> Iterator[tuple[int, list]]:
        """(query id, [(score, id)]) with all that can be among the k best, given that k others reach the floor."""
        points, queries = for_products(self.points, queries)
        low, high = self.tree.low.astype(points.dtype), self.tree.high.astype(points.dtype)
        nodes = self.tree.nodes
        for at in range(0, len(queries), 512):
            limits = bounds(queries[at:at + 512], low, high)
            for query_id, query, limit, floor in zip(query_ids[at:], queries[at:at + 512], limits, floors[at:]):
                limit = limit.tolist()
                best, kth = [], floor  # heap of (score, -id), the worst on top
                heap = [(-limit[0], 0)]
                while heap:
                    bound, n = heapq.heappop(heap)
                    if kth is not None and -bound < kth:
                        break
                    start, stop, axis, _, left, right = nodes[n]
                    if axis >= 0:
                        for child in (left, right):
                            if kth is None or limit[child] >= kth:
                                heapq.heappush(heap, (-limit[child], child))
                        continue
                    scores = held(points[start:stop] @ query)
                    self.scored += stop - start
                    take = np.arange(stop - start) if kth is None else np.flatnonzero(scores >= kth)
                    for s, i in zip(scores[take].tolist(), self.ids[start:stop][take].tolist()):
                        if i == query_id:
                            continue
                        if len(best) < k:
                            heapq.heappush(best, (s, -i))
                        elif (s, -i) > best[0]:
                            heapq.heapreplace(best, (s, -i))
                    if len(best) == k and (kth is None or best[0][0] > kth):
                        kth = best[0][0]
                yield query_id, [(s, -i) for s, i in best]


def _searcher(k: int, dim: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            shard = Shard(rows["id"].to_numpy(), matrix(rows["v"], dim))
            floors = [None if pd.isna(f) else int(f) for f in queries["floor"].astype(object)]
            for query_id, best in shard.search(queries["id"].to_numpy(), matrix(queries["v"], dim), floors, k):
                out += [(query_id, i, int(s)) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return search


def _router(k: int, dim: int, cells: np.ndarray, low: np.ndarray, high: np.ndarray, home: bool):
    """Sends a query to its home cell, or to the others that its floor can't exclude."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            queries, boxes = for_products(matrix(rows["v"], dim), np.concatenate([low, high]))
            limit = bounds(queries, boxes[:len(low)], boxes[len(low):])
            best = limit.argmax(axis=1)
            out = []
            for i, (query_id, v) in enumerate(zip(rows["id"], rows["v"])):
                if home:
                    out.append((query_id, v, int(cells[best[i]]), None))
                    continue
                floor = rows["floor"].iat[i]
                floor = None if pd.isna(floor) else int(floor)
                out += [(query_id, v, int(cells[c]), floor) for c in range(len(cells)) if c != best[i] and (floor is None or limit[i, c] >= floor)]
            yield pd.DataFrame(out, columns=["id", "v", "cell", "floor"]).astype({"floor": "Int64"})
    return route


def nearest(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (a condition
    on ``id``) picks, the k highest integer inner products among all other rows."""
    spark = vectors.sparkSession
    rows = stored(integer_rows(vectors, scale, id_col, vector_col), "kd-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("queries"), F.max(F.size("v")).alias("dim")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not size.queries:
        return empty
    dim = max(size.dim, 1)
    shape = sample(rows, dim)
    top = Tree(shape, max(1, len(shape) // cell_count(spark, size.n)))

    def place(batches):
        for b in batches:
            b["cell"] = top.leaf_of(matrix(b["v"], dim)).astype("int32")
            yield b[["cell", "id", "v"]]

    placed = stored(without_dominated(rows, k).mapInPandas(place, "cell int, id long, v array<bigint>"), "kd-cells")
    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}  # cells of a bounded tree
    sides = (placed.select("cell", F.posexplode("v")).groupBy("cell", "pos").agg(F.min("col").alias("low"), F.max("col").alias("high"), F.count(F.lit(1)).alias("n")))
    cells = np.array(sorted(sizes))
    low, high = np.zeros((len(cells), dim), np.int64), np.zeros((len(cells), dim), np.int64)
    for r in sides.collect():  # cells x dimensions
        c = int(np.searchsorted(cells, r.cell))
        padded = r.n < sizes[r.cell]
        low[c, r.pos], high[c, r.pos] = min(r.low, 0) if padded else r.low, max(r.high, 0) if padded else r.high

    sent = "id long, v array<bigint>, cell int, floor long"
    queries = rows.filter(is_query).select("id", "v")
    search = _searcher(k, dim)
    at_home = meet(placed, sizes, queries.mapInPandas(_router(k, dim, cells, low, high, True), sent), size.queries, search, FOUND)
    at_home = stored(first(at_home, ["query_id"], k).drop("rank"), "kd-home")
    floors = at_home.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor"))
    routed = queries.join(floors, "id", "left").mapInPandas(_router(k, dim, cells, low, high, False), sent)
    elsewhere = meet(placed, sizes, routed, size.queries, search, FOUND)
    return first(at_home.unionByName(elsewhere), ["query_id"], k).select("query_id", "rank", "vec_id", "score")


def op13_kd_search(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
