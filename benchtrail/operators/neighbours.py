"""Exact k-nearest neighbours (M4) as a metric join, without all pairs.

Pivots cut space into cells: a row belongs to its nearest pivot and stores its
distance to it. A query first searches the cell of its own nearest pivot,
which bounds its k-th distance. By the triangle inequality a cell can hold
something nearer only if the query's distance to the pivot, the cell's least
and largest radius and the bisecting plane between two pivots allow it;
the query is compared with no other cell. Inside a cell only rows whose stored distance to the pivot
differs from the query's by no more than the k-th distance are compared.

Cells close to each other form an area of bounded size, a large cell some blocks of one. A query travels once to an
area, whatever cells of it are asked there, so what is moved grows with the areas and not with the cells; the task
finds out which cells of its area the query needs.

Rows with a null id, or a vector that is null or holds null or non-finite
components, take no part; ties go to the smaller id; a query with fewer than k
rows gets all of them. Vectors are compared in double precision; all have the
length of the longest, shorter ones count as padded with zeros.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.functions.blocks import meet
from benchtrail.session import materialize

#: rows of a block, queries that meet it at a time, at most; rows of a block that are not cut for the sake of more tasks
BLOCK, QUERY_BLOCK, LEAST = 32_768, 32_768, 512
#: pivots at most, sampled rows the pivots are picked from, queries routed at a time
PIVOTS, SAMPLE, ROUTED = 256, 4_096, 2_048
#: distances in double precision may differ by this share from what the triangle inequality says
SLACK = 1e-9
#: queries of a block compared together, pairs compared by differences at a time, pairs that products may leave at a time
TOGETHER, PAIRS, LEFT = 128, 100_000, 1_000_000
FOUND = "query_id long, id long, distance double, compared long"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Numbers of single precision stay so until they are compared: it is half to move."""
    v = F.col(vector_col)
    v = v if df.select(v).dtypes[0][1] == "array<float>" else v.cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(row of x, row of y): Euclidean distances, from differences and not from products, so equal rows are 0 apart."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in y], axis=1) if len(y) else np.zeros((len(x), 0))


def pick_pivots(shape: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: always the one farthest from those chosen."""
    chosen, nearest = [0], distances(shape, shape[:1])[:, 0]
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(shape, shape[chosen[-1:]])[:, 0])
    return shape[chosen]


class Cells:
    """Pivots with the number of rows and the radii of their cells, and the area of each cell."""

    def __init__(self, pivots: np.ndarray, rows: list, block: int):
        self.cells, self.n = np.array([r.pivot for r in rows]), np.array([r.n for r in rows])
        self.pivots = pivots[self.cells]
        self.near, self.far = np.array([r.near for r in rows]), np.array([r.far for r in rows])
        self.apart = distances(self.pivots, self.pivots)
        self.area = self._areas(block)

    def _areas(self, block: int) -> np.ndarray:
        """Areas of at most ``block`` rows: a cell with those nearest to it that are in none; a larger cell is one alone."""
        area, taken = np.full(len(self.n), -1), 0
        for seed in range(len(self.n)):
            if area[seed] < 0:
                room = block
                for c in np.argsort(self.apart[seed], kind="stable"):
                    if area[c] < 0 and (c == seed or self.n[c] <= room):
                        area[c], room = taken, room - self.n[c]
                taken += 1
        return area

    def sizes(self) -> dict[int, int]:
        return {a: int(self.n[self.area == a].sum()) for a in range(self.area.max() + 1)}

    def least(self, to: np.ndarray, home: np.ndarray, to_home: np.ndarray, which: slice | np.ndarray = slice(None)) -> np.ndarray:
        """(query, cell): least possible distance of each query to a row of the cells ``which``, from its distances to their pivots."""
        ring = np.maximum(np.maximum(to - self.far[which], self.near[which] - to), 0)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            plane = (to**2 - to_home[:, None] ** 2) / (2 * self.apart[home][:, which])
        plane[~np.isfinite(plane)] = 0
        # rows of a cell are no farther from their own pivot than from the query's
        return np.maximum(ring, plane)


def _router(cells: Cells, dim: int, home: bool):
    """Adds to each query its home and the areas it must go to: its own at first, later the others that may hold something nearer."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), ROUTED):
                rows = batch.iloc[first:first + ROUTED]
                to = distances(matrix(rows["v"], dim), cells.pivots)
                at, to_home = to.argmin(axis=1), to.min(axis=1)
                if home:
                    kth, areas = np.full(len(rows), np.nan), [cells.area[[a]] for a in at]
                else:
                    kth = rows["kth"].to_numpy(float)
                    reach = np.where(np.isnan(kth), np.inf, kth) + SLACK * (to.max(axis=1) + cells.far.max())
                    asked = cells.least(to, at, to_home) <= reach[:, None]
                    areas = [others[others != cells.area[a]] for a, others in zip(at, (np.unique(cells.area[row]) for row in asked))]
                yield pd.DataFrame({"id": rows["id"].to_numpy(), "v": rows["v"].to_numpy(), "home": at.astype("int32"), "to_home": to_home,
                                    "kth": pd.array(kth, dtype="Float64"), "areas": [a.astype("int32") for a in areas]})
    return route


def _nearer(x: np.ndarray, centred: np.ndarray, norms: np.ndarray, ids: np.ndarray, q: np.ndarray, lean: np.ndarray, lengths: np.ndarray,
            low: np.ndarray, high: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance), by query, distance and id, of the rows low to high of each query that may be among its k
    nearest, if they are no farther than ``kth``. Products (in single precision, from the pivot: ``centred``, ``lean``) leave
    out what is farther than their rounding allows; the rest is compared by differences."""
    first, last = int(low.min()), int(high.max())
    none = np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
    if first >= last:
        return none
    with np.errstate(over="ignore", invalid="ignore"):
        squares = lean @ centred[first:last].T
        squares *= -2
        squares += norms[first:last]
        error = 1.2e-7 * (x.shape[1] + 8) * (norms[first:last].max() + lengths) + SLACK * kth**2 + 1e-37
        limit = kth**2 + error - lengths
        keep = ~(squares > (limit + 1e-6 * np.abs(limit)).astype("float32")[:, None])
        left = np.count_nonzero(keep)
        if left > 64 * k * len(q) and last - first > k:  # only those near the k-th of this block
            at = np.arange(first, last)
            inside = (at >= low[:, None]) & (at < high[:, None])
            least = np.partition(np.where(inside, squares, np.inf), k - 1, axis=1)[:, k - 1]
            keep &= inside & ~(squares > (least + 2 * error)[:, None])
            left = np.count_nonzero(keep)
    if left > LEFT and len(q) > 1:  # many alike: some of the queries at a time
        half = len(q) // 2
        parts = [(n, _nearer(x, centred, norms, ids, q[n], lean[n], lengths[n], low[n], high[n], kth[n], k)) for n in (slice(0, half), slice(half, len(q)))]
        return tuple(np.concatenate([parts[0][1][i], parts[1][1][i] + (half if i == 0 else 0)]) for i in range(3))
    asked, found = np.nonzero(keep)
    found += first
    inside = (found >= low[asked]) & (found < high[asked])
    asked, found = asked[inside], found[inside]
    d = np.concatenate([np.sqrt(((x[found[i:i + PAIRS]] - q[asked[i:i + PAIRS]]) ** 2).sum(axis=1)) for i in range(0, len(found), PAIRS)] or [none[2]])
    order = np.lexsort((ids[found], d, asked))
    asked, found, d = asked[order], found[order], d[order]
    keep = np.arange(len(asked)) - np.searchsorted(asked, asked) < k
    return asked[keep], found[keep], d[keep]


class _Best:
    """The k nearest rows so far of some queries."""

    def __init__(self, n: int, k: int):
        self.d, self.ids, self.free = np.full((n, k), np.inf), np.zeros((n, k), dtype="int64"), np.ones((n, k), dtype=bool)

    def add(self, asked: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        """Rows by query, at most k of each."""
        if not len(asked):
            return
        some, at = np.unique(asked, return_inverse=True)
        place, k = np.arange(len(asked)) - np.searchsorted(asked, asked), self.d.shape[1]
        both = [np.concatenate([old[some], np.full((len(some), k), fill, dtype=old.dtype)], axis=1) for old, fill in ((self.d, np.inf), (self.ids, 0), (self.free, True))]
        for new, value in zip(both, (d, ids, False)):
            new[at, k + place] = value
        order = np.lexsort((both[1], both[2], both[0]), axis=-1)[:, :k]
        self.d[some], self.ids[some], self.free[some] = (np.take_along_axis(new, order, axis=1) for new in both)

    def kth(self) -> np.ndarray:
        return np.where(self.free[:, -1], np.inf, self.d[:, -1])


def _searcher(layout: Cells, dim: int, k: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            rows, queries = rows.sort_values(["pivot", "radius"]), queries.sort_values(["home", "to_home"])
            radius, ids, x = rows["radius"].to_numpy(), rows["id"].to_numpy(), matrix(rows["v"], dim)
            cells, starts = np.unique(rows["pivot"].to_numpy(), return_index=True)
            which, ends = np.searchsorted(layout.cells, cells), np.append(starts[1:], len(x))
            with np.errstate(over="ignore"):
                centred = [(x[a:b] - p).astype("float32") for a, b, p in zip(starts, ends, layout.pivots[which])]
                norms = [(radius[a:b] ** 2).astype("float32") for a, b in zip(starts, ends)]
            asked, home, to_home = queries["id"].to_numpy(), queries["home"].to_numpy(), queries["to_home"].to_numpy(float)
            q, known = matrix(queries["v"], dim), queries["kth"].to_numpy(float, na_value=np.nan)
            first = 0
            while first < len(q):
                last = min(first + TOGETHER, len(q))
                if np.isnan(known[first]):  # those of one home together
                    last = first + int(np.searchsorted(home[first:last], home[first], side="right"))
                some, first = slice(first, last), last
                v, bound, compared, best = q[some], np.where(np.isnan(known[some]), np.inf, known[some]), np.zeros(last - some.start, dtype="int64"), _Best(last - some.start, k)
                to = distances(v, layout.pivots[which])

                def ring(c, n, low, high, bound):
                    with np.errstate(over="ignore"):
                        lean, lengths = (v[n] - layout.pivots[which[c]]).astype("float32"), to[n, c] ** 2
                    compared[n] += high - low
                    a, b = starts[c], ends[c]
                    near, row, d = _nearer(x[a:b], centred[c], norms[c], ids[a:b], v[n], lean, lengths, low, high, bound, k)
                    return n[near], ids[a:b][row], d

                least, slack = layout.least(to, home[some], to_home[some], which), SLACK * (to + layout.far[which])
                own = np.flatnonzero(which == home[some.start])
                if np.isinf(bound).all() and len(own):
                    # the rows about as far from the pivot as the query bound the k-th distance
                    c, every = own[0], np.arange(len(v))
                    place, reach = np.searchsorted(radius[starts[c]:ends[c]], to[:, c]), max(4 * k, 64)
                    window = _Best(len(v), k)
                    window.add(*ring(c, every, np.maximum(place - reach, 0), np.minimum(place + reach, ends[c] - starts[c]), bound))
                    bound = window.kth()
                for c in np.argsort(least.mean(axis=0), kind="stable"):
                    n = np.flatnonzero(least[:, c] <= bound + slack[:, c])
                    if len(n):
                        own_radius, far = radius[starts[c]:ends[c]], bound[n] + slack[n, c]
                        best.add(*ring(c, n, np.searchsorted(own_radius, to[n, c] - far), np.searchsorted(own_radius, to[n, c] + far, side="right"), bound[n]))
                        bound = np.minimum(bound, best.kth())
                at, place = np.nonzero(~best.free & ~(best.d > known[some][:, None]))  # one that is known to have k nearer ones needs no others
                out.append((asked[some][at], best.ids[at, place], best.d[at, place], np.where(np.append(True, at[1:] != at[:-1])[:len(at)], compared[at], 0)))
        return pd.DataFrame({name: np.concatenate([part[i] for part in out]) if out else np.zeros(0, dtype=kind)
                             for i, (name, kind) in enumerate((("query_id", "int64"), ("id", "int64"), ("distance", "float64"), ("compared", "int64")))})
    return search


def nearest_rows(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "id", vector_col: str = "features") -> DataFrame:
    """(query_id, rank, id, distance, compared): the k rows of ``train`` nearest to
    each row of ``test``; ``compared``: how many distances the query took."""
    spark = train.sparkSession
    rows, asked = usable(train, id_col, vector_col), usable(test, id_col, vector_col)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    queries = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not size.n or not queries.n:
        return spark.createDataFrame([], "query_id long, rank int, id long, distance double, compared long")
    dim = max(size.dim, queries.dim, 1)
    shape = rows.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(SAMPLE).collect()  # the pivots' sample
    # small tables in smaller blocks, some for each core
    block = min(BLOCK, max(LEAST, -(-size.n // (2 * spark.sparkContext.defaultParallelism))))
    cells = max(-(-size.n // block), int(np.sqrt(size.n) / 4), 1)
    pivots = pick_pivots(matrix([r.v for r in shape], dim), min(cells, PIVOTS))
    kind = lambda df: dict(df.dtypes)["v"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            to = distances(matrix(b["v"], dim), pivots)
            b["pivot"], b["radius"] = to.argmin(axis=1).astype("int32"), to.min(axis=1)
            yield b[["pivot", "radius", "id", "v"]]

    placed = materialize(rows.mapInPandas(place, f"pivot int, radius double, id long, v {kind(rows)}"), "knn-cells")
    stats = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("near"), F.max("radius").alias("far")).orderBy("pivot").collect()  # one row per pivot
    layout = Cells(pivots, stats, block)
    areas = F.broadcast(spark.createDataFrame([(int(c), int(a)) for c, a in zip(layout.cells, layout.area)], "pivot int, cell int"))
    placed = placed.join(areas, "pivot")  # what meets is an area
    sent = f"id long, v {kind(asked)}, home int, to_home double, kth double, areas array<int>"
    search = _searcher(layout, dim, k)
    order = Window.partitionBy("query_id").orderBy("distance", "id")  # k rows of each block that a query went to
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def run(df: DataFrame, home: bool) -> DataFrame:
        routed = materialize(df.mapInPandas(_router(layout, dim, home), sent), "knn-asked").withColumn("cell", F.explode("areas")).drop("areas")
        to_each = {r.cell: r["count"] for r in routed.groupBy("cell").count().collect()}  # one row per area
        return meet(placed, layout.sizes(), routed, queries.n, search, FOUND, block, QUERY_BLOCK, "id", to_each)

    at_home = materialize(run(asked, True), "knn-home")
    kth = best(at_home).groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("kth"))
    elsewhere = run(asked.join(kth, "id", "left"), False)
    found = materialize(at_home.unionByName(elsewhere), "knn-found")
    compared = found.groupBy("query_id").agg(F.sum("compared").alias("compared"))
    return best(found.drop("compared")).join(compared, "query_id").select("query_id", "rank", "id", "distance", "compared")


def vote(neighbours: DataFrame, labels: DataFrame, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """(query_id, prediction): the most frequent label among a query's neighbours, ties to the smaller label."""
    counted = (neighbours.join(labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")), "id")
               .groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("n")))
    return counted.groupBy("query_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("b")).select("query_id", F.col("b.label").alias("prediction"))
