"""Nearest neighbours by collision counting on single projections.

Vectors lie in blocks, those of a block in bands of similar length. In a band
they are lifted so that the largest inner product is the smallest distance
(one more component makes all lengths equal). Every band is indexed by at most
``PROJECTIONS`` random lines at right angles: one sorted array of projections
per line. A query opens a window around its own projection on every line;
virtual rehashing widens all windows by a factor at a time, so only the
entries new to a window are read. A vector that lies in the windows of more
than a share of the lines is verified by its exact inner product.

How far windows reach decides when a band is done: it is when everything
nearer than the k-th found so far has been verified. With ``recall`` that
holds for each vector with this probability over the lines: the place of a
vector on them is that of a random direction, whose collisions are simulated.
With ``recall=None`` it holds for certain: a vector that misses j of the
windows of half width w is farther than w * sqrt(j), as the lines are at right
angles. Bands come longest first; a query ends when the longest vector of the
next one is shorter than its k-th inner product. No number of verified
vectors ends a search, and the widest windows hold the whole band.

Queries meet every block of vectors, in blocks of their own; no pair is
shuffled but the nearest of a query in a block. The best of each block are merged.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; a repeated id counts once, with the smallest of its
vectors; vectors of different lengths are never compared; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.llm.common import stored

NEIGHBOURS = 20
PROJECTIONS = 64
#: probability that a nearest vector is verified, share of lines that must collide
RECALL, COLLISIONS = 0.95, 0.7
#: half widths of the windows; vectors of length 1 are at most 2 apart
RATIO = 1.15
WIDTHS = np.append(2 * RATIO ** -np.arange(32.0)[::-1], np.inf)
#: a band's shortest vector has this share of its longest one's length, unless it holds fewer rows
BAND, BAND_ROWS = 0.8, 1_024
BLOCK, QUERY_BLOCK = 32_768, 8_192
SEED, TRIALS = 20, 8_192


def lines_for(dim: int, recall: float | None) -> tuple[np.ndarray, int, float]:
    """Lines at right angles, collisions needed, and the distance per half width
    of the windows within which vectors are verified (see above)."""
    rng = np.random.default_rng(SEED)
    m = min(PROJECTIONS, dim)
    need = int(np.ceil(COLLISIONS * m))
    lines = np.linalg.qr(rng.standard_normal((dim, m)))[0].T
    if recall is None:
        return lines, need, float(np.sqrt(m - need + 1))
    x = rng.standard_normal((TRIALS, m))
    beyond = rng.chisquare(dim - m, TRIALS) if dim > m else 0.0  # of the components on no line
    nth = np.partition(np.abs(x), need - 1, axis=1)[:, need - 1] / np.sqrt((x**2).sum(axis=1) + beyond)
    return lines, need, float(1 / np.quantile(nth, recall))


def of_length_one(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
    return scaled / np.sqrt((scaled**2).sum(axis=1))[:, None]


class Band:
    """Sorted projections of vectors of similar length."""

    def __init__(self, first: int, unit: np.ndarray, lines: np.ndarray, need: int, reach: float):
        self.first, self.unit, self.need, self.reach = first, unit, need, reach
        squares = (unit**2).sum(axis=1)
        self.longest = max(float(np.sqrt(squares.max())), np.finfo(float).tiny)
        lift = np.sqrt(np.maximum(0, 1 - squares / self.longest**2))
        along = (lines[:, :-1] / self.longest) @ unit.T + lines[:, -1:] * lift
        self.order = along.argsort(axis=1).astype(np.int32)
        self.sorted = np.take_along_axis(along, self.order, axis=1)

    def places(self, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows around each query begin and end: line, query, window."""
        ends = [(np.searchsorted(s, c[:, None] - WIDTHS), np.searchsorted(s, c[:, None] + WIDTHS, "right")) for s, c in zip(self.sorted, centre.T)]
        return tuple(np.stack(side) for side in zip(*ends))

    def search(self, query: np.ndarray, centre: np.ndarray, left: np.ndarray, right: np.ndarray, k: int, best: np.ndarray,
               skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and products of the vectors verified. ``best`` holds the k
        highest products so far, lowest first; ``skip`` the query's own places."""
        n = len(self.unit)
        count, tried = np.zeros(n, np.int64), np.zeros(n, bool)
        tried[skip] = True
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        r = int(np.argmax((right - left).sum(axis=0) >= self.need))  # narrower windows verify nothing
        lo, hi, width = left[:, r].tolist(), right[:, r].tolist(), WIDTHS[r]
        new = [o[a:b] for o, a, b in zip(self.order, lo, hi)]
        while True:
            count += np.bincount(np.concatenate(new), minlength=n)
            fresh = np.flatnonzero((count >= self.need) & ~tried)
            if len(fresh):
                tried[fresh] = True
                found.append(fresh)
                scores.append(self.unit[fresh] @ query)
                best = np.sort(np.append(best, scores[-1]))[-k:]
            # lifted vectors have length 1: their squared distance is 2 - 2 cos
            wanted = np.inf
            if len(best) == k:
                wanted = np.sqrt(max(0.0, 2 - 2 * best[0] / self.longest)) / self.reach * (1 + 1e-9)
            if wanted <= width or width == np.inf:
                break
            r += 1
            if wanted < WIDTHS[r]:  # no wider than needed
                width = wanted
                wider = ([int(np.searchsorted(s, c - width)) for s, c in zip(self.sorted, centre)],
                         [int(np.searchsorted(s, c + width, "right")) for s, c in zip(self.sorted, centre)])
            else:
                width = WIDTHS[r]
                wider = left[:, r].tolist(), right[:, r].tolist()
            new = [x for o, a, b, c, d in zip(self.order, wider[0], lo, hi, wider[1]) for x in (o[a:b], o[c:d])]
            lo, hi = wider
        return np.concatenate(found), np.concatenate(scores)


class Block:
    """Some vectors in bands, the longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, recall: float | None = RECALL):
        unit = vectors / np.abs(vectors).max()
        length = np.sqrt((unit**2).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        length, unit = length[order] / length.max(), unit[order] / length.max()
        self.ids, self.vectors = ids[order], vectors[order]
        self.lines, need, reach = lines_for(vectors.shape[1] + 1, recall)
        self.bands, at = [], 0
        while at < len(ids):
            end = max(int(np.searchsorted(-length, -BAND * length[at], "right")), at + BAND_ROWS)
            self.bands.append(Band(at, unit[at:end], self.lines, need, reach))
            at = end
        self.verified = 0  # vectors whose product was computed

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        """(query id, ids, inner products) of the nearest found, best first."""
        for at in range(0, len(queries), 256):
            unit = of_length_one(queries[at:at + 256])
            centre = unit @ self.lines[:, :-1].T
            places = {}
            for q, query_id in enumerate(query_ids[at:at + 256]):
                found, scores, best = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
                own = np.flatnonzero(self.ids == query_id)
                for b, band in enumerate(self.bands):
                    if len(best) == k and best[0] > band.longest * (1 + 1e-9):
                        break  # no product of this band or a later one is larger than the length
                    if b not in places:
                        places[b] = band.places(centre)
                    left, right = places[b]
                    inside = own[(own >= band.first) & (own < band.first + len(band.unit))] - band.first
                    more, products = band.search(unit[q], centre[q], left[:, q], right[:, q], k, best, inside)
                    found, scores = np.append(found, more + band.first), np.append(scores, products)
                    best = np.sort(scores)[-k:]
                self.verified += len(found)
                if len(found) > k:  # products of unit vectors order well enough to leave the rest out
                    found = found[scores >= best[0] - 1e-9]
                exact = (self.vectors[found] * queries[at + q]).sum(axis=1)
                top = np.lexsort((self.ids[found], -exact))[:k]
                yield query_id, self.ids[found[top]], exact[top]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: array of doubles, dim): one row per id of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def nearest(vectors: DataFrame, is_query, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding",
            recall: float | None = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (a condition
    on ``id``) picks, its nearest by inner product among all other rows. Each is
    found with probability ``recall``, or for certain if that is None."""
    rows = stored(usable(vectors, id_col, vector_col), "collision-rows")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks = max(1, -(-sizes.n // BLOCK))
    # few blocks meet more parts of the queries, so that every core has one
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    query_blocks = max(1, -(-sizes.q // QUERY_BLOCK), min(-(-2 * cores // blocks), -(-sizes.q // 64)))
    place = F.xxhash64("id")
    data = rows.select("id", "v", "dim", F.pmod(place, F.lit(blocks)).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"))
    queries = rows.filter(is_query).select("id", "v", "dim", F.pmod(place, F.lit(query_blocks)).cast("int").alias("part"),
                                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(queries):
            index = Block(data["id"].to_numpy(), np.stack(data["v"].to_numpy()), recall)
            for query_id, ids, scores in index.search(queries["id"].to_numpy(), np.stack(queries["v"].to_numpy()), k):
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["dim", "block", "part"]
    near = data.groupBy(keys).cogroup(queries.groupBy(keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")  # blocks * k rows per query
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_collision_counting(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)
