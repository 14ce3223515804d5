"""Hard-negative mining with angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. For an
anchor with angles b and a row with angles a to the same directions, the angle
between them lies between max |a - b| and min(a + b, 2 pi - a - b) by the triangle
inequality on the sphere; the cosines of that interval times both norms bound
their inner product. The bounds are widened for rounding and rounded outwards,
so they hold for the integer score. Only rows whose bounds overlap what is
looked for get an integer score.

Rows are placed in cells by their nearest reference; each cell has the
interval of its angles and norms, so an anchor goes only to cells that may
hold something for it. First the positives: the anchor's home cell gives a
k-th score that the other cells must reach. Then the negatives: each positive
asks for the best scores in a window between a share of its own score and that
score, and a row is scored only if its bounds reach into such a window.

Defined results: rows with a null label, null id, or a vector that is null or
holds null or non-finite components take no part; a zero vector scores 0 with all;
a repeated id counts once, with the smallest of its (label, vector); shorter
vectors count as padded with zeros; scaled components and scores are held to
the range of long; ties go to the smaller id; an anchor without a positive, or a positive
without a row in its window, gives no rows; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import stored
from benchtrail.llm.vectors import LONG, cell_count, first, for_products, held, integer_rows, matrix, meet, sample, without_dominated

POSITIVES, NEGATIVES, SCALE = 5, 5, 256
#: a negative's score lies between these percentages of its positive's
LOW, HIGH = 80, 100
REFERENCES, STEP = 16, 512
#: more than the error of an angle near 0 or pi, where arccos loses half the digits
SLACK = 1e-6


def directions(shape: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors: the first usable sampled row, then always the row farthest in angle from those chosen."""
    x = shape.astype(float)
    length = np.sqrt((x**2).sum(axis=1))
    unit = x[length > 0] / length[length > 0, None]
    if not len(unit):
        return np.eye(1, shape.shape[1])
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def polar(x: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references (a zero vector: right angles)."""
    x = x.astype(float)
    norm = np.sqrt((x**2).sum(axis=1))
    return norm, np.arccos(np.clip((x / np.where(norm > 0, norm, 1)[:, None]) @ references.T, -1, 1))


def score_bounds(norm: float, angles: np.ndarray, norms, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of an anchor with rows whose angles lie between
    ``low`` and ``high`` and whose norms lie in ``norms`` (least, largest)."""
    near = np.maximum(np.maximum(low - angles, angles - high), 0).max(axis=1) - SLACK
    far = np.minimum(high + angles, 2 * np.pi - (low + angles)).min(axis=1) + SLACK
    top, bottom = np.cos(np.clip(near, 0, np.pi)), np.cos(np.clip(far, 0, np.pi))
    least, largest = norms
    best = norm * np.where(top >= 0, largest, least) * top
    worst = norm * np.where(bottom >= 0, least, largest) * bottom
    slack = SLACK * norm * largest + SLACK
    return np.clip(np.floor(worst - slack), -LONG, LONG), np.clip(np.ceil(best + slack), -LONG, LONG)  # as doubles: 2**63 either way


class Block:
    """Rows of a block with their stored angles."""

    def __init__(self, rows: pd.DataFrame, dim: int):
        self.ids, self.labels, self.points = rows["id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["v"], dim)
        self.norms, self.angles = rows["norm"].to_numpy(), np.stack(rows["angles"].to_numpy())
        self.scored = 0  # rows that got an integer score

    def prepare(self, queries: np.ndarray) -> np.ndarray:
        self.exact, queries = for_products(self.points, queries)
        return queries

    def reach(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(norm, angles, (self.norms, self.norms), self.angles, self.angles)

    def scores(self, at: np.ndarray, query: np.ndarray) -> list[int]:
        self.scored += len(at)
        return [int(s) for s in held(self.exact[at] @ query).tolist()]

    def positives(self, own: int, label: int, query: np.ndarray, norm: float, angles: np.ndarray, floor: int | None, k: int) -> list[tuple]:
        """[(score, id)] with all rows of the label that can be among the k best, given that k others reach the floor."""
        _, most = self.reach(norm, angles)
        at = np.flatnonzero((self.labels == label) & (self.ids != own) & (most >= (-np.inf if floor is None else floor)))
        best = []
        for part, limit in in_steps(at, most):
            if len(best) == k and limit < best[-1][0]:
                break
            best += [(s, i) for s, i in zip(self.scores(part, query), self.ids[part].tolist()) if floor is None or s >= floor]
            best = sorted(best, key=lambda p: (-p[0], p[1]))[:k]
        return best

    def negatives(self, label: int, query: np.ndarray, norm: float, angles: np.ndarray, positives: list[int], k: int) -> list[list[tuple]]:
        """For each positive's score, the best [(score, id)] of other labels in its window."""
        least, most = self.reach(norm, angles)
        wanted = np.zeros(len(self.ids), bool)
        for p in positives:
            wanted |= (100 * most >= LOW * p) & (100 * least <= HIGH * p)
        found = [[] for _ in positives]
        for part, limit in in_steps(np.flatnonzero(wanted & (self.labels != label)), most):
            if all(len(f) == k and limit < f[-1][0] for f in found):
                break
            scored = list(zip(self.scores(part, query), self.ids[part].tolist()))
            for n, p in enumerate(positives):
                inside = [(s, i) for s, i in scored if LOW * p <= 100 * s <= HIGH * p]
                found[n] = sorted(found[n] + inside, key=lambda x: (-x[0], x[1]))[:k]
        return found


def in_steps(at: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """The rows by falling upper bound, some at a time, with the largest bound among them."""
    at = at[np.argsort(-most[at], kind="stable")]
    for i in range(0, len(at), STEP):
        yield at[i:i + STEP], most[at[i]]


class Cells:
    """Intervals of angles and norms of each cell."""

    def __init__(self, rows: list, references: int):
        self.cells = [r.cell for r in rows]
        self.low = np.array([[r[f"a{i}"] for i in range(references)] for r in rows])
        self.high = np.array([[r[f"b{i}"] for i in range(references)] for r in rows])
        self.norms = np.array([r.least for r in rows]), np.array([r.largest for r in rows])

    def reach(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(norm, angles, self.norms, self.low, self.high)


SENT = "id long, label long, v array<bigint>, norm double, angles array<double>, scores array<bigint>, cell int"


def _router(cells: Cells, which):
    """One row per (anchor, cell of ``which``): the positions in ``cells`` that the anchor goes to."""
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [(r.id, r.label, r.v, r.norm, r.angles, r.scores, cells.cells[c])
                   for r in rows.itertuples(index=False) for c in which(cells, r)]
            yield pd.DataFrame(out, columns=["id", "label", "v", "norm", "angles", "scores", "cell"])
    return route


def home(cells: Cells, r) -> list[int]:
    return [int(cells.reach(r.norm, r.angles)[1].argmax())]


def beyond_home(cells: Cells, r) -> list[int]:
    most = cells.reach(r.norm, r.angles)[1]
    floor = -np.inf if r.scores is None else r.scores[0]
    return [c for c in np.flatnonzero(most >= floor).tolist() if c != int(most.argmax())]


def into_windows(cells: Cells, r) -> list[int]:
    least, most = cells.reach(r.norm, r.angles)
    inside = np.zeros(len(least), bool)
    for p in r.scores.tolist():
        inside |= (100 * most >= LOW * p) & (100 * least <= HIGH * p)
    return np.flatnonzero(inside).tolist()


def _each(block: Block, queries: pd.DataFrame, dim: int):
    for r, query in zip(queries.itertuples(index=False), block.prepare(matrix(queries["v"], dim))):
        yield r, query


def _positives(dim: int, k: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            block = Block(rows, dim)
            for r, query in _each(block, queries, dim):
                floor = None if r.scores is None else int(r.scores[0])
                out += [(r.id, i, s) for s, i in block.positives(r.id, r.label, query, r.norm, r.angles, floor, k)]
        return pd.DataFrame(out, columns=["anchor_id", "vec_id", "score"]).astype("int64")
    return search


def _negatives(dim: int, k: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            block = Block(rows, dim)
            for r, query in _each(block, queries, dim):
                positives = r.scores.tolist()
                for p, found in zip(positives, block.negatives(r.label, query, r.norm, r.angles, positives, k)):
                    out += [(r.id, p, i, s) for s, i in found]
        return pd.DataFrame(out, columns=["anchor_id", "positive_score", "vec_id", "score"]).astype("int64")
    return search


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   scale: int = SCALE, references: int = REFERENCES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each of an anchor's best rows of its own label, the best rows of other
    labels that score within the window below it. ``is_anchor`` is a condition on ``id``,
    ``label`` an expression over the columns of ``vectors``."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors, scale, id_col, vector_col, label)
    rows = stored(rows, "angular-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors"), F.max(F.size("v")).alias("dim")).first()
    if not size.anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim = max(size.dim, 1)
    lines = directions(sample(rows, dim), max(references, min(cell_count(spark, size.n), 4 * references)))

    def place(batches):
        for b in batches:
            norm, angles = polar(matrix(b["v"], dim), lines)
            b["norm"], b["angles"], b["cell"] = norm, list(angles[:, :references]), angles.argmin(axis=1).astype("int32")
            yield b[["cell", "id", "label", "v", "norm", "angles"]]

    schema = "cell int, id long, label long, v array<bigint>, norm double, angles array<double>"
    anchors = rows.filter(is_anchor).mapInPandas(place, schema).drop("cell")
    placed = stored(without_dominated(rows, max(positives, negatives)).mapInPandas(place, schema), "angular-cells")
    stats = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("norm").alias("least"), F.max("norm").alias("largest"),
        *[f(F.col("angles")[i]).alias(f"{name}{i}") for i in range(min(references, len(lines))) for f, name in ((F.min, "a"), (F.max, "b"))]).collect()  # one row per reference
    cells, sizes = Cells(stats, min(references, len(lines))), {r.cell: r.n for r in stats}

    nothing = F.lit(None).cast("array<bigint>")
    found = "anchor_id long, vec_id long, score long"
    asked = anchors.withColumn("scores", nothing)
    at_home = stored(first(meet(placed, sizes, asked.mapInPandas(_router(cells, home), SENT), size.anchors, _positives(dim, positives), found),
                           ["anchor_id"], positives).drop("rank"), "angular-home")
    floors = at_home.groupBy(F.col("anchor_id").alias("id")).agg(F.when(F.count(F.lit(1)) == positives, F.array(F.min("score"))).alias("scores"))
    asked = anchors.join(floors, "id", "left").mapInPandas(_router(cells, beyond_home), SENT)
    elsewhere = meet(placed, sizes, asked, size.anchors, _positives(dim, positives), found)
    chosen = stored(first(at_home.unionByName(elsewhere), ["anchor_id"], positives).drop("rank"), "angular-positives")

    scores = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most ``positives``
    asked = anchors.join(scores, "id").mapInPandas(_router(cells, into_windows), SENT)
    inside = meet(placed, sizes, asked, size.anchors, _negatives(dim, negatives), "anchor_id long, positive_score long, vec_id long, score long")
    best = first(inside, ["anchor_id", "positive_score"], negatives)
    pairs = chosen.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (pairs.join(best, ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def op12_angular_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, changed)


OP12_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""
