"""Searches over integer vectors against brute force, and their awkward cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from benchtrail.llm import angular_negatives as A
from benchtrail.llm import kd_search as K
from benchtrail.llm import vectors as V

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, cell string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, label, 7, "x", "y", "z") for i, e, label in rows], SCHEMA)


def clean(rows, scale, labelled=False):
    """{id: (label, vector of ints)} of the rows that take part."""
    out = {}
    for i, e, label in rows:
        if i is None or e is None or (labelled and label is None) or any(x is None or not math.isfinite(x) for x in e):
            continue
        row = ((label if labelled else 0), tuple(max(-2**63, min(2**63 - 1, math.floor(scale * x))) for x in e))
        out[i] = min(out.get(i, row), row)
    return out


def dot(a, b):
    return max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def brute_top(rows, every, k, scale):
    whole = clean(rows, scale)
    return {(q, n + 1, i, s) for q in whole if q % every == 0
            for n, (s, i) in enumerate(sorted(((dot(whole[q][1], v), i) for i, (_, v) in whole.items() if i != q), key=lambda p: (-p[0], p[1]))[:k])}


def brute_negatives(rows, every):
    whole, out = clean(rows, A.SCALE, True), set()
    for a in whole:
        if a % every:
            continue
        scored = sorted(((dot(whole[a][1], v), i) for i, (_, v) in whole.items() if i != a), key=lambda p: (-p[0], p[1]))
        for ps, p in [x for x in scored if whole[x[1]][0] == whole[a][0]][:5]:
            inside = [x for x in scored if whole[x[1]][0] != whole[a][0] and 80 * ps <= 100 * x[0] <= 100 * ps][:5]
            out |= {(a, p, n + 1, i, ps, s) for n, (s, i) in enumerate(inside)}
    return out


def gaussian(n=400, dim=12, seed=1):
    r = np.random.default_rng(seed)
    return [(i, r.normal(size=dim).tolist(), int(r.integers(0, 4))) for i in range(n)]


def clustered(n=600, dim=8, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, dim)) * 6
    return [(i, (centres[i % 9] + r.normal(size=dim) / 4).tolist(), i % 3) for i in range(n)]


def awkward():
    rows = gaussian(90, 4, 3)
    hot = [0.5, 0.25, -0.5, 1.0]
    rows += [(i, hot, 1) for i in range(100, 160)] + [(i, hot, 2) for i in range(160, 175)]  # a third of all rows, ties everywhere
    rows += [(200, None, 1), (210, [1.0, None, 0.0, 0.0], 1), (220, [float("nan"), 0.0, 0.0, 0.0], 1), (230, [float("inf"), 0.0, 0.0, 0.0], 1),
             (240, [0.0, 0.0, 0.0, 0.0], 1), (250, [1.0, 1.0], 2), (260, [], 1), (None, [1.0, 1.0, 1.0, 1.0], 1), (270, [1.0, 2.0, 3.0, 4.0], None),
             (280, [-0.0, -0.001, 0.001, 0.0], 3), (0, [9.0, 9.0, 9.0, 9.0], 1), (0, [9.0, 9.0, 9.0, 9.0], 1), (10, hot, 1)]
    return rows


def huge():
    return [(i, [x * 1e12 for x in v], label) for i, v, label in gaussian(40, 3, 4)] + [(50, [1e300, -1e300, 1.0], 1)]


@pytest.fixture(params=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(V, "BLOCK", 32)
        monkeypatch.setattr(V, "QUERY_BLOCK", 5)


@pytest.mark.parametrize("rows", [gaussian(), clustered(), awkward(), huge()], ids=["gaussian", "clustered", "awkward", "huge"])
def test_kd_search_equals_brute_force(spark, blocks, rows):
    got = K.nearest(table(spark, rows), F.col("id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == brute_top(rows, 10, K.TOP, K.SCALE) and len(got) == len(set(got))


@pytest.mark.parametrize("rows", [gaussian(), clustered(), awkward(), huge()], ids=["gaussian", "clustered", "awkward", "huge"])
def test_hard_negatives_equal_brute_force(spark, blocks, rows):
    got = A.hard_negatives(table(spark, rows), F.col("id") % 10 == 0, F.col("label")).collect()
    assert {tuple(r) for r in got} == brute_negatives(rows, 10) and len(got) == len(set(got))


def test_empty_and_tiny_tables(spark):
    none = table(spark, [])
    assert K.nearest(none, F.col("id") % 10 == 0).count() == 0 and A.hard_negatives(none, F.col("id") % 10 == 0, F.col("label")).count() == 0
    one = table(spark, [(0, [1.0], 1)])
    assert K.nearest(one, F.col("id") % 10 == 0).count() == 0 and A.hard_negatives(one, F.col("id") % 10 == 0, F.col("label")).count() == 0
    no_queries = table(spark, [(1, [1.0], 1), (2, [1.0], 1)])
    assert K.nearest(no_queries, F.col("id") % 10 == 0).columns == ["query_id", "rank", "vec_id", "score"]
    assert K.nearest(no_queries, F.col("id") % 10 == 0).count() == 0


def test_boxes_and_windows_leave_rows_of_clustered_vectors_unscored():
    rows = clustered(4000)
    points = np.array([[math.floor(1024 * x) for x in e] for _, e, _ in rows])
    shard = K.Shard(np.arange(len(points)), points)
    found = dict(shard.search(np.arange(20), points[:20], [None] * 20, 10))
    assert shard.scored < 0.5 * 20 * len(points)
    for q in range(20):
        want = sorted(((-int(s), i) for i, s in enumerate(points @ points[q]) if i != q))[:10]
        assert sorted(((-s, i) for s, i in found[q])) == [(s, i) for s, i in want]


def test_score_bounds_hold():
    r = np.random.default_rng(9)
    points = np.concatenate([r.integers(-300, 300, (500, 6)), np.zeros((1, 6), int), r.integers(-1, 2, (50, 6))])
    points = np.concatenate([points, points[:20], -points[:20]])
    lines = A.directions(points, 5)
    norms, angles = A.polar(points, lines)
    for q in range(0, len(points), 7):
        least, most = A.score_bounds(norms[q], angles[q], (norms, norms), angles, angles)
        scores = points @ points[q]
        assert (least <= scores).all() and (scores <= most).all()
