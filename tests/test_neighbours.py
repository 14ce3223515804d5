"""Exact nearest rows (M4) against brute force."""

import math

import numpy as np
import pytest

from benchtrail.operators import neighbours as N

SCHEMA = "id long, v array<double>, label int"


def clustered(n, seed, dim=6, ids=0):
    r = np.random.default_rng(seed)
    centres = np.random.default_rng(0).normal(size=(20, dim)) * 20
    return [(ids + i, (centres[r.integers(0, 20)] + r.normal(size=dim)).tolist(), int(r.integers(0, 3))) for i in range(n)]


def odd():
    rows = clustered(60, 4) + [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1) for i in range(40)]  # two fifths alike: ties
    return rows + [(200, None, 1), (201, [1.0, None], 1), (202, [math.nan] * 6, 1), (203, [math.inf] * 6, 1), (204, [], 2), (205, [1.0], 0), (None, [0.0] * 6, 1)]


def brute(train, test, k):
    ok = lambda rows: [(i, list(v) + [0.0] * (6 - len(v))) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in ok(test):
        d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), i) for i, w in ok(train))
        out[q] = [(round(x, 9), i) for x, i in d[:k]]
    return out


@pytest.mark.parametrize("blocks", [False, True])
@pytest.mark.parametrize("train,test", [(clustered(900, 1), clustered(50, 2, ids=5000)), (odd(), odd()), (clustered(3, 3), clustered(4, 4))])
def test_nearest_rows_equal_brute_force(spark, monkeypatch, train, test, blocks):
    if blocks:
        monkeypatch.setattr(N, "BLOCK", 40)
        monkeypatch.setattr(N, "QUERY_BLOCK", 7)
    found = {}
    got = N.nearest_rows(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA), 5, "id", "v").orderBy("query_id", "rank").collect()
    for r in got:
        found.setdefault(r.query_id, []).append((round(r.distance, 9), r.id))
        assert r.rank == len(found[r.query_id])
    assert found == brute(train, test, 5)


def test_clustered_queries_compare_few_rows(spark):
    train, test = spark.createDataFrame(clustered(4000, 1), SCHEMA), spark.createDataFrame(clustered(100, 2, ids=9000), SCHEMA)
    compared = {r.query_id: r.compared for r in N.nearest_rows(train, test, 5, "id", "v").collect()}
    assert len(compared) == 100 and sum(compared.values()) < 0.25 * 100 * 4000


def test_vote_and_empty_tables(spark):
    near = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (1, 13), (2, 10)], "query_id long, id long")
    labels = spark.createDataFrame([(10, 2), (11, 2), (12, 1), (13, 1)], "id long, label int")
    assert {tuple(r) for r in N.vote(near, labels).collect()} == {(1, 1), (2, 2)}
    some, none = spark.createDataFrame(clustered(5, 1), SCHEMA), spark.createDataFrame([], SCHEMA)
    for a, b in ((none, some), (some, none)):
        assert N.nearest_rows(a, b, 5, "id", "v").count() == 0


def test_groups_of_a_search_are_not_merged_into_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 100)
    monkeypatch.setattr(N, "QUERY_BLOCK", 50)
    r = np.random.default_rng(7)
    rows = [(i, r.normal(size=16).tolist(), 0) for i in range(2000)]
    train, test = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[:200], SCHEMA)
    tasks = []
    meet = N.meet
    monkeypatch.setattr(N, "meet", lambda *a: tasks.append(d := meet(*a)) or d)
    N.nearest_rows(train, test, 5, "id", "v").collect()
    assert all(d.rdd.getNumPartitions() >= 80 for d in tasks)  # 20 blocks with 4 parts at least; the planner made 4 tasks of them


def test_a_query_travels_once_to_an_area_of_many_cells(spark, monkeypatch):
    r = np.random.default_rng(8)
    rows = [(i, r.normal(size=16).tolist(), 0) for i in range(4000)]  # no structure: each query asks most cells
    train, test = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[:200], SCHEMA)
    sent = []
    meet = N.meet
    monkeypatch.setattr(N, "meet", lambda *a: sent.append(a[2]) or meet(*a))
    got = N.nearest_rows(train, test, 5, "id", "v").collect()
    assert len(got) == 1000 and all(x.id == x.query_id and x.distance == 0 for x in got if x["rank"] == 1)
    assert [d.count() for d in sent][0] == 200 and all(d.count() <= 200 * 9 for d in sent)  # 4000 rows: 15 cells in 8 or 9 areas of 512 at most


def test_router_makes_no_more_rows_than_it_gets():
    r = np.random.default_rng(9)
    pivots, Row = r.normal(size=(60, 16)), type("Row", (), {})
    stats = []
    for i in range(60):
        stats.append(Row())
        stats[-1].__dict__.update(pivot=i, cell=i, n=10, near=0.0, far=9.0)
    layout = N.Cells(pivots, stats, 200)
    assert sorted(layout.sizes().values()) == [200, 200, 200]
    some = N.pd.DataFrame({"id": range(5000), "v": list(r.normal(size=(5000, 16))), "kth": [3.0] * 5000})
    out = list(N._router(layout, 16, False)(iter([some])))
    assert sum(len(x) for x in out) == 5000 and max(len(x) for x in out) <= N.ROUTED
    assert all(len(set(a)) == len(a) <= 2 for x in out for a in x["areas"])


@pytest.mark.parametrize("offset,scale", [(0.0, 1.0), (1e5, 1.0), (0.0, 1e-30), (0.0, 1e30)])
def test_products_leave_out_nothing_that_is_near(spark, monkeypatch, offset, scale):
    monkeypatch.setattr(N, "LEAST", 100)
    monkeypatch.setattr(N, "LEFT", 500)
    r = np.random.default_rng(10)
    x = (r.normal(size=(700, 8)) * scale + offset).astype("float32")
    x[600:650] = x[600]  # alike
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    found = {}
    for g in N.nearest_rows(df, df.filter("id % 5 = 0"), 5, "id", "v").orderBy("query_id", "rank").collect():
        found.setdefault(g.query_id, []).append((g.distance, g.id))
    wide = x.astype(float)
    for q in range(0, 700, 5):
        d = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        nearest = np.lexsort((np.arange(700), d))[:5]
        assert [i for _, i in found[q]] == nearest.tolist() and np.allclose([a for a, _ in found[q]], d[nearest], rtol=1e-12, atol=0)
    assert len(found) == 140
