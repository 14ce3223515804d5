"""Language identification, quality classifier and neighbour search: held-out accuracy, recall, awkward cases."""

import zlib

import duckdb
import numpy as np
import pytest
from cases import awkward, awkward_rows, empty
from pyspark.sql import functions as F

from benchtrail.llm import collision_search as C
from benchtrail.llm import language_id as L
from benchtrail.llm import quality_model as Q

SF = "/root/testdata/sf0.01"


def table(name, sf=SF):
    return duckdb.sql(f"select * from read_parquet('{sf}/{name}.parquet')").df()


def test_op9_held_out_accuracy(spark):
    got = L.op9_family_then_pairs(spark, SF).toPandas().merge(table("documents"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.score.between(0, 1).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97


def test_language_steps():
    assert L.family_of("de") == L.family_of("en") != L.family_of("fr") == L.family_of("es") and L.family_of("xx") == "xx"
    assert L.features(None or "") is None and L.features("123 !?") is None
    x = np.array([L.features(t) for t in ("der und die", "the and of", "el de los", "le et les")] * 3)
    model = L.Model(x, np.array(["de", "en", "es", "fr"] * 3, object))
    assert model.predict(x)[0] == ["de", "en", "es", "fr"] * 3
    one = L.Model(x[:1], np.array(["de"], object))
    assert one.predict(x)[0] == ["de"] * 12


def test_language_awkward_rows(spark):
    df = awkward(spark)
    model = L.learn(df, "doc_id", "text", "lang")
    found = {(r.id, r.lang_pred, r.score) for r in L.identify(df, model).collect()}
    assert {(5, "und", 0.0), (6, "und", 0.0), (7, "und", 0.0)} <= found and any(f[:2] == (8, "en") for f in found)
    assert L.learn(empty(spark), "doc_id", "text", "lang") is None
    assert {r.lang_pred for r in L.identify(df, None).collect()} == {"und"}
    assert L.identify(empty(spark), model).count() == 0


def test_op6_held_out_accuracy(spark):
    got = Q.op6_boosted_statistics(spark, SF).toPandas().merge(table("labels"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = got[got.held_out]
    assert ((held.predicted == held.quality).mean() > 0.95) and held.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()


def test_flat_trees_equal_a_walk_row_by_row():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(Q.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = Q.Trees(x, y)
    score = trees.score(x)
    assert ((score > 0.5) == y).mean() > 0.95
    for i in range(0, 600, 50):
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < 2**Q.DEPTH - 1:
                node = 2 * node + 1 + int(x[i, trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - (2**Q.DEPTH - 1)]
        assert abs(score[i] - 1 / (1 + np.exp(-total))) < 1e-12


def test_quality_awkward_rows(spark):
    stats = Q.document_statistics(awkward(spark))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.learn(stats, labels)
    got = Q.score_quality(stats, model).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in got)
    assert Q.learn(Q.document_statistics(empty(spark)), labels).score(np.zeros((1, len(Q.STATISTICS))))[0] == 0.5
    assert Q.statistics(None) == Q.statistics("") == Q.statistics(" \n")


def brute(ids, vectors, k=20):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (vectors * vectors[q]).sum(axis=1)
        s[q] = -np.inf
        best = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out[ids[q]] = list(zip(ids[best].tolist(), s[best].tolist()))
    return out


def test_op5_recall_scores_and_order(spark):
    rows = table("embeddings", "/root/testdata/sf0.1").sort_values("vec_id")
    want = brute(rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float))
    got = {}
    for r in C.op5_collision_counting(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.95
    for q, found in got.items():
        exact = dict(want[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in found if i in exact)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def directions(n, dim, seed):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def vector_sets():
    r = np.random.default_rng(7)
    centres = r.standard_normal((60, 32))
    hot = np.repeat(r.standard_normal((1, 16)), 1500, axis=0)  # a third of all rows are one vector
    yield "gaussian", r.standard_normal((6000, 64)), 0.5
    yield "log-normal lengths", directions(6000, 64, 8) * r.lognormal(0, 1, 6000)[:, None], 0.2
    yield "clusters", centres[r.integers(0, 60, 6000)] + 0.15 * r.standard_normal((6000, 32)), 0.2
    yield "hot vector", np.concatenate([hot, r.standard_normal((3000, 16))]), 1.0
    yield "one component", r.standard_normal((300, 1)), 1.0
    yield "huge and tiny", directions(600, 8, 9) * np.where(np.arange(600) % 2, 1e120, 1e-120)[:, None], 1.0


@pytest.mark.parametrize("recall", [C.RECALL, None], ids=["probable", "exact"])
@pytest.mark.parametrize("name, vectors, most", list(vector_sets()), ids=[name for name, *_ in vector_sets()])
def test_neighbours_of_a_block(name, vectors, most, recall):
    ids = np.random.default_rng(3).permutation(len(vectors) * 2)[:len(vectors)]
    asked = np.flatnonzero(ids % 20 == 0)[:60]
    block, want = C.Block(ids, vectors, recall), brute(ids, vectors)
    hits = 0
    for query_id, found, scores in block.search(ids[asked], vectors[asked], 20):
        got = list(zip(found.tolist(), scores.tolist()))
        assert len(got) == 20 and got == sorted(got, key=lambda p: (-p[1], p[0]))
        hits += len({i for i, _ in got} & {i for i, _ in want[query_id]})
        if recall is None:
            assert [i for i, _ in got] == [i for i, _ in want[query_id]]
    assert hits >= 0.95 * 20 * len(asked)
    if recall is not None:
        assert block.verified <= most * len(asked) * len(vectors)


def test_lines_find_a_vector_with_the_probability_asked():
    lines, need, reach = C.lines_for(65, 0.95)
    assert np.allclose(lines @ lines.T, np.eye(len(lines)))
    nth = np.sort(np.abs(directions(4000, 65, 11) @ lines.T), axis=1)[:, need - 1]
    assert abs((nth * reach <= 1).mean() - 0.95) < 0.015
    lines, need, reach = C.lines_for(65, None)
    nth = np.sort(np.abs(directions(4000, 65, 12) @ lines.T), axis=1)[:, need - 1]
    assert (nth * reach <= 1).all()


def test_neighbours_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 10)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [
        (100, None), (120, [0.0, 0.0, 0.0]), (140, [nan, 1.0, 1.0]), (160, [inf, 1.0, 1.0]), (180, [None, 1.0, 1.0]), (200, [1.0, 2.0]),
        (None, [1.0, 1.0, 1.0]), (20, [6.0, 1.0, 2.0]), (220, []), (61, [1e-3, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, id int, block int")
    got = {}
    for r in C.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    clean = {i: v for i, v in rows if i is not None and i < 100 and not (i == 20 and v[0] == 6.0)}
    clean[20] = min(v for i, v in rows if i == 20)
    ids = np.array(sorted(clean))
    want = brute(ids, np.array([clean[i] for i in ids]))
    assert got.keys() == want.keys()  # the query of another length has no other vector to meet
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    exact = {}
    for r in C.nearest(df, F.col("id") % 20 == 0, recall=None).orderBy("query_id", "rank").collect():
        exact.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert exact == want
    assert C.nearest(df.filter("vec_id < 0"), F.col("id") % 20 == 0).count() == 0
