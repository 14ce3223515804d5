"""The resumable search against a step-by-step simulation over gaps of unbuildable builds."""

import random

from pyspark.sql import functions as F

from benchtrail.operators import search as Q

KEYS = ["case"]


def simulate(axis, buildable, fails, good, bad):
    """(status, newest good, oldest bad, builds looked at) of one alert."""
    lo, hi, seen = axis.index(good), axis.index(bad), []
    lo0 = lo
    while True:
        n = hi - lo + 1
        mid = hi - n // 2
        inside = [i for i in range(lo + 1, hi) if axis[i] in buildable]
        older, newer = [i for i in inside if i <= mid], [i for i in inside if i >= mid]
        near = ([older[-1]] if older else []) + ([newer[0]] if newer else [])
        if not near:
            break
        pick = min(near, key=lambda i: (abs(i - mid), i))
        seen.append(axis[pick])
        if fails(axis[pick]):
            hi = pick
        else:
            lo = pick
    if lo == lo0:
        seen.append(axis[lo])
        if fails(axis[lo]):
            return Q.NO_ANSWER, axis[lo], axis[hi], seen
    return Q.FOUND, axis[lo], axis[hi], seen


def test_sessions_that_answer_what_was_asked_equal_a_simulation(spark, tmp_dir):
    r = random.Random(4)
    axis = sorted(r.sample(range(1000, 9000), 60))
    buildable = {c for i, c in enumerate(axis) if i in (0, 59) or not (10 <= i < 30 or i % 3 == 1)}
    alerts = {}
    for n in range(25):
        good, bad = sorted(r.sample(range(60), 2))
        turn = r.choice([0, r.randint(good, bad), bad])  # first failing place; 0: even the good end fails
        alerts[f"case_{n}"] = (axis[good], axis[bad], lambda c, at=axis[turn] if turn else 0: c >= at)
    alerts["never"] = (axis[3], axis[40], lambda c: False)
    changes = spark.createDataFrame([(c,) for c in axis * 2], "changelist long")
    builds = spark.createDataFrame([(c, c in buildable) for c in axis], "changelist long, build_ok boolean")
    search = Q.CulpritSearch(spark, f"{tmp_dir}/s", KEYS)
    search.begin(spark.createDataFrame([(k, g, b) for k, (g, b, _) in alerts.items()], "case string, good_cl long, bad_cl long"), changes, builds)
    results, asked = [], {k: [] for k in alerts}
    schema = "case string, changelist long, fail boolean"
    for _ in range(3):
        todo = Q.CulpritSearch(spark, f"{tmp_dir}/s", KEYS).resume(changes, builds, spark.createDataFrame(results, schema)).collect()  # a new session each time
        for t in todo:
            asked[t["case"]].append(t.changelist)
            results.append((t["case"], t.changelist, alerts[t["case"]][2](t.changelist)))
            assert t.built or t.changelist not in buildable
    every = [(k, c, f(c)) for k, (_, _, f) in alerts.items() for c in axis]
    assert search.resume(changes, builds, spark.createDataFrame(every, schema)).count() == 0
    state = {s["case"]: s for s in search.state().collect()}
    for k, (good, bad, f) in alerts.items():
        status, lo, hi, seen = simulate(axis, buildable, f, good, bad)
        s = state[k]
        assert (s.status, s.lo_cl, s.hi_cl) == (status, lo, hi) and asked[k] == seen[:3][:len(asked[k])] and len(asked[k]) == min(3, len(seen))
    found = {c["case"]: c.culprit_cl for c in search.culprits().collect()}
    assert set(found) == set(alerts) and any(v is None for v in found.values()) and len({s.status for s in state.values()}) == 2


def test_unknown_builds_are_asked_for_and_failed_ones_skipped(spark):
    axis = list(range(10, 80, 10))
    changes = spark.createDataFrame([(c,) for c in axis], "changelist long")
    none = spark.createDataFrame([], "changelist long, build_ok boolean")
    ranges = spark.createDataFrame([("a", 10, 70)], "case string, good_cl long, bad_cl long")
    empty = spark.createDataFrame([], "case string, changelist long, fail boolean")
    st = Q.advance(Q.start(ranges, Q.usable_axis(changes, none), KEYS), Q.usable_axis(changes, none), empty, KEYS)
    assert st.first().status == Q.WAITING and st.first().next_cl == 40
    failed = spark.createDataFrame([(40, False), (30, False)], "changelist long, build_ok boolean")
    assert Q.advance(st, Q.usable_axis(changes, failed), empty, KEYS).first().next_cl == 50
    assert Q.advance(st.filter(F.lit(False)), Q.usable_axis(changes, none), empty, KEYS).count() == 0
