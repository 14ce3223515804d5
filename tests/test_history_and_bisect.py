"""Run-history operators (A12, R1, A7-A9, W4) and the culprit search
on hand-made edges; bisection against a plain-Python run of the same rules."""

import datetime as dt
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from benchtrail.functions.ranking import dense_index
from benchtrail.operators import bisect as B
from benchtrail.operators import history as H
from benchtrail.plans import regression as R

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("test_case_name string, board string, changelist bigint, updatetime timestamp, event_id bigint, "
          "min_value double, avg_value double, max_value double, algorithm string")


def runs(spark, rows):
    full = [(c, b, cl, T0 + dt.timedelta(seconds=s), e, v, v * 1.1, v * 1.2, c.split("_")[0]) for c, b, cl, s, e, v in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_latest_record_tie_on_updatetime(spark):
    df = runs(spark, [("fft_a_16", "b", 1, 5, 1, 10.0), ("fft_a_16", "b", 1, 5, 2, 20.0), ("fft_a_16", "b", 1, 3, 9, 30.0)])
    r = H.latest_record(df, H.RECORD, values=["min_value"]).first()
    assert r.min_value == 20.0                      # equal time: the greater event id wins


def test_regression_alert_edges(spark):
    df = runs(spark, [
        ("fft_a_16", "b", 10, 1, 1, 100.0), ("fft_a_16", "b", 20, 2, 2, 111.0),   # +11 % -> alert
        ("dct_a_16", "b", 10, 1, 3, 100.0), ("dct_a_16", "b", 20, 2, 4, 110.0),   # exactly 10 % -> no alert (strict)
        ("qmf_a_16", "b", 20, 1, 5, 50.0),                                         # one build only -> no baseline
        ("math_a_16", "b", 10, 1, 6, 0.0), ("math_a_16", "b", 20, 2, 7, 5.0),     # baseline 0 -> no baseline
        ("blkvec_a_16", "b", 10, 1, 8, 100.0), ("blkvec_a_16", "b", 20, 2, 9, 80.0),  # -20 % -> alert, flag 0
    ])
    a = {r.test_case_name: r for r in R.regression_alerts(df).collect()}
    assert a["fft_a_16"].alert and a["fft_a_16"].flag == 1 and a["fft_a_16"].delta_pct == pytest.approx(11.0)
    assert not a["dct_a_16"].alert and a["dct_a_16"].status == "in_range"
    assert a["qmf_a_16"].status == "no_baseline" and not a["qmf_a_16"].alert
    assert a["math_a_16"].status == "no_baseline" and a["math_a_16"].delta_pct is None
    assert a["blkvec_a_16"].alert and a["blkvec_a_16"].flag == 0
    assert [r.test_case_name for r in R.slower_than_previous(df).collect()] == ["fft_a_16"]


def test_baseline_list_and_range(spark):
    df = runs(spark, [("fft_a_16", "b", cl, cl, cl, float(cl)) for cl in (10, 20, 30, 40)])
    recs = H.latest_record(df, H.RECORD, values=["min_value"])
    b = H.baseline(recs, cls=["30", "x", "99", "10"]).first()
    assert b.base_value == 20.0 and b.base_cl == 10 and b.base_n == 2      # last listed that exists
    r = H.baseline(recs, cl_range=(15, 35)).first()
    assert r.base_value == 25.0 and r.base_cl == 30
    assert H.baseline(recs, cl_range=(41, 50)).count() == 0
    # explicit candidate missing from the series reports value 0
    a = R.regression_alerts(df, candidate=99, cls=["10", "20"]).first()
    assert a.cand_value == 0.0 and a.delta_pct == -100.0


# deltas -0.3, -0.1, -0.05, 0, 0.05, 0.2, 0.5, 0.6; boundaries are strict except >= 0.05
@pytest.mark.parametrize("mode,expect", [
    # reference: -0.05 falls in no bucket and "better than 20 %" is never reached
    ("reference", {"better_than_20": 0, "better_than_5": 2, "same_in_5": 1, "worse_than_5": 2,
                   "worse_than_20": 1, "worse_than_50": 1}),
    ("fixed", {"better_than_20": 1, "better_than_5": 1, "same_in_5": 2, "worse_than_5": 2,
               "worse_than_20": 1, "worse_than_50": 1}),
])
def test_delta_histogram_boundaries(spark, mode, expect):
    pairs = spark.createDataFrame([(f"c{i}", 100.0 * (1 + d), 100.0) for i, d in
                                   enumerate([-0.3, -0.1, -0.05, 0.0, 0.05, 0.2, 0.5, 0.6])],
                                  "test_case_name string, dut double, ref double")
    h = H.delta_histogram(pairs, mode).first().asDict()
    assert {k: h[k] for k in expect} == expect and h["n_common"] == 8


def test_compare_builds_counts_add_up(spark):
    df = runs(spark, [("fft_a_16", "b", 1, 1, 1, 100.0), ("fft_a_16", "b", 2, 2, 2, 90.0),
                      ("fft_b_16", "b", 1, 1, 3, 100.0), ("fft_b_16", "b", 2, 2, 4, 111.0),
                      ("fft_c_16", "b", 1, 1, 5, 100.0), ("fft_c_16", "b", 2, 2, 6, 110.0),
                      ("fft_d_16", "b", 1, 1, 7, 100.0)])                  # lacks build 2: left out
    s = H.compare_builds(df, 1, 2, threshold=10).first()
    assert (s.better, s.worse, s.no_change, s.total) == (0, 1, 2, 3)     # -10 % and +10 % are not beyond 10 %
    assert s.better + s.worse + s.no_change == s.total


def test_dense_index_is_a_total_order(spark):
    vals = random.Random(3).sample(range(10_000), 997)
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    got = sorted((r.idx, r.v) for r in dense_index(df, "v", "idx", partitions=7).collect())
    assert got == list(enumerate(sorted(vals)))


def test_dense_index_of_many_wide_rows(spark):
    """Positions are ranks for any number of partitions, also if most rows share one value."""
    wide = F.repeat(F.sha2(F.col("id").cast("string"), 256), 4)
    df = spark.range(400_000).select(F.when(F.col("id") % 10 == 0, F.xxhash64("id")).otherwise(F.lit(7)).alias("v"), "id", wide.alias("w"))
    for partitions in (8, 32, 64):
        got = dense_index(df, "v", "idx", partitions=partitions).select("v", "idx", F.lag("v").over(Window.orderBy("idx")).alias("before"))
        s = got.agg(F.count("*").alias("n"), F.countDistinct("idx").alias("d"), F.min("idx").alias("lo"), F.max("idx").alias("hi"),
                    F.count_if(F.col("before") > F.col("v")).alias("wrong")).first()
        assert (s.n, s.d, s.lo, s.hi, s.wrong) == (400_000, 400_000, 0, 399_999, 0)


def test_last_n_axis(spark):
    df = runs(spark, [("fft_a_16", "b", 10, 1, 1, 1.0), ("fft_b_16", "b", 20, 1, 2, 1.0), ("fft_a_16", "b", 30, 1, 3, 1.0)])
    s = H.latest_record(df, H.RECORD, values=["min_value"])
    assert sorted((r.changelist, r.x) for r in H.last_n(s, 2).collect()) == [(20, 0), (30, 1)]
    assert sorted((r.changelist, r.x) for r in H.last_n(s, 0).collect()) == [(10, 0), (20, 1), (30, 2)]


def bisect_reference(verdicts, good_i, bad_i):
    """The search loop as the reference runs it, on positions of one axis."""
    lo, hi, lo0 = good_i, bad_i, good_i
    while True:
        n = hi - lo + 1
        mid = hi - n // 2
        if mid == lo:
            break
        if verdicts[mid]:
            hi = mid
        else:
            lo = mid
    if lo == lo0 and verdicts[lo]:
        return None
    return hi


def test_first_bad_matches_reference_loop(spark):
    rnd = random.Random(11)
    rows, ranges, expect = [], [], {}
    for s in range(40):
        n = rnd.randint(1, 40)
        verdicts = [rnd.random() < 0.4 for _ in range(n)]
        if s % 3 == 0:                                   # monotone history
            k = rnd.randint(0, n - 1)
            verdicts = [i >= k for i in range(n)]
        cls = sorted(rnd.sample(range(1000), n))
        rows += [(f"c{s}", "b", cl, v) for cl, v in zip(cls, verdicts)]
        g, b = sorted(rnd.sample(range(n), 2)) if n > 1 else (0, 0)
        ranges.append((f"c{s}", "b", cls[g], cls[b]))
        ans = bisect_reference(verdicts, g, b)
        expect[f"c{s}"] = None if ans is None else cls[ans]
    v = spark.createDataFrame(rows, "test_case_name string, board string, changelist bigint, fail boolean")
    r = spark.createDataFrame(ranges, "test_case_name string, board string, good_cl bigint, bad_cl bigint")
    got = {row.test_case_name: row.culprit_cl for row in B.first_bad(v, r, ["test_case_name", "board"]).collect()}
    assert got == expect


def test_nearest_buildable(spark):
    builds = spark.createDataFrame([(cl, cl not in (40, 50, 60)) for cl in range(10, 110, 10)], "changelist bigint, build_ok boolean")
    wanted = spark.createDataFrame([(60,), (30,), (10,)], "changelist bigint")
    got = {r.changelist: r.buildable_cl for r in B.nearest_buildable(builds, wanted, k=4).collect()}
    assert got == {60: 30, 30: 30, 10: 10}            # 60, 50, 40 failed; 30 is the 4th try
    got3 = {r.changelist: r.buildable_cl for r in B.nearest_buildable(builds, wanted, k=3).collect()}
    assert got3[60] is None


def test_group_median_equals_percentile_with_hot_group(spark):
    from benchtrail.functions.ranking import group_median
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 999))) for _ in range(6000)] + \
           [(f"g{rnd.randint(0, 80)}", float(rnd.randint(0, 30))) for _ in range(3000)] + [("two", 1.0), ("two", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    from pyspark.sql import functions as F
    a = {r.k: r.m for r in group_median(df, "k", "v", "m", partitions=5).collect()}
    b = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert a == b and a["two"] == 2.5


def test_alerts_compare_the_exact_delta(spark):
    from benchtrail.plans.regression import regression_alerts
    df = runs(spark, [("fft_a_16", "b", 1, 1, 1, 100.0), ("fft_a_16", "b", 2, 2, 2, 110.0000003),
                      ("fft_b_16", "b", 1, 1, 3, 100.0), ("fft_b_16", "b", 2, 2, 4, 110.0)])
    got = {r.test_case_name: (r.alert, r.delta_pct, r.status) for r in regression_alerts(df, threshold=10).collect()}
    assert got == {"fft_a_16": (True, 10.0, "out_of_range"), "fft_b_16": (False, 10.0, "in_range")}


def test_report_rows_of_odd_case_names(spark):
    df = runs(spark, [("fft_1", "b", 1, 1, 1, 100.0), ("fft_x", "b", 1, 1, 2, 100.0), ("fft_16", "b", 1, 1, 3, 640.0)])
    df = df.withColumn("algorithm", F.lit("fft"))
    for variant in ("nightly", "two_build"):
        got = {r.test_case_name: r.third for r in H.report_rows(df, variant=variant).collect()}
        assert got == {"fft_1": None, "fft_x": None, "fft_16": 2.0}


def test_frame_that_never_ran_scales_nothing(spark):
    from benchtrail.operators.merge import scale_to_frame
    df = spark.createDataFrame([("f", "frame", 0, 8.0, 2.0, 4.0), ("f", "n", 5, 8.0, 2.0, 4.0), ("g", "frame", 2, 8.0, 2.0, 4.0), ("g", "n", 5, 8.0, 2.0, 4.0)],
                               "file string, name string, num_calls bigint, max double, min double, avg double")
    got = {(r.file, r.name): r.max for r in scale_to_frame(df, "frame").collect()}
    assert got == {("f", "frame"): 8.0, ("f", "n"): 8.0, ("g", "frame"): 8.0, ("g", "n"): 24.0}


def test_whole_table_queries_hold_every_board_and_algorithm(spark):
    import __spark_entry__ as E
    from benchtrail.fixtures import fixture
    from conftest import SMOKE

    runs, q = fixture(spark, SMOKE, "f1_runs"), E.queries()
    assert q["o3_first_seen_order_boards"](spark, SMOKE).count() == runs.count()
    tables = q["a15_benchmark_pivots"](spark, SMOKE).select("algorithm", "test_case_name").collect()
    assert sorted(map(tuple, tables)) == sorted(map(tuple, runs.select("algorithm", "test_case_name").distinct().collect()))
    assert len({r.algorithm for r in tables}) > 1
