"""History / reporting queries over F1 (profile runs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, with_fixtures
from benchtrail.operators import history as H
from benchtrail.plans import regression as R
from benchtrail.registry import query

# newest update wins per (case, board, build) -- the oracle's own formulation
RECS = """recs as (select * from (select *, row_number() over (partition by test_case_name, board, changelist
          order by updatetime desc, event_id desc) as rn_ from f1_runs) t where rn_ = 1)"""

# parameters of the registered queries (builds of the fixture: 2000010 .. 2000300)
RANGE = (2000100, 2000200)
LIST = ["2000050", "2000150", "x", "2000990", "2000120"]
BASE_CL, CAND_CL = 2000150, 2000300


def runs(spark, sf_dir):
    return fixture(spark, sf_dir, "f1_runs")


RANKED = RECS + """,
ranked as (select *, row_number() over (partition by test_case_name, board order by changelist desc) as r from recs)"""


@query("r1_regression_alert", with_fixtures("""
select c.test_case_name, c.board, c.changelist as cand_cl, c.min_value as cand_value,
       b.changelist as base_cl, b.min_value as base_value,
       round(100 * (c.min_value - b.min_value) / b.min_value, 6) as delta_pct
from ranked c join ranked b on c.test_case_name = b.test_case_name and c.board = b.board and c.r = 1 and b.r = 2
where 100 * (c.min_value - b.min_value) / b.min_value > 10
""", "f1_runs", ctes=RANKED))
def r1_regression_alert(spark, sf_dir):
    return R.slower_than_previous(runs(spark, sf_dir))


ALERT_COLS = "test_case_name, board, cand_cl, cand_value, base_cl, base_value, delta_pct, alert, flag, status"


def _alerts_sql(cand_sql: str, base_sql: str) -> str:
    return with_fixtures(f"""
select s.test_case_name, s.board, c.cand_cl, c.cand_value, b.base_cl, round(b.base_value, 6) as base_value,
       round(100 * (c.cand_value - b.base_value) / nullif(b.base_value, 0), 6) as delta_pct,
       coalesce(abs(100 * (c.cand_value - b.base_value) / nullif(b.base_value, 0)) > 10, false) as alert,
       case when 100 * (c.cand_value - b.base_value) / nullif(b.base_value, 0) > 0 then 1 else 0 end as flag,
       case when b.base_value is null or b.base_value = 0 then 'no_baseline'
            when abs(100 * (c.cand_value - b.base_value) / b.base_value) > 10 then 'out_of_range'
            else 'in_range' end as status
from (select distinct test_case_name, board from recs) s
left join ({cand_sql}) c on s.test_case_name = c.test_case_name and s.board = c.board
left join ({base_sql}) b on s.test_case_name = b.test_case_name and s.board = b.board
""", "f1_runs", ctes=RECS)


@query("r1_alert_range_baseline", _alerts_sql(
    """select test_case_name, board, changelist as cand_cl, min_value as cand_value from
       (select *, row_number() over (partition by test_case_name, board order by changelist desc) as r from recs) t where r = 1""",
    f"""select test_case_name, board, max(changelist) as base_cl, avg(min_value) as base_value from recs
        where changelist between {RANGE[0]} and {RANGE[1]} group by 1, 2"""))
def r1_alert_range_baseline(spark, sf_dir):
    # the baseline is a mean: rounded for comparison (summation order differs between engines)
    return R.regression_alerts(runs(spark, sf_dir), cl_range=RANGE).withColumn("base_value", F.round("base_value", 6))


@query("r1_alert_list_baseline", _alerts_sql(
    f"""select s.test_case_name, s.board, cast({CAND_CL} as bigint) as cand_cl, coalesce(r.min_value, 0.0) as cand_value
        from (select distinct test_case_name, board from recs) s
        left join recs r on r.test_case_name = s.test_case_name and r.board = s.board and r.changelist = {CAND_CL}""",
    """select test_case_name, board, arg_max(changelist, pos) as base_cl, avg(min_value) as base_value
       from recs join (values (2000050, 0), (2000150, 1), (2000990, 3), (2000120, 4)) l(cl, pos) on changelist = cl
       group by 1, 2"""))
def r1_alert_list_baseline(spark, sf_dir):
    return (R.regression_alerts(runs(spark, sf_dir), candidate=CAND_CL, cls=LIST)
             .withColumn("base_value", F.round("base_value", 6)))


@query("r2_alert_records", with_fixtures("""
select c.test_case_name, c.board, c.changelist as cand_cl, b.changelist as base_cl,
       round(100 * (c.min_value - b.min_value) / b.min_value, 6) as delta_pct,
       concat(cast(round(100 * (c.min_value - b.min_value) / b.min_value, 6) as varchar), ';', c.changelist, ',', b.changelist,
              ';', c.algorithm, ';', c.test_case_name, ';nightly;5.0') as record
from ranked c join ranked b on c.test_case_name = b.test_case_name and c.board = b.board and c.r = 1 and b.r = 2
where 100 * (c.min_value - b.min_value) / b.min_value > 5
""", "f1_runs", ctes=RANKED))
def r2_alert_records(spark, sf_dir):
    r = runs(spark, sf_dir)
    alg = r.select("test_case_name", "algorithm").distinct()
    a = R.regression_alerts(r, threshold=5).join(alg, "test_case_name")
    return (R.alert_records(a, table="algorithm", cfg="nightly", threshold=5.0)
             .select("test_case_name", "board", "cand_cl", "base_cl", "delta_pct", "record"))


@query("a12_latest_record", with_fixtures("""
select test_case_name, board, changelist, updatetime, event_id, max_value, min_value, avg_value from recs
""", "f1_runs", ctes=RECS))
def a12_latest_record(spark, sf_dir):
    return H.latest_record(runs(spark, sf_dir), H.RECORD,
                           values=["updatetime", "event_id", "max_value", "min_value", "avg_value"])


@query("w1_history_series", with_fixtures("""
select test_case_name, board, changelist, updatetime, event_id, min_value, avg_value from
(select *, row_number() over (partition by test_case_name, board, changelist order by updatetime desc, event_id desc) as rn_
 from f1_runs where changelist >= 2000100 and lower(test_case_name) like 'fft\\_%' escape '\\') t where rn_ = 1
""", "f1_runs"))
def w1_history_series(spark, sf_dir):
    return H.history_series(runs(spark, sf_dir), min_cl=2000100, like="'FFT\\_%'")


@query("w2_previous_build", with_fixtures("""
select test_case_name, board, changelist, min_value,
       lag(changelist) over (partition by test_case_name, board order by changelist) as prev_cl,
       lag(min_value) over (partition by test_case_name, board order by changelist) as prev_value
from recs
""", "f1_runs", ctes=RECS))
def w2_previous_build(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    return H.with_previous(s)


@query("w3_pct_from_first", with_fixtures("""
select test_case_name, board, changelist, min_value,
       round(100 * (min_value - first_value(min_value) over w) / first_value(min_value) over w, 6) as pct_from_first
from recs window w as (partition by test_case_name, board order by changelist rows between unbounded preceding and unbounded following)
""", "f1_runs", ctes=RECS))
def w3_pct_from_first(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    return H.pct_from_first(s)


@query("w4_last_n", with_fixtures("""
select r.test_case_name, r.board, r.changelist, r.min_value, a.x from recs r join
 (select changelist, cast(row_number() over (order by changelist) - 1 as bigint) as x from
   (select distinct changelist from recs order by changelist desc limit 5) t) a on r.changelist = a.changelist
""", "f1_runs", ctes=RECS))
def w4_last_n(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    return H.last_n(s, 5)


@query("w4_axis_all", with_fixtures("""
select r.test_case_name, r.board, r.changelist, r.min_value, a.x from recs r join
 (select changelist, cast(dense_rank() over (order by changelist) - 1 as bigint) as x from (select distinct changelist from recs) t) a
 on r.changelist = a.changelist
""", "f1_runs", ctes=RECS))
def w4_axis_all(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    return H.last_n(s, 0)


@query("a7_baseline_range", with_fixtures(f"""
select test_case_name, board, round(avg(min_value), 6) as base_value, max(changelist) as base_cl, count(*) as base_n
from recs where changelist between {RANGE[0]} and {RANGE[1]} group by 1, 2
""", "f1_runs", ctes=RECS))
def a7_baseline_range(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    b = H.baseline(s, cl_range=RANGE)
    return b.withColumn("base_value", F.round("base_value", 6))


@query("a7_baseline_list", with_fixtures("""
select test_case_name, board, round(avg(min_value), 6) as base_value, arg_max(changelist, pos) as base_cl, count(*) as base_n
from recs join (values (2000050, 0), (2000150, 1), (2000990, 3), (2000120, 4)) l(cl, pos) on changelist = cl group by 1, 2
""", "f1_runs", ctes=RECS))
def a7_baseline_list(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    b = H.baseline(s, cls=LIST)
    return b.withColumn("base_value", F.round("base_value", 6))


_PAIRS = f"""pairs as (select b.test_case_name, b.algorithm, b.board, b.min_value as base, c.min_value as cand
  from recs b join recs c on b.test_case_name = c.test_case_name and b.board = c.board
  where b.changelist = {BASE_CL} and c.changelist = {CAND_CL})"""


@query("a8_compare_builds", with_fixtures("""
select algorithm, board,
       count(*) filter (where base - cand > base * 5.0 / 100) as better,
       count(*) filter (where not (base - cand > base * 5.0 / 100) and cand - base > base * 5.0 / 100) as worse,
       count(*) filter (where not (base - cand > base * 5.0 / 100) and not (cand - base > base * 5.0 / 100)) as no_change,
       count(*) as total
from pairs group by 1, 2
""", "f1_runs", ctes=RECS + ",\n" + _PAIRS))
def a8_compare_builds(spark, sf_dir):
    return H.compare_builds(runs(spark, sf_dir), BASE_CL, CAND_CL, threshold=5)


@query("a8_case_lists", with_fixtures("""
select test_case_name, algorithm, board, base, cand,
       case when base - cand > base * 5.0 / 100 then 'better' when cand - base > base * 5.0 / 100 then 'worse' else 'no_change' end as verdict
from pairs
""", "f1_runs", ctes=RECS + ",\n" + _PAIRS))
def a8_case_lists(spark, sf_dir):
    return H.case_lists(runs(spark, sf_dir), BASE_CL, CAND_CL, threshold=5)


_SUMMARY = """s as (select algorithm, board,
       count(*) filter (where base - cand > base * 5.0 / 100) as better,
       count(*) filter (where not (base - cand > base * 5.0 / 100) and cand - base > base * 5.0 / 100) as worse,
       count(*) filter (where not (base - cand > base * 5.0 / 100) and not (cand - base > base * 5.0 / 100)) as no_change,
       count(*) as total from pairs group by 1, 2)"""


@query("a13_accumulate", with_fixtures("""
select algorithm, board, cast(sum(better) as bigint) as better, cast(sum(worse) as bigint) as worse,
       cast(sum(no_change) as bigint) as no_change, cast(sum(total) as bigint) as total
from s group by rollup (algorithm, board)
""", "f1_runs", ctes=RECS + ",\n" + _PAIRS + ",\n" + _SUMMARY))
def a13_accumulate(spark, sf_dir):
    return H.accumulate(H.compare_builds(runs(spark, sf_dir), BASE_CL, CAND_CL, threshold=5))


_DUT_REF = f"""dut as (select test_case_name, min_value as dut from (select *, row_number() over (partition by test_case_name
    order by updatetime desc, event_id desc) as r from f1_runs where board = 'board_a' and changelist = {CAND_CL}) t where r = 1),
ref as (select test_case_name, min_value as ref from (select *, row_number() over (partition by test_case_name
    order by updatetime desc, event_id desc) as r from f1_runs where board = 'board_b' and changelist = {CAND_CL}) t where r = 1)"""


def _hist_sql(mode: str) -> str:
    if mode == "reference":
        bucket = """case when d > 0.5 then 'worse_than_50' when d > 0.2 then 'worse_than_20' when d >= 0.05 then 'worse_than_5'
                    when d < 0.05 and d > -0.05 then 'same_in_5' when d < -0.05 then 'better_than_5' end"""
    else:
        bucket = """case when d > 0.5 then 'worse_than_50' when d > 0.2 then 'worse_than_20' when d >= 0.05 then 'worse_than_5'
                    when d < -0.2 then 'better_than_20' when d < -0.05 then 'better_than_5' else 'same_in_5' end"""
    return with_fixtures("""
select count(*) filter (where bucket = 'better_than_20') as better_than_20, count(*) filter (where bucket = 'better_than_5') as better_than_5,
       count(*) filter (where bucket = 'same_in_5') as same_in_5, count(*) filter (where bucket = 'worse_than_5') as worse_than_5,
       count(*) filter (where bucket = 'worse_than_20') as worse_than_20, count(*) filter (where bucket = 'worse_than_50') as worse_than_50,
       count(*) as n_common from b
""", "f1_runs", ctes=_DUT_REF + f""",
b as (select {bucket} as bucket from (select (dut - ref) / ref as d from dut join ref using (test_case_name)) x)""")


DUT = {"board": "board_a", "changelist": CAND_CL}
REF = {"board": "board_b", "changelist": CAND_CL}


@query("a9_delta_histogram", _hist_sql("reference"))
def a9_delta_histogram(spark, sf_dir):
    return H.delta_histogram(H.dut_ref(runs(spark, sf_dir), DUT, REF), "reference")


@query("a9_delta_histogram_fixed", _hist_sql("fixed"))
def a9_delta_histogram_fixed(spark, sf_dir):
    return H.delta_histogram(H.dut_ref(runs(spark, sf_dir), DUT, REF), "fixed")


@query("j1_dut_ref", with_fixtures("""
select test_case_name, dut, ref from dut join ref using (test_case_name)
""", "f1_runs", ctes=_DUT_REF))
def j1_dut_ref(spark, sf_dir):
    return H.dut_ref(runs(spark, sf_dir), DUT, REF)


@query("a10_distinct", with_fixtures("""
select count(distinct test_case_name) as n_cases, count(distinct changelist) as n_changelists, count(distinct min_value) as n_values from f1_runs
""", "f1_runs"))
def a10_distinct(spark, sf_dir):
    return H.distinct_counts(runs(spark, sf_dir))


@query("a15_benchmark_pivots", with_fixtures("""
select algorithm, test_case_name, max(case when board = 'board_a' then min_value end) as board_a,
       max(case when board = 'board_b' then min_value end) as board_b
from lr group by 1, 2
""", "f1_runs", ctes="""lr as (select * from (select *, row_number() over (partition by algorithm, test_case_name, board
   order by changelist desc, updatetime desc, event_id desc) as r from f1_runs) t where r = 1)"""))
def a15_benchmark_pivots(spark, sf_dir):
    return H.benchmark_pivot(runs(spark, sf_dir), None, ["board_a", "board_b"])


@query("a19_series_extent", with_fixtures("""
select test_case_name, board, round(lo - f * 0.01, 6) as y_min, round(hi + f * 0.01, 6) as y_max,
       round(100 * (lo - f) / f - 1, 6) as delta_min, round(100 * (hi - f) / f + 1, 6) as delta_max from g
""", "f1_runs", ctes=RECS + """,
g as (select test_case_name, board, arg_min(min_value, changelist) as f, min(min_value) as lo, max(min_value) as hi
      from recs group by 1, 2)"""))
def a19_series_extent(spark, sf_dir):
    s = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    return H.series_extent(s)


@query("r3_report_rows", with_fixtures("""
select test_case_name, board, algorithm, changelist,
       cast(case when algorithm = 'math' then floor(cast(trunc(min_value) as bigint) / 100.0) else cast(trunc(min_value) as bigint) end as bigint) as first,
       round(100 * (avg_value - min_value) / nullif(cast(trunc(min_value) as bigint), 0), 0) as spread,
       case when algorithm = 'fft' then round(5 * n * log2(n), 6) end as work,
       case when algorithm = 'fft' then round(cast(trunc(min_value) as bigint) / (5 * n * log2(n)), 2) end as third
from (select *, cast(split_part(test_case_name, '_', -1) as bigint) as n from
  (select *, row_number() over (partition by test_case_name, board order by changelist desc, updatetime desc, event_id desc) as r from f1_runs) t
  where r = 1) x
""", "f1_runs"))
def r3_report_rows(spark, sf_dir):
    return H.report_rows(runs(spark, sf_dir))


@query("o2_rank_regressions", with_fixtures("""
select c.test_case_name, c.board, c.changelist as cand_cl, b.changelist as base_cl,
       round(100 * (c.min_value - b.min_value) / b.min_value, 6) as delta_pct
from ranked c join ranked b on c.test_case_name = b.test_case_name and c.board = b.board and c.r = 1 and b.r = 2
order by delta_pct desc, c.test_case_name, c.board limit 10
""", "f1_runs", ctes=RANKED))
def o2_rank_regressions(spark, sf_dir):
    a = R.regression_alerts(runs(spark, sf_dir)).filter(F.col("flag") == 1)
    return H.rank_regressions(a, 10).select("test_case_name", "board", "cand_cl", "base_cl", "delta_pct")


@query("q1_key_violations", with_fixtures("""
select test_case_name, board, changelist, updatetime, count(*) as n
from (select * from f1_runs union all select * from f1_runs where event_id % 97 in (0, 5)) r group by 1, 2, 3, 4 having count(*) > 1
""", "f1_runs"))
def q1_key_violations(spark, sf_dir):
    r = runs(spark, sf_dir)
    again = r.filter((F.col("event_id") % 97).isin(0, 5))  # rows that were loaded twice
    return H.key_violations(r.unionByName(again), ["test_case_name", "board", "changelist", "updatetime"])


@query("q2_multi_run_builds", with_fixtures("""
select test_case_name, board, changelist, count(*) as n from f1_runs group by 1, 2, 3 having count(*) > 1
""", "f1_runs"))
def q2_multi_run_builds(spark, sf_dir):
    return H.key_violations(runs(spark, sf_dir), list(H.RECORD))


@query("u2_common_cases", with_fixtures(f"""
select test_case_name from f1_runs where changelist = {BASE_CL} intersect select test_case_name from f1_runs where changelist = {CAND_CL}
""", "f1_runs"))
def u2_common_cases(spark, sf_dir):
    r = runs(spark, sf_dir)
    a = r.filter(F.col("changelist") == BASE_CL).select("test_case_name")
    b = r.filter(F.col("changelist") == CAND_CL).select("test_case_name")
    return a.intersect(b)


@query("u3_missing_cases", with_fixtures(f"""
select distinct test_case_name from f1_runs where changelist = {BASE_CL}
  and test_case_name not in (select test_case_name from f1_runs where changelist = {CAND_CL})
""", "f1_runs"))
def u3_missing_cases(spark, sf_dir):
    r = runs(spark, sf_dir)
    a = r.filter(F.col("changelist") == BASE_CL).select("test_case_name").distinct()
    b = r.filter(F.col("changelist") == CAND_CL).select("test_case_name")
    return a.join(b, "test_case_name", "left_anti")


@query("u4_changelist_axis", with_fixtures("""
select changelist from f1_runs where board = 'board_a' union select changelist from f1_runs where board = 'board_b'
""", "f1_runs"))
def u4_changelist_axis(spark, sf_dir):
    r = runs(spark, sf_dir)
    return (r.filter(F.col("board") == "board_a").select("changelist")
             .union(r.filter(F.col("board") == "board_b").select("changelist")).distinct())


@query("r3_report_rows_two_build", with_fixtures(f"""
select test_case_name, board, algorithm, changelist,
       case when algorithm = 'math' then round(min_value / 100, 0) else min_value end as first,
       round(100 * (avg_value - min_value) / nullif(min_value, 0), 0) as spread,
       case when algorithm = 'fft' then round(min_value / (5 * n * log2(n)), 2) end as third
from (select *, cast(split_part(test_case_name, '_', -1) as bigint) as n from
  (select *, row_number() over (partition by test_case_name, board order by updatetime desc, event_id desc) as r
   from f1_runs where changelist = {CAND_CL}) t where r = 1) x
""", "f1_runs"))
def r3_report_rows_two_build(spark, sf_dir):
    return H.report_rows(runs(spark, sf_dir), changelist=CAND_CL, variant="two_build")


_UNPIVOT = "select '{0}' as part, metric, n from (unpivot ({1}) on columns(*) into name metric value n)"


@query("r4_two_build_statistic", _UNPIVOT.format("histogram", _hist_sql("reference")) + " union all " + _UNPIVOT.format(
    "builds", "select cast(sum(better) as bigint) as better, cast(sum(worse) as bigint) as worse, cast(sum(no_change) as bigint) as no_change, "
    "cast(sum(total) as bigint) as total from (" + with_fixtures("select * from s", "f1_runs", ctes=RECS + ",\n" + _PAIRS + ",\n" + _SUMMARY) + ")"))
def r4_two_build_statistic(spark, sf_dir):
    histogram, builds = R.two_build_statistic(runs(spark, sf_dir), DUT, REF, BASE_CL, CAND_CL, threshold=5)
    builds = builds.agg(*[F.sum(c).alias(c) for c in ("better", "worse", "no_change", "total")])

    def rows(df, part):
        return df.unpivot([], df.columns, "metric", "n").select(F.lit(part).alias("part"), "metric", F.col("n").cast("bigint").alias("n"))

    return rows(histogram, "histogram").unionByName(rows(builds, "builds"))
