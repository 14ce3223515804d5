"""Culprit-search queries over F1: midpoints, bisection over recorded values,
nearest buildable build, culprit authors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, with_fixtures
from benchtrail.operators import bisect as B
from benchtrail.operators import history as H
from benchtrail.operators import search as Q
from benchtrail.plans import regression as R
from benchtrail.registry import query
from benchtrail.registry.history import RANGE, RECS
from benchtrail.session import scratch_path

KEYS = ["test_case_name", "board"]
THR = 10.0

CHANGES_SQL = """select distinct changelist, concat('dev_', cast((changelist / 10) % 13 as varchar(4))) as author from f1_runs"""
BUILDS_SQL = """select distinct changelist, changelist % 130 >= 60 as build_ok from f1_runs"""


def runs(spark, sf_dir):
    return fixture(spark, sf_dir, "f1_runs")


def range_alerts(spark, sf_dir):
    a = R.regression_alerts(runs(spark, sf_dir), cl_range=RANGE, threshold=THR)
    return a.filter(F.col("alert") & (F.col("flag") == 1))


ALERT_CTES = RECS + f""",
lat as (select * from (select *, row_number() over (partition by test_case_name, board order by changelist desc) as r from recs) t where r = 1),
bas as (select test_case_name, board, max(changelist) as base_cl, avg(min_value) as base_value from recs
        where changelist between {RANGE[0]} and {RANGE[1]} group by 1, 2),
rng as (select l.test_case_name, l.board, b.base_cl, l.changelist as cand_cl, b.base_value from lat l join bas b using (test_case_name, board)
        where 100 * (l.min_value - b.base_value) / b.base_value > {THR}),
pos as (select r.test_case_name, r.board, r.changelist,
               cast(row_number() over (partition by r.test_case_name, r.board order by r.changelist) - 1 as bigint) as idx,
               r.min_value > a.base_value * (1 + {THR} / 100) as fail
        from recs r join rng a on r.test_case_name = a.test_case_name and r.board = a.board),
init as (select a.test_case_name, a.board, a.base_cl as good_cl, a.cand_cl as bad_cl, pl.idx as lo, ph.idx as hi from rng a
         join pos pl on pl.test_case_name = a.test_case_name and pl.board = a.board and pl.changelist = a.base_cl
         join pos ph on ph.test_case_name = a.test_case_name and ph.board = a.board and ph.changelist = a.cand_cl)"""

MID = "(s.hi - (s.hi - s.lo + 1) // 2)"
BISECT_CTES = ALERT_CTES + f""",
st (test_case_name, board, good_cl, bad_cl, lo, hi, lo0, done, rounds) as (
  select test_case_name, board, good_cl, bad_cl, lo, hi, lo, false, 0 from init
  union all
  select s.test_case_name, s.board, s.good_cl, s.bad_cl,
         case when {MID} = s.lo then s.lo when coalesce(p.fail, false) then s.lo else {MID} end,
         case when {MID} = s.lo then s.hi when coalesce(p.fail, false) then {MID} else s.hi end,
         s.lo0, {MID} = s.lo, s.rounds + case when {MID} = s.lo then 0 else 1 end
  from st s left join pos p on p.test_case_name = s.test_case_name and p.board = s.board and p.idx = {MID}
  where not s.done),
fin as (select s.test_case_name, s.board, s.good_cl, s.bad_cl,
               case when s.lo = s.lo0 and coalesce(pl.fail, false) then null else ph.changelist end as culprit_cl, s.rounds
        from st s left join pos pl on pl.test_case_name = s.test_case_name and pl.board = s.board and pl.idx = s.lo
        left join pos ph on ph.test_case_name = s.test_case_name and ph.board = s.board and ph.idx = s.hi
        where s.done)"""


def _rec(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


@query("w8_next_midpoint", with_fixtures("""
select i.test_case_name, i.board, i.good_cl, i.bad_cl, p.changelist as mid_cl
from init i join pos p on p.test_case_name = i.test_case_name and p.board = i.board and p.idx = i.hi - (i.hi - i.lo + 1) // 2
""", "f1_runs", ctes=ALERT_CTES))
def w8_next_midpoint(spark, sf_dir):
    recs = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    a = range_alerts(spark, sf_dir).select(*KEYS, F.col("base_cl").alias("good_cl"), F.col("cand_cl").alias("bad_cl"))
    axis = B.axis_positions(recs.join(a.select(*KEYS), KEYS, "left_semi"), KEYS)
    return B.next_midpoint(axis, a, KEYS)


@query("w9_first_bad", _rec(with_fixtures("select * from fin", "f1_runs", ctes=BISECT_CTES)))
def w9_first_bad(spark, sf_dir):
    recs = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["min_value"])
    a = range_alerts(spark, sf_dir)
    verdicts = (recs.join(a.select(*KEYS, "base_value"), KEYS)
                    .select(*KEYS, "changelist", (F.col("min_value") > F.col("base_value") * (1 + THR / 100)).alias("fail")))
    return B.first_bad(verdicts, a.select(*KEYS, F.col("base_cl").alias("good_cl"), F.col("cand_cl").alias("bad_cl")), KEYS)


@query("r8_culprit_search", _rec(with_fixtures("""
select f.*, c.author, 'NO' as emailed from fin f left join changes c on f.culprit_cl = c.changelist
""", "f1_runs", ctes=BISECT_CTES + ",\nchanges as (" + CHANGES_SQL + ")")))
def r8_culprit_search(spark, sf_dir):
    r = runs(spark, sf_dir)
    recs = H.latest_record(r, H.RECORD, values=["min_value"])
    changes = spark.sql(CHANGES_SQL)
    return B.culprit_search(range_alerts(spark, sf_dir), recs, changes, THR)


@query("w10_nearest_buildable", with_fixtures("""
select w.changelist, (select c.changelist from ax c where c.i between w.i - 4 and w.i and c.build_ok
                      order by c.i desc limit 1) as buildable_cl
from ax w
""", "f1_runs", ctes="b as (" + BUILDS_SQL + "),\nax as (select changelist, build_ok, cast(dense_rank() over (order by changelist) as bigint) as i from b)"))
def w10_nearest_buildable(spark, sf_dir):
    runs(spark, sf_dir)
    builds = spark.sql(BUILDS_SQL)
    return B.nearest_buildable(builds, builds.select("changelist"), k=5)


@query("l2_nightly_culprits", _rec(with_fixtures("""
select f.*, c.author, 'NO' as emailed from fin f left join changes c on f.culprit_cl = c.changelist
""", "f1_runs", ctes=BISECT_CTES + ",\nchanges as (" + CHANGES_SQL + ")")))
def l2_nightly_culprits(spark, sf_dir):
    from benchtrail.plans.nightly import nightly_report
    r = runs(spark, sf_dir)
    return nightly_report(r, spark.sql(CHANGES_SQL), threshold=THR, cl_range=RANGE)["culprits"]


# the change axis is every build of the fixture; results exist only for the
# builds a series has records for (sparse history)
NEXT_CTES = ALERT_CTES + """,
ax as (select changelist, cast(dense_rank() over (order by changelist) - 1 as bigint) as g from (select distinct changelist from f1_runs) c),
rg as (select a.test_case_name, a.board, a.base_cl as good_cl, a.cand_cl as bad_cl, l.g as lo, h.g as hi
       from rng a join ax l on l.changelist = a.base_cl join ax h on h.changelist = a.cand_cl),
md as (select r.*, x.changelist as mid_cl from rg r join ax x on x.g = r.hi - (r.hi - r.lo + 1) // 2
       where r.hi - (r.hi - r.lo + 1) // 2 <> r.lo)"""


@query("w9_next_tests", with_fixtures("""
select md.test_case_name, md.board, md.good_cl, md.bad_cl, md.mid_cl,
       exists (select 1 from recs r where r.test_case_name = md.test_case_name and r.board = md.board
               and r.changelist = md.mid_cl) as tested
from md
""", "f1_runs", ctes=NEXT_CTES))
def w9_next_tests(spark, sf_dir):
    r = runs(spark, sf_dir)
    recs = H.latest_record(r, H.RECORD, values=["min_value"])
    a = range_alerts(spark, sf_dir)
    verdicts = recs.select(*KEYS, "changelist", F.lit(False).alias("fail"))
    return B.next_tests(r.select("changelist"), verdicts,
                        a.select(*KEYS, F.col("base_cl").alias("good_cl"), F.col("cand_cl").alias("bad_cl")), KEYS)


# three of seven builds never build, so midpoints have to move and some ranges hold no build at all
SEARCH_CTES = ALERT_CTES + """,
gaps as (select changelist, cast(floor(changelist / 10) as bigint) % 7 not in (2, 3, 4) as build_ok from (select distinct changelist from f1_runs) c),
ax as (select changelist, build_ok, cast(row_number() over (order by changelist) - 1 as bigint) as g from gaps),
near as (select g, max(case when build_ok then g end) over (order by g) as before, min(case when build_ok then g end) over (order by g desc) as after from ax),
s0 as (select a.test_case_name, a.board, a.base_cl as good_cl, a.cand_cl as bad_cl, l.g as lo, h.g as hi, l.g as lo0 from rng a join ax l on l.changelist = a.base_cl join ax h on h.changelist = a.cand_cl),
vd as (select p.test_case_name, p.board, x.g, p.fail from pos p join ax x on x.changelist = p.changelist),
walk as (
  select test_case_name, board, good_cl, bad_cl, lo, hi, lo0, 0 as rounds, 'open' as status, cast(null as bigint) as nxt from s0
  union all
  select q.test_case_name, q.board, q.good_cl, q.bad_cl, case when q.pick is not null and not v.fail then q.pick else q.lo end,
         case when q.pick is not null and v.fail then q.pick else q.hi end, q.lo0, q.rounds + case when q.pick is not null and v.fail is not null then 1 else 0 end,
         case when q.look is null then 'found' when v.fail is null then 'waiting' when q.pick is null and v.fail then 'no answer' when q.pick is null then 'found' else 'open' end,
         case when q.look is not null and v.fail is null then q.look end
  from (select t.*, coalesce(t.pick, case when t.lo = t.lo0 then t.lo end) as look from
    (select u.*, case when older is null then newer when newer is null then older when mid - older <= newer - mid then older else newer end as pick from
      (select w.*, n.g as mid, case when n.before > w.lo and n.before < w.hi then n.before end as older, case when n.after > w.lo and n.after < w.hi then n.after end as newer
       from walk w join near n on n.g = w.hi - (w.hi - w.lo + 1) // 2 where w.status = 'open') u) t) q
  left join vd v on v.test_case_name = q.test_case_name and v.board = q.board and v.g = q.look)"""


@query("w9_resumable_search", _rec(with_fixtures("""
select w.test_case_name, w.board, w.good_cl, w.bad_cl, l.changelist as lo_cl, h.changelist as hi_cl, w.status, n.changelist as next_cl, w.rounds
from walk w join ax l on l.g = w.lo join ax h on h.g = w.hi left join ax n on n.g = w.nxt where w.status <> 'open'
""", "f1_runs", ctes=SEARCH_CTES)))
def w9_resumable_search(spark, sf_dir):
    r = runs(spark, sf_dir)
    recs = H.latest_record(r, H.RECORD, values=["min_value"])
    a = range_alerts(spark, sf_dir)
    verdicts = (recs.join(a.select(*KEYS, "base_value"), KEYS)
                    .select(*KEYS, "changelist", (F.col("min_value") > F.col("base_value") * (1 + THR / 100)).alias("fail")))
    builds = r.select("changelist").distinct().withColumn("build_ok", ~(F.floor(F.col("changelist") / 10) % 7).isin(2, 3, 4))
    search = Q.CulpritSearch(spark, scratch_path(spark, f"search/{uuid.uuid4().hex[:8]}"), KEYS)
    search.begin(a.select(*KEYS, F.col("base_cl").alias("good_cl"), F.col("cand_cl").alias("bad_cl")), r.select("changelist"), builds)
    for known in ("changelist % 30 = 0", "changelist % 20 = 0 or changelist % 30 = 0", "true"):  # results come in over three sessions
        search.resume(r.select("changelist"), builds, verdicts.filter(known))
    return search.state()
