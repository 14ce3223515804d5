"""Acceptance queries over F5 (comparator logs, spec hierarchy, results)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, raw, with_fixtures
from benchtrail.operators import accept as A
from benchtrail.operators import compat as C
from benchtrail.registry import query
from benchtrail.session import scratch_path


def specs(spark, sf_dir):
    """Spec rows shaped like the XML scan (id, parent, steps in order)."""
    rows = fixture(spark, sf_dir, "f5_specs")
    steps = F.array_sort(F.collect_list(F.struct("step_no", F.col("step_type").alias("type"), "processor")))
    return (rows.groupBy("id", "parent").agg(steps.alias("_s"))
                .select("id", "parent", F.transform("_s", lambda s: F.struct(s["type"].alias("type"),
                                                                          s["processor"].alias("processor")))
                        .alias("steps")))


def metrics(spark, sf_dir):
    return A.parse_metric_sections(fixture(spark, sf_dir, "f5_log_lines"))


CASE = "concat('case_', cast(case_id as varchar(12)))"
BAD = "case_id % 17 = 5"
EXTRA = "case_id % 19 = 7"
# the first threshold section of a misnested log is never closed, so its second one counts as its first
AT = f"case when kind = 'threshold' and {BAD} then segment - 2 else segment - 1 end"
CLOSED = f"not (kind = 'threshold' and {BAD} and segment = 1)"

PAIRS = f"""t as (select {CASE} as file, {AT} as segment, type, value as thr from f5_metric where kind = 'threshold' and {CLOSED}),
e as (select {CASE} as file, segment - 1 as segment, type, value as err from f5_metric where kind = 'error'),
pr as (select coalesce(t.file, e.file) as file, coalesce(t.segment, e.segment) as segment, coalesce(t.type, e.type) as type, thr, err
       from t full outer join e on t.file = e.file and t.segment = e.segment and t.type = e.type),
ok as (select file, bool_or(thr is null or err is null) as mism,
              bool_and(coalesce((case when type <> 'median' then err < 1.0 else err < 0.5 or (thr >= 0.5 and err < 1.0) end)
                       or (thr < 10.0 and err - thr < 0.1) or (thr >= 10.0 and err - thr < 1.0), false)) as all_ok
       from pr group by file),
bad as (select distinct {CASE} as file from f5_metric where {BAD}),
wrong as (select distinct {CASE} as file from f5_metric where {BAD} or {EXTRA}),
verdict as (select ok.file, (mism or wrong.file is not null) as case_error,
                   not (mism or wrong.file is not null) and all_ok as accepted from ok left join wrong on ok.file = wrong.file)"""


@query("s8_metric_sections", with_fixtures(f"""
select {CASE} as file, kind, cast({AT} as int) as segment, type, value from f5_metric where {CLOSED}
""", "f5_metric"))
def s8_metric_sections(spark, sf_dir):
    return metrics(spark, sf_dir)[0]


@query("s8_case_errors", with_fixtures(f"""
select {CASE} as file, {BAD} as error,
       count(distinct segment) + case when {EXTRA} then 1 else 0 end - case when {BAD} then 1 else 0 end as n_threshold,
       count(distinct segment) as n_error
from f5_metric group by case_id
""", "f5_metric"))
def s8_case_errors(spark, sf_dir):
    return metrics(spark, sf_dir)[1]


@query("j8_pair_metrics", with_fixtures("select file, cast(segment as int) as segment, type, thr, err from pr",
                                        "f5_metric", ctes=PAIRS))
def j8_pair_metrics(spark, sf_dir):
    return A.pair_metrics(metrics(spark, sf_dir)[0])


@query("a17_accept_cases", with_fixtures("select file, case_error, accepted from verdict", "f5_metric", ctes=PAIRS))
def a17_accept_cases(spark, sf_dir):
    m, errs = metrics(spark, sf_dir)
    return A.accept_cases(A.pair_metrics(m), errs, cases=fixture(spark, sf_dir, "f5_log_lines"))


TOOLS_REC = """own as (select s.id, s.parent, e.processor as tool from (select distinct id, parent from f5_specs) s
    left join (select id, min(step_no) as first_eval from f5_specs where step_type = 'eval' group by id) fe on s.id = fe.id
    left join f5_specs e on e.id = fe.id and e.step_no = fe.first_eval),
walk (id, cur, tool, depth) as (select id, parent, tool, 0 from own
    union all select w.id, o.parent, o.tool, w.depth + 1 from walk w join own o on w.cur = o.id where w.tool is null and w.depth < 64),
tools as (select id, arg_min(tool, depth) filter (where tool is not null) as tool from walk group by id)"""


def _recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


# specs that are each other's parent, beside the hierarchy; the last one may miss its partner
PARTNER = "s_suppkey + case when s_suppkey % 2 = 0 then 1 else -1 end"


@query("j9_resolve_tools", _recursive(with_fixtures("""select id, tool, false as cycle from tools
union all select concat('loop_', cast(s_suppkey as varchar)), null, """ + PARTNER + """ in (select s_suppkey from supplier) from supplier""", "f5_specs", ctes=TOOLS_REC)))
def j9_resolve_tools(spark, sf_dir):
    hierarchy = specs(spark, sf_dir)
    loops = raw(spark, sf_dir, "supplier").select(
        F.concat(F.lit("loop_"), F.col("s_suppkey").cast("string")).alias("id"), F.concat(F.lit("loop_"), F.expr(PARTNER).cast("string")).alias("parent"),
        F.array().cast(hierarchy.schema["steps"].dataType).alias("steps"))
    return A.resolve_tools(hierarchy.unionByName(loops))


R6 = TOOLS_REC + ",\n" + PAIRS + """,
acc as (select v.file as test_api from verdict v join tools t on v.file = t.id where v.accepted and t.tool = 'FREQCMP'),
relab as (select r.test_api, case when r.test_result = 'failed' and a.test_api is not null then 'passed' else r.test_result end as test_result,
                 (r.test_result = 'failed' and a.test_api is not null) as relabeled
          from f5_results r left join acc a on r.test_api = a.test_api)"""


@query("r6_accept_failures", _recursive(with_fixtures("select test_api, test_result, relabeled from relab",
                                                      "f5_metric", "f5_specs", "f5_results", ctes=R6)))
def r6_accept_failures(spark, sf_dir):
    return A.accept_failures(fixture(spark, sf_dir, "f5_results"), fixture(spark, sf_dir, "f5_log_lines"),
                             specs(spark, sf_dir))


@query("a14_relabeled_summary", _recursive(with_fixtures("""
select concat(cast(count(*) filter (where test_result = 'passed') as varchar), '/', cast(count(*) as varchar)) as total_passed,
       concat(cast(count(*) filter (where test_result = 'failed') as varchar), '/', cast(count(*) as varchar)) as total_failed,
       concat(cast(count(*) filter (where test_result = 'unresolved') as varchar), '/', cast(count(*) as varchar)) as total_unresolved
from relab
""", "f5_metric", "f5_specs", "f5_results", ctes=R6)))
def a14_relabeled_summary(spark, sf_dir):
    r = A.accept_failures(fixture(spark, sf_dir, "f5_results"), fixture(spark, sf_dir, "f5_log_lines"),
                          specs(spark, sf_dir))
    # the summary of the original log, corrected by the re-labelled count
    original = r.withColumn("test_result", F.when(F.col("relabeled"), F.lit("failed")).otherwise(F.col("test_result")))
    return C.result_summary(original, relabeled="relabeled")


@query("s9_read_specs", with_fixtures("""
select id, parent, cast(row_number() over (partition by id order by step_no) - 1 as int) as pos, step_type as type, processor from f5_specs
""", "f5_specs"))
def s9_read_specs(spark, sf_dir):
    """Specs written as XML files and read back."""
    folder = scratch_path(spark, f"specs-{uuid.uuid4().hex[:8]}")
    (specs(spark, sf_dir).select(F.col("id").alias("_id"), F.col("parent").alias("_parent"),
                                 F.transform("steps", lambda x: F.struct(x["type"].alias("_type"), x["processor"].alias("processor"))).alias("step"))
     .write.format("xml").option("rootTag", "testspecs").option("rowTag", "testspec").save(folder))
    return A.read_specs(spark, folder).select("id", "parent", F.posexplode("steps").alias("pos", "s")).select(
        "id", "parent", "pos", F.col("s.type").alias("type"), F.col("s.processor").alias("processor"))
