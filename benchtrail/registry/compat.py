"""Compatibility queries over F4 (results, rendered result logs, builds, notifications)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, with_fixtures
from benchtrail.operators import compat as C
from benchtrail.registry import query
from benchtrail.session import scratch_path
from benchtrail.sinks import writers as K
from benchtrail.sources import logs as L

KEY = list(C.KEY)
KEYS_SQL = "intrinsic_version, project_name, project_version, project_release"
DUT_V, REF_V = "1998", "1997"


def keyed(df):
    """Key columns from a result-log file name ``<version>_<project id>.log``."""
    stem = F.regexp_extract("file", r"^([^_]+)_(.*)\.log$", 2)
    p = C.split_project(stem)
    return df.select(F.regexp_extract("file", r"^([^_]+)_", 1).alias("intrinsic_version"),
                     p["project_name"].alias("project_name"), p["project_version"].alias("project_version"),
                     p["project_release"].alias("project_release"), *[c for c in df.columns if c != "file"])


def parsed(spark, sf_dir):
    details, summary = L.parse_test_results(fixture(spark, sf_dir, "f4_log_lines"))
    return keyed(details), keyed(summary)


FILE = "concat(intrinsic_version, '_', project_name, '_', project_version, '_', project_release, '.log')"


@query("s5_test_details", with_fixtures(f"select {FILE} as file, test_api, test_result from f4_results", "f4_results"))
def s5_test_details(spark, sf_dir):
    d, _ = L.parse_test_results(fixture(spark, sf_dir, "f4_log_lines"))
    return d


SUMMARY_SQL = f"""select {KEYS_SQL},
       concat(cast(count(case when test_result = 'passed' then 1 end) as varchar), '/', cast(count(*) as varchar)) as total_passed,
       concat(cast(count(case when test_result = 'failed' then 1 end) as varchar), '/', cast(count(*) as varchar)) as total_failed,
       concat(cast(count(case when test_result = 'unresolved' then 1 end) as varchar), '/', cast(count(*) as varchar)) as total_unresolved
from f4_results group by 1, 2, 3, 4"""


@query("s5_test_summary", with_fixtures(SUMMARY_SQL, "f4_results"))
def s5_test_summary(spark, sf_dir):
    _, s = parsed(spark, sf_dir)
    return s


@query("a14_result_summary", with_fixtures(SUMMARY_SQL, "f4_results"))
def a14_result_summary(spark, sf_dir):
    d, _ = parsed(spark, sf_dir)
    return C.result_summary(d, KEY)


@query("p7_split_project", with_fixtures(f"select distinct {KEYS_SQL} from f4_results", "f4_results"))
def p7_split_project(spark, sf_dir):
    d, _ = parsed(spark, sf_dir)
    return d.select(*KEY).distinct()


@query("p8_abbreviate", with_fixtures("""
select distinct config, concat(project_name, '_', project_version, '_',
       array_to_string(list_transform(string_split(project_release, '_'), lambda x: x[1]), '')) as abbreviated from f4_builds
""", "f4_builds"))
def p8_abbreviate(spark, sf_dir):
    b = fixture(spark, sf_dir, "f4_builds")
    return b.select("config", C.abbreviate(F.col("config")).alias("abbreviated")).distinct()


@query("p1_select_where", with_fixtures(f"""
select test_api, test_result from f4_results where project_name = 'Enc' and intrinsic_version = '{DUT_V}'
""", "f4_results"))
def p1_select_where(spark, sf_dir):
    return C.select_where(fixture(spark, sf_dir, "f4_results"), {"project_name": "Enc", "intrinsic_version": DUT_V},
                          "test_result", keys=["test_api"])


@query("a11_latest_version", with_fixtures("""
select project_name, project_version, project_release, coalesce(max(intrinsic_version), '') as latest_version
from f4_results group by 1, 2, 3
""", "f4_results"))
def a11_latest_version(spark, sf_dir):
    d, _ = parsed(spark, sf_dir)
    return C.latest_version(d)


@query("j3_verdict_diff", with_fixtures(f"""
select d.project_name, d.project_version, d.project_release, d.test_api, d.test_result as dut_result, r.test_result as ref_result,
       case when r.test_result is null then 'new' else 'diff' end as kind
from (select * from f4_results where intrinsic_version = '{DUT_V}') d
left join (select * from f4_results where intrinsic_version = '{REF_V}') r
  on d.project_name = r.project_name and d.project_version = r.project_version and d.project_release = r.project_release
 and d.test_api = r.test_api
where r.test_result is null or r.test_result <> d.test_result
""", "f4_results"))
def j3_verdict_diff(spark, sf_dir):
    d, _ = parsed(spark, sf_dir)
    proj = list(C.PROJECT)
    dut = d.filter(F.col("intrinsic_version") == DUT_V).drop("intrinsic_version")
    ref = d.filter(F.col("intrinsic_version") == REF_V).drop("intrinsic_version")
    return C.verdict_diff(dut, ref, proj)


@query("p12_check_results", with_fixtures(f"""
select {KEYS_SQL}, count(*) filter (where test_result = 'failed') as n_failed,
       count(*) filter (where test_result = 'unresolved') as n_unresolved,
       cast(bool_or(test_result in ('failed', 'unresolved')) as int) as flag
from f4_results group by 1, 2, 3, 4
""", "f4_results"))
def p12_check_results(spark, sf_dir):
    d, _ = parsed(spark, sf_dir)
    return C.check_results(d, KEY)


R5_CTES = f"""pairs as (select project_name, project_version, project_release, intrinsic_version,
     lag(intrinsic_version) over (partition by project_name, project_version, project_release order by intrinsic_version) as ref_version
   from (select distinct {KEYS_SQL} from f4_results) v),
cmp as (select p.intrinsic_version, p.project_name, p.project_version, p.project_release, p.ref_version,
     count(*) filter (where r.test_result is not null and r.test_result <> d.test_result) as n_diff,
     count(*) filter (where r.test_result is null and d.test_result = 'failed') as n_new_failed,
     count(*) filter (where r.test_result is null and d.test_result = 'unresolved') as n_new_unresolved
   from pairs p join f4_results d on d.intrinsic_version = p.intrinsic_version and d.project_name = p.project_name
        and d.project_version = p.project_version and d.project_release = p.project_release
   left join f4_results r on r.intrinsic_version = p.ref_version and r.project_name = p.project_name
        and r.project_version = p.project_version and r.project_release = p.project_release and r.test_api = d.test_api
   where p.ref_version is not null group by 1, 2, 3, 4, 5),
summ as ({SUMMARY_SQL})"""


@query("r5_compat_test_summary", with_fixtures(f"""
select c.intrinsic_version, c.project_name, c.project_version, c.project_release, c.ref_version,
       s.total_passed as subtotal_on_passed, s.total_failed as subtotal_on_failed, s.total_unresolved as subtotal_on_unresolved,
       case when n_diff + n_new_failed + n_new_unresolved > 0 then '{C.TESTS_FAIL}' else '{C.TESTS_PASS}' end as compare_summary,
       n_diff, n_new_failed, n_new_unresolved, cast(n_diff + n_new_failed + n_new_unresolved > 0 as int) as ret,
       'nightly_tag' as updated_by
from cmp c join summ s using ({KEYS_SQL})
""", "f4_results", ctes=R5_CTES))
def r5_compat_test_summary(spark, sf_dir):
    d, s = parsed(spark, sf_dir)
    _, test_summary, _ = C.compat_summary(d, s, updated_by="nightly_tag")
    return test_summary


@query("r5_compat_build_summary", with_fixtures(f"""
select {KEYS_SQL}, 1 as build_result, '{C.BUILD_PASSED}' as build_msg, cast(null as varchar) as updated_by from cmp
""", "f4_results", ctes=R5_CTES))
def r5_compat_build_summary(spark, sf_dir):
    d, s = parsed(spark, sf_dir)
    build, _, _ = C.compat_summary(d, s)
    return build


@query("r5_compat_rows", with_fixtures(f"""
select f.{KEYS_SQL.replace(', ', ', f.')}, test_api, test_result from f4_results f join cmp using ({KEYS_SQL})
""", "f4_results", ctes=R5_CTES))
def r5_compat_rows(spark, sf_dir):
    d, s = parsed(spark, sf_dir)
    _, _, rows = C.compat_summary(d, s)
    return rows


EXP_VERSION = "1995"


@query("j4_expectation_check", with_fixtures(f"""
select b.*, e.config is not null as expected,
       (e.config is not null and b.build_failed <> 0) or (e.config is null and b.build_failed = 0) as unexpected
from f4_builds b left join e on b.config = e.config
""", "f4_builds", ctes=f"""e as (select distinct config from f4_builds where intrinsic_version = '{EXP_VERSION}' and build_failed = 0)"""))
def j4_expectation_check(spark, sf_dir):
    b = fixture(spark, sf_dir, "f4_builds")
    exp = (b.filter((F.col("intrinsic_version") == EXP_VERSION) & (F.col("build_failed") == 0))
            .select(F.col("config").alias("line"))
            .unionByName(b.select(F.concat(F.col("project_name"), F.lit("_v9_msvs_x64")).alias("line"))))
    return C.expectation_check(b, exp, mode="contains")


@query("a18_overall", with_fixtures(f"""
select {KEYS_SQL}, cast(bool_or(build_failed <> 0 or test_failed <> 0) as int) as ret from f4_builds group by 1, 2, 3, 4
""", "f4_builds"))
def a18_overall(spark, sf_dir):
    return C.overall(fixture(spark, sf_dir, "f4_builds"), KEY, cols=("build_failed", "test_failed"))


@query("p13_removable_tags", with_fixtures(f"""
select {KEYS_SQL}, updated_by from f4_builds where updated_by like 'v%' and updated_by not like '%release'
""", "f4_builds"))
def p13_removable_tags(spark, sf_dir):
    return C.removable_tags(fixture(spark, sf_dir, "f4_builds")).select(*KEY, "updated_by")


@query("k6_update_where", with_fixtures(f"""
select {KEYS_SQL}, case when updated_by like 'v%' and updated_by not like '%release' then null else updated_by end as updated_by
from f4_builds
""", "f4_builds"))
def k6_update_where(spark, sf_dir):
    b = fixture(spark, sf_dir, "f4_builds").select(*KEY, "updated_by")
    t = F.col("updated_by")
    table = K.versioned(spark, scratch_path(spark, f"sink-out/k6-{uuid.uuid4().hex[:8]}"), "CompatBuildSummary")
    table.append(b)
    table.update(t.startswith("v") & ~t.endswith("release"), {"updated_by": None})
    return table.read().select(*KEY, "updated_by")


@query("k10_defaults", with_fixtures(f"""
select 'CompatBuildSummary' as target, cast(build_result as varchar) as a, build_msg as b, count(*) as n from
  (select {KEYS_SQL}, 1 as build_result, 'Build passed!' as build_msg from f4_builds) t group by 1, 2, 3
union all select 'CompatTestSummary', 'Tests pass', updated_by, count(*) from f4_builds group by 1, 2, 3
union all select 'Compatibility', test_result, null, count(*) from f4_results group by 1, 2, 3
union all select 'notification', 'NO', 'NO', count(*) from f4_notify group by 1, 2, 3
union all select 'release_version_tag', tag, null, count(*) from (select distinct cast(intrinsic_version as bigint) as changelist, min(updated_by) as tag from f4_builds group by intrinsic_version) t group by 1, 2, 3
union all select 'test_case_hierarchy', case when parent is null then 'root' else 'child' end, null, count(distinct id) from f5_specs group by 1, 2, 3
""", "f4_results", "f4_builds", "f4_notify", "f5_specs"))
def k10_defaults(spark, sf_dir):
    root = scratch_path(spark, f"sink-out/k10-{uuid.uuid4().hex[:8]}")
    builds, notify = fixture(spark, sf_dir, "f4_builds"), fixture(spark, sf_dir, "f4_notify")
    tags = builds.groupBy(F.col("intrinsic_version").cast("bigint").alias("changelist")).agg(F.min("updated_by").alias("tag"))
    specs = fixture(spark, sf_dir, "f5_specs").select(F.col("id").alias("test_case_name"), F.col("parent").alias("parent_test_case")).distinct()
    given = {"CompatBuildSummary": (builds.select(*KEY), F.col("build_result").cast("string"), F.col("build_msg")),
             "CompatTestSummary": (builds.select(*KEY, "updated_by"), F.col("compare_summary"), F.col("updated_by")),
             "Compatibility": (fixture(spark, sf_dir, "f4_results"), F.col("test_result"), F.lit(None).cast("string")),
             "notification": (notify.select("changelist", "author"), F.col("emailed"), F.col("ack")),
             "release_version_tag": (tags, F.col("tag"), F.lit(None).cast("string")),
             "test_case_hierarchy": (specs, F.when(F.col("parent_test_case").isNull(), "root").otherwise("child"), F.lit(None).cast("string"))}
    out = None
    for name, (rows, a, b) in given.items():
        table = K.versioned(spark, root, name)
        table.append(rows)
        counted = table.read().groupBy(F.lit(name).alias("target"), a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("k4_write_routed", with_fixtures(f"""
select 'Compatibility' as target, {KEYS_SQL}, test_api as a, test_result as b, null as c from f4_results join cmp using ({KEYS_SQL})
union all select 'CompatTestSummary', {KEYS_SQL}, s.total_passed, concat(s.total_failed, ' ', s.total_unresolved),
  case when n_diff + n_new_failed + n_new_unresolved > 0 then '{C.TESTS_FAIL}' else '{C.TESTS_PASS}' end from cmp join summ s using ({KEYS_SQL})
union all select 'CompatBuildSummary', {KEYS_SQL}, '1', '{C.BUILD_PASSED}', null from cmp
""", "f4_results", ctes=R5_CTES))
def k4_write_routed(spark, sf_dir):
    root = scratch_path(spark, f"sink-out/k4-{uuid.uuid4().hex[:8]}")
    K.write_routed(C.compat_summary(*parsed(spark, sf_dir)), root)
    read = {"Compatibility": ("test_api", "test_result", F.lit(None).cast("string")),
            "CompatTestSummary": ("subtotal_on_passed", F.concat_ws(" ", "subtotal_on_failed", "subtotal_on_unresolved"), "compare_summary"),
            "CompatBuildSummary": (F.col("build_result").cast("string"), "build_msg", "updated_by")}
    parts = [spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("target"), *KEY, *[(F.col(c) if isinstance(c, str) else c).alias(x) for c, x in zip(cols, "abc")])
             for n, cols in read.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("p17_pending_notifications", with_fixtures("""
select changelist, author, concat('Performance issue on changelist ', cast(changelist as varchar)) as subject,
       concat('Hi ', author, ', changelist ', cast(changelist as varchar), ' introduced a performance drop; please acknowledge it.') as message
from f4_notify where emailed = 'NO'
""", "f4_notify"))
def p17_pending_notifications(spark, sf_dir):
    return C.pending_notifications(fixture(spark, sf_dir, "f4_notify"))


@query("s15_read_expected", with_fixtures("select distinct config from f4_builds where build_failed = 0", "f4_builds"))
def s15_read_expected(spark, sf_dir):
    ok = fixture(spark, sf_dir, "f4_builds").filter("build_failed = 0")
    lines = ok.select(F.explode(F.array(F.concat(F.lit("  "), F.col("config"), F.lit(" ")), F.lit(""), F.col("config"))).alias("line"))
    return L.read_expected(lines)
