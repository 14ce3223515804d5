"""Fixture views F1-F5: rows of the reference's logical schemas derived from
the driver's test tables.

The SQL text is portable: Spark registers each as a temp view, the DuckDB
oracle inlines the same text as a CTE (see ``with_fixtures``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benchtrail.functions.scan import TASK_ROWS

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations")

# profile runs. Grain of a "latest record" is (test_case_name, board, changelist);
# loop_no numbers the repeated runs of one case and build, event_id breaks ties.
F1_RUNS = """
select concat(algorithm, '_', event_type, '_', cast(size_n as varchar(8))) as test_case_name, algorithm, size_n,
       board, changelist, updatetime, event_id,
       cast(row_number() over (partition by algorithm, event_type, size_n, board, changelist order by updatetime, event_id) as bigint) as loop_no,
       value * 1.2e0 as max_value, value as min_value, value * 1.1e0 as avg_value
from (select event_id, event_type, value, ts as updatetime,
        case user_id % 5 when 0 then 'fft' when 1 then 'dct' when 2 then 'qmf' when 3 then 'math' else 'blkvec' end as algorithm,
        cast(power(2, 4 + user_id % 6) as bigint) as size_n,
        case cast(floor(user_id / 30) as bigint) % 2 when 0 then 'board_a' else 'board_b' end as board,
        cast(2000000 + 10 * day(ts) as bigint) as changelist
      from events) e
"""

# profile log lines, one file per (changelist, board, loop_no).
F2_PROFILE_LINES = """
select concat('run_', cast(changelist as varchar(12)), '_', board, '_', cast(loop_no as varchar(8)), '.log') as file,
       cast(row_number() over (partition by changelist, board, loop_no order by test_case_name, k) as bigint) as line_no,
       case k when 0 then concat('Node Name        : ', test_case_name)
              when 1 then concat('Total            : ', cast(cast(floor(avg_value * 100) as bigint) as varchar(20)), ' cycles')
              when 2 then concat('Max              : ', cast(cast(floor(max_value * 100) as bigint) as varchar(20)), ' cycles')
              when 3 then concat('Min              : ', cast(cast(floor(min_value * 100) as bigint) as varchar(20)), ' cycles')
              when 4 then concat('Avg              : ', cast(cast(floor(avg_value * 100) as bigint) as varchar(20)), ' cycles')
              else concat('Number of Calls  : ', cast(1 + event_id % 7 as varchar(8))) end as line
from f1_runs cross join (select 0 as k union all select 1 union all select 2 union all select 3 union all select 4 union all select 5) n
"""

# F2 (environment): one key=value file per (changelist, board); a value with a
# second '=' and a repeated key (last wins) included.
F2_ENV_LINES = """
select concat('env_', cast(changelist as varchar(12)), '_', board, '.txt') as file, cast(k + 1 as bigint) as line_no,
       case k when 0 then concat('cmd=bench --runs ', cast(changelist % 7 as varchar(4)))
              when 1 then concat('backend=', case when board = 'board_a' then 'neon' else 'c66x' end)
              when 2 then concat('board=', board)
              when 3 then concat('changelist=', cast(changelist as varchar(12)))
              when 4 then 'compiler=gcc=4.9'
              else concat('backend=', case when changelist % 20 = 0 then 'sse' else 'neon' end) end as line
from (select distinct changelist, board from f1_runs) r
cross join (select 0 as k union all select 1 union all select 2 union all select 3 union all select 4 union all select 5) n
"""

# operator usage, API universe, coverage trace.
F3_USAGE = """
select concat('op_', cast(l_partkey % 300 as varchar(8))) as api, concat('prod_', cast(l_suppkey % 3 as varchar(8))) as product,
       cast(year(l_shipdate) as bigint) as changelist, cast(sum(cast(l_quantity as bigint)) as bigint) as total
from lineitem where l_partkey % 4 <> 3 or l_suppkey % 3 = 0 group by 1, 2, 3
"""

F3_API = """
select concat('op_', cast(p_partkey as varchar(8))) as api, p_brand as category, p_size = 1 as deprecated, p_size > 45 as is_macro from part
"""

F3_TRACE = """
select concat('FNDA:', cast(count(case when l_returnflag = 'A' and l_quantity > 45 then 1 end) as varchar(12)), ',op_', cast(l_partkey as varchar(8))) as line
from lineitem group by l_partkey
"""

# F3 (usage trees): one count log per (product, changelist): a root node with
# one detail line per api, a TOTAL line, then one child node per api.
F3_USAGE_LINES = """
select concat('count_', product, '_', cast(changelist as varchar(8)), '.log') as file, cast(line_no as bigint) as line_no, line from (
  select product, changelist, 1 as line_no, 'frame_process proc (entered 3 times)' as line
  from (select distinct product, changelist from f3_usage) p
  union all
  select product, changelist, 1 + row_number() over (partition by product, changelist order by api) as line_no,
         concat('    ', api, '  ', cast(total as varchar(20)), '  ', cast(total as varchar(20))) as line from f3_usage
  union all
  select product, changelist, 2 + count(*) as line_no, concat('    TOTAL  1  ', cast(sum(total) as varchar(20))) as line
  from f3_usage group by product, changelist
  union all
  select product, changelist,
         2 + count(*) over (partition by product, changelist) + row_number() over (partition by product, changelist order by api) as line_no,
         concat('  hl_', api, ' op (entered ', cast(total % 9 + 1 as varchar(4)), ' times)') as line from f3_usage
) u
"""

# F3 (deep usage trees): one log per brand, one subtree per part: a (2) > stage (4) >
# c and d (6), under every third d a deep node (8), then leaf (4) under a. The stage and
# a are returned to by closing headers; every fourth group has a closing header of no
# node. Only c has a TOTAL line; details after a closing header are lost.
F3_TREE = """
select concat('tree_', cast(brand as varchar(20)), '.log') as file, g, k, size, kind, name, indent, times from (
  select brand, cast(0 as bigint) as g, 0 as k, 0 as size, 'h' as kind, 'frame_process' as name, 0 as indent, cast(2 as bigint) as times from (select distinct p_brand as brand from part) b
  union all select brand, g, 1, size, 'h', concat('hl_a', cast(g as varchar(12))), 2, cast(1 + size % 5 as bigint) from f3_groups
  union all select brand, g, 2, size, 'h', concat('stage', cast(g as varchar(12))), 4, cast(2 as bigint) from f3_groups
  union all select brand, g, 3, size, 'h', concat('hl_c', cast(g as varchar(12))), 6, cast(size as bigint) from f3_groups
  union all select brand, g, 4, size, 'd', concat('api_', cast(size % 7 as varchar(12))), 8, cast(size + 10 as bigint) from f3_groups
  union all select brand, g, 5, size, 'd', 'TOTAL', 8, cast(size + 10 as bigint) from f3_groups
  union all select brand, g, 6, size, 'h', concat('hl_d', cast(g as varchar(12))), 6, cast(0 as bigint) from f3_groups
  union all select brand, g, 7, size, 'h', concat('deep', cast(g as varchar(12))), 8, cast(1 as bigint) from f3_groups where g % 3 = 0
  union all select brand, g, 8, size, 'd', 'api_x', 10, cast(4 as bigint) from f3_groups
  union all select brand, g, 9, size, 'c', concat('stage', cast(g as varchar(12))), 4, cast(9 as bigint) from f3_groups
  union all select brand, g, 10, size, 'd', 'api_lost', 8, cast(7 as bigint) from f3_groups
  union all select brand, g, 11, size, 'o', concat('ghost', cast(g as varchar(12))), 2, cast(1 as bigint) from f3_groups where g % 4 = 1
  union all select brand, g, 12, size, 'c', concat('hl_a', cast(g as varchar(12))), 2, cast(9 as bigint) from f3_groups
  union all select brand, g, 13, size, 'h', concat('leaf', cast(g as varchar(12))), 4, cast(3 as bigint) from f3_groups
  union all select brand, g, 14, size, 'c', concat('hl_a', cast(g as varchar(12))), 2, cast(9 as bigint) from f3_groups) t
"""
F3_GROUPS = """
select p_brand as brand, cast(row_number() over (partition by p_brand order by p_partkey) as bigint) as g, p_size as size from part
"""

F3_TREE_LINES = """
select file, cast(row_number() over (partition by file order by g, k) as bigint) as line_no,
       case kind when 'd' then concat(substring('            ', 1, indent), name, '  ', cast(times as varchar(12)), '.5  ', cast(times as varchar(12)))
                 else concat(substring('            ', 1, indent), name, ' op (entered ', cast(times as varchar(12)), ' times)') end as line
from f3_tree
"""

# F3 (coverage): header lines per category (one "poison" line per API with a
# comment, a #define for macro APIs) and report lines (covered when the span
# class is lineCov; some calls pass the API as the first argument).
F3_HEADER_LINES = """
select concat('hdr_', category, '.h') as file, cast(row_number() over (partition by category order by api, k) as bigint) as line_no, line
from (select api, category, 0 as k, concat('#pragma GCC poison ', api, ' /* category ', category, ' */') as line from f3_api
      union all
      select api, category, 1 as k, concat('#define ', api, case when length(api) % 2 = 0 then '(x) ((x) + 1)' else ' 42' end)
      from f3_api where is_macro) h
"""

F3_REPORT_LINES = """
select concat('<span class="', case when p_size % 3 = 0 then 'lineCov' else 'lineNoCov' end, '">    ',
              case when p_size % 5 = 0 then concat('acc = wrap(op_', cast(p_partkey as varchar(8)), ', 3);')
                   else concat('acc = op_', cast(p_partkey as varchar(8)), '(buf, n);') end, '</span>') as line
from part
"""

# functional test results, REF = one year, DUT = the next. One configuration passes all its cases from 1996 on.
F4_RESULTS = """
select intrinsic_version, project_name, project_version, project_release, test_api,
       case when clean then 'passed' when status = 'F' then 'passed' when status = 'P' then 'failed' else 'unresolved' end as test_result
from (select cast(year(o_orderdate) as varchar(4)) as intrinsic_version,
        case o_custkey % 3 when 0 then 'Mixer' when 1 then 'Dec_Pro' else 'Enc' end as project_name,
        'v1.0' as project_version, case o_custkey % 2 when 0 then 'generic_float_release' else 'neon_int_debug' end as project_release,
        concat('case_', cast(o_custkey % 400 as varchar(8))) as test_api, o_orderstatus as status,
        year(o_orderdate) >= 1996 and o_custkey % 3 = 2 and o_custkey % 2 = 1 as clean,
        row_number() over (partition by year(o_orderdate), o_custkey % 3, o_custkey % 2, o_custkey % 400 order by o_orderkey desc) as rn
      from orders) o where rn = 1
"""

# F4 (logs): one result log per (version, project) rendered from F4: one line
# per case, then the three summary lines.
F4_LOG_LINES = """
select concat(intrinsic_version, '_', project_name, '_', project_version, '_', project_release, '.log') as file,
       cast(rn as bigint) as line_no,
       concat(cast(rn as varchar(8)), '/', cast(n as varchar(8)), ' ', test_api, '... ', upper(test_result)) as line
from (select *, row_number() over (partition by intrinsic_version, project_name, project_version, project_release order by test_api) as rn,
             count(*) over (partition by intrinsic_version, project_name, project_version, project_release) as n from f4_results) r
union all
select concat(intrinsic_version, '_', project_name, '_', project_version, '_', project_release, '.log') as file,
       cast(n + k as bigint) as line_no,
       concat(case k when 1 then 'PASSED: ' when 2 then 'FAILED: ' else 'UNRESOLVED: ' end,
              cast(case k when 1 then p when 2 then f else u end as varchar(8)), '/', cast(n as varchar(8))) as line
from (select intrinsic_version, project_name, project_version, project_release, count(*) as n,
             count(case when test_result = 'passed' then 1 end) as p, count(case when test_result = 'failed' then 1 end) as f,
             count(case when test_result = 'unresolved' then 1 end) as u
      from f4_results group by 1, 2, 3, 4) s
cross join (select 1 as k union all select 2 union all select 3) kk
"""

# F4 (builds): one build per (version, project) with a failed flag (every third, others each year) and a tag.
F4_BUILDS = """
select intrinsic_version, project_name, project_version, project_release,
       concat(project_name, '_', project_version, '_', project_release) as config,
       case when (cast(intrinsic_version as int) + length(project_name) + length(project_release)) % 3 = 0 then 1 else 0 end as build_failed,
       case when count(case when test_result <> 'passed' then 1 end) > 0 then 1 else 0 end as test_failed,
       case cast(intrinsic_version as int) % 4 when 0 then concat('v', intrinsic_version, '_release')
            when 1 then concat('v', intrinsic_version, '_rc') when 2 then 'nightly' else 'V_upper' end as updated_by
from f4_results group by 1, 2, 3, 4
"""

# F4 (notifications): culprit notifications, open ones have emailed = 'NO'.
F4_NOTIFY = """
select o_orderkey as changelist, concat('dev_', cast(o_custkey % 50 as varchar(4))) as author,
       case when o_orderstatus = 'O' then 'NO' else 'YES' end as emailed, 'NO' as ack, o_orderpriority as jira, '' as comment
from orders
"""

# tolerance segments (threshold and error per case, segment, type).
F5_METRIC = """
select case_id, segment, type, kind,
       case kind when 'threshold' then cast((case_id * 7 + segment * 3 + tix) % 120 as double) / 10
                 else cast((case_id * 13 + segment * 5 + tix * 11) % 90 as double) / 10 end as value
from (select distinct l_suppkey as case_id, l_linenumber as segment, case l_returnflag when 'A' then 'average' else 'median' end as type,
        case l_returnflag when 'A' then 0 else 1 end as tix
      from lineitem where l_linenumber <= 1 + l_suppkey % 2 and l_returnflag <> 'R') x
cross join (select 'threshold' as kind union all select 'error') k
where not (kind = 'error' and case_id % 10 = 3 and type = 'median')
"""

# F5 (logs): one comparator log per case rendered from F5; cases with
# case_id % 17 = 5 get an error-section marker inside their first threshold
# section (misnested), cases with case_id % 19 = 7 a last threshold section
# without a metric and without an error section.
F5_LOG_LINES = """
select concat('case_', cast(case_id as varchar(12))) as file,
       cast(row_number() over (partition by case_id order by segment, sec, k, type) as bigint) as line_no, line
from (select case_id, segment, case kind when 'threshold' then 0 else 1 end as sec, 1 as k, type,
             concat('  Largest ', type, ' power error:  * ', cast(value as varchar(20)), ' dB') as line from f5_metric
      union all select distinct case_id, segment, 0, 0, '', 'Test metrics:' from f5_metric
      union all select distinct case_id, segment, 0, 2, '', 'Results:' from f5_metric
      union all select distinct case_id, segment, 1, 0, '', 'Average error per band (dB)' from f5_metric
      union all select distinct case_id, segment, 1, 2, '', '''*'' indicates a test failure point' from f5_metric
      union all select distinct case_id, segment, 0, 1, 'zz', 'Average error section opened early' from f5_metric
                where case_id % 17 = 5 and segment = 1
      union all select distinct case_id, 99, 0, 0, '', 'Test metrics:' from f5_metric where case_id % 19 = 7
      union all select distinct case_id, 99, 0, 2, '', 'Results:' from f5_metric where case_id % 19 = 7) x
"""

# F5 (specs): test specification hierarchy, one row per step; parent = id / 2.
F5_SPECS = """
select concat('case_', cast(s_suppkey as varchar(12))) as id,
       case when s_suppkey > 1 then concat('case_', cast(cast(floor(s_suppkey / 2) as bigint) as varchar(12))) end as parent,
       step_no, step_type,
       case when step_no = 1 then 'CODEC'
            when step_no = 2 then case s_suppkey % 4 when 0 then 'FREQCMP' when 2 then 'PESQ' end
            else 'BITEXACT' end as processor
from supplier cross join (select 1 as step_no, 'run' as step_type union all select 2, 'eval' union all select 3, 'eval') st
where step_no = 1 or (step_no = 2 and s_suppkey % 3 <> 0) or (step_no = 3 and s_suppkey % 5 = 0)
"""

# F5 (results): verdict per case of F5 (most failed).
F5_RESULTS = """
select distinct concat('case_', cast(case_id as varchar(12))) as test_api,
       case when case_id % 4 = 1 then 'passed' else 'failed' end as test_result from f5_metric
"""

FIXTURES = {
    "f1_runs": F1_RUNS,
    "f2_profile_lines": F2_PROFILE_LINES,
    "f2_env_lines": F2_ENV_LINES,
    "f3_usage": F3_USAGE,
    "f3_usage_lines": F3_USAGE_LINES,
    "f3_groups": F3_GROUPS,
    "f3_tree": F3_TREE,
    "f3_tree_lines": F3_TREE_LINES,
    "f3_api": F3_API,
    "f3_trace": F3_TRACE,
    "f3_header_lines": F3_HEADER_LINES,
    "f3_report_lines": F3_REPORT_LINES,
    "f4_results": F4_RESULTS,
    "f4_log_lines": F4_LOG_LINES,
    "f4_builds": F4_BUILDS,
    "f4_notify": F4_NOTIFY,
    "f5_metric": F5_METRIC,
    "f5_log_lines": F5_LOG_LINES,
    "f5_specs": F5_SPECS,
    "f5_results": F5_RESULTS,
}

# Fixtures a fixture depends on (CTE order for the oracle).
DEPENDS = {"f2_profile_lines": ("f1_runs",), "f2_env_lines": ("f1_runs",), "f3_usage_lines": ("f3_usage",), "f3_header_lines": ("f3_api",),
           "f3_tree": ("f3_groups",), "f3_tree_lines": ("f3_groups", "f3_tree"),
           "f4_log_lines": ("f4_results",), "f4_builds": ("f4_results",),
           "f5_log_lines": ("f5_metric",), "f5_results": ("f5_metric",)}

# Raw tables each fixture reads.
SOURCES = {"f1_runs": ("events",), "f2_profile_lines": ("events",), "f2_env_lines": ("events",),
           "f3_usage": ("lineitem",), "f3_usage_lines": ("lineitem",),
           "f3_groups": ("part",), "f3_tree": ("part",), "f3_tree_lines": ("part",), "f3_api": ("part",), "f3_header_lines": ("part",), "f3_report_lines": ("part",), "f3_trace": ("lineitem",), "f4_results": ("orders",), "f4_log_lines": ("orders",), "f4_builds": ("orders",),
           "f4_notify": ("orders",),
           "f5_metric": ("lineitem",), "f5_log_lines": ("lineitem",), "f5_results": ("lineitem",),
           "f5_specs": ("supplier",)}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_raw(spark: SparkSession, sf_dir: str, names=RAW_TABLES) -> None:
    for name in names:
        raw(spark, sf_dir, name).createOrReplaceTempView(name)


# Spark form of the fixtures' small constant expansions: the shared text
# multiplies rows by joining a constant table of a few rows; Spark expands
# each row with a generator instead, so no join without keys is planned.
SPARK_EXPANSIONS = (
    ("cross join (select 0 as k union all select 1 union all select 2 union all select 3 union all select 4 union all select 5) n",
     "lateral view explode(sequence(0, 5)) n as k"),
    ("cross join (select 1 as k union all select 2 union all select 3) kk",
     "lateral view explode(sequence(1, 3)) kk as k"),
    ("cross join (select 'threshold' as kind union all select 'error') k",
     "lateral view explode(array('threshold', 'error')) k as kind"),
    ("cross join (select 1 as step_no, 'run' as step_type union all select 2, 'eval' union all select 3, 'eval') st",
     "lateral view inline(array(struct(1, 'run'), struct(2, 'eval'), struct(3, 'eval'))) st as step_no, step_type"),
)


# Spark form of the windows over runs: what a window sorts is dealt by its keys over tasks of
# bounded size (the log lines before a run is expanded to its six lines), not by the planner's sizes.
SPARK_DEALT = {
    "f1_runs": (1, "(select event_id, event_type, value, ts as updatetime",
                "(select /*+ repartition({tasks}, algorithm, event_type, size_n, board, changelist) */ event_id, event_type, value, ts as updatetime"),
    "f2_profile_lines": (6, "from f1_runs lateral view", "from (select /*+ repartition({tasks}, changelist, board, loop_no) */ * from f1_runs) r lateral view"),
}


def spark_text(name: str, rows: int = 0, parallelism: int = 1) -> str:
    """The fixture's text for Spark; ``rows`` are the rows of its source. Few rows are left to the planner."""
    text = FIXTURES[name]
    for shared, spark_form in SPARK_EXPANSIONS:
        text = text.replace(shared, spark_form)
    if name in SPARK_DEALT:
        times, shared, spark_form = SPARK_DEALT[name]
        tasks = -(-rows * times // TASK_ROWS)
        if tasks > parallelism:
            text = text.replace(shared, spark_form.format(tasks=tasks))
    return text


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame (the raw tables are registered first)."""
    register_raw(spark, sf_dir, SOURCES[name])
    needed = {name, *DEPENDS.get(name, ())}
    size = (raw(spark, sf_dir, "events").count() if needed & set(SPARK_DEALT) else 0, spark.sparkContext.defaultParallelism)
    for dep in DEPENDS.get(name, ()):
        spark.sql(spark_text(dep, *size)).createOrReplaceTempView(dep)
    df = spark.sql(spark_text(name, *size))
    df.createOrReplaceTempView(name)
    return df


def with_fixtures(sql: str, *names: str, ctes: str = "") -> str:
    """Prefix ``sql`` with the fixture CTEs it names, then the extra ``ctes``
    text (``name as (...), ...``) -- the DuckDB oracle form."""
    ordered: list[str] = []
    for n in names:
        for dep in DEPENDS.get(n, ()):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    parts = [f"{n} as ({FIXTURES[n]})" for n in ordered]
    if ctes:
        parts.append(ctes)
    return "with " + ",\n".join(parts) + "\n" + sql
