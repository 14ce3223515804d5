"""Ingest queries: parse rendered profile / environment logs (F2) and merge loops."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, with_fixtures
from benchtrail.operators import merge as M
from benchtrail.registry import query
from benchtrail.sources import logs as L

RUN_FILE = r"^run_(\d+)_(\w+)_(\d+)\.log$"
FRAME = "dct_click_32"
ONE_NODE = "fft_click_16"

# per file of F2: the case at each node position (oracle side, from the runs themselves)
POS = """pos as (select *, concat('run_', cast(changelist as varchar(12)), '_', board, '_', cast(loop_no as varchar(8)), '.log') as file,
  row_number() over (partition by changelist, board, loop_no order by test_case_name) as p from f1_runs)"""


def profile_lines(spark, sf_dir):
    return fixture(spark, sf_dir, "f2_profile_lines")


def profile_nodes(spark, sf_dir):
    return with_run_keys(L.parse_profile_report(profile_lines(spark, sf_dir)))


def with_run_keys(n):
    """S2 nodes with the run key taken from the file name."""
    return n.select("*", F.regexp_extract("file", RUN_FILE, 1).cast("bigint").alias("changelist"),
                    F.regexp_extract("file", RUN_FILE, 2).alias("board"),
                    F.regexp_extract("file", RUN_FILE, 3).cast("bigint").alias("loop"))


@query("s2_parse_profile_report", with_fixtures("""
select file, cast(6 * (p - 1) + 1 as bigint) as node_ix, test_case_name as name,
       cast(floor(avg_value * 100) as bigint) as total, floor(max_value * 100) as max, floor(min_value * 100) as min,
       floor(avg_value * 100) as avg, cast(1 + event_id % 7 as bigint) as num_calls
from pos
""", "f1_runs", ctes=POS))
def s2_parse_profile_report(spark, sf_dir):
    return L.parse_profile_report(profile_lines(spark, sf_dir))


@query("s3_parse_profile_stats", with_fixtures("""
select file, test_case_name as node, stat, value from pos,
  (select 'Max' as stat union all select 'Avg' union all select 'Min') s,
  lateral (select case stat when 'Max' then floor(max_value * 100) when 'Avg' then floor(avg_value * 100)
                  else floor(min_value * 100) end as value) v
""", "f1_runs", ctes=POS))
def s3_parse_profile_stats(spark, sf_dir):
    return L.parse_profile_stats(profile_lines(spark, sf_dir))


ENV_LAST = """kv as (select file, line_no, split_part(line, '=', 1) as key, split_part(line, '=', 2) as value from f2_env_lines
   where line like '%=%'),
last as (select file, key, value from (select *, row_number() over (partition by file, key order by line_no desc) as r from kv) t where r = 1)"""


@query("s4_parse_environment", with_fixtures("select file, key, value from last", "f2_env_lines", ctes=ENV_LAST))
def s4_parse_environment(spark, sf_dir):
    return L.parse_environment(fixture(spark, sf_dir, "f2_env_lines"))


@query("s4_environment_columns", with_fixtures("""
select file, """ + ", ".join(f"max(case when key = '{k}' then value end) as {k}" for k in L.ENV_KEYS) + """
from last group by file
""", "f2_env_lines", ctes=ENV_LAST))
def s4_environment_columns(spark, sf_dir):
    return L.environment_columns(L.parse_environment(fixture(spark, sf_dir, "f2_env_lines")))


@query("p9_coerce_number", with_fixtures("""
select file, key, value,
       case when value like '%.%' or value like '%e%' then try_cast(value as double)
            else cast(try_cast(value as bigint) as double) end as number
from last
""", "f2_env_lines", ctes=ENV_LAST))
def p9_coerce_number(spark, sf_dir):
    env = L.parse_environment(fixture(spark, sf_dir, "f2_env_lines"))
    return env.withColumn("number", L.coerce_number(F.col("value")))


@query("p9_coerce_value", with_fixtures("""
select file, key, case when not f then try_cast(value as bigint) end as integer, case when f then try_cast(value as double) end as number,
       case when (case when f then try_cast(value as double) else try_cast(value as bigint) end) is null then value end as text
from (select *, value like '%.%' or value like '%e%' as f from last) v
""", "f2_env_lines", ctes=ENV_LAST))
def p9_coerce_value(spark, sf_dir):
    env = L.parse_environment(fixture(spark, sf_dir, "f2_env_lines"))
    v = L.coerce_value(F.col("value"))
    return env.select("file", "key", *[v[c].alias(c) for c in ("integer", "number", "text")])


def _merge_sql(fn: str) -> str:
    return with_fixtures(f"""
select changelist, board, test_case_name,
       cast(floor({fn}(floor(max_value * 100))) as bigint) as max_value,
       cast(floor({fn}(floor(min_value * 100))) as bigint) as min_value,
       cast(floor({fn}(floor(avg_value * 100))) as bigint) as avg_value
from f1_runs group by 1, 2, 3
""", "f1_runs")


@query("a1_merge_loops", _merge_sql("median"))
def a1_merge_loops(spark, sf_dir):
    return M.merge_loops(profile_nodes(spark, sf_dir), ["changelist", "board"], behaviour="default")


@query("a1_merge_codec", _merge_sql("min"))
def a1_merge_codec(spark, sf_dir):
    return M.merge_loops(profile_nodes(spark, sf_dir), ["changelist", "board"], behaviour="codec")


@query("a1_merge_worst", _merge_sql("max"))
def a1_merge_worst(spark, sf_dir):
    return M.merge_loops(profile_nodes(spark, sf_dir), ["changelist", "board"], behaviour="worst")


@query("p16_root_dropped", _merge_sql("median"))
def p16_root_dropped(spark, sf_dir):
    """Every log begins with a root node, which is no test case."""
    lines = fixture(spark, sf_dir, "f2_profile_lines")
    root = [f"Node Name        : {M.ROOT_NODE}", *[f"{k:17s}: 999999 cycles" for k in ("Total", "Max", "Min", "Avg")], "Number of Calls  : 1"]
    heads = lines.select("file").distinct().select("file", F.posexplode(F.array(*[F.lit(x) for x in root])).alias("n", "line"))
    heads = heads.select("file", (F.col("n") - len(root)).cast("bigint").alias("line_no"), "line")
    return M.merge_loops(with_run_keys(L.parse_profile_report(lines.unionByName(heads))), ["changelist", "board"], behaviour="default")


@query("j11_positional_merge", with_fixtures("""
select pos.changelist, pos.board, arg_min(test_case_name, loop_no) as test_case_name,
       cast(floor(median(floor(max_value * 100))) as bigint) as max_value,
       cast(floor(median(floor(min_value * 100))) as bigint) as min_value,
       cast(floor(median(floor(avg_value * 100))) as bigint) as avg_value
from pos join m on pos.changelist = m.changelist and pos.board = m.board where p <= m.m
group by pos.changelist, pos.board, p
""", "f1_runs", ctes=POS + """,
m as (select changelist, board, min(n) as m from (select changelist, board, loop_no, count(*) as n from pos group by 1, 2, 3) c group by 1, 2)"""))
def j11_positional_merge(spark, sf_dir):
    return M.merge_loops(profile_nodes(spark, sf_dir), ["changelist", "board"], mode="reference")


@query("a2_min_stats", with_fixtures("""
select test_case_name as node, round(30 * min(floor(max_value * 100)) / 1e6, 2) as min_max,
       round(30 * min(floor(avg_value * 100)) / 1e6, 2) as min_avg
from f1_runs group by 1
""", "f1_runs"))
def a2_min_stats(spark, sf_dir):
    return M.min_stats(L.parse_profile_stats(profile_lines(spark, sf_dir)), fps=30)


@query("a2_min_stats_node", with_fixtures(f"""
select test_case_name as node, round(30 * min(floor(max_value * 100)) / 1e6, 2) as min_max,
       round(30 * min(floor(avg_value * 100)) / 1e6, 2) as min_avg, round(30 * min(floor(min_value * 100)) / 1e6, 2) as min_min
from f1_runs where test_case_name = '{ONE_NODE}' group by 1
""", "f1_runs"))
def a2_min_stats_node(spark, sf_dir):
    return M.min_stats(L.parse_profile_stats(profile_lines(spark, sf_dir)), fps=30, node=ONE_NODE)


@query("a3_master_report", with_fixtures("""
select test_case_name as node, stat, file, value from pos,
  (select 'Max' as stat union all select 'Avg' union all select 'Min') s,
  lateral (select case stat when 'Max' then floor(max_value * 100) when 'Avg' then floor(avg_value * 100)
                  else floor(min_value * 100) end as value) v
""", "f1_runs", ctes=POS))
def a3_master_report(spark, sf_dir):
    return M.master_report(L.parse_profile_stats(profile_lines(spark, sf_dir)))


@query("a4_scale_to_frame", with_fixtures(f"""
select pos.file, cast(6 * (p - 1) + 1 as bigint) as node_ix, test_case_name as name,
       cast(floor(avg_value * 100) as bigint) as total, cast(1 + event_id % 7 as bigint) as num_calls,
       floor(max_value * 100) * sc as max, floor(min_value * 100) * sc as min, floor(avg_value * 100) * sc as avg
from pos join f on pos.file = f.file,
 lateral (select case when not (coalesce(has_frame, false) and n > 1) or test_case_name = '{FRAME}' then 1
                      when 1 + event_id % 7 > fc then cast(ceil((1 + event_id % 7) / fc) as bigint) else 1 end as sc) s
""", "f1_runs", ctes=POS + f""",
f as (select file, max(case when test_case_name = '{FRAME}' then 1 + event_id % 7 end) as fc,
      bool_or(test_case_name = '{FRAME}') as has_frame, count(*) as n from pos group by file)"""))
def a4_scale_to_frame(spark, sf_dir):
    return M.scale_to_frame(L.parse_profile_report(profile_lines(spark, sf_dir)), FRAME)


@query("s1_log_scan", with_fixtures("select file, line_no, line from f2_profile_lines", "f2_profile_lines"))
def s1_log_scan(spark, sf_dir):
    """The F2 logs written as text files (one folder per log), then
    scanned back with line numbers restored from the split layout."""
    scanned = L.read_log_lines(spark, _write_logs(spark, sf_dir, "logs"), "*.txt")
    return scanned.select(F.regexp_extract("file", r"file=([^/]+)/", 1).alias("file"), "line_no", "line")


def _write_logs(spark, sf_dir, name):
    """The F2 logs as text files (one folder per log) in the shared folder."""
    import uuid

    from benchtrail.session import scratch_path
    from benchtrail.sinks.writers import write_logs
    out = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    write_logs(profile_lines(spark, sf_dir), out)
    return out


LOG_PATH = r"file=run_(\d+)_(\w+)_(\d+)\.log/"
ENV_FILE = r"^env_(\d+)_(.+)\.txt$"

L1_SQL = with_fixtures("""
select changelist, board, test_case_name,
       cast(floor(median(floor(max_value * 100))) as bigint) as max_value,
       cast(floor(median(floor(min_value * 100))) as bigint) as min_value,
       cast(floor(median(floor(avg_value * 100))) as bigint) as avg_value,
       concat('bench --runs ', cast(changelist % 7 as varchar)) as cmd,
       case when changelist % 20 = 0 then 'sse' else 'neon' end as backend,
       cast(null as varchar) as target, cast(null as varchar) as os, cast(null as varchar) as arch,
       'gcc' as compiler, cast(null as varchar) as glibc, 'cycle' as unitperf
from f1_runs group by changelist, board, test_case_name
""", "f1_runs")


@query("l1_profile_runs", L1_SQL)
def l1_profile_runs(spark, sf_dir):
    from benchtrail.plans.ingest import profile_runs
    f = F.col("file")
    return profile_runs(
        profile_lines(spark, sf_dir), fixture(spark, sf_dir, "f2_env_lines"),
        run_of_log={"changelist": F.regexp_extract(f, RUN_FILE, 1).cast("bigint"),
                    "board": F.regexp_extract(f, RUN_FILE, 2), "loop": F.regexp_extract(f, RUN_FILE, 3).cast("bigint")},
        run_of_env={"changelist": F.regexp_extract(f, ENV_FILE, 1).cast("bigint"),
                    "board": F.regexp_extract(f, ENV_FILE, 2)})


@query("t1_ingest_logs", _merge_sql("median"))
def t1_ingest_logs(spark, sf_dir):
    """Log files picked up by a file stream, parsed per micro-batch and
    appended idempotently; the loops of each run are merged over everything
    ingested."""
    import uuid

    from benchtrail.session import scratch_path
    from benchtrail.streaming import ingest as S
    folder = _write_logs(spark, sf_dir, "t1-logs")
    out = scratch_path(spark, f"t1-nodes-{uuid.uuid4().hex[:8]}")
    S.ingest_logs(S.log_file_stream(spark, folder, "*.txt"), L.parse_profile_report, out, f"{out}-checkpoint")
    nodes = spark.read.parquet(out)
    f = F.col("file")
    nodes = nodes.select("*", F.regexp_extract(f, LOG_PATH, 1).cast("bigint").alias("changelist"),
                         F.regexp_extract(f, LOG_PATH, 2).alias("board"),
                         F.regexp_extract(f, LOG_PATH, 3).cast("bigint").alias("loop"))
    return M.merge_loops(nodes, ["changelist", "board"], behaviour="default")


@query("a1_merge_loops_ranked", _merge_sql("median"))
def a1_merge_loops_ranked(spark, sf_dir):
    """A1 with the skew-proof exact median (global rank instead of one
    buffer per group)."""
    return M.merge_loops(profile_nodes(spark, sf_dir), ["changelist", "board"], behaviour="default", median="ranked")
