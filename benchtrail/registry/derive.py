"""Derivation queries: backend / platform / table-name splits, pending work,
first-seen order, operator catalogue, environment enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, raw, with_fixtures
from benchtrail.functions import derive as D
from benchtrail.operators import merge as M
from benchtrail.registry import query
from benchtrail.registry.ingest import POS, profile_nodes
from benchtrail.sources import logs as L

# configuration strings derived from the events' users
CONFIGS = """select distinct user_id,
  concat(case user_id % 3 when 0 then 'linux' when 1 then 'osx' else 'beagleboard' end, '_',
         case user_id % 6 when 0 then 'cortex_a9_vfp_neon' when 1 then 'cortex_a9' when 2 then 'x86' when 3 then 'amd64'
                          when 4 then 'c64plus' else 'c64' end, '_',
         case user_id % 4 when 0 then 'gnu' when 1 then 'icc' when 2 then 'rvct_cslibc' else 'c6run' end) as build_config,
  concat('bench_', case user_id % 7 when 0 then 'generic_float32' when 1 then 'armv7int_neon' when 2 then 'armv7int'
                   when 3 then 'c64plus' when 4 then 'ipp_float_interleaved' when 5 then 'ipp_float_non_interleaved' else 'sse4' end,
         case when user_id % 11 = 0 then '_release' else '_cycle_profile' end) as executable
from events"""


def configs(spark, sf_dir):
    raw(spark, sf_dir, "events").createOrReplaceTempView("events")
    return spark.sql(CONFIGS)


@query("p5_derive_backend", f"""
select user_id, executable,
  case when executable like '%generic_float32%' then 'generic_float32' when executable like '%armv7int_neon%' then 'armv7int_neon'
       when executable like '%armv7int%' then 'armv7int' when executable like '%c64plus%' then 'c64plus'
       when executable like '%ipp_float_interleaved%' then 'ipp_float_interleaved'
       when executable like '%ipp_float_non_interleaved%' then 'ipp_float_non_interleaved' end as backend,
  case when executable like '%cycle_profile%' then 'cycle_profile' end as target
from ({CONFIGS}) c
""")
def p5_derive_backend(spark, sf_dir):
    c = configs(spark, sf_dir)
    d = D.derive_backend(F.col("executable"))
    return c.select("user_id", "executable", d["backend"].alias("backend"), d["target"].alias("target"))


@query("p6_derive_platform", f"""
select user_id, build_config,
  case when build_config like '%linux%' or build_config like '%beagleboard%' then 'linux' when build_config like '%osx%' then 'osx' end as os,
  case when build_config like '%cortex_a9%' then case when build_config like '%vfp_neon%' then 'cortex_a9_vfp_neon' else 'cortex_a9' end
       when build_config like '%x86%' then 'x86' when build_config like '%amd64%' then 'amd64'
       when build_config like '%c64plus%' then 'c64plus' when build_config like '%c64%' then 'c64' end as arch,
  case when build_config like '%gnu%' then 'gnu' when build_config like '%icc%' then 'icc'
       when build_config like '%rvct_cslibc%' then 'rvct_cslibc' when build_config like '%c6run%' then 'ccs' end as compiler,
  case when build_config like '%gnu%' then '4.4.6' when build_config like '%icc%' then '12.1.3'
       when build_config like '%rvct_cslibc%' then '5.01' when build_config like '%c6run%' then '7.1.4' end as version
from ({CONFIGS}) c
""")
def p6_derive_platform(spark, sf_dir):
    c = configs(spark, sf_dir)
    d = D.derive_platform(F.col("build_config"))
    return c.select("user_id", "build_config", *[d[k].alias(k) for k in ("os", "arch", "compiler", "version")])


# board names of table names carry no '_' (the first part is the board)
TABLES = """select distinct concat(replace(board, '_', ''), '_neon_int_', algorithm, '_bench') as table_name,
  replace(board, '_', '') as board, algorithm from f1_runs"""


@query("p10_split_table_name", with_fixtures(f"""
select table_name, board, 'neon_int' as datatype, algorithm from ({TABLES}) t
""", "f1_runs"))
def p10_split_table_name(spark, sf_dir):
    fixture(spark, sf_dir, "f1_runs")
    t = spark.sql(TABLES)
    d = D.split_table_name(F.col("table_name"))
    return t.select("table_name", d["board"].alias("board"), d["datatype"].alias("datatype"), d["algorithm"].alias("algorithm"))


WORK = "select distinct test_case_name, changelist from f1_runs where board = 'board_a'"
DONE = "select distinct test_case_name, changelist from f1_runs where board = 'board_b'"


@query("p11_pending", with_fixtures(f"""
select w.test_case_name, w.changelist from ({WORK}) w where not exists
  (select 1 from ({DONE}) d where d.test_case_name = w.test_case_name and d.changelist = w.changelist)
""", "f1_runs"))
def p11_pending(spark, sf_dir):
    fixture(spark, sf_dir, "f1_runs")
    return D.pending(spark.sql(WORK), spark.sql(DONE), ["test_case_name", "changelist"])


@query("p11_found", with_fixtures(f"""
select w.test_case_name, w.changelist from ({WORK}) w where exists
  (select 1 from ({DONE}) d where d.test_case_name = w.test_case_name and d.changelist = w.changelist)
""", "f1_runs"))
def p11_found(spark, sf_dir):
    fixture(spark, sf_dir, "f1_runs")
    return D.found(spark.sql(WORK), spark.sql(DONE), ["test_case_name", "changelist"])


@query("o3_first_seen_order_boards", with_fixtures("""
select board, test_case_name, changelist, event_id, min(event_id) over (partition by board, test_case_name) as first_seen
from f1_runs
""", "f1_runs"))
def o3_first_seen_order_boards(spark, sf_dir):
    r = fixture(spark, sf_dir, "f1_runs").select("board", "test_case_name", "changelist", "event_id")
    return D.first_seen_order(r, ["board", "test_case_name"], "event_id")


CATALOGUE = """select concat(category, '.txt') as file, cast(row_number() over (partition by category order by api) as bigint) as line_no,
  concat('  ', case when is_macro then 'mc_' else 'hl_' end, api, ' op (entered ', cast(length(api) as varchar(4)), ' times)') as line
from f3_api"""


@query("s7_operator_catalogue", with_fixtures("select category as algorithm, api from f3_api where not is_macro", "f3_api"))
def s7_operator_catalogue(spark, sf_dir):
    fixture(spark, sf_dir, "f3_api")
    return L.operator_catalogue(spark.sql(CATALOGUE), "hl_")


@query("p4_with_environment", with_fixtures("""
select p.file, p.test_case_name as name, p.changelist, p.board,
       case when p.changelist % 20 = 0 then 'sse' else 'neon' end as backend, 'gcc' as compiler
from pos p
""", "f1_runs", ctes=POS))
def p4_with_environment(spark, sf_dir):
    nodes = profile_nodes(spark, sf_dir).select("file", "name", "changelist", "board")
    env = L.environment_columns(L.parse_environment(fixture(spark, sf_dir, "f2_env_lines")), ("backend", "compiler"))
    env = env.select(F.regexp_extract("file", r"^env_(\d+)_", 1).cast("bigint").alias("changelist"),
                     F.regexp_extract("file", r"^env_\d+_(.+)\.txt$", 1).alias("board"), "backend", "compiler")
    return M.with_environment(nodes, env, ["changelist", "board"])
