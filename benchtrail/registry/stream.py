"""Streaming queries: each runs a Structured Streaming query over a file
stream of a test table until everything available is processed, then
returns what its sink wrote (read back as a batch DataFrame)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, raw, with_fixtures
from benchtrail.operators import history as H
from benchtrail.registry import ORACLE, ingest, query  # noqa: F401  (ingest registers the oracle used below)
from benchtrail.registry.culprit import BUILDS_SQL
from benchtrail.registry.history import RECS
from benchtrail.session import materialize, scratch_path
from benchtrail.sources import logs as L
from benchtrail.streaming import growing as G
from benchtrail.streaming import ingest as S

# The F1 projection of an events row (same expressions as the fixture view,
# without the loop number, which needs a window over the whole table).
RUN_EXPRS = [
    "concat(case user_id % 5 when 0 then 'fft' when 1 then 'dct' when 2 then 'qmf' when 3 then 'math' else 'blkvec' end,"
    " '_', event_type, '_', cast(cast(power(2, 4 + user_id % 6) as bigint) as string)) as test_case_name",
    "case cast(floor(user_id / 30) as bigint) % 2 when 0 then 'board_a' else 'board_b' end as board",
    "cast(2000000 + 10 * day(ts) as bigint) as changelist",
    "ts as updatetime", "event_id", "value * 1.2e0 as max_value", "value as min_value", "value * 1.1e0 as avg_value",
]

USAGE_EXPRS = [
    "concat('op_', cast(l_partkey % 300 as string)) as api",
    "cast(year(l_shipdate) as bigint) as changelist",
    "cast(l_quantity as bigint) as total",
]


def _out(spark, name):
    return scratch_path(spark, f"stream-out/{name}-{uuid.uuid4().hex[:8]}")


@query("t1_dispatch_ingest", """
select event_id, event_type, user_id, value from events where event_type in ('error', 'purchase')
""")
def t1_dispatch_ingest(spark, sf_dir):
    stream = S.file_stream(spark, sf_dir, "events")
    out = _out(spark, "t1")
    d = S.Dispatcher("event_type")
    cols = ("event_id", "event_type", "user_id", "value")
    errors = S.batch_writer(f"{out}/errors", lambda df: df.select(*cols))
    purchases = S.batch_writer(f"{out}/purchases", lambda df: df.select(*cols))
    d.register("error", errors)
    d.register("purchase", purchases)
    d.register("purchase", purchases)     # registered once only
    S.run_available(stream, d, f"{out}-checkpoint")
    return spark.read.parquet(f"{out}/errors").unionByName(spark.read.parquet(f"{out}/purchases")).drop("batch_id")


@query("t2_gate", with_fixtures(f"""
select event_id, changelist from f1_runs where changelist in (select changelist from ({BUILDS_SQL}) b where build_ok)
""", "f1_runs"))
def t2_gate(spark, sf_dir):
    fixture(spark, sf_dir, "f1_runs")
    builds = spark.sql(BUILDS_SQL)
    stream = S.file_stream(spark, sf_dir, "events").selectExpr(*RUN_EXPRS)
    out = _out(spark, "t2")
    S.run_available(S.gate(stream, builds, "changelist").select("event_id", "changelist"), S.batch_writer(out), f"{out}-checkpoint")
    return spark.read.parquet(out).drop("batch_id")


@query("t3_latest_record_stream", with_fixtures("""
select test_case_name, board, changelist, updatetime, event_id, max_value, min_value, avg_value from recs
""", "f1_runs", ctes=RECS))
def t3_latest_record_stream(spark, sf_dir):
    stream = S.file_stream(spark, sf_dir, "events").selectExpr(*RUN_EXPRS)
    agg = S.latest_record_stream(stream, H.RECORD,
                                 values=["updatetime", "event_id", "max_value", "min_value", "avg_value"])
    out = _out(spark, "t3a")
    S.run_available(agg, S.batch_writer(out), f"{out}-checkpoint", output_mode="update")
    return S.read_latest(spark, out, H.RECORD)


@query("t3_usage_totals_stream", with_fixtures("""
select api, changelist, cast(sum(total) as bigint) as total from f3_usage group by 1, 2
""", "f3_usage"))
def t3_usage_totals_stream(spark, sf_dir):
    stream = (S.file_stream(spark, sf_dir, "lineitem")
               .filter("l_partkey % 4 <> 3 or l_suppkey % 3 = 0").selectExpr(*USAGE_EXPRS))
    agg = S.usage_totals_stream(stream)
    out = _out(spark, "t3b")
    S.run_available(agg, S.batch_writer(out), f"{out}-checkpoint", output_mode="update")
    return S.read_latest(spark, out, ("api", "changelist"))


def _write_logs(lines, folder, share):
    """Every file of ``lines`` with the first ``share`` of its lines, the last of them without its end."""
    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_no")
        kept = "\n".join(rows["line"].iloc[:max(1, int(len(rows) * share))])
        system, path = arrow_fs.FileSystem.from_uri(f"{folder}/{rows['file'].iat[0]}")
        with system.open_output_stream(path) as f:
            f.write(kept.encode())
        return rows.iloc[:1][["file"]]
    lines.select("file", "line_no", "line").groupBy("file").applyInPandas(write, "file string").write.format("noop").mode("overwrite").save()


@query("t1_growing_logs", ORACLE["s2_parse_profile_report"])
def t1_growing_logs(spark, sf_dir):
    out = _out(spark, "t1-growing")
    spark.range(1).write.parquet(f"{out}/logs/made")  # makes the folder on whatever file system it is
    folder = spark.read.format("binaryFile").load(f"{out}/logs/made").select("path").first()[0].rsplit("/", 2)[0]
    lines = materialize(fixture(spark, sf_dir, "f2_profile_lines"), "f2-lines")  # written three times
    logs = G.GrowingLogs(spark, folder, f"{out}/state")
    for share in (0.3, 0.7, 1.0):
        _write_logs(lines, folder, share)
        logs.take(L.parse_profile_report, F.col("line").startswith("Node Name"), final=share == 1.0)
    rows = logs.rows().withColumn("file", F.regexp_extract("file", "([^/]+)$", 1))
    return rows.select(L.parse_profile_report(lines.limit(0)).columns)


@query("t3_compacted_records", with_fixtures("""
select test_case_name, board, changelist, updatetime, event_id, max_value, min_value, avg_value from recs
""", "f1_runs", ctes=RECS))
def t3_compacted_records(spark, sf_dir):
    out = _out(spark, "t3c")
    raw(spark, sf_dir, "events").repartition(8, "event_id").write.parquet(f"{out}/events")  # eight files, one a batch
    stream = spark.readStream.schema(raw(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/events").selectExpr(*RUN_EXPRS)
    agg = S.latest_record_stream(stream, H.RECORD, values=["updatetime", "event_id", "max_value", "min_value", "avg_value"])
    store = G.Compacted(spark, f"{out}/store", H.RECORD, every=3)
    S.run_available(agg, store.add, f"{out}-checkpoint", output_mode="update")
    return store.read()
