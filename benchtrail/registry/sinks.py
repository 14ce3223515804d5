"""Sink and source round trips: each query writes derived rows with a sink
into the shared scratch folder and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchtrail.fixtures import fixture, raw, with_fixtures
from benchtrail.operators import history as H
from benchtrail.registry import query
from benchtrail.registry.history import BASE_CL, CAND_CL, RECS, _PAIRS, _SUMMARY
from benchtrail.session import scratch_path
from benchtrail.sinks import writers as K
from benchtrail.sources import tables as TB


def _dir(spark, name):
    return scratch_path(spark, f"sink-out/{name}-{uuid.uuid4().hex[:8]}")


def runs(spark, sf_dir):
    return fixture(spark, sf_dir, "f1_runs")


REPORT_SQL = """select test_case_name, board, algorithm, changelist,
       cast(case when algorithm = 'math' then floor(cast(trunc(min_value) as bigint) / 100.0) else cast(trunc(min_value) as bigint) end as bigint) as first,
       round(100 * (avg_value - min_value) / nullif(cast(trunc(min_value) as bigint), 0), 0) as spread,
       case when algorithm = 'fft' then round(cast(trunc(min_value) as bigint) / (5 * n * log2(n)), 2) end as third
from (select *, cast(split_part(test_case_name, '_', -1) as bigint) as n from
  (select *, row_number() over (partition by test_case_name, board order by changelist desc, updatetime desc, event_id desc) as r from f1_runs) t
  where r = 1) x"""


@query("k7_report_csv", with_fixtures("""
select algorithm, board, test_case_name as name,
       case when algorithm = 'fft' then concat(cast(first as varchar), '   ', coalesce(cast(spread as varchar), 'null'), '%   ',
                                               coalesce(cast(third as varchar), 'null'))
            else concat(cast(first as varchar), '   ', coalesce(cast(spread as varchar), 'null'), '%') end as cell, changelist
from rep
""", "f1_runs", ctes="rep as (" + REPORT_SQL + ")"))
def k7_report_csv(spark, sf_dir):
    out = _dir(spark, "k7")
    K.write_report_csv(H.report_rows(runs(spark, sf_dir)), out)
    schema = "name string, cell string, changelist bigint, algorithm string, board string"
    return spark.read.schema(schema).csv(out).select("algorithm", "board", "name", "cell", "changelist")


@query("k9_partition_by_algorithm", with_fixtures("""
select test_case_name, algorithm, board, changelist, min_value from recs
""", "f1_runs", ctes=RECS))
def k9_partition_by_algorithm(spark, sf_dir):
    out = _dir(spark, "k9")
    recs = H.latest_record(runs(spark, sf_dir), H.RECORD, values=["algorithm", "min_value"])
    K.partition_by_algorithm(recs, out)
    return spark.read.parquet(out).select("test_case_name", "algorithm", "board", "changelist", "min_value")


@query("k3_fan_out", with_fixtures("""
select t as target, test_case_name, max_value, min_value, avg_value from f1_runs cross join (select unnest(['t1', 't2', 'csv']) as t) x
""", "f1_runs"))
def k3_fan_out(spark, sf_dir):
    out = _dir(spark, "k3")
    r = runs(spark, sf_dir)
    K.fan_out(r, [f"{out}/t1", f"{out}/t2"], f"{out}/csv")
    schema = "test_case_name string, max_value double, min_value double, avg_value double"
    cols = [c.split()[0] for c in schema.split(", ")]
    read = [spark.read.parquet(f"{out}/{t}").select(F.lit(t).alias("target"), *cols) for t in ("t1", "t2")]
    csv = spark.read.schema(schema).option("header", True).csv(f"{out}/csv")
    return read[0].unionByName(read[1]).unionByName(csv.select(F.lit("csv").alias("target"), *cols))


@query("k2_write_table", with_fixtures("""
select test_case_name, algorithm, size_n, board, changelist, updatetime, event_id, loop_no, max_value, min_value, avg_value from recs
""", "f1_runs", ctes=RECS))
def k2_write_table(spark, sf_dir):
    out = _dir(spark, "k2")
    r = runs(spark, sf_dir)
    recs = H.latest_record(r, H.RECORD)
    K.write_table(recs, out, mode="overwrite")
    K.write_table(recs.limit(0), out, mode="append")
    return spark.read.parquet(out)


@query("k8_summary_json", with_fixtures("""
select 'summary' as part, concat(algorithm, ' ', board) as name, better, worse, no_change, total from s
union all select verdict, test_case_name, null, null, null, null from (select test_case_name,
  case when base - cand > base * 5.0 / 100 then 'better' when cand - base > base * 5.0 / 100 then 'worse' end as verdict from pairs) v where verdict is not null
""", "f1_runs", ctes=RECS + ",\n" + _PAIRS + ",\n" + _SUMMARY))
def k8_summary_json(spark, sf_dir):
    out = _dir(spark, "k8")
    r = runs(spark, sf_dir)
    K.write_summary_json(H.compare_builds(r, BASE_CL, CAND_CL, 5), H.case_lists(r, BASE_CL, CAND_CL, 5), out)
    counts = ("better", "worse", "no_change", "total")
    schema = "algorithm string, board string, better bigint, worse bigint, no_change bigint, total bigint"
    read = spark.read.schema(schema).json(f"{out}/summary").select(F.lit("summary").alias("part"), F.concat_ws(" ", "algorithm", "board").alias("name"), *counts)
    for verdict in ("better", "worse"):
        names = spark.read.text(f"{out}/{verdict}")
        read = read.unionByName(names.select(F.lit(verdict).alias("part"), F.col("value").alias("name"), *[F.lit(None).cast("bigint").alias(c) for c in counts]))
    return read


@query("k1_append_known", with_fixtures("""
select test_case_name, max_value, min_value, avg_value, cast(null as varchar) as unitperf, cast(null as varchar) as cmd,
       cast(null as varchar) as backend, cast(null as varchar) as target, cast(null as varchar) as os, cast(null as varchar) as arch,
       changelist, cast(null as varchar) as compiler, cast(null as varchar) as glibc, cast(null as varchar) as technology,
       cast(null as timestamp) as updatetime, algorithm, board from f1_runs
""", "f1_runs"))
def k1_append_known(spark, sf_dir):
    root = _dir(spark, "k1")
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    (name,) = K.create_tables(spark, root, ["profile_runs"], prefix=prefix)
    r = runs(spark, sf_dir)            # has columns the table lacks (event_id, loop_no, size_n)
    K.append_known(r, name, key_cols=("updatetime",))
    return spark.table(name)


@query("k5_write_parallel", "select o_orderkey, o_custkey, o_totalprice from orders")
def k5_write_parallel(spark, sf_dir):
    out = _dir(spark, "k5")
    K.write_parallel(raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), out, n=4)
    return spark.read.parquet(out)


@query("s12_read_table", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def s12_read_table(spark, sf_dir):
    return TB.read_table(spark, f"{sf_dir.rstrip('/')}/orders.parquet", ["o_orderkey", "o_totalprice"],
                         where={"o_orderstatus": "F"})


ORDERS_CSV = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])


@query("s13_read_csv_folder", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def s13_read_csv_folder(spark, sf_dir):
    out = _dir(spark, "s13")
    o = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    o.write.mode("overwrite").option("header", False).csv(f"{out}/daily")
    return TB.read_csv_folder(spark, f"{out}/daily", ORDERS_CSV).drop("source_file")
