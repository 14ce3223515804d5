"""Composite plans: L1 ingest (batch and stream) and the L2 nightly report."""

import datetime as dt
import os

from pyspark.sql import functions as F

from benchtrail.plans.ingest import profile_runs
from benchtrail.plans.nightly import nightly_report
from benchtrail.sources import logs as L
from benchtrail.streaming import ingest as S
from conftest import lines_df

LOOP1 = """Node Name : Root-Node
Node Name   : fir
Max   : 120 cycles
Min   : 100 cycles
Avg   : 110 cycles
Node Name   : iir
Max   : 50 cycles
Min   : 40 cycles
Avg   : 45 cycles"""
LOOP2 = LOOP1.replace("100 cycles", "90 cycles").replace("40 cycles", "44 cycles")
LOOP3 = LOOP1.replace("100 cycles", "95 cycles")
ENV = "backend=neon\ncompiler=gcc=4.9\nboard=b1"


def test_profile_runs_batch(spark):
    logs = lines_df(spark, {"r_7_1.log": LOOP1, "r_7_2.log": LOOP2, "r_7_3.log": LOOP3})
    env = lines_df(spark, {"env_7.txt": ENV})
    rows = profile_runs(logs, env,
                        run_of_log={"changelist": F.regexp_extract("file", r"r_(\d+)_", 1).cast("bigint"),
                                    "loop": F.regexp_extract("file", r"_(\d+)\.log", 1).cast("bigint")},
                        run_of_env={"changelist": F.regexp_extract("file", r"env_(\d+)", 1).cast("bigint")},
                        behaviour="default")
    got = {r.test_case_name: r for r in rows.collect()}
    assert set(got) == {"fir", "iir"}                         # the root node is skipped
    assert got["fir"].min_value == 95 and got["iir"].min_value == 40     # median over three loops
    assert got["fir"].backend == "neon" and got["fir"].compiler == "gcc" and got["fir"].unitperf == "cycle"
    codec = {r.test_case_name: r.min_value for r in profile_runs(
        logs, env, {"changelist": F.lit(7).cast("bigint"), "loop": F.regexp_extract("file", r"_(\d+)\.log", 1)},
        {"changelist": F.lit(7).cast("bigint")}, behaviour="codec").collect()}
    assert codec == {"fir": 90, "iir": 40}


def test_log_stream_ingest(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs")
    os.makedirs(src)
    for name, text in {"a.log": LOOP1 + "\n", "b.log": LOOP2}.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    out = os.path.join(tmp_dir, "nodes")
    checkpoint = os.path.join(tmp_dir, "checkpoint")
    S.ingest_logs(S.log_file_stream(spark, src), L.parse_profile_report, out, checkpoint)
    got = {(os.path.basename(r.file), r.name): r.min for r in spark.read.parquet(out).collect()}
    assert got[("a.log", "fir")] == 100.0 and got[("b.log", "fir")] == 90.0 and len(got) == 6
    # a later run with the same checkpoint keeps these and reads the new file only
    os.remove(os.path.join(src, "a.log"))
    with open(os.path.join(src, "c.log"), "w") as f:
        f.write(LOOP3)
    S.ingest_logs(S.log_file_stream(spark, src), L.parse_profile_report, out, checkpoint)
    rows = [os.path.basename(r.file) for r in spark.read.parquet(out).collect()]
    assert len(rows) == 9 and {f: rows.count(f) for f in set(rows)} == {"a.log": 3, "b.log": 3, "c.log": 3}


def test_nightly_report(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for cl in range(1, 11):                                  # case x gets 30 % slower from build 6 on
        rows.append(("fft_x_16", "b", cl, t0 + dt.timedelta(days=cl), cl, 100.0 if cl < 6 else 130.0))
        rows.append(("fft_y_16", "b", cl, t0 + dt.timedelta(days=cl), 100 + cl, 100.0))
    runs = spark.createDataFrame(rows, "test_case_name string, board string, changelist bigint, updatetime timestamp, "
                                       "event_id bigint, min_value double")
    changes = spark.createDataFrame([(cl, f"dev{cl}") for cl in range(1, 11)], "changelist bigint, author string")
    rep = nightly_report(runs, changes, threshold=10, top_k=5, cl_range=(1, 3))
    assert [r.test_case_name for r in rep["top"].collect()] == ["fft_x_16"]
    c = rep["culprits"].first()
    assert (c.culprit_cl, c.author, c.emailed) == (6, "dev6", "NO")
