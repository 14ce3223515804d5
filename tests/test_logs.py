"""Log sources and parsers: file scan line order, form A/B profile reports,
environment files, test-result logs, traces, API universe."""

import os

from pyspark.sql import functions as F

from benchtrail.functions import scan
from benchtrail.functions.scan import previous_max, running_max
from benchtrail.sources import logs as L
from conftest import lines_df


def _write(d, name, text, newline="\n"):
    p = os.path.join(d, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", newline="") as f:
        f.write(text.replace("\n", newline))
    return p


def test_read_log_lines_keeps_every_line_whatever_the_splits(spark, tmp_dir):
    big = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    _write(tmp_dir, "a/run_1.log", "\n".join(big) + "\n")
    _write(tmp_dir, "b/run_2.log", "first\nsecond\r\nthird \r still third", newline="\n")
    _write(tmp_dir, "b/skip.txt", "not a log\n")
    _write(tmp_dir, "c/run_3.log", "one\ntwo\n", newline="\r\n")
    want = {("run_1.log", i + 1): line for i, line in enumerate(big)}          # a final newline adds no line
    want |= {("run_2.log", i + 1): line for i, line in enumerate(["first", "second", "third \r still third"])}
    want |= {("run_3.log", 1): "one", ("run_3.log", 2): "two"}                 # \r before \n is stripped
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for build, run in (("16384", "16384"), ("16384", "128m"), ("128m", "5000")):   # the split size changes in between
            spark.conf.set("spark.sql.files.maxPartitionBytes", build)
            df = L.read_log_lines(spark, tmp_dir, "*.log")
            spark.conf.set("spark.sql.files.maxPartitionBytes", run)
            assert {(os.path.basename(r.file), r.line_no): r.line for r in df.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parsers_read_their_input_once(spark, tmp_dir):
    _write(tmp_dir, "run.log", PROFILE_A)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    lines = lines_df(spark, {"run.log": PROFILE_A})
    for parse in (L.parse_profile_report, L.parse_profile_stats):
        before = reads.value
        parse(lines.mapInArrow(counted, lines.schema)).collect()
        assert reads.value - before == lines.count()


def test_scan_tasks_hold_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(scan, "TASK_ROWS", 500, raising=False)
    df = spark.range(40_000).selectExpr("concat('f', id div 100) as file", "id % 100 as line_no", "if(id % 10 = 0, id, null) as v")
    for out in (running_max(df, ["file"], "line_no", F.col("v"), "m"), scan.running_count(df, ["file"], "line_no", F.col("v").isNotNull(), "m")):
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) <= 2_500, max(sizes)  # tasks of about 500 rows, not one in four of all


def test_running_max_chunked_equals_plain_window(spark):
    rows = [("f", i, i if i % 7 == 0 else None) for i in range(1, 400)] + [("g", i, None) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, v bigint")
    got = {(r.file, r.line_no): r.m for r in running_max(df, ["file"], "line_no", F.col("v"), "m", chunk=16).collect()}
    before = {(r.file, r.line_no): r.m for r in previous_max(df, ["file"], "line_no", F.col("v"), "m", chunk=16).collect()}
    for (f, n), m in got.items():
        assert m == max([i for (ff, i, v) in rows if ff == f and i <= n and v is not None], default=None)
        assert before[f, n] == max([i for (ff, i, v) in rows if ff == f and i < n and v is not None], default=None)


PROFILE_A = """preamble Max line: 9 x
Node Name        : alpha
Total            : 100 cycles
Max              : 30 cycles
Min              : 10 cycles
Avg              : 20.5 cycles
Number of Calls  : 4
Max              : 31 cycles
Node Name        : beta
Total Max        : 7 cycles
Avg              : 1e3 cycles
Number of Calls  : 2"""


def test_profile_report_form_a(spark):
    out = {r.name: r for r in L.parse_profile_report(lines_df(spark, {"p.log": PROFILE_A}), chunk=4).collect()}
    assert set(out) == {"alpha", "beta"}                       # lines before the first header ignored
    a = out["alpha"]
    assert (a.total, a.max, a.min, a.avg, a.num_calls) == (100, 31.0, 10.0, 20.5, 4)   # last value wins
    b = out["beta"]
    assert b.total == 7 and b.max is None                      # "Total" is tried before "Max"
    assert b.avg == 1000.0 and b.num_calls == 2
    assert a.node_ix == 2 and b.node_ix == 9


PROFILE_B = """Node Name : Root
Max : 5
Node Name : first
Max : 10
Avg : 4.5
Min : 1
Node Name : Root
Min : 0
Node Name : second
Max : 7
Node Name : first
Max : 99"""


def test_profile_stats_form_b(spark):
    out = {(r.node, r.stat): r.value for r in L.parse_profile_stats(lines_df(spark, {"s.log": PROFILE_B})).collect()}
    # Root opens nothing: its Min falls to "first"; the later "first" block replaces the earlier one
    assert out == {("second", "Max"): 7.0, ("first", "Max"): 99.0}


def test_profile_stats_root_lines_fall_to_previous_node(spark):
    text = "Node Name : first\nMax : 10\nNode Name : Root\nMin : 3\nAvg : 2"
    out = {(r.node, r.stat): r.value for r in L.parse_profile_stats(lines_df(spark, {"s.log": text})).collect()}
    assert out == {("first", "Max"): 10.0, ("first", "Min"): 3.0, ("first", "Avg"): 2.0}


def test_environment(spark):
    text = "cmd=run -x\nbackend=neon\ncompiler=gcc=4.9\nno equals here\nbackend=sse"
    env = {r.key: r.value for r in L.parse_environment(lines_df(spark, {"e.txt": text})).collect()}
    assert env == {"cmd": "run -x", "backend": "sse", "compiler": "gcc"}
    cols = L.environment_columns(L.parse_environment(lines_df(spark, {"e.txt": text}))).first()
    assert cols.backend == "sse" and cols.board is None


def test_coerce_number(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("2e3",), ("abc",), ("1.2.3",)], "t string")
    got = [r.n for r in df.select(L.coerce_number(F.col("t")).alias("n")).collect()]
    assert got == [12.0, 1.5, 2000.0, None, None]


RESULTS = """1/4 case_a... PASSED
2/4 case_b... failed
3/4 case_c... UNRESOLVED extra
2/4 case_b... Passed
passed: 2/4
FAILED: 1/4
UNRESOLVED: 1/4"""


def test_test_results(spark):
    det, summ = L.parse_test_results(lines_df(spark, {"r.log": RESULTS}))
    assert {r.test_api: r.test_result for r in det.collect()} == {"case_a": "passed", "case_b": "passed",
                                                                 "case_c": "unresolved"}
    s = summ.first()
    assert (s.total_passed, s.total_failed, s.total_unresolved) == ("2/4", "1/4", "1/4")


def test_trace_universe_expected(spark):
    trace = lines_df(spark, {"t": "FNDA:0,op_a\nFNDA:3,op_b\nFN:12,op_c\nFNDA:12,op_d"})
    assert {(r.api, r.hits) for r in L.read_trace(trace).collect()} == {("op_b", 3), ("op_d", 12)}
    hdr = lines_df(spark, {"h": "#pragma GCC poison op_a op_b /* old op_z */\nint op_q;\n#pragma GCC poison  op_c"})
    uni = {r.api for r in L.read_api_universe(hdr, "poison", "#pragma GCC poison").collect()}
    assert uni == {"op_a", "op_b", "op_c"}
    exp = lines_df(spark, {"x": "cfg_a\n\n  cfg_b  \ncfg_a"})
    assert {r.config for r in L.read_expected(exp).collect()} == {"cfg_a", "cfg_b"}


def test_operator_catalogue(spark):
    cat = lines_df(spark, {"dir/fft.txt": "  hl_add op (entered 3 times)\n  ll_mul op (entered 1 times)\nhl_add op (entered 2 times)",
                           "dir/notes.md": "hl_x op (entered 1 times)"})
    assert {(r.algorithm, r.api) for r in L.operator_catalogue(cat, "hl_").collect()} == {("fft", "add")}
