"""Compatibility helpers (P7, P8, J3, J4, K4, K6), tolerance acceptance
(S8, S9, J9, A17, P18), streaming dispatch (T1-T3) and sinks (K1, K10)."""

import os
import uuid

from pyspark.sql import functions as F

from benchtrail.operators import accept as A
from benchtrail.operators import compat as C
from benchtrail.sinks import writers as K
from benchtrail.streaming import ingest as S
from conftest import lines_df


def test_split_project_and_abbreviate(spark):
    df = spark.createDataFrame([("MS_Mixer_v2.5.0_generic_float32_release",), ("Enc_core_debug",),
                                ("A_v1_V2_x_y",), ("lib_V3",)], "p string")
    got = [tuple(r) for r in df.select(C.split_project(F.col("p")).alias("s")).select("s.*").collect()]
    assert got == [("MS_Mixer", "v2.5.0", "generic_float32_release"),
                   ("", "Enc", "core_debug"),                      # no v part -> index 0
                   ("A_v1", "V2", "x_y"),                          # the last v/V part counts
                   ("lib", "V3", "")]
    ab = [r.a for r in df.select(C.abbreviate(F.col("p")).alias("a")).collect()]
    assert ab[0] == "MS_Mixer_v2.5.0_gfr" and ab[2] == "A_v1_V2_xy"


def test_verdict_diff_and_expectation(spark):
    dut = spark.createDataFrame([("a", "passed"), ("b", "failed"), ("n", "unresolved")], "test_api string, test_result string")
    ref = spark.createDataFrame([("a", "passed"), ("b", "passed"), ("r", "failed")], "test_api string, test_result string")
    assert {(r.test_api, r.kind) for r in C.verdict_diff(dut, ref).collect()} == {("b", "diff"), ("n", "new")}
    builds = spark.createDataFrame([("Enc_v1_neon_int_debug", 1), ("Dec_v1_x", 0), ("Mix_v2_y", 0)],
                                   "config string, build_failed int")
    expected = spark.createDataFrame([("Enc_v1_neon_int_debug",), ("Enc_v1_msvs_release",), ("other",)], "line string")
    got = {r.config: (r.expected, r.unexpected) for r in C.expectation_check(builds, expected).collect()}
    assert got == {"Enc_v1_neon_int_debug": (True, True), "Dec_v1_x": (False, True), "Mix_v2_y": (False, True)}
    got_c = {r.config: r.expected for r in C.expectation_check(builds, expected, mode="contains").collect()}
    assert got_c["Enc_v1_neon_int_debug"] is True


def test_route_update_summary(spark):
    b, t, rows = (spark.createDataFrame([(1, "m")], "build_result int, build_msg string"),
                  spark.createDataFrame([("x", "s")], "compare_summary string, test_api string"),
                  spark.createDataFrame([("a", "passed")], "test_api string, test_result string"))
    assert [C.route_by_shape(d) for d in (b, t, rows)] == ["CompatBuildSummary", "CompatTestSummary", "Compatibility"]
    tags = spark.createDataFrame([("v1.2_rc",), ("v1.2_release",), ("nightly",), (None,)], "updated_by string")
    assert [r.updated_by for r in C.removable_tags(tags).collect()] == ["v1.2_rc"]
    upd = C.update_where(tags, F.col("updated_by") == "nightly", {"updated_by": None})
    assert [r.updated_by for r in upd.collect()] == ["v1.2_rc", "v1.2_release", None, None]
    det = spark.createDataFrame([("a", "passed", False), ("b", "passed", True), ("c", "failed", False), ("d", "unresolved", False)],
                                "test_api string, test_result string, relabeled boolean")
    s = C.result_summary(det, relabeled="relabeled").first()
    assert (s.total_passed, s.total_failed, s.total_unresolved) == ("3/4", "0/4", "1/4")


LOG = """Test metrics:
  Largest average power error:  * 2.0 dB
  Largest median power error:  * 0.8 dB
Results:
Average error table
  Largest average power error:  * 0.9 dB
  Largest median power error:  * 0.7 dB
'*' indicates a test failure point"""

BAD_LOG = """Test metrics:
Average error too early
Results:"""


def test_metric_sections_and_acceptance(spark):
    lines = lines_df(spark, {"ok": LOG, "bad": BAD_LOG, "empty": "nothing here"})
    m, errs = A.parse_metric_sections(lines)
    assert {(r.kind, r.segment, r.type): r.value for r in m.filter(F.col("file") == "ok").collect()} == {
        ("threshold", 0, "average"): 2.0, ("threshold", 0, "median"): 0.8,
        ("error", 0, "average"): 0.9, ("error", 0, "median"): 0.7}
    assert {r.file: r.error for r in errs.collect()} == {"ok": False, "bad": True}
    v = {r.file: (r.case_error, r.accepted) for r in A.accept_cases(A.pair_metrics(m), errs, cases=lines).collect()}
    # median: err 0.7 >= 0.5 but thr >= 0.5 and err < 1.0 -> acceptable; empty log: no segments -> accepted
    assert v == {"ok": (False, True), "bad": (True, False), "empty": (False, True)}


def test_acceptable_rule(spark):
    df = spark.createDataFrame([("average", 0.0, 0.99), ("average", 0.0, 1.0), ("median", 0.4, 0.6),
                                ("median", 5.0, 5.09), ("x", 12.0, 12.99), ("x", 12.0, 13.0)], "type string, thr double, err double")
    got = [r.ok for r in df.select(A.acceptable(F.col("thr"), F.col("err"), F.col("type")).alias("ok")).collect()]
    assert got == [True, False, False, True, True, False]


SPECS = """<testsuite>
<testspec id="root"><step type="run"><processor>CODEC</processor></step><step type="eval"><processor>FREQCMP</processor></step></testspec>
<testspec id="mid" parent="root"><step type="eval"/></testspec>
<testspec id="leaf" parent="mid"><step type="run"><processor>X</processor></step></testspec>
<testspec id="deep" parent="leaf"/>
<testspec id="own" parent="root"><step type="eval"><processor>PESQ</processor></step><step type="eval"><processor>FREQCMP</processor></step></testspec>
<testspec id="lost" parent="nowhere"/>
</testsuite>"""


def test_specs_and_tool_inheritance(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.xml"), "w") as f:
        f.write(SPECS)
    specs = A.read_specs(spark, tmp_dir)
    assert specs.count() == 6
    tools = {r.id: r.tool for r in A.resolve_tools(specs).collect()}
    assert tools == {"root": "FREQCMP", "mid": "FREQCMP", "leaf": "FREQCMP", "deep": "FREQCMP",
                     "own": "PESQ", "lost": None}


def test_dispatcher_registers_once_and_replays_idempotently(spark, tmp_dir):
    seen = []
    d = S.Dispatcher("event_type")
    h = S.batch_writer(os.path.join(tmp_dir, "out"))
    d.register("a", h)
    d.register("a", h)
    d.register("b", lambda df, i: seen.append(df.count()))
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "event_type string, v int")
    d(batch, 7)
    d(batch, 7)                       # the same batch replayed after a failure
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    assert sorted(r.v for r in out.collect()) == [1, 2] and seen == [1, 1]
    d.unregister("b", d._handlers["b"][0])
    assert d.types() == ["a"]


def test_stream_latest_record_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    rows = [(f"c{i % 5}", i % 3, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, cl bigint, event_id bigint, v double").withColumn("updatetime", F.col("event_id").cast("timestamp"))
    df.filter("event_id < 40").repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    agg = S.latest_record_stream(stream, ["k", "cl"], values=["v"])
    out = os.path.join(tmp_dir, "snap")
    checkpoint = os.path.join(tmp_dir, "checkpoint")
    S.run_available(agg, S.batch_writer(out), checkpoint, output_mode="update")
    df.filter("event_id >= 40").write.mode("append").parquet(src)         # a restart continues from the state
    S.run_available(S.latest_record_stream(spark.readStream.schema(df.schema).parquet(src), ["k", "cl"], values=["v"]),
                    S.batch_writer(out), checkpoint, output_mode="update")
    from benchtrail.operators.history import latest_record
    batch = {(r.k, r.cl): r.v for r in latest_record(df, ["k", "cl"], values=["v"]).collect()}
    assert {(r.k, r.cl): r.v for r in S.read_latest(spark, out, ["k", "cl"]).collect()} == batch


def test_append_known_and_tables(spark, tmp_dir):
    prefix = f"t{uuid.uuid4().hex[:6]}_"
    names = K.create_tables(spark, tmp_dir, prefix=prefix)
    assert set(names) == {f"{prefix}{n}" for n in K.SCHEMAS} and {f"{prefix}profile_runs", f"{prefix}notification"} <= set(names)
    df = spark.createDataFrame([(5, "dev", "NO", "x-extra")], "changelist int, author string, emailed string, extra string")
    K.append_known(df, f"{prefix}notification")
    r = spark.table(f"{prefix}notification").first()
    assert (r.changelist, r.author, r.emailed, r.ack) == (5, "dev", "NO", None)


def sections(*parts):
    """Log text: "t" / "e" open and close a threshold / error section around the metrics given."""
    out = []
    for kind, metrics in parts:
        out.append(A.THR_OPEN if kind == "t" else A.ERR_OPEN + " per band")
        out += [f"Largest {t} power error:  * {v} dB" for t, v in metrics]
        out.append(A.THR_CLOSE if kind == "t" else A.ERR_CLOSE)
    return "\n".join(out)


def test_section_counts_decide_on_acceptance(spark):
    ok = [("average", 0.1)]
    lines = lines_df(spark, {
        "even": sections(("t", ok), ("e", ok)), "none": "nothing", "more_thr": sections(("t", ok), ("t", []), ("e", ok)),
        "empty_pair": sections(("t", []), ("e", []), ("t", ok), ("e", ok)), "unclosed": sections(("t", ok), ("e", ok)) + "\n" + A.THR_OPEN,
        "only_empty": sections(("t", [])), "nested": A.THR_OPEN + "\n" + sections(("e", ok))})
    metrics, errors = A.parse_metric_sections(lines)
    got = {r.file: (r.case_error, r.accepted) for r in A.accept_cases(A.pair_metrics(metrics), errors, cases=lines).collect()}
    good, bad = (False, True), (True, False)
    assert got == {"even": good, "none": good, "more_thr": bad, "empty_pair": good, "unclosed": good, "only_empty": bad, "nested": bad}


def test_tools_of_deep_chains_and_cycles(spark):
    step = [("eval", "X")]
    rows = [(f"n{i}", f"n{i + 1}" if i < 300 else None, step if i == 300 else []) for i in range(301)]
    rows += [("a", "b", []), ("b", "a", []), ("c", "a", []), ("d", "missing", [])]
    specs = spark.createDataFrame(rows, "id string, parent string, steps array<struct<type: string, processor: string>>")
    got = {r.id: (r.tool, r.cycle) for r in A.resolve_tools(specs).collect()}
    assert all(got[f"n{i}"] == ("X", False) for i in range(301))
    assert got["a"] == got["b"] == got["c"] == (None, True) and got["d"] == (None, False)


def test_written_logs_equal_a_partitioned_text_table(spark, tmp_dir):
    from benchtrail.sinks.writers import write_logs
    rows = [(f"run_{f}.log", i, f"line {i} é" if i % 5 else None) for f in range(7) for i in range(9)] + [(None, 1, "x"), (None, 2, "")]
    lines = spark.createDataFrame(rows, "file string, line_no bigint, line string").repartition(5)
    write_logs(lines, f"file:{tmp_dir}/a")
    lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", "line").write.partitionBy("file").text(f"{tmp_dir}/b")
    read = lambda d: sorted(r.value for r in spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(f"{tmp_dir}/{d}").collect())
    names = lambda d: sorted(x for x in os.listdir(f"{tmp_dir}/{d}") if "=" in x)
    assert read("a") == read("b") and names("a") == names("b") and len(names("a")) == 8


def test_lines_of_a_streamed_log_do_not_carry_its_text(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/logs")
    for name, text in {"a": "one\r\n\ntwo\n", "b": "", "c": "\n", "d": "x"}.items():
        with open(f"{tmp_dir}/logs/{name}.log", "w", newline="") as f:
            f.write(text)
    stream = S.log_file_stream(spark, f"{tmp_dir}/logs")
    assert "- Filter" not in stream._jdf.queryExecution().analyzed().toString()  # no line is held against its whole text
    S.run_available(stream, S.batch_writer(f"{tmp_dir}/out"), f"{tmp_dir}/check")
    got = sorted((os.path.basename(r.file), r.line_no, r.line) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [("a.log", 1, "one"), ("a.log", 2, ""), ("a.log", 3, "two"), ("c.log", 1, ""), ("d.log", 1, "x")]
