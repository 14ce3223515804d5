"""Accepting failures within tolerance.

A failed case may be re-labelled PASSED when its evaluation tool is the
frequency comparator and every error of every output segment is within the
tolerance rule of ``acceptable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchtrail.functions.scan import previous_max, running_count
from benchtrail.session import materialize

# Section markers and metric line of the comparator log, the
# tool that can be analysed, and the tolerance rule constants (dB).
THR_OPEN = "Test metrics:"
THR_CLOSE = "Results:"
ERR_OPEN = "Average error"
ERR_CLOSE = "'*' indicates a test failure point"
METRIC = r"Largest\s+(\S+)\s+power error:\s+\*\s+(\S+)\s+dB"
ANALYSABLE_TOOL = "FREQCMP"
MEDIAN = "median"
OTHER_MAX = 1.0
MEDIAN_MAX, MEDIAN_LOOSE_FROM, MEDIAN_LOOSE_MAX = 0.5, 0.5, 1.0
THR_HIGH_FROM, OVER_LOW, OVER_HIGH = 10.0, 0.1, 1.0


def parse_metric_sections(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(metrics, case_errors)`` from comparator logs (``file`` = case).

    metrics: ``file, kind (threshold|error), segment, type, value`` -- the
    k-th closed threshold section pairs with the k-th closed error section;
    inside a section the last value of a type wins.
    case_errors: ``file, error, n_threshold, n_error`` -- ``error`` is true
    when sections are misnested (a section opened inside another, or closed
    without being open); the counts are those of closed sections, with or
    without a metric in them.
    """
    line = F.col("line")
    mk = (F.when(line.contains(THR_OPEN), "thr_open").when(line.contains(THR_CLOSE), "thr_close")
           .when(line.contains(ERR_OPEN), "err_open").when(line.contains(ERR_CLOSE), "err_close"))
    tagged = lines.select("file", "line_no", mk.alias("marker"),
                          F.when(line.rlike(METRIC), F.regexp_extract(line, METRIC, 1)).alias("type"),
                          F.regexp_extract(line, METRIC, 2).try_cast("double").alias("value"))
    tagged = materialize(tagged.filter(F.col("marker").isNotNull() | F.col("type").isNotNull()), "comparator-lines")

    # every line looks at the last marker before it
    mark = F.when(F.col("marker").isNotNull(), F.struct(F.col("line_no").alias("l"), F.col("marker").alias("k")))
    seen = materialize(previous_max(tagged, ["file"], "line_no", mark, "last"), "comparator-marks")
    at, last = F.col("marker"), F.coalesce(F.col("last.k"), F.lit("idle"))
    bad = ((at.isin("thr_open", "err_open") & last.isin("thr_open", "err_open"))
           | ((at == "thr_close") & (last != "thr_open")) | ((at == "err_close") & (last != "err_open")))
    closes = ((at == "thr_close") & (last == "thr_open")) | ((at == "err_close") & (last == "err_open"))
    kind = F.when(at == "thr_close", "threshold").otherwise("error")
    case_errors = seen.filter(at.isNotNull()).groupBy("file").agg(
        F.bool_or(bad).alias("error"), F.count_if(closes & (at == "thr_close")).alias("n_threshold"),
        F.count_if(closes & (at == "err_close")).alias("n_error"))
    closed = seen.filter(closes).select("file", kind.alias("kind"), "line_no", F.col("last.l").alias("_sec"))
    sections = running_count(closed, ["file", "kind"], "line_no", F.lit(True), "_n").select(
        "file", "kind", "_sec", (F.col("_n") - 1).cast("int").alias("segment"))

    data = seen.filter(at.isNull() & last.isin("thr_open", "err_open")).select(
        "file", "line_no", "type", "value", F.col("last.l").alias("_sec"))
    metrics = data.join(sections, ["file", "_sec"]).groupBy("file", "kind", "segment", "type").agg(
        F.max_by("value", "line_no").alias("value"))
    return metrics, case_errors


def acceptable(thr: Column, err: Column, type_: Column) -> Column:
    """A17 rule for one (type, threshold, error)."""
    base = F.when(type_ != F.lit(MEDIAN), err < OTHER_MAX).otherwise(
        (err < MEDIAN_MAX) | ((thr >= MEDIAN_LOOSE_FROM) & (err < MEDIAN_LOOSE_MAX)))
    over = err - thr
    return base | ((thr < THR_HIGH_FROM) & (over < OVER_LOW)) | ((thr >= THR_HIGH_FROM) & (over < OVER_HIGH))


def pair_metrics(metrics: DataFrame, case_col: str = "file") -> DataFrame:
    """Threshold and error of each (case, segment, type), full outer."""
    t = metrics.filter(F.col("kind") == "threshold").select(case_col, "segment", "type", F.col("value").alias("thr"))
    e = metrics.filter(F.col("kind") == "error").select(case_col, "segment", "type", F.col("value").alias("err"))
    return t.join(e, [case_col, "segment", "type"], "full_outer")


def accept_cases(pairs: DataFrame, case_errors: DataFrame | None = None, case_col: str = "file",
                 cases: DataFrame | None = None) -> DataFrame:
    """A17 (+J8 check): per case, ``case_error`` (the numbers of closed
    threshold and error sections or the type sets differ, or the log was
    misnested) and ``accepted`` (no case error and all pairs acceptable; a
    case with no segments is accepted). ``cases`` lists every analysed case,
    so logs without any section are reported too."""
    ok = acceptable(F.col("thr"), F.col("err"), F.col("type"))
    per = pairs.groupBy(case_col).agg(
        F.bool_or(F.col("thr").isNull() | F.col("err").isNull()).alias("_mismatch"),
        F.bool_and(F.coalesce(ok, F.lit(False))).alias("_all_ok"))
    if cases is not None:
        per = cases.select(case_col).distinct().join(per, case_col, "left")
    if case_errors is not None:
        wrong = F.col("error") | (F.col("n_threshold") != F.col("n_error"))
        per = per.join(case_errors.select(case_col, wrong.alias("error")), case_col, "left" if cases is not None else "full_outer")
    else:
        per = per.withColumn("error", F.lit(False))
    err = F.coalesce(F.col("_mismatch"), F.lit(False)) | F.coalesce(F.col("error"), F.lit(False))
    return per.select(case_col, err.alias("case_error"),
                      (~err & F.coalesce(F.col("_all_ok"), F.lit(True))).alias("accepted"))


# --- S9 / J9 --------------------------------------------------------------------

SPEC_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_parent", T.StringType()),
    T.StructField("step", T.ArrayType(T.StructType([
        T.StructField("_type", T.StringType()),
        T.StructField("processor", T.StringType())]))),
])


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """Every ``testspec`` element of the XML files under ``path``:
    ``id, parent, steps array<struct<type, processor>>``."""
    raw = (spark.read.format("xml").option("rowTag", "testspec").option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.xml").schema(SPEC_SCHEMA).load(path))
    return raw.select(F.col("_id").alias("id"), F.col("_parent").alias("parent"),
                      F.transform("step", lambda s: F.struct(s["_type"].alias("type"),
                                                             s["processor"].alias("processor"))).alias("steps"))


def own_tool(specs: DataFrame) -> DataFrame:
    """The processor of a spec's first ``eval`` step (null when it has no
    eval step or that step has no processor): ``id, parent, tool``."""
    first_eval = F.try_element_at(F.filter("steps", lambda s: s["type"] == "eval"), F.lit(1))
    return specs.select("id", "parent", first_eval["processor"].alias("tool"))


def resolve_tools(specs: DataFrame) -> DataFrame:
    """Each spec's evaluation tool, inherited from the nearest ancestor
    that has one (``id, tool, cycle``; tool is null when no ancestor has one or
    a parent is missing; ``cycle`` marks specs whose ancestors never end).

    Pointer doubling: every round joins the unresolved rows with the state
    itself, which is stored each round, so a chain of n specs is resolved in
    about log2(n) rounds. What is open when all specs would fit into the
    chains followed so far can only be a cycle.
    """
    state = materialize(own_tool(specs).select("id", "tool", F.when(F.col("tool").isNull(), F.col("parent")).alias("ptr")), "specs")
    followed, n = 1, state.count()
    while followed <= 2 * n and not state.filter(F.col("ptr").isNotNull()).isEmpty():
        look = state.select(F.col("id").alias("_pid"), F.col("tool").alias("_ptool"), F.col("ptr").alias("_pptr"))
        state = materialize(state.join(look, F.col("ptr") == F.col("_pid"), "left").select(
            "id", F.coalesce(F.col("tool"), F.col("_ptool")).alias("tool"),
            F.when(F.col("tool").isNull() & F.col("_ptool").isNull(), F.col("_pptr")).alias("ptr")), "specs")
        followed *= 2
    return state.select("id", "tool", F.col("ptr").isNotNull().alias("cycle"))


def relabel(results: DataFrame, accepted: DataFrame, case_col: str = "test_api",
            result_col: str = "test_result") -> DataFrame:
    """FAILED -> PASSED for accepted cases; adds ``relabeled``."""
    a = accepted.filter(F.col("accepted")).select(case_col).distinct().withColumn("_acc", F.lit(True))
    j = results.join(a, case_col, "left")
    flip = (F.lower(F.col(result_col)) == "failed") & F.coalesce(F.col("_acc"), F.lit(False))
    return j.select(*[c for c in results.columns if c != result_col],
                    F.when(flip, F.lit("passed")).otherwise(F.col(result_col)).alias(result_col),
                    flip.alias("relabeled"))


def comparator_verdicts(lines: DataFrame) -> DataFrame:
    """Per case (``file``) whether its comparator log is acceptable."""
    metrics, errors = parse_metric_sections(lines)
    return accept_cases(pair_metrics(metrics), errors, cases=lines)


#: evaluation tool -> function from log lines to verdicts (file, accepted)
ANALYSERS = {ANALYSABLE_TOOL: comparator_verdicts}


def accept_failures(results: DataFrame, metric_lines: DataFrame, specs: DataFrame,
                    case_col: str = "test_api", analysers=None) -> DataFrame:
    """Every case's log goes to the analyser registered for its evaluation
    tool (J9); cases of other tools stay FAILED; accepted ones are re-labelled (P18)."""
    tools = resolve_tools(specs).select(F.col("id").alias("file"), "tool")
    verdicts = None
    for tool, analyse in (analysers or ANALYSERS).items():
        own = metric_lines.join(tools.filter(F.col("tool") == tool).select("file"), "file", "left_semi")
        found = analyse(own).select(F.col("file").alias(case_col), "accepted")
        verdicts = found if verdicts is None else verdicts.unionByName(found)
    return relabel(results, verdicts, case_col)
