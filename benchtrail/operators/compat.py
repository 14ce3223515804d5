"""Functional-test (compatibility) operators: verdict diffs, expectation
checks, project-id handling and result summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("intrinsic_version", "project_name", "project_version", "project_release")
PROJECT = ("project_name", "project_version", "project_release")

# Verdict words, summary messages and tool marker.
PASSED, FAILED, UNRESOLVED = "passed", "failed", "unresolved"
TESTS_PASS = "Tests pass"
TESTS_FAIL = "Tests fail, investigation needed"
BUILD_PASSED = "Build passed!"
WINDOWS_TOOL = "msvs"


# --- P1 / P7 / P8 / P13 / P17 ---------------------------------------------------------

def select_where(df: DataFrame, equal: dict, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows where every ``col = value`` holds; keys plus one column."""
    cond = F.lit(True)
    for k, v in equal.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond).select(*keys, out)


def split_project(col: Column) -> Column:
    """``name_version_release`` -> struct(project_name, project_version,
    project_release). The version is the last ``_`` part beginning with v/V
    (none: part 0); name = parts before it, release = parts after it."""
    parts = F.split(col, "_")
    idx = F.array_max(F.transform(parts, lambda x, i: F.when(
        F.trim(x).startswith("v") | F.trim(x).startswith("V"), i).otherwise(F.lit(0))))
    n = F.size(parts)
    return F.struct(
        F.array_join(F.slice(parts, F.lit(1), idx), "_").alias("project_name"),
        F.element_at(parts, idx + 1).alias("project_version"),
        F.array_join(F.slice(parts, idx + 2, F.greatest(n - idx - 1, F.lit(0))), "_").alias("project_release"))


def abbreviate(col: Column) -> Column:
    """``name_version_<initials of the release parts>``."""
    p = split_project(col)
    initials = F.array_join(F.transform(F.split(p["project_release"], "_"), lambda x: F.substring(x, 1, 1)), "")
    return F.concat_ws("_", p["project_name"], p["project_version"], initials)


def removable_tags(df: DataFrame, tag: str = "updated_by") -> DataFrame:
    """Rows whose tag may be removed: begins with ``v`` and does not end
    in ``release``."""
    t = F.col(tag)
    return df.filter(t.startswith("v") & ~t.endswith("release"))


def pending_notifications(df: DataFrame) -> DataFrame:
    """Notifications not yet sent (``emailed = 'NO'``) with subject and
    message text (sending itself is not part of the library)."""
    return (df.filter(F.col("emailed") == "NO")
              .select("changelist", "author",
                      F.format_string("Performance issue on changelist %s", F.col("changelist")).alias("subject"),
                      F.format_string("Hi %s, changelist %s introduced a performance drop; please acknowledge it.",
                                      F.col("author"), F.col("changelist")).alias("message")))


# --- A11 / J3 / P12 / A14 / A18 ---------------------------------------------------------

def latest_version(df: DataFrame, keys: Sequence[str] = PROJECT, col: str = "intrinsic_version",
                   numeric: bool = False) -> DataFrame:
    """Greatest version per key by text order ('' if none); ``numeric``
    compares as numbers instead."""
    if numeric:
        m = F.max(F.col(col).try_cast("double"))
        v = F.max_by(F.col(col), F.col(col).try_cast("double"))
        return df.groupBy(*keys).agg(F.coalesce(F.when(m.isNotNull(), v), F.lit("")).alias("latest_version"))
    return df.groupBy(*keys).agg(F.coalesce(F.max(col), F.lit("")).alias("latest_version"))


def previous_versions(versions: DataFrame, keys: Sequence[str] = PROJECT, col: str = "intrinsic_version") -> DataFrame:
    """(DUT, REF) pairs for all builds at once: each version of a project
    against the greatest earlier version of the same project (text order)."""
    w = Window.partitionBy(*keys).orderBy(col)
    v = versions.select(*keys, col).distinct()
    return v.select(*keys, F.col(col).alias("dut_version"), F.lag(col).over(w).alias("ref_version")) \
            .filter(F.col("ref_version").isNotNull())


def verdict_diff(dut: DataFrame, ref: DataFrame, keys: Sequence[str] = (),
                 api: str = "test_api", result: str = "test_result") -> DataFrame:
    """DUT cases against REF cases (same ``keys``): ``kind`` = ``diff``
    when a common case changed verdict, ``new`` for cases only in DUT.
    REF-only cases are ignored."""
    keys = list(keys)
    r = ref.select(*keys, api, F.col(result).alias("ref_result"))
    j = dut.select(*keys, api, F.col(result).alias("dut_result")).join(r, [*keys, api], "left")
    kind = F.when(F.col("ref_result").isNull(), "new").when(F.col("ref_result") != F.col("dut_result"), "diff")
    return j.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def check_results(details: DataFrame, keys: Sequence[str] = (), result: str = "test_result") -> DataFrame:
    """Per key the number of failed and unresolved cases and the flag
    (any of them). The case lists are the rows of ``details`` filtered by
    verdict; nothing is collected per key."""
    r = F.col(result)
    return details.groupBy(*keys).agg(
        F.count_if(r == FAILED).cast("bigint").alias("n_failed"),
        F.count_if(r == UNRESOLVED).cast("bigint").alias("n_unresolved"),
        F.bool_or((r == FAILED) | (r == UNRESOLVED)).cast("int").alias("flag"))


def result_summary(details: DataFrame, keys: Sequence[str] = (), result: str = "test_result",
                   relabeled: str | None = None) -> DataFrame:
    """``passed``, ``failed``, ``unresolved`` as ``n/m`` text (m = all
    cases). With ``relabeled`` (a boolean column: FAILED turned PASSED),
    passed gains and failed loses those cases; unresolved is unchanged."""
    r = F.col(result)
    k = F.count_if(F.col(relabeled)) if relabeled else F.lit(0)
    agg = details.groupBy(*keys).agg(F.count_if(r == PASSED).alias("_p"), F.count_if(r == FAILED).alias("_f"),
                                     F.count_if(r == UNRESOLVED).alias("_u"), F.count(F.lit(1)).alias("_n"),
                                     k.alias("_k"))
    fmt = lambda c: F.format_string("%d/%d", c, F.col("_n"))
    return agg.select(*keys, fmt(F.col("_p") + F.col("_k")).alias("total_passed"),
                      fmt(F.col("_f") - F.col("_k")).alias("total_failed"), fmt(F.col("_u")).alias("total_unresolved"))


def overall(df: DataFrame, keys: Sequence[str] = (), cols: Sequence[str] = ("build_result", "test_result")) -> DataFrame:
    """The return flag = OR of the build and test flags."""
    anyv = F.lit(False)
    for c in cols:
        anyv = anyv | (F.coalesce(F.col(c), F.lit(0)) != 0)
    return df.groupBy(*keys).agg(F.bool_or(anyv).cast("int").alias("ret"))


# --- J4 ---------------------------------------------------------------------------

#: length of the strings by which lines and configurations are joined
GRAM = 8


def expectation_check(builds: DataFrame, expected: DataFrame, config: str = "config",
                      build_failed: str = "build_failed", mode: str = "equal") -> DataFrame:
    """A build is a failure when it was expected to succeed and failed,
    or was not expected and succeeded. ``expected`` has one ``line`` per
    configuration; lines naming the Windows tool are abbreviated (P8) first.

    mode="equal": the configuration equals the line.
    mode="contains": the configuration occurs anywhere in a line. A line that
    contains it also holds each of its ``GRAM``-character strings (all of it
    if it is shorter); the one with the smallest hash joins the strings of
    the lines, and the joined lines are searched for the configuration.
    """
    line = F.trim(F.col("line"))
    exp = expected.select(F.when(line.contains(WINDOWS_TOOL), abbreviate(line)).otherwise(line).alias("_exp"))
    if mode == "contains":
        def grams(text: str, size: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(F.col(text), i, size))

        names = builds.select(F.col(config).alias("_cfg")).filter(F.length("_cfg") > 0).distinct()
        own = grams("_cfg", F.least(F.length("_cfg"), F.lit(GRAM)))
        names = names.select("_cfg", F.array_min(F.transform(own, lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"].alias("_gram"))
        lines = exp.filter(F.length("_exp") > 0).distinct()
        held = lines.select("_exp", F.explode(F.sequence(F.lit(1), F.least(F.length("_exp"), F.lit(GRAM)))).alias("_n"))
        held = held.select("_exp", F.explode(F.array_distinct(grams("_exp", F.col("_n")))).alias("_gram"))
        found = (held.join(names, "_gram").filter(F.col("_exp").contains(F.col("_cfg")))
                     .select(F.col("_cfg").alias(config)).distinct().withColumn("_found", F.lit(True)))
    elif mode == "equal":
        found = exp.select(F.col("_exp").alias(config)).distinct().withColumn("_found", F.lit(True))
    else:
        raise ValueError(mode)
    j = builds.join(found, config, "left")
    f = F.coalesce(F.col("_found"), F.lit(False))
    failed = F.col(build_failed) != 0
    return j.select(*builds.columns, f.alias("expected"),
                    ((f & failed) | (~f & ~failed)).alias("unexpected"))


# --- R5 ---------------------------------------------------------------------------

def compat_summary(details: DataFrame, summaries: DataFrame, updated_by: str | None = None,
                   keys: Sequence[str] = KEY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R5 for every (project, version) at once: each version is compared with
    the project's previous version. Returns (build summary, test summary,
    compatibility rows) -- the three result tables.

    ``details``: key columns + test_api, test_result (S5 output with keys);
    ``summaries``: key columns + total_passed/failed/unresolved (S5).
    """
    keys = list(keys)
    proj = [k for k in keys if k != "intrinsic_version"]
    pairs = previous_versions(details, proj)
    dut = details.join(pairs.withColumnRenamed("dut_version", "intrinsic_version"), keys)
    ref = details.select(*proj, F.col("intrinsic_version").alias("ref_version"), "test_api",
                         F.col("test_result").alias("ref_result"))
    j = dut.join(ref, [*proj, "ref_version", "test_api"], "left")
    is_new = F.col("ref_result").isNull()
    counts = j.groupBy(*keys, "ref_version").agg(
        F.count_if(~is_new & (F.col("ref_result") != F.col("test_result"))).cast("bigint").alias("n_diff"),
        F.count_if(is_new & (F.col("test_result") == FAILED)).cast("bigint").alias("n_new_failed"),
        F.count_if(is_new & (F.col("test_result") == UNRESOLVED)).cast("bigint").alias("n_new_unresolved"))
    ret = (F.col("n_diff") + F.col("n_new_failed") + F.col("n_new_unresolved")) > 0
    tag = F.lit(updated_by).cast("string")
    test_summary = (counts.join(summaries, keys, "left")
                          .select(*keys, "ref_version",
                                  F.col("total_passed").alias("subtotal_on_passed"),
                                  F.col("total_failed").alias("subtotal_on_failed"),
                                  F.col("total_unresolved").alias("subtotal_on_unresolved"),
                                  F.when(ret, TESTS_FAIL).otherwise(TESTS_PASS).alias("compare_summary"),
                                  "n_diff", "n_new_failed", "n_new_unresolved", ret.cast("int").alias("ret"),
                                  tag.alias("updated_by")))
    build_summary = counts.select(*keys, F.lit(1).alias("build_result"), F.lit(BUILD_PASSED).alias("build_msg"),
                                  tag.alias("updated_by"))
    rows = details.join(pairs.select(*proj, F.col("dut_version").alias("intrinsic_version")), keys, "left_semi") \
                  .select(*keys, "test_api", "test_result")
    return build_summary, test_summary, rows


# --- K4 / K6 ------------------------------------------------------------------------

# Which marker column routes a frame to which table (first match).
ROUTES = (("compare_summary", "CompatTestSummary"), ("build_msg", "CompatBuildSummary"), ("test_api", "Compatibility"))


def route_by_shape(df: DataFrame) -> str | None:
    """K4: the destination table of a frame, chosen by the first marker
    column it has (schema only; no data is read)."""
    for col, table in ROUTES:
        if col in df.columns:
            return table
    return None


def update_where(df: DataFrame, predicate: Column, assignments: dict) -> DataFrame:
    """K6: conditional update as a new snapshot: assigned columns take the
    new value where ``predicate`` holds."""
    out = df
    for c, v in assignments.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(predicate, val).otherwise(F.col(c)))
    return out
