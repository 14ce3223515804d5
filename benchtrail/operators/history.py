"""Run-history operators over the profile-runs table (one row per run of a
test case on a board for a build).

Grain: a *series* is (test_case_name, board); a *record* is one
(test_case_name, board, changelist). Several runs of one record are resolved
by ``latest_record`` (newest ``updatetime``, ``event_id`` as tie-break).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("test_case_name", "board")
RECORD = ("test_case_name", "board", "changelist")
CL = "changelist"


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


# --- P2 / W1 / A12 -----------------------------------------------------------

def history(runs: DataFrame, min_cl: int | None = None, like: str | None = None,
            case_insensitive: bool = True) -> DataFrame:
    """Runs with changelist >= ``min_cl`` whose case name matches ``like``.

    Surrounding quotes of the pattern are stripped; the default comparison is
    case-insensitive like the collation the reports ran against.
    """
    out = runs
    if min_cl is not None:
        out = out.filter(F.col(CL) >= F.lit(min_cl))
    if like is not None:
        pat = like.strip("'").strip('"')
        name = F.col("test_case_name")
        out = out.filter(name.ilike(pat) if case_insensitive else name.like(pat))
    return out


def latest_record(runs: DataFrame, keys: Sequence[str] = RECORD, ts: str = "updatetime",
                  tie: Sequence[str] = ("event_id",), values: Sequence[str] | None = None) -> DataFrame:
    """Per key, the values of the run with the greatest (ts, tie...).

    One aggregation with a partial ``max_by`` on the map side -- no window,
    no N+1 correlated lookups; a key holding many runs is combined before the
    shuffle. The struct buffers make it a sort-based aggregate, which spills
    rather than failing on large partitions.
    """
    keys = _cols(keys)
    if values is None:
        values = [c for c in runs.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in [ts, *tie]])
    agg = runs.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_latest"))
    return agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in values])


def history_series(runs: DataFrame, min_cl: int | None = None, like: str | None = None,
                   value_cols: Sequence[str] = ("min_value", "avg_value")) -> DataFrame:
    """One row per (case, board, changelist), newest update wins."""
    hist = history(runs, min_cl, like)
    return latest_record(hist, RECORD, values=["updatetime", "event_id", *value_cols])


# --- W2 / W3 / A19 / W4 --------------------------------------------------------

def with_previous(series: DataFrame, value: str = "min_value", keys: Sequence[str] = SERIES) -> DataFrame:
    """Previous build's changelist and value within the series."""
    w = Window.partitionBy(*keys).orderBy(CL)
    return (series.withColumn("prev_cl", F.lag(CL).over(w))
                  .withColumn("prev_value", F.lag(value).over(w)))


def pct_from_first(series: DataFrame, value: str = "min_value", keys: Sequence[str] = SERIES) -> DataFrame:
    """Percent change of every value from the series' first (oldest) value."""
    w = Window.partitionBy(*keys).orderBy(CL).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(value).over(w)
    return series.withColumn("pct_from_first", F.round(F.try_divide(100 * (F.col(value) - first), first), 6))


def series_extent(series: DataFrame, value: str = "min_value", keys: Sequence[str] = SERIES) -> DataFrame:
    """Chart extents per series: [min - 1% of first, max + 1% of first],
    and the percent-delta range widened by 1 on each side."""
    first = F.min_by(value, CL)
    agg = series.groupBy(*keys).agg(first.alias("_first"), F.min(value).alias("_min"), F.max(value).alias("_max"))
    pd_lo = F.try_divide(100 * (F.col("_min") - F.col("_first")), F.col("_first"))
    pd_hi = F.try_divide(100 * (F.col("_max") - F.col("_first")), F.col("_first"))
    return agg.select(*keys,
                      F.round(F.col("_min") - F.col("_first") * 0.01, 6).alias("y_min"),
                      F.round(F.col("_max") + F.col("_first") * 0.01, 6).alias("y_max"),
                      F.round(pd_lo - 1, 6).alias("delta_min"),
                      F.round(pd_hi + 1, 6).alias("delta_max"))


def last_n(series: DataFrame, n: int) -> DataFrame:
    """Rows on the last ``n`` changelists of the common axis (the union of
    all series' changelists); ``x`` = position on that axis. n = 0 keeps all.

    The axis is distinct changelists. For n > 0 it is cut to n rows by a
    top-n (bounded, so it is broadcast); for n = 0 the position is a
    distributed dense index (no single-partition window).
    """
    from benchtrail.functions.ranking import dense_index

    axis = series.select(CL).distinct()
    if n > 0:
        top = axis.orderBy(F.col(CL).desc()).limit(n)
        w = Window.orderBy(CL)  # at most n rows
        top = top.withColumn("x", (F.row_number().over(w) - 1).cast("bigint"))
        return series.join(F.broadcast(top), CL, "inner")
    return series.join(dense_index(axis, CL, "x"), CL, "inner")


# --- A7 baseline ---------------------------------------------------------------

def baseline(series: DataFrame, value: str = "min_value", cl_range: tuple[int, int] | None = None,
             cls: Sequence | None = None, keys: Sequence[str] = SERIES) -> DataFrame:
    """Baseline value per series.

    ``cl_range=(lo, hi)``: mean over the series' changelists in [lo, hi].
    ``cls=[...]``: mean over the listed changelists the series has; entries
    that are absent or not numeric are ignored. ``base_cl`` is the last
    changelist that contributed (highest in range, last listed for a list).
    A series with no contributing build gets no row (caller sees null).
    """
    keys = _cols(keys)
    if cl_range is not None:
        lo, hi = int(cl_range[0]), int(cl_range[1])
        sel = series.filter(F.col(CL).between(lo, hi))
        return sel.groupBy(*keys).agg(F.avg(value).alias("base_value"), F.max(CL).alias("base_cl"),
                                      F.count(F.lit(1)).alias("base_n"))
    if cls is not None:
        spark = series.sparkSession
        wanted = [(int(str(c).strip()), i) for i, c in enumerate(cls) if str(c).strip().isdigit()]
        lst = spark.createDataFrame(wanted, f"{CL} bigint, _pos int") if wanted else \
            spark.createDataFrame([], f"{CL} bigint, _pos int")
        # The list is user input of bounded length: broadcasting it is safe.
        sel = series.join(F.broadcast(lst), CL, "inner")
        return sel.groupBy(*keys).agg(F.avg(value).alias("base_value"), F.max_by(CL, "_pos").alias("base_cl"),
                                      F.count(F.lit(1)).alias("base_n"))
    raise ValueError("baseline needs cl_range or cls")


# --- J1 / J2 / A8 / A9 / A13 -------------------------------------------------------

def value_at(runs: DataFrame, changelist: int, value: str = "min_value",
             keys: Sequence[str] = SERIES) -> DataFrame:
    """Latest record of every series at one changelist (correlated-max query
    of the reports, as one aggregation)."""
    at = runs.filter(F.col(CL) == F.lit(int(changelist)))
    return latest_record(at, [*keys], values=[value])


def compare_builds(runs: DataFrame, base_cl: int, cand_cl: int, threshold: float = 10,
                   value: str = "min_value", group: Sequence[str] = ("algorithm", "board")) -> DataFrame:
    """A8 (+J2): better / worse / unchanged counts of cases between two builds.

    Cases that lack either build are left out of every count. Better when
    base - cand > base*thr/100, worse when cand - base > base*thr/100 (strict).
    One row per ``group`` (a reference "table" is one algorithm x board).
    """
    keys = ["test_case_name", *group]
    base = value_at(runs, base_cl, value, keys).withColumnRenamed(value, "base")
    cand = value_at(runs, cand_cl, value, keys).withColumnRenamed(value, "cand")
    both = base.join(cand, keys, "inner")
    lim = F.col("base") * F.lit(float(threshold)) / 100
    better = (F.col("base") - F.col("cand")) > lim
    worse = ~better & ((F.col("cand") - F.col("base")) > lim)
    return both.groupBy(*group).agg(
        F.count_if(better).cast("bigint").alias("better"),
        F.count_if(worse).cast("bigint").alias("worse"),
        F.count_if(~better & ~worse).cast("bigint").alias("no_change"),
        F.count(F.lit(1)).cast("bigint").alias("total"))


def case_lists(runs: DataFrame, base_cl: int, cand_cl: int, threshold: float = 10,
               value: str = "min_value", group: Sequence[str] = ("algorithm", "board")) -> DataFrame:
    """A8 name lists: one row per compared case with its verdict."""
    keys = ["test_case_name", *group]
    base = value_at(runs, base_cl, value, keys).withColumnRenamed(value, "base")
    cand = value_at(runs, cand_cl, value, keys).withColumnRenamed(value, "cand")
    lim = F.col("base") * F.lit(float(threshold)) / 100
    verdict = (F.when((F.col("base") - F.col("cand")) > lim, "better")
                .when((F.col("cand") - F.col("base")) > lim, "worse")
                .otherwise("no_change"))
    return base.join(cand, keys, "inner").withColumn("verdict", verdict)


def accumulate(summaries: DataFrame, group: Sequence[str] = ("algorithm", "board")) -> DataFrame:
    """Totals over all tables at once, plus per-table rows (rollup)."""
    g = _cols(group)
    return summaries.rollup(*g).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("better", "worse", "no_change", "total")])


# Fixed bucket labels of the two-build delta histogram (reference values).
DELTA_BUCKETS = ("better_than_20", "better_than_5", "same_in_5", "worse_than_5", "worse_than_20", "worse_than_50")


def delta_bucket(delta: Column, mode: str = "reference") -> Column:
    """A9 bucket of delta = (dut - ref) / ref, first matching rule wins.

    reference: >0.5, >0.2, >=0.05, |d|<0.05, <-0.05, <-0.2 (the last is never
    reached and d = -0.05 falls in no bucket). fixed: <-0.2 is tested before
    <-0.05 and d = -0.05 counts as "same".
    """
    if mode == "reference":
        return (F.when(delta > 0.5, "worse_than_50").when(delta > 0.2, "worse_than_20")
                 .when(delta >= 0.05, "worse_than_5").when((delta < 0.05) & (delta > -0.05), "same_in_5")
                 .when(delta < -0.05, "better_than_5").when(delta < -0.2, "better_than_20"))
    if mode == "fixed":
        return (F.when(delta > 0.5, "worse_than_50").when(delta > 0.2, "worse_than_20")
                 .when(delta >= 0.05, "worse_than_5").when(delta < -0.2, "better_than_20")
                 .when(delta < -0.05, "better_than_5").otherwise("same_in_5"))
    raise ValueError(mode)


def dut_ref(runs: DataFrame, dut: dict, ref: dict, value: str = "min_value") -> DataFrame:
    """DUT and REF values joined on test case. ``dut``/``ref`` are
    equality filters (e.g. board and changelist) selecting one table/build."""
    def side(sel: dict, name: str) -> DataFrame:
        df = runs
        for k, v in sel.items():
            df = df.filter(F.col(k) == F.lit(v))
        return latest_record(df, ["test_case_name"], values=[value]).withColumnRenamed(value, name)
    return side(dut, "dut").join(side(ref, "ref"), "test_case_name", "inner")


def delta_histogram(pairs: DataFrame, mode: str = "reference") -> DataFrame:
    """Counts per bucket over the common cases, one row, zero-filled."""
    delta = F.try_divide(F.col("dut") - F.col("ref"), F.col("ref"))
    b = delta_bucket(delta, mode)
    return pairs.agg(*[F.count_if(b == F.lit(name)).cast("bigint").alias(name) for name in DELTA_BUCKETS],
                     F.count(F.lit(1)).cast("bigint").alias("n_common"))


# --- A10 / A15 / J12 / R3 report row -----------------------------------------------

def distinct_counts(runs: DataFrame) -> DataFrame:
    """A10: distinct cases, changelists and values (exact)."""
    return runs.agg(F.count_distinct("test_case_name").cast("bigint").alias("n_cases"),
                    F.count_distinct(CL).cast("bigint").alias("n_changelists"),
                    F.count_distinct("min_value").cast("bigint").alias("n_values"))


def benchmark_pivot(runs: DataFrame, algorithm: str | None, columns: Sequence[str], column: str = "board",
                    value: str = "min_value") -> DataFrame:
    """Function rows x backend columns for one algorithm; each cell is
    the latest build's latest value of that series (joined by name, D9).
    ``columns`` is the fixed list of backends (the pivot has a known width).
    ``algorithm`` None gives the tables of all algorithms, with it as a key."""
    sel = runs if algorithm is None else runs.filter(F.col("algorithm") == F.lit(algorithm))
    keys = ["algorithm"] * (algorithm is None) + ["test_case_name"]
    rec = latest_record(sel, [*keys, column], ts=CL, tie=("updatetime", "event_id"), values=[value])
    return rec.groupBy(*keys).pivot(column, list(columns)).agg(F.first(value))


def report_rows(runs: DataFrame, changelist: int | None = None, variant: str = "nightly") -> DataFrame:
    """R3 (+J12): per case and board, the report cells of one build
    (latest build of the series when ``changelist`` is None).

    first = int(min); spread = round(100*(avg-min)/first) (null when first is 0
    or avg is missing); fft: work = 5 n log2 n with n the last ``_`` part,
    third = round(first/work, 2), both null when n isn't a number or work is 0; math: first = first div 100 after the spread
    (the nightly report divides integers).

    variant="two_build" (the DUT-vs-REF report): first is the minimum itself
    (no int), math divides as floats and rounds, and there is no work cell;
    a case without an average gets no row.
    """
    if changelist is None:
        rec = latest_record(runs, SERIES, ts=CL, tie=("updatetime", "event_id"),
                            values=["algorithm", CL, "min_value", "avg_value"])
    else:
        rec = latest_record(runs.filter(F.col(CL) == int(changelist)), SERIES,
                            values=["algorithm", CL, "min_value", "avg_value"])
    if variant == "two_build":
        rec = rec.filter(F.col("avg_value").isNotNull())
        mn = F.col("min_value")
        spread2 = F.round(F.try_divide(100 * (F.col("avg_value") - mn), mn), 0)
        n2 = F.element_at(F.split("test_case_name", "_"), -1).try_cast("bigint")
        return rec.select(
            *SERIES, "algorithm", CL,
            F.when(F.col("algorithm") == "math", F.round(mn / 100, 0)).otherwise(mn).alias("first"),
            spread2.alias("spread"),
            F.when(F.col("algorithm") == "fft", F.round(F.try_divide(mn, 5 * n2 * F.log2(n2)), 2)).alias("third"))
    first = F.col("min_value").cast("bigint")
    spread = F.round(F.try_divide(100 * (F.col("avg_value") - F.col("min_value")), first), 0)
    n = F.element_at(F.split("test_case_name", "_"), -1).try_cast("bigint")
    work = 5 * n * F.log2(n)
    is_fft = F.col("algorithm") == "fft"
    is_math = F.col("algorithm") == "math"
    return rec.select(
        *SERIES, "algorithm", CL,
        F.when(is_math, F.floor(first / 100)).otherwise(first).cast("bigint").alias("first"),
        spread.alias("spread"),
        F.when(is_fft, F.round(work, 6)).alias("work"),
        F.when(is_fft, F.round(F.try_divide(first, work), 2)).alias("third"))


# --- O2 / Q1 / Q2 -----------------------------------------------------------------

def rank_regressions(alerts: DataFrame, k: int, by: str = "delta_pct") -> DataFrame:
    """O2: the k largest regressions (TakeOrderedAndProject: per-partition top-k,
    then a k-row merge)."""
    return alerts.orderBy(F.col(by).desc(), *[F.col(c) for c in RECORD if c in alerts.columns]).limit(k)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1/Q2: key values that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
              .filter(F.col("n") > 1))
