"""Regression alerts and two-build statistics over run history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.operators.history import (CL, SERIES, baseline, compare_builds, delta_histogram,
                                          dut_ref, history, latest_record)

DEFAULT_THRESHOLD = 10


def regression_alerts(runs: DataFrame, value: str = "min_value", threshold: float = DEFAULT_THRESHOLD,
                      candidate: int | None = None, cl_range: tuple[int, int] | None = None,
                      cls: Sequence | None = None, min_cl: int | None = None, like: str | None = None,
                      keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series with candidate, baseline, delta and verdict.

    Candidate: the series' latest build, or build ``candidate`` (a series
    without it gets value 0, as the report does). Baseline: the build before
    the latest; or the mean over ``cl_range``; or the mean over the builds of
    ``cls`` the series has. delta = 100*(cand-base)/base; ``alert`` when
    |delta| > threshold (strict); ``flag`` = 1 only for increases. No baseline
    or a zero baseline gives a null delta and status ``no_baseline``.
    """
    keys = list(keys)
    hist = history(runs, min_cl, like)
    # Newest update wins per (series, build) -- partial aggregation map-side.
    recs = latest_record(hist, [*keys, CL], values=[value])

    need_top2 = cl_range is None and cls is None
    if candidate is None or need_top2:
        # latest two builds per series; the rank filter becomes a group limit
        # that is applied before the shuffle as well (bounded rows per series).
        w = Window.partitionBy(*keys).orderBy(F.col(CL).desc())
        top = recs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
        out = top.groupBy(*keys).agg(
            F.max(F.when(F.col("_rn") == 1, F.col(CL))).alias("cand_cl"),
            F.max(F.when(F.col("_rn") == 1, F.col(value))).alias("cand_value"),
            F.max(F.when(F.col("_rn") == 2, F.col(CL))).alias("base_cl"),
            F.max(F.when(F.col("_rn") == 2, F.col(value))).alias("base_value"))
    else:
        out = recs.groupBy(*keys).agg(
            F.max(F.when(F.col(CL) == F.lit(int(candidate)), F.col(value))).alias("cand_value"))

    if candidate is not None:
        # the explicit build: a series without it reports value 0
        at = recs.filter(F.col(CL) == F.lit(int(candidate))).select(*keys, F.col(value).alias("_cv"))
        if need_top2:
            out = out.drop("cand_value").join(at, keys, "left").withColumnRenamed("_cv", "cand_value")
        out = (out.withColumn("cand_cl", F.lit(int(candidate)).cast("bigint"))
                  .withColumn("cand_value", F.coalesce(F.col("cand_value"), F.lit(0.0))))

    if not need_top2:
        b = baseline(recs, value, cl_range=cl_range, cls=cls, keys=keys)
        out = out.drop("base_cl", "base_value").join(b.select(*keys, "base_cl", "base_value"), keys, "left")

    delta = F.try_divide(100 * (F.col("cand_value") - F.col("base_value")), F.col("base_value"))
    thr = F.lit(float(threshold))
    alert = (delta > thr) | (delta < -thr)  # the exact value decides, the shown one is rounded
    return out.select(*keys, "cand_cl", "cand_value", "base_cl", "base_value", F.round(delta, 6).alias("delta_pct"),
                      F.coalesce(alert, F.lit(False)).alias("alert"), F.when(delta > 0, 1).otherwise(0).alias("flag"),
                      F.when(delta.isNull(), "no_baseline").when(alert, "out_of_range").otherwise("in_range").alias("status"))


def slower_than_previous(runs: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                         value: str = "min_value") -> DataFrame:
    """Minimum slice: series whose latest build is slower than the previous
    one by more than ``threshold`` percent, worst first."""
    a = regression_alerts(runs, value=value, threshold=threshold)
    return (a.filter(F.col("alert") & (F.col("flag") == 1))
             .select(*SERIES, "cand_cl", "cand_value", "base_cl", "base_value", "delta_pct")
             .orderBy(F.col("delta_pct").desc(), *SERIES))


def alert_records(alerts: DataFrame, table: Column | str = "algorithm", cfg: str = "", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """R2: the alert line for each increase, ``delta;cand,ref;table;case;cfg;thr``,
    next to typed columns (the line is what the culprit search reads back)."""
    inc = alerts.filter(F.col("alert") & (F.col("flag") == 1))
    tbl = F.col(table) if isinstance(table, str) else table
    line = F.format_string("%s;%s,%s;%s;%s;%s;%s", F.col("delta_pct").cast("string"), F.col("cand_cl"),
                           F.col("base_cl"), tbl, F.col("test_case_name"), F.lit(cfg), F.lit(str(threshold)))
    return inc.withColumn("record", line)


def two_build_statistic(runs: DataFrame, dut: dict, ref: dict, base_cl: int, cand_cl: int,
                        threshold: float = DEFAULT_THRESHOLD, mode: str = "reference") -> tuple[DataFrame, DataFrame]:
    """(histogram of DUT vs REF deltas, better/worse/same counts)."""
    return (delta_histogram(dut_ref(runs, dut, ref), mode),
            compare_builds(runs, base_cl, cand_cl, threshold))

