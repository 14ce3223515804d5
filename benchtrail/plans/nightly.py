"""L2: the nightly regression report -- history filter, latest records,
alerts, alert records, worst-first ranking and the culprit search for every
increase -- over all tables (boards, algorithms) at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.operators.bisect import culprit_search
from benchtrail.operators.history import RECORD, history, latest_record, rank_regressions
from benchtrail.plans.regression import DEFAULT_THRESHOLD, regression_alerts


def nightly_report(runs: DataFrame, changes: DataFrame, threshold: float = DEFAULT_THRESHOLD, top_k: int = 10,
                   cl_range: tuple[int, int] | None = None, cls: Sequence | None = None,
                   min_cl: int | None = None, like: str | None = None) -> dict[str, DataFrame]:
    """``alerts`` (every series with its verdict), ``increases`` (alerts that
    got slower, worst first), ``top`` (the ``top_k`` worst) and ``culprits``
    (first failing build and author for each increase)."""
    hist = history(runs, min_cl, like)
    alerts = regression_alerts(hist, threshold=threshold, cl_range=cl_range, cls=cls)
    increases = alerts.filter(F.col("alert") & (F.col("flag") == 1))
    top = rank_regressions(increases, top_k)
    recs = latest_record(hist, RECORD, values=["min_value"])
    culprits = culprit_search(increases, recs, changes, threshold)
    return {"alerts": alerts, "increases": increases.orderBy(F.col("delta_pct").desc()), "top": top,
            "culprits": culprits}
