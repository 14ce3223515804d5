"""Resumable culprit search over builds that may not build.

The search state of every alert is a stored table: the newest build known
good and the oldest known bad, as positions on the axis of all changes. A round
looks at the build nearest to the midpoint that isn't known to be
unbuildable, inside the range; equally near ones go to the older. Its recorded verdict moves an
end; without one the alert waits and the build is asked for. When no
build is left between the ends the newest good and the oldest bad build bracket the
culprit. If the good end never moved it is tested itself; if it fails there is
no answer. All alerts advance together, and a later call resumes from the stored
state with the results that came in since.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchtrail.functions.ranking import dense_index
from benchtrail.functions.scan import running_max
from benchtrail.operators.bisect import CL, midpoint
from benchtrail.session import materialize
from benchtrail.sinks.versioned import VersionLog

#: fixed values: where a search stands
OPEN, WAITING, FOUND, NO_ANSWER = "open", "waiting", "found", "no answer"


def usable_axis(changes: DataFrame, builds: DataFrame) -> DataFrame:
    """(idx, changelist, before, after): every change with the nearest positions at or before
    and at or after it that aren't known to be unbuildable. ``builds``: changelist, build_ok."""
    bad = builds.groupBy(CL).agg(F.bool_and(~F.col("build_ok")).alias("bad"))
    axis = dense_index(changes.select(CL).filter(F.col(CL).isNotNull()).distinct(), CL, "idx")
    axis = materialize(axis.join(bad, CL, "left").select("idx", CL, F.when(~F.coalesce("bad", F.lit(False)), F.col("idx")).alias("u"),
                                                       F.lit(0).alias("_all"), (-F.col("idx")).alias("_back")), "axis")
    axis = materialize(running_max(axis, ["_all"], "idx", F.col("u"), "before"), "axis")
    after = running_max(axis.select("_all", "_back", "idx", "u"), ["_all"], "_back", -F.col("u"), "m").select("idx", (-F.col("m")).alias("after"))
    return materialize(axis.select("idx", CL, "before").join(after, "idx"), "axis")


def start(ranges: DataFrame, axis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state before the first round. ``ranges``: keys, good_cl, bad_cl, both on the axis."""
    at = lambda c, out: axis.select(F.col(CL).alias(c), F.col("idx").alias(out))
    return (ranges.select(*keys, "good_cl", "bad_cl").join(at("good_cl", "lo"), "good_cl").join(at("bad_cl", "hi"), "bad_cl")
            .select(*keys, "good_cl", "bad_cl", F.col("good_cl").alias("lo_cl"), F.col("bad_cl").alias("hi_cl"),
                    F.lit(OPEN).alias("status"), F.lit(None).cast("long").alias("next_cl"), F.lit(0).alias("rounds")))


def advance(state: DataFrame, axis: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All alerts as far as the recorded results go. ``results``: keys, changelist, fail.

    The state is kept by changelist, so the axis may have grown since. Each round is
    one join of the small state with the axis and one with the results."""
    keys = list(keys)
    cols = state.columns
    verdicts = materialize(results.groupBy(*keys, CL).agg(F.bool_or("fail").alias("fail")), "verdicts")
    st = state.withColumn("status", F.when(F.col("status") == WAITING, OPEN).otherwise(F.col("status")))
    at = lambda c, out: axis.select(F.col(CL).alias(c), F.col("idx").alias(out))
    while True:
        j = st.filter(F.col("status") == OPEN).join(at("lo_cl", "lo"), "lo_cl").join(at("hi_cl", "hi"), "hi_cl")
        j = j.withColumn("mid", midpoint()).join(axis.select(F.col("idx").alias("mid"), "before", "after"), "mid")
        older = F.when((F.col("before") > F.col("lo")) & (F.col("before") < F.col("hi")), F.col("before"))
        newer = F.when((F.col("after") > F.col("lo")) & (F.col("after") < F.col("hi")), F.col("after"))
        pick = (F.when(older.isNull(), newer).when(newer.isNull(), older)
                .when(F.col("mid") - older <= newer - F.col("mid"), older).otherwise(newer))
        j = j.withColumn("pick", pick).join(axis.select(F.col("idx").alias("pick"), F.col(CL).alias("pick_cl")), "pick", "left")
        # nothing left between the ends: a good end that never moved is looked at itself
        ends = F.col("pick").isNull()
        j = j.withColumn("look", F.when(~ends, F.col("pick_cl")).when(F.col("lo_cl") == F.col("good_cl"), F.col("lo_cl")))
        j = j.join(verdicts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(CL).alias("look_cl"), "fail"),
                   [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("look") == F.col("look_cl")], "left")
        fail = F.col("fail")
        status = (F.when(F.col("look").isNull(), FOUND).when(fail.isNull(), WAITING)
                  .when(ends & fail, NO_ANSWER).when(ends, FOUND).otherwise(OPEN))
        moved = ~ends & fail.isNotNull()
        step = j.select(*keys, "good_cl", "bad_cl", F.when(moved & ~fail, F.col("pick_cl")).otherwise(F.col("lo_cl")).alias("lo_cl"),
                        F.when(moved & fail, F.col("pick_cl")).otherwise(F.col("hi_cl")).alias("hi_cl"), status.alias("status"),
                        F.when(status == WAITING, F.col("look")).alias("next_cl"), (F.col("rounds") + moved.cast("int")).alias("rounds"))
        st = materialize(st.filter(F.col("status") != OPEN).select(*cols).unionByName(step.select(*cols)), "search")
        if st.filter(F.col("status") == OPEN).isEmpty():
            return st


class CulpritSearch:
    """A search whose state is stored between calls, under a log of versions."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ("test_case_name", "board")):
        self.spark, self.root, self.keys, self.log = spark, root.rstrip("/"), list(keys), VersionLog(spark, root)

    def _store(self, state: DataFrame) -> None:
        version, _ = self.log.latest()
        name = f"state/{version + 1}-{uuid.uuid4().hex[:12]}"
        state.write.parquet(f"{self.root}/{name}")
        self.log.commit(version + 1, {"state": name})

    def state(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.log.latest()[1]['state']}")

    def begin(self, ranges: DataFrame, changes: DataFrame, builds: DataFrame) -> None:
        self._store(start(ranges, usable_axis(changes, builds), self.keys))

    def resume(self, changes: DataFrame, builds: DataFrame, results: DataFrame) -> DataFrame:
        """Advance with all that is recorded now; returns the builds to build and test next:
        keys, changelist, built."""
        self._store(advance(self.state(), usable_axis(changes, builds), results, self.keys))
        built = builds.filter("build_ok").select(CL).distinct().withColumn("_b", F.lit(True))
        asked = self.state().filter(F.col("status") == WAITING).select(*self.keys, F.col("next_cl").alias(CL))
        return asked.join(built, CL, "left").select(*self.keys, CL, F.coalesce("_b", F.lit(False)).alias("built"))

    def culprits(self) -> DataFrame:
        """(keys, good_cl, bad_cl, culprit_cl, last_good_cl, rounds) of the alerts that are settled (culprit null: no answer)."""
        s = self.state().filter(F.col("status").isin(FOUND, NO_ANSWER))
        found = F.col("status") == FOUND
        return s.select(*self.keys, "good_cl", "bad_cl", F.when(found, F.col("hi_cl")).alias("culprit_cl"),
                        F.when(found, F.col("lo_cl")).alias("last_good_cl"), "rounds")
