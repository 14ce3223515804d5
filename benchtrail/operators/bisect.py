"""Culprit search over recorded verdicts.

The reference bisects one alert at a time, building and testing the midpoint
build of [good, bad]. Here every alert is bisected at once: builds get a
position on their series' axis, and each round is one equi-join of the
(small) search state with the verdicts at the midpoints. Rounds: about
log2(builds in the widest range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.session import checkpoint_dir

CL = "changelist"


def axis_positions(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Position (0-based, oldest first) of every build of a series."""
    w = Window.partitionBy(*keys).orderBy(CL)
    return records.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint"))


def midpoint(lo: str = "lo", hi: str = "hi"):
    """Of the n builds in [good, bad] listed newest first, the one at index
    floor(n/2) from the front (as a position on the oldest-first axis)."""
    n = F.col(hi) - F.col(lo) + 1
    return F.col(hi) - F.floor(n / 2).cast("bigint")


def next_midpoint(axis: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For every range (``keys``, good_cl, bad_cl) the midpoint build,
    from the positions of the axis (``keys``, changelist, idx)."""
    keys = list(keys)
    pos = axis.select(*keys, CL, "idx")
    r = (ranges.join(pos.withColumnRenamed(CL, "good_cl").withColumnRenamed("idx", "lo"), [*keys, "good_cl"])
               .join(pos.withColumnRenamed(CL, "bad_cl").withColumnRenamed("idx", "hi"), [*keys, "bad_cl"]))
    m = r.withColumn("idx", midpoint())
    return m.join(pos, [*keys, "idx"]).select(*keys, "good_cl", "bad_cl", F.col(CL).alias("mid_cl"))


def first_bad(verdicts: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first failing build per range by bisection over recorded
    verdicts, with the reference's rules: test the midpoint; a failure
    moves the bad end there, a pass moves the good end; stop when the
    midpoint is the good end; the answer is the bad end. If the good end
    never moved it is tested itself and, if it fails, there is no answer.

    ``verdicts``: ``keys, changelist, fail`` (one row per build of a series);
    ``ranges``: ``keys, good_cl, bad_cl``. Returns ``keys, good_cl, bad_cl,
    culprit_cl, rounds``.
    """
    keys = list(keys)
    spark = verdicts.sparkSession
    checkpoint_dir(spark)
    # positions are laid out by (series, position) once; every round's lookup
    # then shuffles only the small search state
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pos = axis_positions(verdicts.select(*keys, CL, "fail"), keys)
    p = pos.repartition(n_parts, *keys, "idx").select(*keys, "idx", CL, "fail").checkpoint()
    st = (ranges.join(p.select(*keys, F.col(CL).alias("good_cl"), F.col("idx").alias("lo")), [*keys, "good_cl"])
                .join(p.select(*keys, F.col(CL).alias("bad_cl"), F.col("idx").alias("hi")), [*keys, "bad_cl"])
                .select(*keys, "good_cl", "bad_cl", "lo", "hi", F.col("lo").alias("lo0"),
                        F.lit(False).alias("done"), F.lit(0).alias("rounds")))
    st = st.checkpoint()
    while not st.filter(~F.col("done")).isEmpty():  # every round halves the open ranges
        m = st.withColumn("_mid", F.when(~F.col("done"), midpoint()))
        stop = F.col("_mid") == F.col("lo")
        j = m.join(p.select(*keys, F.col("idx").alias("_mid"), F.col("fail").alias("_fail")), [*keys, "_mid"], "left")
        fail = F.coalesce(F.col("_fail"), F.lit(False))
        active = ~F.col("done") & ~stop
        st = j.select(*keys, "good_cl", "bad_cl",
                      F.when(active & ~fail, F.col("_mid")).otherwise(F.col("lo")).alias("lo"),
                      F.when(active & fail, F.col("_mid")).otherwise(F.col("hi")).alias("hi"),
                      "lo0", (F.col("done") | stop).alias("done"),
                      (F.col("rounds") + F.when(active, 1).otherwise(0)).alias("rounds")).checkpoint()
    end = (st.join(p.select(*keys, F.col("idx").alias("lo"), F.col("fail").alias("_lo_fail")), [*keys, "lo"], "left")
             .join(p.select(*keys, F.col("idx").alias("hi"), F.col(CL).alias("_hi_cl")), [*keys, "hi"], "left"))
    no_answer = (F.col("lo") == F.col("lo0")) & F.coalesce(F.col("_lo_fail"), F.lit(False))
    return end.select(*keys, "good_cl", "bad_cl", F.when(no_answer, F.lit(None)).otherwise(F.col("_hi_cl"))
                      .cast("bigint").alias("culprit_cl"), "rounds")


def nearest_buildable(builds: DataFrame, wanted: DataFrame, k: int = 5) -> DataFrame:
    """For each wanted build, the first of the ``k`` builds at or before
    it (newest first, itself included) whose build passed; null if none.
    ``builds``: changelist, build_ok; ``wanted``: changelist (+ any columns).
    Each wanted build looks at exactly k axis positions (equi-joins only)."""
    from benchtrail.functions.ranking import dense_index

    axis = dense_index(builds.select(CL, "build_ok").distinct(), CL, "bidx")
    w = wanted.join(axis.select(CL, F.col("bidx").alias("_w")), CL)
    tries = w.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_back")) \
             .withColumn("bidx", F.col("_w") - F.col("_back"))
    cand = tries.join(axis.select("bidx", F.col(CL).alias("_cand"), "build_ok"), "bidx")
    out_cols = [c for c in wanted.columns]
    best = (cand.filter(F.col("build_ok")).groupBy(*out_cols)
                .agg(F.min_by("_cand", "_back").alias("buildable_cl")))
    return wanted.join(best, out_cols, "left")


def with_authors(culprits: DataFrame, changes: DataFrame, cl_col: str = "culprit_cl") -> DataFrame:
    """The author of each culprit build (equi-join with the change
    dimension; AQE broadcasts it when its runtime size is small)."""
    return culprits.join(changes.select(F.col(CL).alias(cl_col), "author"), cl_col, "left")


def culprit_search(alerts: DataFrame, records: DataFrame, changes: DataFrame, threshold: float,
                   keys: Sequence[str] = ("test_case_name", "board"), value: str = "min_value") -> DataFrame:
    """For every alert (increase over the baseline), bisect
    [base_cl, cand_cl] on the recorded values -- a build fails when its value
    exceeds base * (1 + threshold/100) -- and attach the culprit's author as
    an open notification row."""
    keys = list(keys)
    a = alerts.select(*keys, F.col("base_cl").alias("good_cl"), F.col("cand_cl").alias("bad_cl"), "base_value")
    verdicts = (records.join(a.select(*keys, "base_value"), keys)
                       .select(*keys, CL, (F.col(value) > F.col("base_value") * (1 + float(threshold) / 100)).alias("fail")))
    found = first_bad(verdicts, a.select(*keys, "good_cl", "bad_cl"), keys)
    return (with_authors(found, changes)
            .withColumn("emailed", F.lit("NO")))


def next_tests(changes: DataFrame, verdicts: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W9 on sparse history (W8 + P11): for every open range, the midpoint
    build on the full change axis (every change between good and bad, as the
    search walks it), and whether a result for it is already recorded.
    Rows with ``tested`` = false are the builds to build and test next; after
    their results are recorded the next round starts from the updated ranges.
    ``changes``: changelist; ``verdicts``: keys, changelist, fail;
    ``ranges``: keys, good_cl, bad_cl."""
    from benchtrail.functions.ranking import dense_index

    keys = list(keys)
    axis = dense_index(changes.select(CL).distinct(), CL, "_g")
    r = (ranges.join(axis.select(F.col(CL).alias("good_cl"), F.col("_g").alias("lo")), "good_cl")
               .join(axis.select(F.col(CL).alias("bad_cl"), F.col("_g").alias("hi")), "bad_cl"))
    m = r.withColumn("_g", midpoint()).filter(F.col("_g") != F.col("lo"))   # mid at the good end: search is over
    m = m.join(axis, "_g").withColumnRenamed(CL, "mid_cl")
    done = verdicts.select(*keys, F.col(CL).alias("mid_cl")).distinct().withColumn("tested", F.lit(True))
    return (m.join(done, [*keys, "mid_cl"], "left")
             .select(*keys, "good_cl", "bad_cl", "mid_cl", F.coalesce(F.col("tested"), F.lit(False)).alias("tested")))
