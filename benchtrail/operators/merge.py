"""Merging repeated profiling loops and scaling node statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Loop behaviour -> statistic, and the node that is skipped.
BEHAVIOUR = {"default": "median", "codec": "min", "worst": "max"}
ROOT_NODE = "Root-Node"


def _stat(col: str, behaviour: str) -> Column:
    how = BEHAVIOUR[behaviour]
    if how == "median":
        return F.median(col)          # exact (percentile 0.5, interpolated)
    return F.min(col) if how == "min" else F.max(col)


def merge_loops(nodes: DataFrame, run_keys: Sequence[str], loop_col: str = "loop",
                behaviour: str = "default", mode: str = "name", median: str = "percentile") -> DataFrame:
    """A1: one row per run and node over the repeated loops of the run.

    Each of max/min/avg is reduced over the loops (default median, ``codec``
    min, ``worst`` max) and rounded down. The root node is skipped (P16).

    median="percentile" keeps each (run, node) group's values in one
    aggregation buffer (groups are the loops of one run); median="ranked"
    computes the same exact median by global rank, for groups of any size.

    mode="name": loops are matched by node name (a node missing from some
    loops is merged over the loops that have it).
    mode="reference" (J11): node k of every loop is matched with node k of the
    others; positions past the shortest loop are dropped and the name comes
    from the first loop.
    """
    run_keys = list(run_keys)
    if mode == "name" and BEHAVIOUR[behaviour] == "median" and median == "ranked":
        return _ranked_median_merge(nodes.filter(F.col("name") != ROOT_NODE), run_keys)
    if mode == "name":
        kept = nodes.filter(F.col("name") != ROOT_NODE)
        out = kept.groupBy(*run_keys, F.col("name").alias("test_case_name")).agg(
            *[F.floor(_stat(s, behaviour)).cast("bigint").alias(f"{s}_value") for s in ("max", "min", "avg")])
        return out
    if mode != "reference":
        raise ValueError(mode)
    # position of the node inside its loop's log (nodes per log: a bounded group)
    w = Window.partitionBy(*run_keys, loop_col).orderBy("node_ix")
    pos = nodes.withColumn("pos", F.row_number().over(w))
    sizes = pos.groupBy(*run_keys, loop_col).agg(F.max("pos").alias("_n"))
    shortest = sizes.groupBy(*run_keys).agg(F.min("_n").alias("_m"))
    pos = pos.join(shortest, run_keys).filter(F.col("pos") <= F.col("_m"))
    agg = pos.groupBy(*run_keys, "pos").agg(
        F.min_by("name", loop_col).alias("test_case_name"),
        *[F.floor(_stat(s, behaviour)).cast("bigint").alias(f"{s}_value") for s in ("max", "min", "avg")])
    return agg.filter(F.col("test_case_name") != ROOT_NODE).drop("pos")


def _ranked_median_merge(kept: DataFrame, run_keys: list[str]) -> DataFrame:
    from benchtrail.functions.ranking import group_median
    stats = ("max", "min", "avg")
    long = kept.select(*run_keys, F.col("name").alias("test_case_name"),
                       F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).alias("v")) for s in stats])).alias("_sv"))
    long = long.select(*run_keys, "test_case_name", F.col("_sv.stat").alias("stat"), F.col("_sv.v").alias("v"))
    med = group_median(long, [*run_keys, "test_case_name", "stat"], "v", "m")
    wide = med.groupBy(*run_keys, "test_case_name").pivot("stat", list(stats)).agg(F.first("m"))
    return wide.select(*run_keys, "test_case_name",
                       *[F.floor(F.col(s)).cast("bigint").alias(f"{s}_value") for s in stats])


def min_stats(stats: DataFrame, fps: float, node: str | None = None) -> DataFrame:
    """A2: best of all ``.log`` files: min over logs of Max / Avg (/ Min for
    one node), scaled ``round(fps * v / 1e6, 2)``. ``stats`` is S3 output."""
    logs = stats.filter(F.col("file").endswith(".log"))
    if node is not None:
        logs = logs.filter(F.col("node") == node)

    def best(stat: str) -> Column:
        return F.round(F.lit(float(fps)) * F.min(F.when(F.col("stat") == stat, F.col("value"))) / 1e6, 2)

    cols = [best("Max").alias("min_max"), best("Avg").alias("min_avg")]
    if node is not None:
        cols.append(best("Min").alias("min_min"))
    return logs.groupBy("node").agg(*cols)


def master_report(stats: DataFrame) -> DataFrame:
    """A3: every value of every node and stat over the ``.log`` files, one row
    per value (``node, stat, file, value``) -- the per-node lists of the
    report, kept as rows instead of one array per node."""
    return stats.filter(F.col("file").endswith(".log") & F.col("stat").isin("Max", "Avg", "Min")) \
                .select("node", "stat", "file", "value")


def scale_to_frame(nodes: DataFrame, frame_node: str) -> DataFrame:
    """A4: per log, when the frame node is present and there is more than one
    node: nodes without a call count are dropped, and every other node's
    max/min/avg is multiplied by ceil(calls / frame_calls) if it ran more
    often than the frame node (else by 1, also if the frame node never ran).
    Otherwise the log is unchanged.
    """
    per_file = nodes.groupBy("file").agg(
        F.max(F.when(F.col("name") == frame_node, F.col("num_calls"))).alias("_frame_calls"),
        F.max(F.when(F.col("name") == frame_node, F.lit(True))).alias("_has_frame"),
        F.count(F.lit(1)).alias("_n"))
    j = nodes.join(per_file, "file")
    active = F.coalesce(F.col("_has_frame"), F.lit(False)) & (F.col("_n") > 1)
    is_frame = F.col("name") == frame_node
    scale = F.when(~active | is_frame, F.lit(1)).when(
        F.col("num_calls") > F.col("_frame_calls"),
        F.coalesce(F.ceil(F.try_divide("num_calls", "_frame_calls")), F.lit(1))).otherwise(F.lit(1))
    keep = ~active | is_frame | F.col("num_calls").isNotNull()
    return (j.filter(keep)
             .select(*[c for c in nodes.columns if c not in ("max", "min", "avg")],
                     *[(F.col(s) * scale).alias(s) for s in ("max", "min", "avg")]))


def with_environment(nodes: DataFrame, env: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Run-level environment values on every node row (equi-join on the
    run key; AQE turns it into a broadcast when the runtime size allows)."""
    return nodes.join(env, on, "left")
