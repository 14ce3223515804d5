"""L1: profile logs to run rows -- S1 scan, S2 parse, A1 loop merge, S4/P4
environment -- as one lazy plan (the only boundaries are shuffles)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchtrail.operators.merge import merge_loops, with_environment
from benchtrail.sources.logs import ENV_KEYS, environment_columns, parse_environment, parse_profile_report


def profile_runs(log_lines: DataFrame, env_lines: DataFrame, run_of_log: dict[str, Column],
                 run_of_env: dict[str, Column], behaviour: str = "default", mode: str = "name",
                 env_keys: Sequence[str] = ENV_KEYS) -> DataFrame:
    """Run rows from profile logs and environment files.

    ``run_of_log`` maps run-key names to expressions over a log's ``file``
    column, including ``loop`` (the repetition number); ``run_of_env`` maps
    the same run keys (without ``loop``) over an environment file's ``file``.
    Environment values override nothing: keys that are run keys are dropped
    from the environment record.
    """
    run_keys = [k for k in run_of_log if k != "loop"]
    nodes = parse_profile_report(log_lines)
    nodes = nodes.select("*", *[e.alias(k) for k, e in run_of_log.items()])
    merged = merge_loops(nodes, run_keys, loop_col="loop", behaviour=behaviour, mode=mode)
    env = environment_columns(parse_environment(env_lines), env_keys)
    env = env.select(*[e.alias(k) for k, e in run_of_env.items()],
                     *[F.col(k) for k in env_keys if k not in run_of_env])
    return (with_environment(merged, env, run_keys)
            .withColumn("unitperf", F.lit("cycle")))
