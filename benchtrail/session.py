"""Spark session and shared-folder helpers.

Every operator in the package is a plain DataFrame -> DataFrame function; this
module only builds a session with the settings the operators assume (UTC, AQE,
no UI) and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A broadcast side must have a known, small size; 32 MB is the ceiling
    # the planner may pick on its own (dimension tables, CL axis, catalogues).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Pack many small log files into one split.
    "spark.sql.files.openCostInBytes": str(1 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "benchtrail",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given. Only a local master gets a fresh
    folder of this machine when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="benchtrail-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: what
    follows sees the same rows however often it reads them, and reads only
    the columns it needs."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
