"""Sinks: schema-checked appends, table writes, fan-out, report files and
table definitions (K1-K3, K5, K7-K10)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchtrail.operators.compat import route_by_shape
from benchtrail.session import materialize
from benchtrail.sinks.versioned import VersionedTable

#: name of the folder of a null, as Spark's writers have it
NO_NAME = "__HIVE_DEFAULT_PARTITION__"

# Table definitions (columns and keys of the result tables). Keys are
# documented and checked by ``key_violations``; Spark does not enforce them.
PROFILE_RUNS = T.StructType([
    T.StructField("test_case_name", T.StringType()), T.StructField("max_value", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()), T.StructField("avg_value", T.DoubleType()),
    T.StructField("unitperf", T.StringType()), T.StructField("cmd", T.StringType()),
    T.StructField("backend", T.StringType()), T.StructField("board", T.StringType()),
    T.StructField("target", T.StringType()), T.StructField("os", T.StringType()),
    T.StructField("arch", T.StringType()), T.StructField("changelist", T.LongType()),
    T.StructField("compiler", T.StringType()), T.StructField("glibc", T.StringType()),
    T.StructField("technology", T.StringType()), T.StructField("updatetime", T.TimestampType()),
    T.StructField("algorithm", T.StringType()),
])
NOTIFICATION = T.StructType([
    T.StructField("changelist", T.LongType()), T.StructField("author", T.StringType()),
    T.StructField("emailed", T.StringType()), T.StructField("ack", T.StringType()),
    T.StructField("jira", T.StringType()), T.StructField("comment", T.StringType()),
])
KEYED = [T.StructField(c, T.StringType()) for c in ("intrinsic_version", "project_name", "project_version", "project_release")]
BUILD_SUMMARY = T.StructType([*KEYED, T.StructField("build_result", T.LongType()), T.StructField("build_msg", T.StringType()), T.StructField("updated_by", T.StringType())])
TEST_SUMMARY = T.StructType([*KEYED, *[T.StructField(c, T.StringType()) for c in (
    "subtotal_on_passed", "subtotal_on_failed", "subtotal_on_unresolved", "compare_summary", "updated_by")]])
COMPATIBILITY = T.StructType([*KEYED, T.StructField("test_api", T.StringType()), T.StructField("test_result", T.StringType())])
HIERARCHY = T.StructType([T.StructField("test_case_name", T.StringType()), T.StructField("parent_test_case", T.StringType())])
RELEASE_TAG = T.StructType([T.StructField("changelist", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("tag", "sprint", "release_version")]])
_KEY = ("intrinsic_version", "project_name", "project_version", "project_release")
SCHEMAS = {"profile_runs": (PROFILE_RUNS, ("test_case_name", "board", "changelist", "updatetime")),
           "notification": (NOTIFICATION, ("changelist",)),
           "CompatBuildSummary": (BUILD_SUMMARY, _KEY), "CompatTestSummary": (TEST_SUMMARY, _KEY),
           "Compatibility": (COMPATIBILITY, (*_KEY, "test_api")),
           "test_case_hierarchy": (HIERARCHY, ("test_case_name",)), "release_version_tag": (RELEASE_TAG, ("changelist",))}
#: values of columns that a new row doesn't give (all others: null)
DEFAULTS = {"notification": {"emailed": "NO", "ack": "NO"}, "CompatBuildSummary": {"build_result": 1, "build_msg": "Build passed!"},
            "CompatTestSummary": {"compare_summary": "Tests pass"}}
PARTITIONS = {"profile_runs": "algorithm", "CompatBuildSummary": "project_name", "CompatTestSummary": "project_name", "Compatibility": "project_name"}


def versioned(spark: SparkSession, root: str, name: str) -> VersionedTable:
    """The known table ``name`` below ``root``, with its defaults, keys and partitions."""
    schema, keys = SCHEMAS[name]
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}", schema, keys, DEFAULTS.get(name), PARTITIONS.get(name))


def create_tables(spark: SparkSession, root: str, names: Sequence[str] | None = None,
                  prefix: str = "") -> list[str]:
    """``CREATE TABLE ... USING parquet`` for the known tables under
    ``root`` (profile runs partitioned by algorithm and board)."""
    made = []
    for name in names or SCHEMAS:
        schema, _ = SCHEMAS[name]
        given = lambda f: f" DEFAULT {DEFAULTS[name][f]!r}" if f in DEFAULTS.get(name, {}) else ""
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{given(f.name)}" for f in schema.fields)
        part = " PARTITIONED BY (algorithm, board)" if name == "profile_runs" else ""
        full = f"{prefix}{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet{part} LOCATION '{root.rstrip('/')}/{full}'")
        made.append(full)
    return made


def append_known(df: DataFrame, table: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """K1: append ``df`` to ``table`` keeping only the columns the table
    knows (unknown ones are dropped, missing ones and generated key columns
    are typed nulls), in the table's column order. Returns what was written."""
    target = df.sparkSession.table(table).schema
    have = set(df.columns) - set(key_cols)
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])
    out.write.insertInto(table)
    return out


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """K2: append to or replace a parquet table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Fixed value: the four columns of the CSV copy written next to the tables.
CSV_COLUMNS = ("test_case_name", "max_value", "min_value", "avg_value")


def fan_out(df: DataFrame, paths: Sequence[str], csv_path: str | None = None) -> None:
    """K3: one frame to several tables plus a four-column CSV copy; the frame
    is computed once."""
    df = materialize(df, "fan-out")
    for p in paths:
        df.write.mode("append").parquet(p)
    if csv_path:
        df.select(*CSV_COLUMNS).write.mode("overwrite").option("header", True).csv(csv_path)


def write_parallel(df: DataFrame, path: str, n: int, batch: int = 1000, fmt: str = "parquet",
                   options: dict | None = None) -> None:
    """K5: write with ``n`` parallel writers (every row once; JDBC targets get
    ``batchsize``)."""
    w = df.repartition(n).write.mode("append")
    if fmt == "jdbc":
        w.format("jdbc").option("batchsize", batch).options(**(options or {})).save()
    else:
        w.format(fmt).options(**(options or {})).save(path)


def report_cells(rows: DataFrame) -> DataFrame:
    """K7 cells from R3 report rows: ``name, cell, changelist`` where cell is
    ``first   spread%   third`` (fft) or ``first   spread%`` (others)."""
    two = F.format_string("%s   %s%%", F.col("first"), F.col("spread"))
    three = F.format_string("%s   %s%%   %s", F.col("first"), F.col("spread"), F.col("third"))
    cell = F.when(F.col("algorithm") == "fft", three).otherwise(two)
    return rows.select("algorithm", "board", F.col("test_case_name").alias("name"), cell.alias("cell"), "changelist")


def write_report_csv(rows: DataFrame, path: str) -> None:
    """K7: report cells as CSV, one folder per algorithm (and board)."""
    report_cells(rows).write.mode("overwrite").partitionBy("algorithm", "board").csv(path)


def write_summary_json(summary: DataFrame, cases: DataFrame, path: str) -> None:
    """K8: better / worse / unchanged counts as JSON and the better and
    worse case names as text lists."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    for verdict in ("better", "worse"):
        (cases.filter(F.col("verdict") == verdict).select("test_case_name")
              .write.mode("overwrite").text(f"{path}/{verdict}"))


def partition_by_algorithm(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K9: files laid out by algorithm (partition pruning on read)."""
    df.write.mode(mode).partitionBy("algorithm").parquet(path)


def write_routed(frames: Sequence[DataFrame], root: str) -> list[str]:
    """K4: append every frame to the table that its columns name (see
    ``route_by_shape``), below ``root``; a frame of no known shape is an error."""
    names = [route_by_shape(df) for df in frames]
    if None in names:
        raise ValueError("a frame has the shape of no known table")
    for df, name in zip(frames, names):
        df.write.mode("append").parquet(f"{root.rstrip('/')}/{name}")
    return names


def write_logs(lines: DataFrame, folder: str) -> None:
    """``(file, line_no, line)`` as text logs, ``folder/file=<file>/log.txt``: the layout of a
    partitioned text table, but a log is one write, without a commit that moves each. A task
    writes its logs one after the other and holds a batch of lines; a repeated task writes the same."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, out = None, None
        for b in batches:
            for file, rows in b.fillna({"file": NO_NAME, "line": ""}).groupby("file", sort=False):  # rows come file by file
                if file != name:
                    if out is not None:
                        out.close()
                    system, path = arrow_fs.FileSystem.from_uri(f"{folder}/file={file}")
                    system.create_dir(path)
                    name, out = file, system.open_output_stream(f"{path}/log.txt")
                out.write(("\n".join(rows["line"]) + "\n").encode())
        if out is not None:
            out.close()
        yield pd.DataFrame({"n": [0]})

    # hashed into many parts that are not merged: opening files takes the time, not bytes
    spark = lines.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (lines.select("file", "line_no", "line").repartition(parts, "file").sortWithinPartitions("file", "line_no").select("file", "line")
          .mapInPandas(write, "n long").write.format("noop").mode("overwrite").save())
