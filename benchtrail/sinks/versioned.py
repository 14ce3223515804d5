"""Versioned tables (K6, K10): appends with key checks and defaults, and
conditional updates that rewrite only the partitions they touch.

A table is a folder of data directories and a log of versions. A write first
puts its files into directories of its own, then adds one row to the log: the
new version with the directories that make it up. Nobody reads a directory
that no version names, so a writer that is lost before that row leaves the last
version as it was. When two writers add the same version, the one with the
smallest token wins and the other gets a ``Conflict``.

The directories of a version are listed by partition value; a reader that asks
for some partitions opens only theirs. A value of the partition column is
one directory per write, so it should be a column of few values.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from benchtrail.operators.compat import update_where
from benchtrail.session import materialize

LOG = "version long, token string, state string"


class Conflict(RuntimeError):
    """Another writer added the same version first."""


class DuplicateKey(ValueError):
    """Rows to be added have a key twice, or one that the table has."""


class VersionLog:
    """The log of versions at ``root/log``: each is one file of one row, so it is there in full or not at all."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def latest(self, version: int | None = None) -> tuple[int, dict]:
        """(version, state) of the newest version, or of the one asked for; (0, {}) before the first."""
        log = self.rows()
        if log is not None and version is not None:
            log = log.filter(F.col("version") == version)
        found = None if log is None else log.orderBy(F.col("version").desc(), "token").first()
        return (0, {}) if found is None else (found.version, json.loads(found.state))

    def commit(self, version: int, state: dict) -> None:
        token = uuid.uuid4().hex
        self.spark.createDataFrame([(version, token, json.dumps(state))], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        if self.rows().filter(F.col("version") == version).agg(F.min("token")).first()[0] != token:
            raise Conflict(f"version {version} of {self.root} was added by another writer")


class VersionedTable:
    """A table with defaults, keys and versions. ``defaults`` fill columns that an append doesn't have."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str] = (), defaults: dict | None = None,
                 partition_by: str | None = None):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self.defaults, self.partition_by, self.log = defaults or {}, partition_by, VersionLog(spark, root)

    def _part(self) -> Column:
        return F.lit("all") if self.partition_by is None else F.coalesce(F.concat(F.lit("v"), F.col(self.partition_by).cast("string")), F.lit("null"))

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        """Partition value -> the directory that now holds its rows."""
        name = uuid.uuid4().hex
        path = f"{self.root}/data/{name}"
        rows.withColumn("_part", F.sha1(self._part())).write.partitionBy("_part").parquet(path)
        # the directories are named by a hash: any text is a partition value
        parts = rows.select(self._part().alias("p")).distinct().select("p", F.sha1("p").alias("h")).collect()  # few values, by contract
        return {r.p: [f"{name}/_part={r.h}"] for r in parts}

    def read(self, partitions: Iterable | None = None, version: int | None = None) -> DataFrame:
        """The newest rows (or those of a version), of all or of some partitions."""
        state = self.log.latest(version)[1].get("parts", {})
        if partitions is not None:
            wanted = {"null" if p is None else f"v{p}" for p in partitions}
            state = {p: d for p, d in state.items() if p in wanted}
        paths = [f"{self.root}/data/{d}" for dirs in state.values() for d in dirs]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def directories(self) -> dict[str, list[str]]:
        return self.log.latest()[1].get("parts", {})

    def shaped(self, rows: DataFrame) -> DataFrame:
        """The table's columns: those it doesn't know are dropped, missing ones take their default (or null)."""
        unknown = set(self.keys) - set(rows.columns)
        if unknown - set(self.defaults):
            raise ValueError(f"key columns without a value: {sorted(unknown)}")
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(self.defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in self.schema])

    def append(self, rows: DataFrame) -> int:
        """Add rows; their keys must be new. Existing files stay as they are."""
        version, state = self.log.latest()
        rows = materialize(self.shaped(rows), "append")
        if self.keys:
            twice = rows.groupBy(*self.keys).count().filter("count > 1")
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys]
            there = rows.alias("n").join(self.read().select(*self.keys).alias("o"), same, "left_semi")
            if not twice.isEmpty() or not there.isEmpty():
                raise DuplicateKey(f"{twice.count()} keys twice among the new rows, {there.count()} keys already there")
        parts = dict(state.get("parts", {}))
        for p, dirs in self._write(rows).items():
            parts[p] = parts.get(p, []) + dirs
        self.log.commit(version + 1, {"parts": parts})
        return version + 1

    def update(self, predicate: Column, assignments: dict) -> int:
        """K6: assign where ``predicate`` holds. Only partitions with such a row are rewritten;
        assigned values may not be keys or the partition column."""
        fixed = {*self.keys, self.partition_by} & set(assignments)
        if fixed:
            raise ValueError(f"can't assign {sorted(fixed)}")
        version, state = self.log.latest()
        parts = dict(state.get("parts", {}))
        touched = [r.p for r in self.read().filter(predicate).select(self._part().alias("p")).distinct().collect()]
        if touched:
            paths = [f"{self.root}/data/{d}" for p in touched for d in parts[p]]
            # a predicate that is null changes nothing
            rows = update_where(self.spark.read.schema(self.schema).parquet(*paths), F.coalesce(predicate, F.lit(False)), assignments)
            parts.update(self._write(self.shaped(rows)))
        self.log.commit(version + 1, {"parts": parts})
        return version + 1
