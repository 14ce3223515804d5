"""Relational and CSV sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name_or_path: str, columns: Sequence[str] | None = None,
               where: dict | None = None) -> DataFrame:
    """A table by name (catalog) or parquet path, with a column list and
    equality filters -- both reach the scan (pruning and pushdown)."""
    df = spark.table(name_or_path) if "/" not in name_or_path else spark.read.parquet(name_or_path)
    for k, v in (where or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    return df.select(*columns) if columns else df


def read_csv_folder(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.csv") -> DataFrame:
    """Headerless CSV files of a folder with a fixed schema; malformed
    fields become null and unreadable files are skipped. The file name is
    kept so a name order can be reproduced when it matters."""
    df = (spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
               .option("ignoreCorruptFiles", "true").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").csv(path))
    return df.withColumn("source_file", F.col("_metadata.file_name"))
