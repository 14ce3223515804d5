"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchtrail.session import scratch_path

#: a word is a run of anything but space and the ASCII controls 9-13; bytes.split() cuts at exactly these
WORD_RE = r"[^\x20\x09-\x0D]+"
WORD_GAPS = " \t\n\x0b\x0c\r"
#: keys with more than this share of all rows (one in HOT) are joined by broadcast
HOT = 10_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, also when the
    executors that computed it are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # nothing reads the shuffles behind a stored table again
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed(big: DataFrame, small: DataFrame, on: list[str], total: int, how: str = "inner") -> DataFrame:
    """Join ``big`` with the one row that ``small`` has for a key, where a key may hold any share of ``big``.

    ``small`` is cheap to read twice and tells in ``copies`` how many rows of
    ``big`` have its key; ``total`` is at least the number of rows of ``big``.
    Fewer than ``HOT`` keys hold more than ``total / HOT`` rows, so the rows
    of ``small`` for them are broadcast, and no task gets more rows of one key.
    """
    hot = F.col("copies") * HOT > total
    few = F.broadcast(small.filter(hot))
    rest = big.join(few.select(*on), on, "left_anti").join(small.filter(~hot), on, how)
    return big.join(few, on).unionByName(rest)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), as a native expression."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def id_text(col: Column) -> Column:
    """An id as text (null: empty)."""
    return F.coalesce(col.cast("string"), F.lit(""))


def fold(col: Column, n: int) -> Column:
    """Remainder of the CRC-32 of the id as text."""
    return F.crc32(F.encode(id_text(col), "utf-8")) % n
