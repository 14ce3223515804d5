"""The corpus pipeline: quality rules, one document of each group of near
copies, secrets redacted, sources mixed to target weights, sequences packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from benchtrail.llm.common import documents, stored
from benchtrail.llm.jaccard_join import one_per_group
from benchtrail.llm.mixing import mix_documents
from benchtrail.llm.packing import pack_documents
from benchtrail.llm.quality_rules import keep_quality
from benchtrail.llm.secret_scan import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("quality_rules", quality), ("jaccard_join", near_copies), ("secret_scan", secrets), ("mixing", mixture), ("packing", packing)]
#: zstandard ratios and token ids have no SQL form; tests/llm holds the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
