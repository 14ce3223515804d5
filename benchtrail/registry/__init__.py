"""Named queries over the test tables, each with an independent DuckDB
formulation (the correctness oracle). Each area module registers its own."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

AREAS = ("history", "derive", "ingest", "compat", "usage", "coverage", "accept", "culprit", "stream", "ml", "sinks")


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is the DuckDB SQL over the raw views (omitted for non-SQL operators)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for area in AREAS:
        importlib.import_module(f"benchtrail.registry.{area}")
