"""The coverage report -- removal chain, step counts and the change of the
not-covered list against the stored one -- over one pass of the chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.operators.coverage import chain_counts, coverage_chain, list_diff
from benchtrail.session import materialize


def coverage_report(universe: DataFrame, trace: DataFrame, report: DataFrame, header_lines: DataFrame,
                    deprecated: DataFrame, stored: DataFrame, col: str = "api") -> dict[str, DataFrame]:
    """``chain`` (api, reason), ``counts`` (names left after each step) and
    ``changes`` (names added to or removed from the stored not-covered list)."""
    chain = materialize(coverage_chain(universe, trace, report, header_lines, deprecated, col), "coverage-chain")
    return {"chain": chain, "counts": chain_counts(chain),
            "changes": list_diff(chain.filter(F.col("reason") == "not_covered"), stored, col)}
