"""Column derivations from names and configuration strings (P5, P6, P10,
P11, O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ordered substring rules (first match wins).
BACKEND_RULES = ("generic_float32", "armv7int_neon", "armv7int", "c64plus", "ipp_float_interleaved",
                 "ipp_float_non_interleaved")
TARGET_RULES = ("cycle_profile",)
OS_RULES = (("linux", "linux"), ("beagleboard", "linux"), ("osx", "osx"))
ARCH_RULES = (("cortex_a9", None), ("x86", "x86"), ("amd64", "amd64"), ("c64plus", "c64plus"), ("c64", "c64"))
COMPILER_RULES = (("gnu", "gnu"), ("icc", "icc"), ("rvct_cslibc", "rvct_cslibc"), ("c6run", "ccs"))
COMPILER_VERSION = (("gnu", "4.4.6"), ("icc", "12.1.3"), ("rvct_cslibc", "5.01"), ("ccs", "7.1.4"))


def _first_match(col: Column, rules, on_unknown: str) -> Column:
    expr = None
    for rule in rules:
        needle, value = (rule, rule) if isinstance(rule, str) else rule
        cond = col.contains(needle)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if on_unknown == "error":
        return expr.otherwise(F.raise_error(F.concat(F.lit("not recognized: "), col)))
    return expr


def derive_backend(col: Column, on_unknown: str = "null", backends=BACKEND_RULES, targets=TARGET_RULES) -> Column:
    """P5: struct(backend, target) from an executable / config name by ordered
    substring rules (the first that the name contains); unknown -> null (or
    an error). The rules of an installation are parameters."""
    return F.struct(_first_match(col, backends, on_unknown).alias("backend"),
                    _first_match(col, targets, on_unknown).alias("target"))


def derive_platform(col: Column, on_unknown: str = "null") -> Column:
    """struct(os, arch, compiler, version) from a build configuration."""
    arch = (F.when(col.contains("cortex_a9"),
                   F.when(col.contains("vfp_neon"), F.lit("cortex_a9_vfp_neon")).otherwise(F.lit("cortex_a9"))))
    for needle, value in ARCH_RULES[1:]:
        arch = arch.when(col.contains(needle), F.lit(value))
    if on_unknown == "error":
        arch = arch.otherwise(F.raise_error(F.concat(F.lit("unsupported architecture: "), col)))
    cc = _first_match(col, COMPILER_RULES, on_unknown)
    version = None
    for c, v in COMPILER_VERSION:
        version = F.when(cc == c, F.lit(v)) if version is None else version.when(cc == c, F.lit(v))
    return F.struct(_first_match(col, OS_RULES, on_unknown).alias("os"), arch.alias("arch"),
                    cc.alias("compiler"), version.alias("version"))


def split_table_name(col: Column) -> Column:
    """P10: struct(board, datatype, algorithm) of a table name
    ``<board>_<datatype...>_<algorithm>_bench``."""
    parts = F.split(col, "_")
    n = F.size(parts)
    bench = F.array_position(parts, "bench")
    alg_at = F.when(bench > 1, bench - 1).otherwise(n)
    return F.struct(F.element_at(parts, 1).alias("board"),
                    F.array_join(F.slice(parts, F.lit(2), F.greatest(alg_at - 2, F.lit(0))), "_").alias("datatype"),
                    F.element_at(parts, alg_at.cast("int")).alias("algorithm"))


def pending(work: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work items without a stored result yet (left anti join)."""
    return work.join(history.select(*keys).distinct(), list(keys), "left_anti")


def found(work: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work items that already have a stored result (left semi join)."""
    return work.join(history.select(*keys).distinct(), list(keys), "left_semi")


def first_seen_order(df: DataFrame, case: str | Sequence[str], seen: str, then: Sequence[str] = ("changelist",)) -> DataFrame:
    """O3: rows ordered by the first appearance of their case (one column or
    several), then by ``then``; ``first_seen`` is the case's smallest ``seen`` value."""
    case = [case] if isinstance(case, str) else list(case)
    fs = df.groupBy(*case).agg(F.min(seen).alias("first_seen"))
    return df.join(fs, case).orderBy("first_seen", *case, *then)
