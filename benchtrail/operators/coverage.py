"""API coverage: set algebra over API lists, trace records and report text
(J5, J6, J7, U5, R7).

The text matches are done without pairing every API with every line: each
line is cut into the candidate strings an API could equal at a match
position, and candidates are equi-joined with the API set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchtrail.session import materialize

# The match rules of the coverage scripts.
# An API matches a report line when it is preceded by a character other than
# '_' and followed by ' ', '|', '(' or the end of the line, or when it stands
# between '(' and ','. A line counts as covered when it contains "lineCov".
COVERED_MARK = "lineCov"
# the characters that end a name
ENDS = "[ |(]"
# what stands between '(' and ','
ARGUMENT = r"\(([^(,]+)(?=,)"
# '#define' followed by the defined name
DEFINE = r"^#define +([^ |(]+)"


# characters at the end of a name that tell which of its lengths are worth a try
TAIL = 3


def match_candidates(lines: DataFrame, names: DataFrame, line_col: str = "line", col: str = "api") -> DataFrame:
    """The strings an API of ``names`` could equal at a match position of some
    line, in one column ``cand``. Lines are cut where a name ends, so an API
    with the boundary rule is the end of a piece, and the character before it
    (the end of the piece before, if it is a whole one) is not '_'. APIs are
    plain strings of any characters but the boundary ones.

    What a piece or an argument can match depends on its text alone: both are
    deduplicated in one aggregation (with a map-side combine), and a piece is
    only cut at the lengths of the names that end in the same few characters
    as itself."""
    line = F.col(line_col)
    pieces = lines.select(F.posexplode(F.split(line, ENDS)).alias("pos", "piece")).select("piece", (F.col("pos") > 0).alias("whole"), F.lit(True).alias("ends"))
    arguments = lines.filter(line.contains("(")).select(F.explode(F.regexp_extract_all(line, F.lit(ARGUMENT), 1)).alias("piece"),
                                                        F.lit(True).alias("whole"), F.lit(False).alias("ends"))
    cut = (pieces.unionByName(arguments).filter("piece != ''").groupBy("piece").agg(F.max("whole").alias("whole"), F.max("ends").alias("ends"))
           .withColumn("n", F.length("piece")))
    tails = (names.select(F.right(F.col(col), F.lit(TAIL)).alias("tail"), F.length(col).alias("k"))
             .groupBy("tail").agg(F.collect_set("k").alias("ks")))  # as many as names have lengths
    tail = F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(TAIL), "n")), lambda k: F.right(F.col("piece"), k)))
    tried = cut.withColumn("tail", tail).join(tails, "tail").select("piece", "whole", "ends", "n", F.explode("ks").alias("k"))
    inside = F.col("ends") & (F.col("k") < F.col("n")) & (F.expr("substring(piece, n - k, 1)") != "_")
    return tried.filter((F.col("whole") & (F.col("k") == F.col("n"))) | inside).select(F.expr("right(piece, k)").alias("cand"))


def token_match(apis: DataFrame, report: DataFrame, covered: Column | None = None,
                col: str = "api") -> DataFrame:
    """The APIs that occur (boundary rule above) in a covered line of the
    report. ``covered`` defaults to "line contains lineCov"."""
    cov = covered if covered is not None else F.col("line").contains(COVERED_MARK)
    names = materialize(apis.select(col).distinct(), "names")  # read twice: for the tails and the join
    found = match_candidates(report.filter(cov).select("line"), names, col=col)
    return names.join(found.withColumnRenamed("cand", col), col, "left_semi")


def macro_defined(apis: DataFrame, header_lines: DataFrame, col: str = "api") -> DataFrame:
    """The APIs that have a ``#define <api>`` line (name followed by
    ' ', '|', '(' or the end of the line)."""
    defined = (header_lines.filter(F.col("line").rlike(DEFINE))
                           .select(F.regexp_extract("line", DEFINE, 1).alias(col)).distinct())
    return apis.select(col).distinct().join(defined, col, "left_semi")


# Reasons, in the order the chain removes APIs.
REASONS = ("executed", "called_macro", "macro", "deprecated", "not_covered")


def coverage_chain(universe: DataFrame, trace: DataFrame, report: DataFrame, header_lines: DataFrame,
                   deprecated: DataFrame, col: str = "api") -> DataFrame:
    """One row per API of the universe with the first reason that removes
    it: executed (trace hits >= 1), called macro (matched in a covered report
    line), macro (has a #define), deprecated; the rest is ``not_covered``.

    Every test gives a set of names with its place in the chain; the smallest
    place of a name is its reason (a later test never changes an earlier
    removal), so one aggregation joins the universe once."""
    u = materialize(universe.select(col).distinct(), "universe")
    tests = (trace.filter(F.col("hits") >= 1).select(col), token_match(u, report, col=col),
             macro_defined(u, header_lines, col), deprecated.select(col))
    places = None
    for place, names in enumerate(tests):
        names = names.withColumn("_place", F.lit(place))
        places = names if places is None else places.unionByName(names)
    first = places.groupBy(col).agg(F.min("_place").alias("_place"))
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.coalesce("_place", F.lit(len(REASONS) - 1)) + 1)
    return u.join(first, col, "left").select(col, reason.alias("reason"))


def chain_counts(chain: DataFrame) -> DataFrame:
    """J5 step counts: universe, not executed, after called macros, after
    macros, not covered (non-increasing)."""
    r = F.col("reason")
    return chain.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_universe"),
        F.count_if(r != "executed").cast("bigint").alias("n_not_executed"),
        F.count_if(~r.isin("executed", "called_macro")).cast("bigint").alias("n_after_called_macro"),
        F.count_if(~r.isin("executed", "called_macro", "macro")).cast("bigint").alias("n_after_macro"),
        F.count_if(r == "not_covered").cast("bigint").alias("n_not_covered"))


def list_diff(current: DataFrame, reference: DataFrame, col: str = "api") -> DataFrame:
    """The current list against a stored one: ``added`` / ``removed``
    entries (no rows: the lists are equal)."""
    c = current.select(col).distinct().withColumn("_c", F.lit(True))
    r = reference.select(col).distinct().withColumn("_r", F.lit(True))
    j = c.join(r, col, "full_outer")
    change = F.when(F.col("_r").isNull(), "added").when(F.col("_c").isNull(), "removed")
    return j.select(col, change.alias("change")).filter(F.col("change").isNotNull())
