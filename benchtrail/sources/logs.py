"""Log sources and line parsers.

Every parser takes a *lines* DataFrame ``(file, line_no, line)`` -- from
``read_log_lines`` or any table -- and returns typed rows. Order-dependent
state (which node a line belongs to) is a running max over line numbers, see
``benchtrail.functions.scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchtrail.functions.scan import running_max
from benchtrail.session import materialize

# ---------------------------------------------------------------------------
# Line grammar of the logs (must accept exactly what the
# original parsers accept).
# Profile report, form A: node header, total, max, min, avg, number of calls.
A_NODE = r"Node Name.+: (.+)$"
A_TOTAL = r"Total .+: (.+) "
A_MAX = r"Max .+: (.+) "
A_MIN = r"Min .+: (.+) "
A_AVG = r"Avg .+: (.+) "
A_CALLS = r"Number of Calls.+: (.+)$"
# Profile report, form B: node header (word characters), Max, Avg, Min.
B_NODE = r"^.*Node Name\s*:\s*(\w+)"
B_MAX = r"^.*Max\s*:\s*([0-9]+)"
B_AVG = r"^.*Avg\s*:\s*([0-9.]+)"
B_MIN = r"^.*Min\s*:\s*([0-9]+)"
B_ROOT = "Root"
# Test-result log: "i/n name... STATUS" and the three summary lines.
T_LINE = r"(?i)(\d{1,6})/(\d{1,6})\s(\S+)\.\.\.\s(\S+)"
T_PASSED = r"(?i)^PASSED:\s(\d+/\d+)"
T_FAILED = r"(?i)^FAILED:\s(\d+/\d+)"
T_UNRESOLVED = r"(?i)^UNRESOLVED:\s(\d+/\d+)"
# Coverage trace record and header block comment.
FNDA = r"^FNDA:([1-9][0-9]*),(.+)$"
COMMENT = r"/\* .*? ?\*/"
# ---------------------------------------------------------------------------


def read_log_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file, line_no, line)`` for every file under ``path`` whose name
    matches ``glob``, line order kept; lines end at ``\\n``, a ``\\r`` before
    it is stripped.

    The text is scanned once, line by line, so one large log is read by many
    tasks. That scan is stored with each line's block of the file and its
    place in the block; line numbers are counted on the stored rows, so they
    don't depend on how a later scan would be split. The stored lines are
    counted against the sum of the blocks.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = materialize(reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_at"), F.regexp_replace("value", "\r$", "").alias("line")), "log-lines")
    blocks = rows.groupBy("file", "_blk").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n"))
    gap = blocks.filter(F.col("_last") - F.col("_first") + 1 != F.col("_n"))
    if not gap.isEmpty():
        raise RuntimeError("lines of a block are not consecutive")
    w = Window.partitionBy("file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "_blk", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return (rows.join(blocks, ["file", "_blk"])
                .select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("bigint").alias("line_no"), "line"))


def lines_from_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines of a text column (documents, stored logs): ``(file, line_no, line)``."""
    return df.select(F.col(id_col).alias("file"),
                     F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line")) \
             .select("file", (F.col("pos") + 1).cast("bigint").alias("line_no"),
                     F.regexp_replace("line", "\r$", "").alias("line"))


def _x(pattern: str, group: int = 1) -> Column:
    """Captured group, or null when the line does not match."""
    m = F.regexp_extract(F.col("line"), pattern, group)
    return F.when(F.col("line").rlike(pattern), m)


def coerce_number(text: Column) -> Column:
    """A number when the text parses: integral text (no '.' nor 'e') as an
    integer, otherwise as a double; malformed values are null."""
    is_float = text.contains(".") | text.contains("e")
    return F.when(is_float, text.try_cast("double")).otherwise(text.try_cast("bigint").cast("double"))


def coerce_value(text: Column) -> Column:
    """P9 in full: struct(integer, number, text) with the first form that the
    text has -- an integer (kept exact), else a number, else the text itself."""
    is_float = text.contains(".") | text.contains("e")
    integer = F.when(~is_float, text.try_cast("bigint"))
    number = F.when(is_float, text.try_cast("double"))
    return F.struct(integer.alias("integer"), number.alias("number"), F.when(integer.isNull() & number.isNull(), text).alias("text"))


def parse_profile_report(lines: DataFrame, chunk: int | None = None) -> DataFrame:
    """Form-A profile report -> one row per node block:
    ``file, node_ix (header line), name, total, max, min, avg, num_calls``.

    A header opens a block; keyword lines set the open block's fields (last
    one wins); lines before the first header are ignored. A line is tried as
    name, total, max, min, calls, avg in that order.
    """
    name = _x(A_NODE)
    kind = (F.when(name.isNotNull(), "name")
             .when(F.col("line").rlike(A_TOTAL), "total")
             .when(F.col("line").rlike(A_MAX), "max")
             .when(F.col("line").rlike(A_MIN), "min")
             .when(F.col("line").rlike(A_CALLS), "calls")
             .when(F.col("line").rlike(A_AVG), "avg"))
    text = (F.when(kind == "name", name)
             .when(kind == "total", F.regexp_extract("line", A_TOTAL, 1))
             .when(kind == "max", F.regexp_extract("line", A_MAX, 1))
             .when(kind == "min", F.regexp_extract("line", A_MIN, 1))
             .when(kind == "calls", F.regexp_extract("line", A_CALLS, 1))
             .when(kind == "avg", F.regexp_extract("line", A_AVG, 1)))
    tagged = materialize(lines.select("file", "line_no", kind.alias("kind"), text.alias("text")).filter(F.col("kind").isNotNull()), "report-lines")
    hdr = F.when(F.col("kind") == "name", F.col("line_no"))
    kw = {"chunk": chunk} if chunk else {}
    blocks = running_max(tagged, ["file"], "line_no", hdr, "node_ix", **kw).filter(F.col("node_ix").isNotNull())

    def last(k: str) -> Column:
        return F.max_by(F.when(F.col("kind") == k, F.col("text")), F.when(F.col("kind") == k, F.col("line_no")))

    agg = blocks.groupBy("file", "node_ix").agg(
        last("name").alias("name"), last("total").alias("_total"), last("max").alias("_max"),
        last("min").alias("_min"), last("avg").alias("_avg"), last("calls").alias("_calls"))
    return agg.select("file", "node_ix", "name",
                      F.col("_total").try_cast("bigint").alias("total"),
                      coerce_number(F.col("_max")).alias("max"),
                      coerce_number(F.col("_min")).alias("min"),
                      coerce_number(F.col("_avg")).alias("avg"),
                      F.col("_calls").try_cast("bigint").alias("num_calls"))


def parse_profile_stats(lines: DataFrame, chunk: int | None = None) -> DataFrame:
    """S3: form-B profile report -> ``file, node, stat, value`` (stat in
    Max/Avg/Min).

    A header whose node is ``Root`` opens nothing (its lines fall to the
    node before it); the same node name again starts over, so only its last
    block counts; inside a block the last value of a stat wins.
    """
    name = F.regexp_extract("line", B_NODE, 1)
    is_hdr = F.col("line").rlike(B_NODE) & (name != F.lit(B_ROOT))
    stat = (F.when(F.col("line").rlike(B_MAX), "Max")
             .when(F.col("line").rlike(B_AVG), "Avg")
             .when(F.col("line").rlike(B_MIN), "Min"))
    val = (F.when(stat == "Max", F.regexp_extract("line", B_MAX, 1))
            .when(stat == "Avg", F.regexp_extract("line", B_AVG, 1))
            .when(stat == "Min", F.regexp_extract("line", B_MIN, 1)))
    tagged = materialize(lines.select("file", "line_no", F.when(is_hdr, name).alias("hdr"), stat.alias("stat"),
                                      val.try_cast("double").alias("value"))
                              .filter(F.col("hdr").isNotNull() | F.col("stat").isNotNull()), "stats-lines")
    kw = {"chunk": chunk} if chunk else {}
    blk = running_max(tagged, ["file"], "line_no",
                      F.when(F.col("hdr").isNotNull(), F.struct(F.col("line_no").alias("l"), F.col("hdr").alias("n"))),
                      "_blk", **kw).filter(F.col("_blk").isNotNull())
    blk = blk.select("file", "line_no", "stat", "value", F.col("_blk.l").alias("block"), F.col("_blk.n").alias("node"))
    # a header alone is a block too (without a stat): the node's last block decides
    stats = blk.groupBy("file", "node", "block", "stat").agg(F.max_by("value", "line_no").alias("value"))
    newest = F.max("block").over(Window.partitionBy("file", "node"))
    return (stats.withColumn("_newest", newest).filter((F.col("block") == F.col("_newest")) & F.col("stat").isNotNull())
                 .select("file", "node", "stat", "value"))


def parse_environment(lines: DataFrame) -> DataFrame:
    """``key=value`` lines -> ``file, key, value``; text after a second
    ``=`` is dropped, a repeated key keeps its last value, lines without
    ``=`` are skipped."""
    parts = F.split(F.col("line"), "=")
    kv = (lines.filter(F.col("line").contains("="))
               .select("file", "line_no", parts.getItem(0).alias("key"), parts.getItem(1).alias("value")))
    return kv.groupBy("file", "key").agg(F.max_by("value", "line_no").alias("value"))


ENV_KEYS = ("cmd", "backend", "board", "target", "os", "arch", "changelist", "compiler", "glibc")


def environment_columns(env: DataFrame, keys=ENV_KEYS) -> DataFrame:
    """S4 as a record: one row per file, one column per known key (fixed
    pivot values, so no extra pass to discover them)."""
    return env.groupBy("file").pivot("key", list(keys)).agg(F.first("value"))


def parse_test_results(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(details, summary)``. details: ``file, test_api, test_result``
    (lower case, last line wins); summary: ``file, total_passed,
    total_failed, total_unresolved`` (``n/m`` text, last wins). Lines are
    trimmed first; matching is case-insensitive; a detail line is not read
    as a summary line."""
    t = lines.select("file", "line_no", F.trim(F.col("line")).alias("line"))
    is_detail = F.col("line").rlike(T_LINE)
    det = (t.filter(is_detail)
            .select("file", "line_no", F.regexp_extract("line", T_LINE, 3).alias("test_api"),
                    F.lower(F.regexp_extract("line", T_LINE, 4)).alias("test_result")))
    details = det.groupBy("file", "test_api").agg(F.max_by("test_result", "line_no").alias("test_result"))

    def last(p: str) -> Column:
        hit = ~is_detail & F.col("line").rlike(p)
        return F.max_by(F.when(hit, F.regexp_extract("line", p, 1)), F.when(hit, F.col("line_no")))

    summary = t.groupBy("file").agg(last(T_PASSED).alias("total_passed"), last(T_FAILED).alias("total_failed"),
                                    last(T_UNRESOLVED).alias("total_unresolved"))
    return details, summary


def operator_catalogue(lines: DataFrame, prefix: str) -> DataFrame:
    """Per ``<algorithm>.txt`` file, the distinct operator names of its
    usage headers (lines stripped first) that begin with ``prefix``, prefix
    cut off: ``algorithm, api``."""
    from benchtrail.operators.usage import HEADER
    alg = F.regexp_extract(F.col("file"), r"([^/]+)\.txt$", 1)
    tok = F.trim(F.col("line"))
    name = F.regexp_extract(tok, HEADER, 2)
    return (lines.filter(F.col("file").endswith(".txt") & tok.rlike(HEADER) & name.startswith(prefix))
                 .select(alg.alias("algorithm"), F.substr(name, F.lit(len(prefix) + 1)).alias("api"))
                 .distinct())


def read_trace(lines: DataFrame) -> DataFrame:
    """``FNDA:<count>,<api>`` records with count >= 1 -> ``api, hits``."""
    m = lines.filter(F.col("line").rlike(FNDA))
    return m.select(F.regexp_extract("line", FNDA, 2).alias("api"),
                    F.regexp_extract("line", FNDA, 1).cast("bigint").alias("hits"))


def read_api_universe(lines: DataFrame, marker: str, phrase: str = "") -> DataFrame:
    """Tokens of the lines holding ``marker``, after removing ``phrase``
    and block comments, distinct: ``api``."""
    body = F.col("line")
    if phrase:
        body = F.regexp_replace(body, F.lit(_literal(phrase)), F.lit(""))
    body = F.regexp_replace(body, F.lit(COMMENT), F.lit(""))
    toks = lines.filter(F.col("line").contains(marker)).select(F.explode(F.split(body, " ")).alias("api"))
    return toks.select(F.regexp_replace("api", r"^\s+|\s+$", "").alias("api")).filter(F.col("api") != "").distinct()


def _literal(text: str) -> str:
    import re
    return re.escape(text)


def read_expected(lines: DataFrame) -> DataFrame:
    """Expected-success list, one configuration per non-empty line."""
    return lines.select(F.trim(F.col("line")).alias("config")).filter(F.col("config") != "").distinct()
