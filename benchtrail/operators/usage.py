"""Operator-usage trees (S6), their nested form, and usage totals.

A usage log is a tree of headers ``<indent><name> <tag> (entered N times)``
with detail lines ``<blanks><api> <average> <total>`` under a node and a
``TOTAL`` line that closes the node's low-level usage.

Lines are classified and detail lines attached to their header with chunked
running scans over line numbers, and so are the relations between headers;
no log is ever held in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchtrail.functions.scan import DEFAULT_CHUNK, previous_max, running_count, running_max
from benchtrail.session import materialize

# Usage-log grammar.
HEADER = r"^(\s*)(\S+)\s(\S+)\s\(entered\s(\d+)\stimes\)"
DETAIL = r"^\s+(\S+)\s+([0-9]+\.?[0-9]*)\s+([0-9]+\.?[0-9]*)"
TOTAL = "TOTAL"
#: stands for no line where numbers can't be null
NO_LINE = -(1 << 62)


def header_relations(hdr: DataFrame) -> DataFrame:
    """Node relations of the header lines, for logs of any size.

    The open node at a header is the node of the header before it. A header
    indented less than the open node closes: it returns to the node of its
    name that was opened last (an ``orphan`` if there is none, which changes
    nothing). So whether a header closes depends on the headers before it,
    and which node it returns to on which of them opened. Both are settled
    together: from the guess that the open node has the indent of the line
    before, last opened node and open node are looked up by chunked scans,
    and the flags are set anew until none changes. Where closing headers are
    indented like the node they close, the guess is right at once; each pass
    settles at least one more header of a log, so it ends.
    """
    line = F.col("line_no")
    h = previous_max(materialize(hdr, "headers"), ["file"], "line_no", F.struct(line.alias("l"), F.col("spaces").alias("s")), "_prev")
    h = materialize(h.withColumn("closing", F.coalesce(F.col("spaces") < F.col("_prev.s"), F.lit(False))).drop("_prev"), "headers")
    while True:
        opened = F.when(~F.col("closing"), F.struct(line.alias("l"), F.col("spaces").alias("s")))
        h = previous_max(h, ["file", "name"], "line_no", opened, "own")
        node = F.when(F.col("closing"), F.col("own")).otherwise(F.struct(line.alias("l"), F.col("spaces").alias("s")))
        h = materialize(h.withColumn("node", node), "headers")
        at = F.when(F.col("node").isNotNull(), F.struct(line.alias("at"), F.col("node.l").alias("l"), F.col("node.s").alias("s")))
        h = previous_max(h, ["file"], "line_no", at, "open")
        h = materialize(h.withColumn("now", F.coalesce(F.col("spaces") < F.col("open.s"), F.lit(False))), "headers")
        if h.filter(F.col("now") != F.col("closing")).isEmpty():
            break
        h = h.withColumn("closing", F.col("now")).drop("own", "node", "open", "now")

    # parent: the open node if this one is deeper, else that node's parent
    state = materialize(h.filter(~F.col("closing")).select(
        "file", "line_no", F.when(F.col("open.s") < F.col("spaces"), F.col("open.l")).alias("parent"),
        F.when(F.col("open.s") == F.col("spaces"), F.col("open.l")).alias("same_as")), "parents")
    state = resolve_parents(state)

    ids = materialize(running_count(h.select("file", "line_no"), ["file"], "line_no", F.lit(True), "_n")
                      .select("file", "line_no", (F.col("_n") - 1).alias("node_id")), "node-ids")
    levels = h.filter(~F.col("closing")).select("file", "spaces").distinct()  # indents of a log, not its lines
    levels = levels.withColumn("depth_id", (F.dense_rank().over(Window.partitionBy("file").orderBy("spaces")) - 1).cast("bigint"))
    by_line = lambda col, out: ids.select("file", F.col("line_no").alias(col), F.col("node_id").alias(out))
    return (h.withColumn("owner", F.coalesce("node.l", "line_no")).join(ids, ["file", "line_no"])
             .join(state.select("file", "line_no", "parent"), ["file", "line_no"], "left")
             .join(by_line("parent", "parent_id"), ["file", "parent"], "left")
             .join(by_line("owner", "owner_id"), ["file", "owner"], "left")
             .join(levels, ["file", "spaces"], "left")
             .select("file", "line_no", "node_id", "name", "tag", "spaces", "loop_times", "parent_id",
                     F.when(~F.col("closing"), F.col("depth_id")).alias("depth_id"), "closing",
                     (F.col("closing") & F.col("own").isNull()).alias("orphan"), "owner_id"))


def resolve_parents(state: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(file, line_no, parent) from rows that have a parent (or none) or the ``same_as`` another line.

    These point to earlier lines only, so one pass over a chunk of lines leaves just pointers
    out of it. Pointer doubling settles the few lines that those point to, whatever a log's length.
    """
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_no")
        found: dict[int, tuple[int, int]] = {}
        for line, parent, same_as in zip(rows["line_no"].tolist(), rows["parent"].tolist(), rows["same_as"].tolist()):
            found[line] = found.get(same_as, (parent, same_as))
        rows["parent"], rows["same_as"] = [x[0] for x in found.values()], [x[1] for x in found.values()]
        return rows[["file", "line_no", "parent", "same_as"]]

    known = lambda c: F.coalesce(F.col(c), F.lit(NO_LINE)).alias(c)
    chunked = state.select("file", "line_no", known("parent"), known("same_as"), F.floor(F.col("line_no") / F.lit(chunk)).alias("_chunk"))
    settled = chunked.groupBy("file", "_chunk").applyInPandas(settle, "file string, line_no bigint, parent bigint, same_as bigint")
    given = lambda c: F.nullif(F.col(c), F.lit(NO_LINE)).alias(c)
    state = materialize(settled.select("file", "line_no", given("parent"), given("same_as")), "parents")
    asked = state.filter(F.col("same_as").isNotNull()).select("file", F.col("same_as").alias("line_no")).distinct()
    ends = materialize(state.join(asked, ["file", "line_no"], "left_semi"), "parents")
    while not ends.filter(F.col("same_as").isNotNull()).isEmpty():
        other = ends.select("file", F.col("line_no").alias("same_as"), F.col("parent").alias("_parent"), F.col("same_as").alias("_same_as"))
        ends = materialize(ends.join(other, ["file", "same_as"], "left").select(
            "file", "line_no", F.coalesce("parent", "_parent").alias("parent"), F.col("_same_as").alias("same_as")), "parents")
    end = ends.select("file", F.col("line_no").alias("same_as"), F.col("parent").alias("_parent"))
    return state.join(end, ["file", "same_as"], "left").select("file", "line_no", F.coalesce("parent", "_parent").alias("parent"))


def parse_usage_tree(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, details)``.

    nodes: ``file, node_id, name, tag, spaces, loop_times, parent_id,
    depth_id, low_average, low_total`` -- one row per opened node; node ids
    count every header, closing ones included (so they have gaps); a closing
    header with no node of its name is reported with ``orphan`` = true.
    details: ``file, node_id, api, average, total`` of nodes whose block has a
    ``TOTAL`` line (the same api again: last wins). Detail lines after a
    closing header are ignored.
    """
    hdr = lines.filter(F.col("line").rlike(HEADER)).select(
        "file", "line_no",
        F.regexp_extract("line", HEADER, 2).alias("name"),
        F.regexp_extract("line", HEADER, 3).alias("tag"),
        F.length(F.regexp_extract("line", HEADER, 1)).alias("spaces"),
        F.regexp_extract("line", HEADER, 4).cast("bigint").alias("loop_times"))
    heads = materialize(header_relations(hdr), "relations")

    det = lines.filter(~F.col("line").rlike(HEADER)).filter(F.col("line").rlike(DETAIL)).select(
        "file", "line_no", F.lit(None).cast("bigint").alias("_h"),
        F.regexp_extract("line", DETAIL, 1).alias("api"),
        F.regexp_extract("line", DETAIL, 2).alias("average"),
        F.regexp_extract("line", DETAIL, 3).alias("total"))
    marks = hdr.select("file", "line_no", F.col("line_no").alias("_h"), F.lit(None).cast("string").alias("api"),
                       F.lit(None).cast("string").alias("average"), F.lit(None).cast("string").alias("total"))
    tagged = running_max(materialize(det.unionByName(marks), "details"), ["file"], "line_no", F.col("_h"), "hdr_line")
    tagged = tagged.filter(F.col("api").isNotNull() & F.col("hdr_line").isNotNull())
    owners = heads.filter(~F.col("closing")).select("file", F.col("line_no").alias("hdr_line"), "node_id")
    attached = tagged.join(owners, ["file", "hdr_line"])   # lines under a closing header drop out here

    summary = (attached.filter(F.col("api") == TOTAL).groupBy("file", "node_id")
                       .agg(F.max_by("average", "line_no").alias("low_average"),
                            F.max_by("total", "line_no").alias("low_total")))
    details = (attached.filter(F.col("api") != TOTAL).groupBy("file", "node_id", "api")
                       .agg(F.max_by("average", "line_no").alias("average"), F.max_by("total", "line_no").alias("total"))
                       .join(summary.select("file", "node_id"), ["file", "node_id"], "left_semi")
                       .select("file", "node_id", "api", F.col("average").try_cast("double").alias("average"),
                               F.col("total").try_cast("double").cast("bigint").alias("total")))
    nodes = (heads.filter(~F.col("closing") | F.col("orphan"))
                  .join(summary, ["file", "node_id"], "left")
                  .select("file", "node_id", "name", "tag", "spaces", "loop_times", "parent_id", "depth_id", "orphan",
                          F.col("low_average").try_cast("double").alias("low_average"),
                          F.col("low_total").try_cast("double").alias("low_total")))
    return nodes, details


def high_usage(nodes: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Per node, its children whose name begins with ``prefix``.
    Returns (summary ``file, node_id, high_total`` -- only nodes whose sum of
    children's loop counts is not 0 --, details ``file, node_id, api, total``
    with the prefix cut off; a name that occurs twice keeps the later child)."""
    kids = nodes.filter(F.col("parent_id").isNotNull() & F.col("name").startswith(prefix))
    summary = (kids.groupBy("file", F.col("parent_id").alias("node_id"))
                   .agg(F.sum("loop_times").cast("bigint").alias("high_total"))
                   .filter(F.col("high_total") != 0))
    details = (kids.groupBy("file", F.col("parent_id").alias("node_id"),
                            F.substr("name", F.lit(len(prefix) + 1)).alias("api"))
                   .agg(F.max_by("loop_times", "node_id").alias("total"))
                   .join(summary.select("file", "node_id"), ["file", "node_id"], "left_semi"))
    return summary, details


def usage_trees(nodes: DataFrame, details: DataFrame, prefix: str, changelist: Column) -> DataFrame:
    """The nested form of usage trees: ``file, node_id, tree`` with one row per
    root and its whole tree as JSON text. A node is an object with name, id,
    loop_times, low_usage, high_usage (each null, or a summary and the details by api), pid
    (its depth id), changelist and, if it has children, child_node: a list in the order of their ids.

    Trees are folded bottom-up, one depth a round: the finished texts of a
    depth are grouped under their parents and embedded there, so a task only
    ever holds a node with its children's texts. ``changelist``: the build of a file, an expression over ``file``.
    """
    usage = lambda average, total, by: F.struct(F.struct(average.alias("average"), total.alias("total")).alias("summary"), by.alias("details"))
    entry = lambda average, total: F.struct("api", F.struct(average.alias("average"), F.col(total).alias("total")).alias("u"))
    by_api = lambda average, total: F.map_from_entries(F.array_sort(F.collect_list(entry(average, total))))
    live = nodes.filter(~F.col("orphan"))
    low = details.groupBy("file", "node_id").agg(by_api(F.col("average"), "total").alias("_low"))
    high_total, high_details = high_usage(live, prefix)
    high = high_details.groupBy("file", "node_id").agg(by_api(F.lit(None).cast("double"), "total").alias("_high")).join(high_total, ["file", "node_id"])
    no_details = F.from_json(F.lit("{}"), "map<string, struct<average: double, total: bigint>>")
    fields = F.struct("name", F.col("node_id").alias("id"), "loop_times",
                      F.when(F.col("low_total").isNotNull(), usage(F.col("low_average"), F.col("low_total"), F.coalesce("_low", no_details))).alias("low_usage"),
                      F.when(F.col("_high").isNotNull(), usage(F.lit(None).cast("double"), F.col("high_total"), F.col("_high"))).alias("high_usage"),
                      F.col("depth_id").alias("pid"), changelist.alias("changelist"))
    above = live.select("file", F.col("node_id").alias("parent_id"), F.col("depth_id").alias("parent_depth"))
    head = F.to_json(fields, {"ignoreNullFields": "false"})
    state = materialize(live.join(low, ["file", "node_id"], "left").join(high, ["file", "node_id"], "left").withColumn("head", head)
                        .join(above, ["file", "parent_id"], "left").select("file", "node_id", "parent_id", "parent_depth", "depth_id", "head"), "tree-nodes")
    depth = state.agg(F.max("depth_id")).first()[0]
    done = None  # finished nodes, deepest first
    for d in range(-1 if depth is None else depth, -1, -1):
        level = state.filter(F.col("depth_id") == d)
        if done is None:
            level = level.withColumn("children", F.lit(None).cast("array<struct<node_id: bigint, tree: string>>"))
        else:
            kids = (done.filter(F.col("parent_depth") == d).groupBy("file", F.col("parent_id").alias("node_id"))
                        .agg(F.array_sort(F.collect_list(F.struct("node_id", "tree"))).alias("children")))
            level = level.join(kids, ["file", "node_id"], "left")
        inner = F.concat(F.lit(',"child_node":['), F.array_join("children.tree", ","), F.lit("]"))
        whole = F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.coalesce(inner, F.lit("")), F.lit("}"))
        level = materialize(level.select("file", "node_id", "parent_id", "parent_depth", whole.alias("tree")), "tree-level")
        done = level if done is None else done.unionByName(level)
    if done is None:
        return state.select("file", "node_id", F.col("head").alias("tree"))
    return done.filter(F.col("parent_id").isNull()).select("file", "node_id", "tree")


def usage_totals(details: DataFrame, changelist_of_file=None) -> DataFrame:
    """A5: usage summed by (api, changelist) over nodes and files (partial
    sums map-side), largest first. ``changelist_of_file``: a Column giving the
    build of a file (default: a ``changelist`` column already present)."""
    d = details if changelist_of_file is None else details.withColumn("changelist", changelist_of_file)
    return (d.groupBy("api", "changelist").agg(F.sum("total").cast("bigint").alias("total"))
             .orderBy(F.col("total").desc(), "api"))


def zero_filled(catalogue: DataFrame, usage: DataFrame, key: str = "api") -> tuple[DataFrame, DataFrame]:
    """Every catalogue item with its usage or 0 (sorted by name,
    descending), and the number of items actually used."""
    u = usage.groupBy(key).agg(F.sum("total").alias("_t"))
    j = catalogue.select(key).distinct().join(u, key, "left")
    filled = j.select(key, F.coalesce(F.col("_t"), F.lit(0)).cast("bigint").alias("total")).orderBy(F.col(key).desc())
    used = j.agg(F.count("_t").cast("bigint").alias("n_used"), F.count(F.lit(1)).cast("bigint").alias("n_items"))
    return filled, used


def usage_diff(ref: DataFrame, dut: DataFrame) -> DataFrame:
    """(api, total) pairs common to both sides, then the rows of each
    side whose api is not among the common ones: ``api, total, side``."""
    common = ref.select("api", "total").join(dut.select("api", "total"), ["api", "total"], "inner").distinct()
    keys = common.select("api").distinct()
    only_ref = ref.select("api", "total").join(keys, "api", "left_anti")
    only_dut = dut.select("api", "total").join(keys, "api", "left_anti")
    return (common.withColumn("side", F.lit("common"))
                  .unionByName(only_ref.withColumn("side", F.lit("ref")))
                  .unionByName(only_dut.withColumn("side", F.lit("dut"))))


def category_coverage(catalogue: DataFrame, usage: DataFrame, product_col: str = "product") -> DataFrame:
    """Per category, catalogue size, items used by any product, and
    items used per product (long form: one row per category and product)."""
    used = usage.filter(F.col("total") > 0).select("api", product_col).distinct()
    j = catalogue.select("api", "category").join(used, "api", "left")
    per_cat = j.groupBy("category").agg(F.count_distinct("api").cast("bigint").alias("n_items"),
                                        F.count_distinct(F.when(F.col(product_col).isNotNull(), F.col("api")))
                                         .cast("bigint").alias("n_used"))
    per_prod = (j.filter(F.col(product_col).isNotNull()).groupBy("category", product_col)
                 .agg(F.count_distinct("api").cast("bigint").alias("n_used_by_product")))
    return per_cat.join(per_prod, "category", "left")
