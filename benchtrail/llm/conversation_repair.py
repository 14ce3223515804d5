"""Repair of conversation structure by weighted CYK interval parsing.

A conversation is right when its role initials form ``(s?(ua)+)?``. The repair
keeps, re-roles, deletes or inserts turns at least cost. The grammar is in
Chomsky normal form: a symbol is a pair (p, q) of places in that pattern, its
binary rules are (p, q) -> (p, r) (r, q), its terminals the edits of one row. A cell
holds, for each symbol that derives a span of rows, the least (cost, audit), the
audit being the initials of the edits in order. The empty span's cell, closed
under insertion, is joined to both sides of every terminal, so all cells are closed.
Cells are combined bottom-up by span length. Two audits of one span and
symbol with equal cost have the same letters for the same rows before they
first differ, so neither begins with the other and the least of a whole is made of
the least of its parts.

Rows are numbered once over all conversations. Runs of ``SPAN`` consecutive
numbers are parsed on their own, however long a conversation is: ``LEAF`` rows
with the whole chart, longer spans by doubling (a symbol names both its
places, so every split of a span gives the same cell). The cells of a conversation's
runs are then joined, ``SPAN`` at a time. The repaired rows are read off the
audit in one ordered pass; a conversation's digest is sequential, so that
pass streams it through one task without holding it.

Defined results: a null role or text counts as one space; rows of one turn are
ordered by role, then the first ``HEAD`` characters of the text, then a hash; null
turns come first; equal rows are duplicates of the first; a null conversation id is a
conversation; without rows the cost is 0 and the audit empty; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchtrail.functions.ranking import dense_index
from benchtrail.llm.common import WORD_GAPS, stored

SPAN, LEAF, HEAD = 1024, 8, 64
#: fixed values: what an edit costs
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: places in the pattern: 0 start, 1 after s, 2 after u, 3 after a; (place, initial) -> place
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
START, ENDS = 0, (0, 3)

Cell = dict[tuple[int, int], tuple[int, str]]


def lesser(cell: Cell, symbol: tuple[int, int], value: tuple[int, str]) -> None:
    if symbol not in cell or value < cell[symbol]:
        cell[symbol] = value


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The binary rules over two adjacent spans."""
    out = {} if into is None else into
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s and ((p, q) not in out or cost + more <= out[p, q][0]):
                lesser(out, (p, q), (cost + more, audit + rest))
    return out


def insertion_closure() -> Cell:
    """Cell of the empty span: any insertions, the cheapest for each symbol."""
    once: Cell = {(p, q): (INSERT, "I") for (p, initial), q in STEPS.items() if initial in ROLES}
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    while (wider := joined(cell, once, dict(cell))) != cell:
        cell = wider
    return cell


EMPTY = insertion_closure()


@lru_cache(None)
def terminal(role: str, fault: str) -> tuple:
    """Cell of one row. ``role``: s, u, a or o (other); ``fault``: c none, t truncated, d must go."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault != "d":
        extra = TRUNCATED if fault == "t" else 0
        for (p, initial), q in STEPS.items():
            if initial == role:
                lesser(cell, (p, q), (extra, "K"))
            if initial in ROLES:
                lesser(cell, (p, q), (extra + REROLE, "R"))
    return tuple(joined(joined(EMPTY, cell), EMPTY).items())


def chart(cells: list[Cell]) -> Cell:
    """CYK over a few adjacent spans: all spans by length, all splits of each."""
    table = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for i in range(len(cells) - length + 1):
            cell = table[i, i + length] = {}
            for k in range(i + 1, i + length):
                joined(table[i, k], table[k, i + length], cell)
    return table[0, len(cells)]


@lru_cache(100_000)
def leaf(word: str) -> tuple:
    return tuple(chart([dict(terminal(word[i], word[i + 1])) for i in range(0, len(word), 2)]).items())


def doubled(cells: list[Cell]) -> Cell:
    """The cell of adjacent spans, joined two by two by length."""
    while len(cells) > 1:
        cells = [joined(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def parse(word: str) -> Cell:
    """The cell of a run of rows, two letters (role, fault) each."""
    return doubled([dict(leaf(word[i:i + 2 * LEAF])) for i in range(0, len(word), 2 * LEAF)]) if word else EMPTY


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[START, end] for end in ENDS if (START, end) in cell)


def pack(cell: Cell) -> str:
    return ",".join(f"{p}{q}{cost}:{audit}" for (p, q), (cost, audit) in sorted(cell.items()))


def unpack(text: str) -> Cell:
    out = {}
    for part in text.split(","):
        cost, audit = part[2:].split(":")
        out[int(part[0]), int(part[1])] = int(cost), audit
    return out


def illegal_pairs(roles: str) -> int:
    return sum(roles[i:i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        roles = [w[::2] for w in b["word"]]
        yield pd.DataFrame({"key": b["key"], "run": b["run"], "cell": [pack(parse(w)) for w in b["word"]], "ends": [r[0] + r[-1] for r in roles],
                            "illegal": [illegal_pairs(r) for r in roles]})


def _join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for key, run, parts in zip(b["key"], b["run"], b["parts"]):
            ends = "".join(p["ends"] for p in parts)
            cell = parts[0]["cell"] if len(parts) == 1 else pack(doubled([unpack(p["cell"]) for p in parts]))
            out.append((key, run, cell, ends[0] + ends[-1], sum(p["illegal"] for p in parts) + sum(illegal_pairs(ends[i:i + 2]) for i in range(1, len(ends) - 1, 2))))
        yield pd.DataFrame(out, columns=["key", "run", "cell", "ends", "illegal"])


def _answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [cheapest(unpack(c)) for c in b["cell"]]
        yield pd.DataFrame({"key": b["key"], "illegal": b["illegal"], "cost": [c for c, _ in found], "audit": [a for _, a in found]})


RUNS = "key string, run long, cell string, ends string, illegal long"


def numbered(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(key, turn, role, text, at): the rows in order."""
    conv = F.col(conv_col).cast("string")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    plain = rows.select(F.when(conv.isNull(), "n").otherwise(F.concat(F.lit("v"), conv)).alias("key"), F.col(turn_col).alias("turn"),
                        role.alias("role"), text.alias("text"), F.substring(text, 1, HEAD).alias("head"))
    return dense_index(plain, ["key", "turn", "role", "head"], "at").drop("head")


def faults(rows: DataFrame) -> DataFrame:
    """(key, turn, at, initial, fault) of ``numbered`` rows, without their texts. The fault is
    the first that a row has: b blank, d duplicate, t truncated, c none."""
    end = F.rtrim(F.col("text"), F.lit(WORD_GAPS))
    initial = F.substring("role", 1, 1)
    firsts = rows.filter(end != "").groupBy("key", "role", F.sha2("text", 256)).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    marks = rows.select("key", "turn", "at", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), F.substring(end, -1, 1).alias("end"))
    fault = F.when(F.col("end") == "", "b").when(F.col("new").isNull(), "d").when(~F.col("end").isin(".", "!", "?"), "t").otherwise("c")
    return stored(marks.join(firsts, "at", "left").select("key", "turn", "at", "initial", fault.alias("fault")), "repair-faults")


def plans(rows: DataFrame) -> DataFrame:
    """(key, illegal, cost, audit) of every conversation, from the ``faults`` of its rows."""
    letters = F.concat("initial", F.when(F.col("fault") == "b", "d").otherwise(F.col("fault")))
    run = F.expr(f"at div {SPAN}")
    words = rows.groupBy("key", run.alias("run")).agg(F.array_sort(F.collect_list(F.struct("at", letters.alias("word")))).alias("w"))  # ``SPAN`` at most
    runs = stored(words.select("key", "run", F.array_join("w.word", "").alias("word")).mapInPandas(_parse, RUNS), "repair-runs")
    while True:
        longest = runs.groupBy("key").count().agg(F.max("count")).first()[0] or 0
        group = F.lit(0) if longest <= SPAN else F.expr(f"run div {SPAN}")
        parts = runs.groupBy("key", group.cast("long").alias("to")).agg(F.array_sort(F.collect_list(F.struct("run", "cell", "ends", "illegal"))).alias("parts"))
        runs = parts.withColumnRenamed("to", "run").mapInPandas(_join, RUNS)
        if longest <= SPAN:
            return runs.mapInPandas(_answer, "key string, illegal long, cost long, audit string")
        runs = stored(runs, "repair-runs")


class Reader:
    """Reads the repaired rows of one conversation off its audit, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def _put(self, initial: str) -> str:
        self.place = STEPS[self.place, initial]
        return ROLES.get(initial, "")

    def _next(self) -> str:
        return "a" if self.place == 2 else "u"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._put(self._next()), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What comes out up to and with this row: (role, text, edit)."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[0])
            yield role, text, edit
        elif edit == "R":
            yield self._put(self._next()), text, edit


def _in_order(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each conversation's audit (at -1) and then its rows, in order in one partition."""
    head = plan.select("key", F.lit(-1).cast("long").alias("at"), F.col("audit").alias("role"), F.lit("").alias("text"))
    return head.unionByName(rows.select("key", "at", "role", "text")).repartition("key").sortWithinPartitions("key", "at")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, reader or None, outputs) per row; None ends a conversation."""
    key = reader = None
    for batch in batches:
        for k, at, role, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if at < 0:
                if reader is not None:
                    yield key, reader.inserted(), True
                key, reader = k, Reader(role)
            else:
                yield key, reader.row(role, text), False
    if reader is not None:
        yield key, reader.inserted(), True


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, n = [], 0
    for key, outputs, last in _events(batches):
        for role, text, edit in outputs:
            out.append({"key": key, "n": n, "role": role, "text": text, "edit": edit})
            n += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, REPAIRED)
                out = []
        n = 0 if last else n
    if out:
        yield pa.RecordBatch.from_pylist(out, REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, first, out = hashlib.sha256(), True, []
    for key, outputs, last in _events(batches):
        for role, text, _ in outputs:
            digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
            first = False
        if last:
            out.append({"key": key, "sha": digest.hexdigest()})
            digest, first = hashlib.sha256(), True
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, DIGESTS)
                out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, DIGESTS)


REPAIRED = pa.schema([("key", pa.string()), ("n", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
DIGESTS = pa.schema([("key", pa.string()), ("sha", pa.string())])


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(key, n, role, text, edit): the rows of the repaired conversations, numbered from 0."""
    return _in_order(rows, plan).mapInArrow(_rows, "key string, n long, role string, text string, edit string")


def repair(conversations: DataFrame, **columns) -> DataFrame:
    """The repaired rows of a table of conversations."""
    rows = numbered(conversations, **columns)
    return repaired(rows, stored(plans(faults(rows)), "repair-plans"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that ``crc32(conv_id:turn) % 20`` plants."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    fate = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "utf-8")) % 20
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).filter("fate != 0")
            .select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def count_of(fault: str) -> Column:
    return F.count_if(F.col("fault") == fault)


def report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """Counts, cheapest repair and digest of every conversation of ``original``, whose rows are now ``rows``."""
    rows = numbered(rows)
    marks = faults(rows)
    plan = stored(plans(marks), "repair-plans")
    turns = marks.groupBy("key", "turn").agg(*(count_of(f).alias(f) for f in "bdt")).groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), *(F.sum(f).alias(f) for f in "bdt"))
    sha = _in_order(rows, plan).mapInArrow(_digests, "key string, sha string")
    conv = F.col("conv_id").cast("string")
    ids = original.select("conv_id", F.when(conv.isNull(), "n").otherwise(F.concat(F.lit("v"), conv)).alias("key")).distinct()
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return ids.join(turns, "key", "left").join(plan, "key", "left").join(sha, "key", "left").select(
        "conv_id", none("gaps").alias("gaps"), none("b").alias("blank"), none("d").alias("duplicate"), none("t").alias("truncated"),
        none("illegal").alias("illegal"), none("cost").alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_interval_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return report(conversations, damaged(conversations))


def _edit(state: str, cost: str, letter: str) -> str:
    """SQL: a state (nine digits of cost, then the audit) after one more edit."""
    return f"printf('%09d', CAST(left({state}, 9) AS BIGINT) + {cost}) || substr({state}, 10) || '{letter}'"


_EXTRA = "CASE WHEN r.fault = 't' THEN 5 ELSE 0 END"
_LIVE = "r.fault NOT IN ('b', 'd')"
_BEFORE_U = "least(w.s0, w.s1, w.s3)"
OP11_SQL = f"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(range(1, length(k) + 1),
      lambda i: [CAST(ascii(substr(k, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295) % 20 AS fate
  FROM fated
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE fate <> 0
), placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM damaged
), r AS (
  SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
      WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'c' END AS fault
  FROM placed
), walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000005I' AS s2, '000000010II' AS s3 FROM r
  UNION ALL
  SELECT conv_id, pos, s0, s1, least(s2, {_edit("least(s0, s1, s3)", "5", "I")}) AS s2,
    least(s3, {_edit("s2", "5", "I")}, {_edit("least(s0, s1)", "10", "II")}) AS s3
  FROM (
    SELECT w.conv_id, r.pos, {_edit("w.s0", "2", "D")} AS s0,
      least({_edit("w.s1", "2", "D")}, CASE WHEN {_LIVE} AND r.i = 's' THEN {_edit("w.s0", _EXTRA, "K")} END) AS s1,
      least({_edit("w.s2", "2", "D")}, CASE WHEN {_LIVE} AND r.i = 'u' THEN {_edit(_BEFORE_U, _EXTRA, "K")} END,
        CASE WHEN {_LIVE} THEN {_edit(_BEFORE_U, "1 + " + _EXTRA, "R")} END) AS s2,
      least({_edit("w.s3", "2", "D")}, CASE WHEN {_LIVE} AND r.i = 'a' THEN {_edit("w.s2", _EXTRA, "K")} END,
        CASE WHEN {_LIVE} THEN {_edit("w.s2", "1 + " + _EXTRA, "R")} END) AS s3
    FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
  )
), best AS (
  SELECT conv_id, least(s0, s3) AS s FROM walk
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), letters AS (
  SELECT conv_id, n, substr(s, 9 + CAST(n AS INTEGER), 1) AS e FROM (SELECT conv_id, s, unnest(range(1, length(s) - 8)) AS n FROM best)
), edits AS (
  SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY n) AS pos FROM letters
), alive AS (
  SELECT e.conv_id, e.n, e.e, r.role, r.text, r.i, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.n) AS m
  FROM edits e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos AND e.e <> 'I' WHERE e.e <> 'D'
), lines AS (
  SELECT conv_id, m, CASE WHEN e = 'K' THEN role
      WHEN (m - max(CASE WHEN m = 1 AND e = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line
  FROM alive
), whole AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY m) AS body FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(left(b.s, 9), '0') AS BIGINT) AS cost, coalesce(substr(b.s, 10), '') AS audit,
  sha256(coalesce(w.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""
