"""Ingest of logs that grow (T1) and compaction of kept-up results.

``GrowingLogs`` keeps a ledger: for each file the bytes and lines taken so far.
A batch lists the files, reads only the bytes beyond the ledger, in splits of
bounded size by any number of tasks, and numbers the lines from where the ledger
stands. A last line without its end stays for the next batch. The lines of the block
still open at the end of a file are carried over and parsed again with what
follows; the newest row of a block counts. Output, carried lines and ledger of a batch
become visible together, by one version added to a log of versions, so a batch that
is lost in between is done anew and nothing is taken twice.

``Compacted`` holds the newest row per key for a stream of changes. Each
batch adds one directory of changes; after ``every`` of them they are merged into
a new base and the version names only that, so the number of
directories a reader opens stays bounded however many batches there were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchtrail.session import materialize
from benchtrail.sinks.versioned import VersionLog

SPLIT = 64 << 20
#: new bytes of a batch that a task reads, about, over several logs
TASK = 16 << 20
READ = 1 << 20
LEDGER = "file string, bytes long, lines long"
LINES = "file string, line_no bigint, line string"


def lines_of_split(uri: str, low: int, high: int, start: int, size: int, final: bool) -> Iterator[tuple[bytes, int]]:
    """(line, where it ends) for the lines that begin in [low, high) of a file. ``start``: where the
    batch begins, at a line's begin; nothing beyond ``size`` is read; ``final``: a last line without its end counts."""
    system, path = arrow_fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        at, held, skip = (low, b"", False) if low == start else (low - 1, b"", True)  # skip what began before
        f.seek(at)
        begin = at
        while begin < high or skip:
            chunk = f.read(min(READ, size - begin - len(held)))
            if not chunk:
                if held and not skip and final:
                    yield held, size
                return
            held += chunk
            first = 0
            while (end := held.find(b"\n", first)) >= 0:
                if not skip:
                    if begin + first >= high:
                        return
                    yield held[first:end], begin + end + 1
                skip, first = False, end + 1
            begin, held = begin + first, held[first:]


class GrowingLogs:
    """The logs of a folder, taken as they grow. ``state``: a folder of the ingest's own."""

    def __init__(self, spark: SparkSession, folder: str, state: str, glob: str = "*.log", split: int = SPLIT):
        self.spark, self.folder, self.glob, self.split = spark, folder, glob, split
        self.state, self.log = state.rstrip("/"), VersionLog(spark, state)

    def _table(self, kind: str, schema: str) -> DataFrame:
        name = self.log.latest()[1].get(kind)
        return self.spark.read.schema(schema).parquet(f"{self.state}/{name}") if name else self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        return self._table("ledger", LEDGER)

    def new_lines(self, final: bool = False) -> tuple[DataFrame, DataFrame]:
        """(file, line_no, line) of what came since the last batch, and the ledger with it."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", self.glob).load(self.folder)
                 .select(F.col("path").alias("file"), F.col("length").alias("size")))  # names and sizes; contents aren't read
        known = materialize(files.join(self.ledger(), "file", "left").select("file", "size", F.coalesce("bytes", F.lit(0)).alias("bytes"),
                                                                            F.coalesce("lines", F.lit(0)).alias("lines")), "listing")
        shrunk = known.filter("size < bytes").count()
        if shrunk:
            raise ValueError(f"{shrunk} logs are shorter than what was read of them")
        grown = known.filter("size > bytes").withColumn("low", F.explode(F.sequence("bytes", F.col("size") - 1, F.lit(self.split))))
        splits = grown.select("file", "low", F.least(F.col("low") + self.split, "size").alias("high"), F.col("bytes").alias("start"), "size")

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for uri, low, high, start, size in b.itertuples(index=False):
                    out = []
                    for n, (line, end) in enumerate(lines_of_split(uri, low, high, start, size, final)):
                        out.append((uri, low, n, end, line.decode("utf-8", "replace").removesuffix("\r")))
                        if len(out) == 10_000:
                            yield pd.DataFrame(out, columns=["file", "low", "n", "end", "line"])
                            out = []
                    if out:
                        yield pd.DataFrame(out, columns=["file", "low", "n", "end", "line"])

        # a task reads many small logs or one split
        new = splits.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("high") - F.col("low")), F.lit(0)).alias("bytes")).first()
        tasks = max(1, min(new.n, max(-(-new.bytes // TASK), self.spark.sparkContext.defaultParallelism)))
        rows = materialize(splits.repartition(tasks, "file", "low").mapInPandas(read, "file string, low long, n long, end long, line string"), "new-lines")
        parts = rows.groupBy("file", "low").agg(F.count(F.lit(1)).alias("count"), F.max("end").alias("end"))
        before = parts.alias("p").join(parts.select(F.col("file").alias("f"), F.col("low").alias("l"), F.col("count").alias("c")).alias("q"),
                                       (F.col("p.file") == F.col("q.f")) & (F.col("q.l") < F.col("p.low")), "left")  # splits of one file
        before = before.groupBy("file", "low").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("before"))
        base = known.select("file", "lines")
        lines = (rows.join(before, ["file", "low"]).join(base, "file")
                 .select("file", (F.col("lines") + F.col("before") + F.col("n") + 1).cast("bigint").alias("line_no"), "line"))
        taken = parts.groupBy("file").agg(F.max("end").alias("end"), F.sum("count").alias("count"))
        ledger = known.join(taken, "file", "left").select("file", F.coalesce("end", "bytes").alias("bytes"), (F.col("lines") + F.coalesce("count", F.lit(0))).alias("lines"))
        # a file that is gone keeps its entry
        return lines, ledger.unionByName(self.ledger().join(known, "file", "left_anti"))

    def take(self, parse: Callable[[DataFrame], DataFrame], opens: Column, final: bool = False) -> int:
        """One batch (an empty file counts as not there): ``parse`` turns (file, line_no, line) into rows with ``file`` and the ``node_ix`` of their block's
        first line; ``opens`` is true for a line that begins a block."""
        version, state = self.log.latest()
        lines, ledger = self.new_lines(final)
        name = f"batch={version + 1}-{uuid.uuid4().hex[:12]}"
        lines = materialize(lines.unionByName(self._table("carry", LINES)), "batch-lines")
        last = lines.filter(opens).groupBy("file").agg(F.max("line_no").alias("_open"))
        carry = lines.join(last, "file", "left").filter(F.col("_open").isNull() | (F.col("line_no") >= F.col("_open"))).drop("_open")
        parse(lines).withColumn("batch", F.lit(version + 1)).write.parquet(f"{self.state}/{name}/rows")
        carry.write.parquet(f"{self.state}/{name}/carry")
        ledger.write.parquet(f"{self.state}/{name}/ledger")
        rows = state.get("rows", []) + [f"{name}/rows"]
        self.log.commit(version + 1, {"rows": rows, "carry": f"{name}/carry", "ledger": f"{name}/ledger"})
        return version + 1

    def rows(self) -> DataFrame:
        """The rows of all batches; of a block that grew, the newest."""
        paths = [f"{self.state}/{r}" for r in self.log.latest()[1]["rows"]]
        rows = self.spark.read.parquet(*paths)
        values = [c for c in rows.columns if c not in ("file", "node_ix", "batch")]
        newest = rows.groupBy("file", "node_ix").agg(F.max_by(F.struct(*values), "batch").alias("_v"))
        return newest.select("file", "node_ix", *[F.col("_v")[c].alias(c) for c in values])


class Compacted:
    """The newest row of each key, from changes that come in batches. A batch that is
    replayed, with the same or a smaller number, changes nothing."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], every: int = 16):
        self.spark, self.root, self.keys, self.every = spark, root.rstrip("/"), list(keys), every
        self.log = VersionLog(spark, root)

    def _newest(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*[f"{self.root}/{p}" for p in paths])
        values = [c for c in rows.columns if c not in (*self.keys, "_batch")]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v"), F.max("_batch").alias("_batch"))
        return newest.select(*self.keys, *[F.col("_v")[c].alias(c) for c in values], "_batch")

    def add(self, changes: DataFrame, batch_id: int) -> None:
        """A foreachBatch sink: the rows that changed, one per key."""
        version, state = self.log.latest()
        if batch_id <= state.get("batch", -1):
            return
        name = f"changes/{batch_id}-{uuid.uuid4().hex[:12]}"
        changes.withColumn("_batch", F.lit(batch_id).cast("long")).write.parquet(f"{self.root}/{name}")
        paths = state.get("paths", []) + [name]
        if len(paths) > self.every:
            base = f"base/{batch_id}-{uuid.uuid4().hex[:12]}"
            self._newest(paths).write.parquet(f"{self.root}/{base}")
            paths = [base]
        self.log.commit(version + 1, {"batch": batch_id, "paths": paths})

    def paths(self) -> list[str]:
        return self.log.latest()[1].get("paths", [])

    def read(self) -> DataFrame:
        return self._newest(self.paths()).drop("_batch")
