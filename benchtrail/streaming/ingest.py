"""Structured Streaming forms of ingest (T1), gating (T2) and the kept-up
latest-record / usage totals (T3).

Micro-batches are dispatched to handlers registered per event type; every
handler output is written under ``batch_id=<id>`` with overwrite, so a batch
replayed after a failure (same id from the checkpoint) replaces its own
output instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchtrail.operators.history import latest_record
from benchtrail.session import materialize

Handler = Callable[[DataFrame, int], None]


class Dispatcher:
    """Handlers by event type; a handler is registered once per type;
    events of a type without handlers are dropped."""

    def __init__(self, type_col: str = "event_type"):
        self.type_col = type_col
        self._handlers: dict[str, list[Handler]] = {}

    def register(self, type_: str, handler: Handler) -> None:
        hs = self._handlers.setdefault(type_, [])
        if handler not in hs:
            hs.append(handler)

    def unregister(self, type_: str, handler: Handler) -> None:
        hs = self._handlers.get(type_, [])
        if handler in hs:
            hs.remove(handler)
        if not hs:
            self._handlers.pop(type_, None)

    def types(self) -> list[str]:
        return sorted(self._handlers)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if not self._handlers:
            return
        kept = materialize(batch.filter(F.col(self.type_col).isin(self.types())), "dispatch")
        for t in self.types():
            part = kept.filter(F.col(self.type_col) == t)
            for h in self._handlers[t]:
                h(part, batch_id)


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Handler:
    """A handler that writes (optionally transformed) rows of a micro-batch
    to ``path/batch_id=<id>``, replacing that batch's earlier output."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = transform(df) if transform else df
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key among the batches that a ``batch_writer``
    wrote for an update-mode stream: every batch holds the keys it changed,
    so a failed write never touches an earlier state."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select(*keys, *[F.col("_v")[c].alias(c) for c in values])


def run_available(stream: DataFrame, sink: Handler, checkpoint: str, output_mode: str = "append") -> None:
    """Run ``stream`` over everything available now (then stop) into the
    foreachBatch ``sink``. ``checkpoint`` names the stream for good: a later
    run with it continues after the last batch (new batch ids, only new
    files); it has to lie in a folder that all executors share."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(sink)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def file_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """A parquet file stream over the files ``<name>.parquet`` of a folder
    (schema taken from the batch table, never inferred per batch)."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def gate(stream: DataFrame, builds: DataFrame, on: Sequence[str] | str, ok_col: str = "build_ok") -> DataFrame:
    """Only items whose build succeeded reach the test stage
    (stream-static left semi join)."""
    return stream.join(builds.filter(F.col(ok_col)).select(on if isinstance(on, str) else list(on)).distinct(),
                       on, "left_semi")


def latest_record_stream(stream: DataFrame, keys: Sequence[str], ts: str = "updatetime",
                         tie: Sequence[str] = ("event_id",), values: Sequence[str] | None = None) -> DataFrame:
    """A12 kept up to date as a stateful aggregation (complete/update
    output mode): the same function as the batch operator."""
    return latest_record(stream, keys, ts, tie, values)


def usage_totals_stream(stream: DataFrame, keys: Sequence[str] = ("api", "changelist"),
                        total: str = "total") -> DataFrame:
    """A5 kept up to date: running sums per (api, changelist)."""
    return stream.groupBy(*keys).agg(F.sum(total).cast("bigint").alias("total"))


def log_file_stream(spark: SparkSession, folder: str, glob: str = "*.log", max_files: int | None = None) -> DataFrame:
    """New log files of a folder as a stream of ``(file, line_no, line)``.
    Each file arrives whole in one micro-batch (whole-text rows), so line
    numbers are exact; a log is one task, which suits the many-small-logs
    case of continuous ingest (one huge log belongs to the batch scan)."""
    r = (spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.load(folder)
    # drop the empty element a final newline leaves (no window on a stream); the text is split
    # once a log and doesn't go along with its lines
    parts = F.split(F.col("value"), "\n")
    kept = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    ex = raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode(kept).alias("pos", "line"))
    return ex.select("file", (F.col("pos") + 1).cast("bigint").alias("line_no"),
                     F.regexp_replace("line", "\r$", "").alias("line"))


def ingest_logs(lines_stream: DataFrame, to_rows: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """T1 for log files: every micro-batch of new logs is turned into rows by
    ``to_rows`` (e.g. parse + loop merge) and written under
    ``out/batch_id=<id>`` (a replayed batch replaces its own output). Run
    again with the same ``checkpoint``, it reads only new logs and keeps what
    earlier runs wrote."""
    run_available(lines_stream, batch_writer(out, to_rows), checkpoint)
