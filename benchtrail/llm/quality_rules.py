"""Quality rules: compression bands over whole documents and fixed chunks.

Repetitive text compresses too well, noise hardly at all. The zstandard ratio
(compressed / raw bytes) of the whole text must lie in a band that depends on
its length, since short texts carry the frame and no history; and at most a
quarter of its 2 KB chunks may lie outside the band for chunks, so that junk
inside a long document counts as well. Base rules come first: too few words,
or too many words in repeated 5-word windows.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged alike; other columns are ignored (measures) or kept
as they are (filter).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import WORD_GAPS, documents

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
LEVEL = 3
#: length from (bytes), lowest and highest ratio of a whole document
BANDS = ((0, 0.0, 99.0), (64, 0.35, 1.30), (128, 0.40, 1.10), (256, 0.40, 0.90), (512, 0.38, 0.78),
         (1024, 0.36, 0.72), (4096, 0.33, 0.70), (16384, 0.25, 0.70))
CHUNK = 2048
CHUNK_BAND = (0.38, 0.72)
MAX_CHUNKS_OUT = 0.25


def repeat_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more, the first included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, v = np.fromiter(map(number.__getitem__, words), np.int64, n), len(number)
    if v == n:
        return 0
    key, span = ids, v
    for k in range(1, WINDOW):  # exact keys: renumbered before the product could overflow
        if span * v >= 2**62:
            _, key = np.unique(key, return_inverse=True)
            span = int(key.max()) + 1
        key, span = key[:n - k] * v + ids[k:], span * v
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k:k + len(twice)] |= twice
    return int(covered.sum())


def band_verdict(raw: bytes, codec: zstandard.ZstdCompressor) -> bool:
    """Whether the whole text and enough of its chunks lie in their bands."""
    _, low, high = BANDS[bisect_right(BANDS, (len(raw), 1e9)) - 1]
    if not raw or not low <= len(codec.compress(raw)) / len(raw) <= high:
        return False
    chunks = [raw[i:i + CHUNK] for i in range(0, len(raw) - CHUNK + 1, CHUNK)]
    if chunks and len(raw) % CHUNK:
        chunks.append(raw[-CHUNK:])  # anchored at the end, so every byte lies in a chunk
    out = sum(not CHUNK_BAND[0] <= len(codec.compress(c)) / CHUNK <= CHUNK_BAND[1] for c in chunks)
    return out <= MAX_CHUNKS_OUT * len(chunks)


def measure(text: str | None, codec: zstandard.ZstdCompressor) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    return (len(words), len(text) - sum(map(text.count, WORD_GAPS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated, failed, not failed and band_verdict(raw, codec))


FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()))


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measures, base_failed, kept) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [measure(t.as_py(), codec) for t in b.column(1)]
            cols = zip(*rows) if rows else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, (_, k) in zip(cols, FIELDS))],
                                             ["id", *(n for n, _ in FIELDS)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            yield b.filter(pa.array([measure(t.as_py(), codec)[-1] for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_compression_bands(spark, sf_dir):
    return quality_measures(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
