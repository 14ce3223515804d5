"""Quality classifier: histogram gradient-boosted trees over text statistics.

Every document becomes a row of statistics that don't depend on its language
(lengths, shares of character classes, repetition, compressibility). Trees of
a fixed depth are grown level by level on histograms of binned statistics and
flattened into arrays, so that a batch of documents walks all trees with a
few numpy steps per level.

Labels are learned from about ``SAMPLE`` labelled rows (twice as many at most), those of the smallest hashes.

Defined results: null and empty texts are scored by their (zero) statistics;
a document with several labels counts with the smallest; without a label, or
with labels of one value, the score is the share of good labels (0.5 without
any); repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, fold, stored

#: bound of the labelled rows that are fitted
SAMPLE = 20_000
BINS, DEPTH, TREES, RATE, MIN_ROWS, RIDGE = 64, 4, 100, 0.1, 15, 1.0
GOOD = 0.7
SYMBOLS = b"#*$%&|<>@^~=_{}[]\\"
STATISTICS = ("log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "distinct_words", "top_word", "same_as_before",
              "symbols", "upper", "digits", "marks", "exclamations", "pipes", "spaces", "multibyte", "entropy", "zlib_ratio",
              "line_words", "repeated_lines", "ends_in_letter", "words_with_symbol")
_SYM, _MARK = np.frombuffer(SYMBOLS, np.uint8), np.frombuffer(b".,;:?!'\"()-", np.uint8)


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode(errors="replace")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, k = len(raw), len(words)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = count[count > 0] / n
    sizes = np.fromiter(map(len, words), np.int64, k)
    tally = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [np.log1p(n), np.log1p(k), sizes.mean(), sizes.std(), sizes.max(), len(tally) / k, max(tally.values()) / k,
            sum(map(eq, words, words[1:])) / k, count[_SYM].sum() / n, count[65:91].sum() / n, count[48:58].sum() / n,
            count[_MARK].sum() / n, count[33] / n, count[124] / n, (count[32] + count[9:14].sum()) / n, count[128:].sum() / n,
            float(-(p * np.log2(p)).sum()), len(zlib.compress(raw, 1)) / n, np.log1p(k / len(lines)), 1 - len(set(lines)) / len(lines),
            sum(x[-1:].isalpha() for x in lines) / len(lines), sum(c for w, c in tally.items() if w[-1] in SYMBOLS) / k]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x: array of the statistics) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[float(v) for v in statistics(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


class Trees:
    """Boosted trees for 0/1 labels. Every tree is complete: inner node i has
    the children 2i + 1 and 2i + 2, and a row goes right if its statistic is
    above the node's threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        inner = 2**DEPTH - 1
        one_sided = len(set(y.tolist())) < 2
        n_trees = 0 if one_sided else TREES
        self.feature = np.zeros((n_trees, inner), np.int64)
        self.threshold = np.full((n_trees, inner), np.inf)
        self.leaf = np.zeros((n_trees, inner + 1))
        if one_sided:
            return
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.array([np.searchsorted(e, c) for e, c in zip(edges, x.T)])  # bin b: edges[b-1] < value <= edges[b]
        columns, score = np.arange(len(edges))[:, None] * BINS, np.full(len(y), self.base)
        for t in range(n_trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                first = 2**level - 1
                at = (columns + binned)[None] + (node - first)[None, None] * (len(edges) * BINS)
                shape = (2**level, len(edges), BINS)
                hist = [np.bincount(at.ravel(), np.broadcast_to(v, binned.shape).ravel(), np.prod(shape)).reshape(shape).cumsum(axis=2)
                        for v in (g, h, np.ones(len(y)))]
                (gl, gs), (hl, hs), (nl, ns) = ((v, v[:, :, -1:]) for v in hist)
                gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
                gain[(nl < MIN_ROWS) | (ns - nl < MIN_ROWS)] = 0
                best = gain.reshape(2**level, -1).argmax(axis=1)
                for i, b in enumerate(best):
                    f, cut = divmod(int(b), BINS)
                    if gain[i, f, cut] > 1e-9 and cut < len(edges[f]):
                        self.feature[t, first + i], self.threshold[t, first + i] = f, edges[f][cut]
                node = self._down(t, node, x)
            leaf = node - inner
            gs, hs = (np.bincount(leaf, v, inner + 1) for v in (g, h))
            self.leaf[t] = RATE * gs / (hs + RIDGE)
            score += self.leaf[t][leaf]

    def _down(self, t, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 2 * node + 1 + (x[np.arange(len(x)), self.feature[t, node]] > self.threshold[t, node])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all trees walk down together."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.base + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Trees:
    """Fit on a bounded sample of the documents with a label."""
    marks = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
    rows = stats.join(marks, "id").withColumn("turn", F.xxhash64("id", "x").bitwiseAND(F.lit(2**40 - 1)) / 2.0**40)
    n = rows.count()
    sample = (rows.filter(F.col("turn") < SAMPLE / max(n, 1)).select("turn", "y", "x").orderBy("turn", "y", "x").limit(2 * SAMPLE).collect())
    sample.sort(key=lambda r: (r.turn, r.y, r.x))
    return Trees(np.array([r.x for r in sample]).reshape(len(sample), len(STATISTICS)), np.array([r.y for r in sample], float))


def score_quality(stats: DataFrame, model: Trees) -> DataFrame:
    """(id, score) per row of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, len(STATISTICS))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["id", "score"])

    return stats.select("id", "x").mapInArrow(run, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def op6_boosted_statistics(spark, sf_dir):
    stats = stored(document_statistics(documents(spark, sf_dir)), "statistics")
    model = learn(stats.filter(fold(F.col("id"), 4) != 2), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(stats, model).select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
