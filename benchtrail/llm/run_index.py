"""Exact removal of long repeated byte strings with a run-length index.

A string of ``LENGTH`` bytes counts as repeated if it also starts anywhere
else. Three steps find all of them:

1. Every window of ``LENGTH`` bytes is owned by the smallest hashed gram in it,
   its anchor. Ownership depends on the window's bytes alone, so equal windows
   have equal anchors, and a window whose anchor occurs once is unique. The
   windows of one anchor form one segment of less than twice ``LENGTH``.
2. Segments of an anchor that are all equal are repeated as a whole.
3. Where the segments of an anchor differ, an index tells which windows
   repeat: the segments of some anchors are laid end to end, their
   Burrows-Wheeler transform is cut into runs, and only at the ends of runs a
   text position and the length of its match with its neighbour in suffix
   order are sampled. Inside a run the match one byte on is one byte shorter,
   so streaming over the text from sample to sample gives the matching
   statistics of every position; windows with a match of ``LENGTH`` repeat.

An anchor with very many different segments (a passage shared by a large part
of all documents, before or after which each goes its own way) would make one
index too large. Its windows are split by how far before the anchor they start,
into halves; the windows of a half have some bytes around the anchor in common,
and equal windows have these alike, so a half is dealt to an index by them.
Equal parts are repeated as a whole, as in step 2. Halves that are still too
large are split again, until a part is a single window.

Spans are judged on the input. Defined results: a null text counts as empty;
repeated rows are copies of each other and are removed whole from ``LENGTH``
bytes on; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, keyed, stored
from benchtrail.llm.shingles import mix

LENGTH = 400
GRAM = 32
#: window starts that are looked at together in a long text
SLICE = 4_000_000
#: bytes of segments in one index, and different segments of one anchor beyond which they are split
INDEX_BYTES, MANY = 1_000_000, 5000
#: symbols that one integer holds
PACKED = 7
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_hashes(b: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of ``size`` bytes."""
    sums = np.append(np.uint64(0), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(b)), dtype=np.uint64))
    return mix((sums[size:] - sums[:-size]) * _powers(INVERSE, len(b) - size + 1))


def anchors(b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of each anchor of some bytes."""
    grams = window_hashes(b, GRAM)
    w, n = LENGTH - GRAM + 1, len(b) - LENGTH + 1
    key = np.full(-(-len(grams) // w) * w, np.iinfo(np.uint64).max)
    key[:len(grams)] = (grams & ~np.uint64(2**24 - 1)) | np.arange(len(grams), dtype=np.uint64)  # the first of equal grams
    rows = key.reshape(-1, w)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(tail[:n], head[w - 1:w - 1 + n]) & np.uint64(2**24 - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return grams[place[first]], place[first], first, np.append(first[1:], n) - 1


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(fp, t1, t2, lo, hi, s1, s2): the anchors of the texts (t1, t2, text), the
    bytes from their first to the end of their last window, and these hashed."""
    names = ["fp", "t1", "t2", "lo", "hi", "s1", "s2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for t1, t2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (t1, t2) in seen:
                    continue
                seen.add((t1, t2))
                raw = text.as_py().encode(errors="replace")
                cols = [[] for _ in names]
                for at in range(0, len(raw) - LENGTH + 1, SLICE):
                    piece = np.frombuffer(raw, np.uint8)[at:at + SLICE + LENGTH - 1]
                    fp, place, first, last = anchors(piece)
                    lo, hi = first + at, last + at + LENGTH
                    digests = [xxhash.xxh3_128_intdigest(raw[x:y], seed=p) for x, y, p in zip(lo.tolist(), hi.tolist(), (place - first).tolist())]
                    k = len(fp)
                    for c, v in zip(cols, (fp.astype(np.int64), np.full(k, t1), np.full(k, t2), lo, hi,
                                           np.array([d >> 64 for d in digests], np.uint64).astype(np.int64),
                                           np.array([d & (2**64 - 1) for d in digests], np.uint64).astype(np.int64))):
                        c.append(v)
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in names))


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a sequence of small integers, with samples at the ends of runs."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.symbols, self.ranks, self.spans = symbols, [], []
        padded, key = np.append(symbols, np.zeros(PACKED - 1, np.int64)), np.zeros(n, np.int64)
        for k in range(PACKED):
            key = key << 9 | padded[k:k + n]
        span = PACKED
        while True:  # suffixes by their first 7, 14, 28, ... symbols
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int32)
            rank[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1], dtype=np.int32))
            self.ranks.append(rank)
            self.spans.append(span)
            if rank[order[-1]] == n - 1:
                break
            key = rank * np.int64(n + 1)
            key[:n - span] += rank[span:] + np.int64(1)
            span *= 2
        suffix = order
        bwt = symbols[suffix - 1]
        bwt[rank[0]] = -1  # nothing stands before the first symbol
        ends = np.flatnonzero(bwt[1:] != bwt[:-1])  # last of each run but the final one
        common = self.common(suffix[ends], suffix[ends + 1])
        self.n, self.runs = n, len(ends) + 1
        #: text positions at run starts and run ends, and their matches with the suffix before and after
        self.starts, self.start_match = np.append(suffix[0], suffix[ends + 1]), np.append(0, common)
        self.ends, self.end_match = np.append(suffix[ends], suffix[-1]), np.append(common, 0)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of different suffixes."""
        n, total = len(self.symbols), np.zeros(len(a), np.int64)
        for rank, span in zip(self.ranks[::-1], self.spans[::-1]):
            x, y = a + total, b + total
            inside = np.flatnonzero(np.maximum(x, y) + span <= n)
            same = rank[x[inside]] == rank[y[inside]]
            total[inside[same]] += span
        going = np.arange(len(a))
        for _ in range(PACKED - 1):
            x, y = a[going] + total[going], b[going] + total[going]
            inside = np.maximum(x, y) < n
            going, x, y = going[inside], x[inside], y[inside]
            going = going[self.symbols[x] == self.symbols[y]]
            total[going] += 1
        return total

    def matching_statistics(self) -> np.ndarray:
        """Longest match of every position with any other one, streamed from sample to sample."""
        best = np.zeros(self.n, np.int64)
        for at, match in ((self.starts, self.start_match), (self.ends, self.end_match)):
            reach, last = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
            reach[at], last[at] = at + match, at
            best = np.maximum(best, reach[np.maximum.accumulate(last)] - np.arange(self.n))
        return best


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """Per segment, the starts of its windows that occur elsewhere in the segments."""
    symbols = np.concatenate([x for s in segments for x in (np.frombuffer(s, np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64))])
    match = RunIndex(symbols).matching_statistics()
    out, at = [], 0
    for s in segments:
        out.append(np.flatnonzero(match[at:at + len(s) - LENGTH + 1] >= LENGTH))
        at += len(s) + 1
    return out


def spans_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows at these (sorted) starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + LENGTH).tolist()))


def _contents(texts: DataFrame, wanted: DataFrame, first: DataFrame) -> DataFrame:
    """``wanted`` (t1, t2, fp, lo, hi, single, many) with the bytes between lo and hi."""
    names = ["t1", "t2", "fp", "lo", "single", "many", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t1, t2, text, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                raw, parts = text.as_py().encode(errors="replace"), parts.as_py()
                k = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t1] * k, pa.int64()), pa.array([t2] * k, pa.int64()), pa.array([p["fp"] for p in parts], pa.int64()),
                     pa.array([p["lo"] for p in parts], pa.int64()), pa.array([p["single"] for p in parts], pa.bool_()),
                     pa.array([p["many"] for p in parts], pa.bool_()), pa.array([raw[p["lo"]:p["hi"]] for p in parts], pa.binary())], names)

    lists = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("fp", "lo", "hi", "single", "many")).alias("parts"))
    return (texts.join(lists.join(first, ["t1", "t2"]), ["t1", "t2"]).filter(F.col("id").eqNullSafe(F.col("first")))
            .select("t1", "t2", "text", "parts")
            .mapInArrow(run, "t1 long, t2 long, fp long, lo long, single boolean, many boolean, bytes binary"))


def _indexed(parts: DataFrame, groups: int) -> DataFrame:
    """(t1, t2, start, end): repeated bytes of single segments, by an index per group of anchors."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["t1", "t2", "lo"])
        # anchors never match across: an index may take as many of them as its size allows
        rows = rows.sort_values("fp", kind="stable")
        size = rows["bytes"].str.len().to_numpy()
        _, number = np.unique(rows["fp"].to_numpy(), return_inverse=True)
        total = np.cumsum(np.bincount(number, size))
        out = []
        for _, part in rows.groupby((total // INDEX_BYTES)[number]):
            single = part["single"].to_numpy()
            for r, starts, one in zip(part.itertuples(), repeated_windows(part["bytes"].tolist()), single):
                if one:
                    out += [(r.t1, r.t2, r.lo + x, r.lo + y) for x, y in spans_of(starts)]
        return pd.DataFrame(out, columns=["t1", "t2", "start", "end"]).astype("int64")

    return (parts.withColumn("g", F.pmod(F.xxhash64("fp"), F.lit(groups))).groupBy("g")
            .applyInPandas(run, "t1 long, t2 long, start long, end long"))


def _halves(parts: DataFrame) -> DataFrame:
    """(t1, t2, fp, lo, hi, x, y, single, s1, s2, bytes): the parts (with the windows that start x to y - 1 bytes
    before the anchor) in two; fp tells the bytes that all windows of a half have in common."""
    names = ["t1", "t2", "fp", "lo", "hi", "x", "y", "single", "s1", "s2", "bytes"]
    kinds = [*[pa.int64()] * 5, pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    signed = lambda h: (h & (2**64 - 1)) - ((h >> 63 & 1) << 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t1, t2, lo, x, y, single, raw in zip(*(batch.column(i).to_pylist() for i in range(7))):
                place = int(anchors(np.frombuffer(raw, np.uint8))[1][0])  # one for all windows of a part
                for u, v in ((x, (x + y) // 2), ((x + y) // 2, y)):
                    start, last = max(0, place - v + 1), min(len(raw) - LENGTH, place - u)
                    if start <= last:
                        common = xxhash.xxh3_64_intdigest(raw[place - u:place - v + 1 + LENGTH], seed=u << 16 | v)
                        part = raw[start:last + LENGTH]
                        digest = xxhash.xxh3_128_intdigest(part, seed=place - start)
                        out.append((t1, t2, signed(common), lo + start, lo + last + LENGTH, u, v, single, signed(digest >> 64), signed(digest), part))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return parts.select("t1", "t2", "lo", "x", "y", "single", "bytes").mapInArrow(
        run, "t1 long, t2 long, fp long, lo long, hi long, x int, y int, single boolean, s1 long, s2 long, bytes binary")


def _split(parts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of the segments of crowded anchors: spans (t1, t2, start, end) of equal parts, and parts for indexes.

    A round halves what is still crowded. After the rounds that it takes to
    reach one window, equal parts are all that a key can have.
    """
    spans, ready = [], []
    parts = parts.withColumns({"x": F.lit(0), "y": F.lit(LENGTH - GRAM + 1)})
    while not parts.isEmpty():
        halves = stored(_halves(parts), "halves")
        total = halves.count()
        kinds = stored(halves.groupBy("fp", "s1", "s2").agg(
            F.count(F.lit(1)).alias("copies"), F.first(F.struct("t1", "t2", "lo", "x", "y", "single", "bytes")).alias("r")), "half-kinds")
        again = kinds.filter("copies > 1").select("fp", "s1", "s2", "copies")
        spans.append(keyed(halves.filter("single").drop("bytes"), again, ["fp", "s1", "s2"], total)
                     .select("t1", "t2", F.col("lo").alias("start"), F.col("hi").alias("end")))
        different = kinds.select("fp", "r.t1", "r.t2", "r.lo", "r.x", "r.y", (F.col("r.single") & (F.col("copies") == 1)).alias("single"), "r.bytes")
        sizes = stored(different.groupBy("fp").agg(F.count(F.lit(1)).alias("copies")), "half-sizes")
        sized = keyed(different, sizes, ["fp"], total)
        ready.append(sized.filter(F.col("copies") <= MANY).select("t1", "t2", "fp", "lo", "single", "bytes"))
        parts = sized.filter(F.col("copies") > MANY)
    return spans, ready


def repeated_spans(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(t1, t2, spans): sorted maximal runs of repeated bytes, of the texts
    that have any; ``texts`` has (id, t1, t2, text), ``rows`` the same without text."""
    found = stored(anchor_rows(texts.select("t1", "t2", "text").filter(F.octet_length("text") >= LENGTH)), "anchors")
    place = F.xxhash64("t1", "t2", "lo")
    total = found.count()
    stats = stored(found.groupBy("fp").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("p"), F.max(place).alias("q"), F.min("s1").alias("x"),
                                           F.max("s1").alias("y"))
                   .filter("p != q").select("fp", "copies", (F.col("x") != F.col("y")).alias("mixed")), "anchor-counts")
    again = keyed(found, stats, ["fp"], total).drop("copies")
    again = stored(again.dropDuplicates(["fp", "t1", "t2", "lo"]), "anchors-again")
    whole = again.filter("not mixed").select("t1", "t2", F.col("lo").alias("start"), F.col("hi").alias("end"))
    mixed = again.filter("mixed")
    segments = stored(mixed.groupBy("fp", "s1", "s2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "lo", "hi")).alias("at")), "segments")
    several = (keyed(mixed, segments.filter("n > 1").select("fp", "s1", "s2", F.col("n").alias("copies")), ["fp", "s1", "s2"], total)
               .select("t1", "t2", F.col("lo").alias("start"), F.col("hi").alias("end")))
    many = segments.groupBy("fp").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > MANY).withColumn("many", F.lit(True))
    wanted = keyed(segments, stored(many, "crowded"), ["fp"], total, "left").select("at.t1", "at.t2", "fp", "at.lo", "at.hi", (F.col("n") == 1).alias("single"),
                                                      F.coalesce("many", F.lit(False)).alias("many"))
    first = rows.groupBy("t1", "t2").agg(F.min("id").alias("first"))  # of equal texts, one is read
    parts = stored(_contents(texts, wanted, first), "segment-bytes")
    spans, ready = _split(parts.filter("many"))
    parts = reduce(DataFrame.unionByName, ready, parts.filter("not many").drop("many"))
    size = parts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    spans = reduce(DataFrame.unionByName, [whole, several, *spans], _indexed(parts, max(1, -(-size // INDEX_BYTES))))
    return spans.groupBy("t1", "t2").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the (sorted) spans, and the number of maximal runs removed."""
    out, at, runs = [], -1, 0
    for start, end in spans:
        if start > at:  # spans that touch are one run
            out.append(raw[max(at, 0):start])
            runs += 1
        at = max(at, end)
    return b"".join([*out, raw[max(at, 0):]]), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept
    bytes) per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    rows = stored(texts.select("id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    copies = rows.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"))
    spans = stored(repeated_spans(texts, rows), "spans")
    names = ["t1", "t2", "n_removed", "n_spans", "kept_sha", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, found in zip(b.column(2), b.column(3)):
                raw = t.as_py().encode()
                kept, runs = _cut(raw, [(x["start"], x["end"]) for x in found.as_py()])
                out.append((len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    # a text that occurs once and has repeated parts is read again; copies go whole, the others stay whole
    alone = spans.join(copies.filter("copies = 1").select("t1", "t2"), ["t1", "t2"])
    partly = texts.join(alone, ["t1", "t2"]).select("t1", "t2", "text", "spans").mapInArrow(
        run, "t1 long, t2 long, n_removed long, n_spans long, kept_sha string, kept binary")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    out = rows.join(copies, ["t1", "t2"]).join(stored(partly, "partly"), ["t1", "t2"], "left").select(
        "id", "t1", "t2", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copied, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(copied, none).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"), "kept")
    if not with_kept:
        return out.drop("t1", "t2", "kept")
    untouched = texts.select("t1", "t2", F.encode("text", "utf-8").alias("whole")).dropDuplicates(["t1", "t2"])
    return out.join(untouched, ["t1", "t2"]).select(
        "id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
        F.when(F.col("n_removed") == 0, F.col("whole")).otherwise(F.coalesce("kept", F.lit(b""))).alias("kept"))


def op2_run_index_repeats(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
