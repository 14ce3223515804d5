"""Best-fit packing of token sequences by hierarchical residual packing.

Documents become token ids; what is longer than a sequence is cut into whole
sequences, the remainder first. Pieces shorter than a sequence are packed up a
tree. At its leaves every partition packs its pieces best-fit (longest first,
into the bin they fill up most) and emits the bins that are nearly full, or too full
for the shortest bin that is left anywhere. An underfull bin goes on as one item
of its fill. A level up, the bins of ``FAN`` neighbouring groups are packed best-fit
again, as items, and so on until one group is left, which emits every bin. A piece's
place is found at the end, from the top down: the offsets of the bins that it lies in add up.

A task holds at most ``TASK_PIECES`` slim rows (never texts or ids) at a time;
a larger group is packed in runs of that many.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no sequence; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, stored

VOCABULARY = "byte_bpe_50k.tiktoken"
#: the same vocabulary for the tokenizers library, with its added tokens
ADDED = "byte_bpe_50k.json"
LENGTH = 1024
END_ID = 2
#: a bin with at most this share unused is emitted in any round
SLACK = 1 / 128
TASK_PIECES = 250_000
#: groups that make one a level up
FAN = 8
#: characters that are encoded at a time
RUN_CHARS = 8_000_000


class Encoder:
    """Ids of texts.

    Between two characters that are no white space, the vocabulary always cuts
    before a space. So the ids of a text are those of its words, each with the
    space before it. The distinct words of a run of texts are encoded in one
    call, told apart by the ids that begin with a space, and dealt out.

    ``added`` are tokens with ids of their own: a text that holds one is cut
    there first, and encoded alone.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocabulary = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added or {})
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[i for token, i in ranks.items() if token[:1] == b" "]] = True

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.vocabulary.encode_ordinary(text), "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.added:
            return self._encode(texts)
        holds = [self.added.search(t) is not None for t in texts]
        rest = iter(self._encode([t for t, h in zip(texts, holds) if not h]))
        return [np.asarray(self.vocabulary.encode(t, allowed_special="all"), "<u4") if h else next(rest) for t, h in zip(texts, holds)]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        ends = np.asarray(split.offsets)
        coded = split.flatten().dictionary_encode()
        words, word = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
        alone = np.array([bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words], bool)
        ids = self._whole(" " + " ".join(compress(words, alone)) if alone.any() else "")
        at = np.append(np.flatnonzero(self.opens[ids]), len(ids))
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[alone], size[alone] = at[:-1], np.diff(at)
        is_first = np.zeros(len(word), bool)
        is_first[ends[:-1]] = True  # the first word of a text has no space before it
        sizes = np.where(is_first, 0, size[word])
        upto = np.append(0, np.cumsum(sizes))
        flat = ids[np.repeat(start[word] - upto[:-1], sizes) + np.arange(upto[-1])]
        odd = np.append(0, np.cumsum(~alone[word] & ~is_first))
        out = []
        for text, x, y in zip(texts, ends.tolist(), ends[1:].tolist()):
            first = words[word[x]]
            if odd[y] > odd[x] or first[-1:].isspace():
                out.append(self._whole(text))
            else:
                out.append(np.concatenate([self._whole(first), flat[upto[x]:upto[y]]]))
        return out


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens of a JSON file of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                 length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 and, if asked for, ids as bytes):
    one row per piece. ``vocabulary`` is a file of ranks that workers can read; by default the
    byte-level one of the installed package, whose ids are those of its JSON
    form for the tokenizers library (which is several times slower), added tokens included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary) if vocabulary else Encoder(public_tokenizers.path(VOCABULARY), added_tokens(public_tokenizers.path(ADDED)))
        for b in batches:
            for at, texts in _runs(b.column(1)):
                rows = []
                for k, raw in enumerate(encoder.encode(texts)):
                    raw = np.append(raw, np.uint32(end_id)).astype("<u4").tobytes()
                    n = len(raw) // 4
                    cuts = [0, *range(n % length or length, n + 1, length)]
                    for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        ids = raw[4 * x:4 * y]
                        rows.append((at + k, i, x, y - x, zlib.crc32(ids), ids if with_ids else None))
                cols = list(zip(*rows))
                out = [b.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
                yield pa.RecordBatch.from_arrays(out + [pa.array(cols[5], pa.binary())] * with_ids, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of about RUN_CHARS characters: (position of the first, texts)."""
    at, run, chars = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t.as_py())
        chars += len(run[-1])
        if chars >= RUN_CHARS:
            yield at, run
            at, run, chars = i + 1, [], 0
    if run:
        yield at, run


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bins by best fit in the given order: (bin, offset) per length, room left per bin.

    Bins wait in a stack for each room; a bit mask of the rooms that have one
    gives the smallest that fits.
    """
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins, offsets, room = 0, [], [], []
    for n in lengths:
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = waiting[r].pop()
            if not waiting[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins.append(b)
        offsets.append(capacity - r)
        room[b] = r - n
        if r > n:
            waiting[r - n].append(b)
            mask |= 1 << (r - n)
    return bins, offsets, room


def _level(items: DataFrame, keys: list[str], level: int, last: bool, length: int) -> DataFrame:
    """``keys`` of the items with bin, offset, fill, open (goes on as an item) and group. At level 0 a
    group is a partition; above, rows come sorted by their group."""
    order = ["length", *(["ids_crc32", "doc_id", "piece"] if level == 0 else ["item"])]

    def pack(frame: pd.DataFrame, group: int, first: int) -> tuple[pd.DataFrame, int]:
        frame = frame.sort_values(order, ascending=[False] + [True] * (len(order) - 1), kind="stable")
        bins, offsets, room = best_fit(frame["length"].tolist(), length)
        left = np.asarray(room, np.int64)[bins]
        frame = frame[keys].assign(bin=first + np.asarray(bins, np.int64), offset=np.asarray(offsets, np.int64), fill=length - left,
                                   open=(not last) & (left > SLACK * length), group=group)
        return frame, first + len(room)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, first, held, n = TaskContext.get().partitionId(), None, [], 0
        for frame in frames:
            for g, part in [(group, frame)] if level == 0 else frame.groupby("group", sort=False):
                if n and (g != group or n >= TASK_PIECES):
                    out, first = pack(pd.concat(held), group, first)
                    held, n = [], 0
                    yield out
                if first is None or g != group:
                    group, first = g, (level << 58) + (int(g) << 36)
                held.append(part)
                n += len(part)
        if n:
            yield pack(pd.concat(held), group, first)[0]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema if f.name in keys)
    return items.mapInPandas(run, f"{schema}, bin long, offset long, fill long, open boolean, group long")


def _open_bins(packed: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(item, length, group) of the bins that go on. One without room for the shortest of them stays as it is."""
    bins = stored(packed.filter("open").groupBy(F.col("bin").alias("item")).agg(F.max("fill").alias("length"), F.max("group").alias("group")), name)
    return bins, bins.agg(F.min("length")).first()[0] or 0


def pack_pieces(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset. Every level is stored, so a lost
    executor cannot change what earlier levels placed."""
    pieces = stored(pieces, "pieces")
    groups, keys = pieces.rdd.getNumPartitions(), pieces.columns
    packed = stored(_level(pieces, keys, 0, groups == 1 and pieces.count() <= TASK_PIECES, length), "packed")
    below, levels, level = packed, [], 0
    while True:
        items, shortest = _open_bins(below, "bins")
        items = items.filter(F.col("length") + shortest <= length)
        if items.isEmpty():
            break
        groups, level = -(-groups // FAN), level + 1
        items = items.withColumn("group", F.expr(f"group div {FAN}"))
        grouped = items.repartition(groups, "group").sortWithinPartitions("group")
        below = stored(_level(grouped, ["item"], level, groups == 1, length), "level")
        levels.append(below.select("item", "bin", "offset"))
        if groups == 1:
            break
    if not levels:
        return packed.select(*keys, F.col("bin").alias("sequence_id"), "offset")
    place = levels.pop()  # (item, bin, offset): where a bin ends up, from the top down
    while levels:
        up = place.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_offset"))
        place = stored(levels.pop().join(up, "bin", "left").select("item", F.coalesce("_bin", "bin").alias("bin"),
                                                                  (F.col("offset") + F.coalesce("_offset", F.lit(0))).alias("offset")), "places")
    up = place.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_offset"))
    moved = packed.filter("open").join(up, "bin", "left")
    moved = moved.select(*keys, F.coalesce("_bin", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("_offset", F.lit(0))).alias("offset"))
    return packed.filter("not open").select(*keys, F.col("bin").alias("sequence_id"), "offset").unionByName(moved)


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Encode, cut and pack: one row per piece with its place."""
    return pack_pieces(token_pieces(docs, **options), options.get("length", LENGTH))


def op7_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))
