"""N-gram Jaccard join by universe partition and pigeonhole.

Two sets of sizes a and b that are similar enough differ in at most
H(a, b) tokens. A size band fixes a number of segments, and tokens are hashed
into segments. If there are more than H segments, one of them is the same in
both sets; if there are more than H / 2, one of them differs by at most one
token. So sets that agree on a segment, or on a segment less one token
(the one-deletion neighbourhood), are candidates.

What is indexed is allocated by its cost. Segments that are empty or hold only
tokens frequent in a sample agree far too often and are left out. A set that
keeps enough others is safe with whole segments, the cheap form (one
signature for about three tokens). A set that doesn't, is indexed again at
the next level: larger segments with their one-deletion neighbourhoods, and
at last all tokens, under new hashes, until enough segments count. A pair is
found on the level that satisfies the first of the two, where both are
indexed. The sample thus changes costs, never results.

Signatures are shuffled in packed blocks. Candidates are verified by the exact
intersection of their sets (of 64-bit shingle hashes). Where many sets agree
on a signature, they are compared with one of them only. If that leaves them
in different components, the signature is open: a set that has enough other
signatures does without it, and a set that doesn't is compared with all sets
of its open signatures, in blocks: the other set of a pair may have gone on to
a level where this one has no signatures, so its own spare ones don't tell
about the pair. So no link between components is lost, and groups aren't
expanded into pairs.

Defined results: a null, empty or blank text has an empty set and is linked
with nothing; equal sets are one node (by a 64-bit key); rows of one id are
told apart by their text; a null id is never a component's name unless it has
no other; other columns are ignored (components) or kept (one per group).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, keyed, stored
from benchtrail.llm.components import components
from benchtrail.llm.shingles import mix, set_key, shingle_set

#: similar: DEN * intersection >= NUM * union
NUM, DEN = 75, 100
#: texts sampled for frequent tokens, in how many of them a token is frequent, and how many tokens are kept
SAMPLE, FREQUENT, MAX_FREQUENT = 4000, 8, 100_000
#: up to so many sets of one signature are compared with each other, more with one of them first
SMALL = 4
#: least parity bits of a set, and sets of a cluster that are compared with each other at a time
BITS, BLOCK = 1024, 2048
#: signatures a task packs at a time, tokens of all texts per bucket of signatures, and shuffle partitions for buckets at most
PACK, BUCKET, PARTITIONS = 2_000_000, 2_000_000, 20_000
LOW = np.uint64(2**48 - 1)


def differ(a: int, b: int) -> int:
    """How many tokens similar sets of these sizes differ in at most."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


#: first size of each band; similar sets lie in the same or in neighbouring bands
EDGES = [1]
while EDGES[-1] < 2**40:
    EDGES.append(EDGES[-1] * DEN // NUM + 1)


def _tags(sums: np.ndarray, segment: np.ndarray, scheme: int, level: int) -> np.ndarray:
    return mix(sums * np.uint64(0xD6E8FEB86659FD93) + mix(segment + np.uint64((scheme << 40) + (level << 56))))


def signatures(x: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """All signatures of a set (sorted token hashes), given the sorted frequent
    tokens; and its slack: without that many of them, the others still find
    all similar sets."""
    n, out, slack = len(x), [], 2**31 - 1
    if not n:
        return x, slack
    k = bisect_right(EDGES, n) - 1
    schemes = [(k, differ(n, n * DEN // NUM))]  # the smaller set of a pair names its scheme
    if k and n * NUM <= (EDGES[k] - 1) * DEN:
        schemes.append((k - 1, differ(n, EDGES[k] - 1)))
    weight = mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    rare = np.ones(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
        rare = (frequent[at] != x).astype(np.int64)
    for scheme, most in schemes:
        if not most:  # only equal sets are similar
            continue
        top = EDGES[scheme + 1] - 1
        h = differ(top, top * DEN // NUM)
        for level in count():
            m = (h + 1) * 8 // 7 + 2 if level == 0 else (h // 2 + 1) * 17 // 16 + (h > 3)
            order = np.argsort(y := mix(x + np.uint64(level * 0x632BE59BD9B4E019 % 2**64))) if level else None
            y, z, c = (x, weight, rare) if level == 0 else (y[order], weight[order], rare[order] if level == 1 else np.ones(n, np.int64))
            segment = ((y >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            sums, rares = np.add.reduceat(z, first), np.add.reduceat(c, first)
            out.append(_tags(sums, segment[first], scheme, level)[rares > 0])
            if level:
                back = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
                left = rares[back] - c > 0
                out.append(_tags((sums[back] - z)[left], segment[left], scheme, level))
            # a segment of two rare tokens still has one after a deletion
            spare = int((rares > min(level, 1)).sum()) - (most if level == 0 else most // 2) - 1
            if spare >= 0:
                slack = min(slack, spare)
                break
    return np.unique(np.concatenate(out)) if out else x[:0], slack


def parity_bits(x: np.ndarray) -> bytes:
    """A bit per hash value that tells whether an odd number of tokens has it."""
    size = max(BITS, 1 << int(2 * len(x)).bit_length())
    return np.packbits(np.bincount((x & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def _may_be_similar(p: bytes, q: bytes, n: int, m: int) -> bool:
    """No similar sets are refused: every bit in which two parities differ takes a token that only one set has."""
    a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
    size = min(len(a), len(b))
    odd = np.bitwise_xor.reduce(a.reshape(-1, size), axis=0) ^ np.bitwise_xor.reduce(b.reshape(-1, size), axis=0)
    return min(n, m) * DEN >= NUM * max(n, m) and int(np.bitwise_count(odd).sum()) <= differ(n, m)


def set_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, u, bits) per document: size, key and parities of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = (shingle_set(t.as_py()) for t in b.column(2))
            rows = [(len(s), set_key(s), parity_bits(s)) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.binary())))], ["id", "text_hash", "n", "u", "bits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, text_hash long, n long, u long, bits binary"))


def _sets(texts: DataFrame) -> DataFrame:
    """(u, members) of each text: members are the hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["u", "members"])

    return texts.mapInArrow(run, "u long, members binary")


def frequent_tokens(texts: DataFrame, n: int) -> np.ndarray:
    """Sorted tokens that occur in several of a bounded sample of sets."""
    turn = F.xxhash64("text").bitwiseAND(F.lit(2**40 - 1)) / 2.0**40
    sample = _sets(texts.filter(turn < SAMPLE / max(n, 1))).dropDuplicates(["u"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s.as_py(), np.int64))], ["x"])

    often = sample.mapInArrow(explode, "x long").groupBy("x").count().filter(F.col("count") >= FREQUENT)
    return np.sort(np.array([r.x for r in often.orderBy(F.desc("count"), "x").limit(MAX_FREQUENT).collect()], np.int64).astype(np.uint64))


def _group_starts(sig: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)


def _signature_key(bucket, low: np.ndarray) -> np.ndarray:
    return (low ^ (np.asarray(bucket).astype(np.uint64) << np.uint64(48))).astype(np.int64)


PACKED = "bucket int, low binary, doc binary, keys binary, slack binary, large binary, star binary, members binary"


def packed_signatures(texts: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Blocks of signatures by bucket: the low bits, a position among the block's set keys, and these.

    Where many sets of one pack agree, only the smallest key goes to the
    signature's bucket; the others are compared with it, and travel as members
    of a large signature through any bucket, so no bucket grows with a group.
    """

    def pack(sigs: list, keys: list, slacks: list) -> pa.RecordBatch:
        u = np.repeat(np.array(keys, np.int64), [len(s) for s in sigs])
        order = np.argsort(np.array(keys, np.int64))
        known, spare = np.array(keys, np.int64)[order], np.array(slacks, np.int64)[order]
        sig = np.concatenate(sigs)
        order = np.lexsort((u, sig))
        sig, u = sig[order], u[order]
        first = _group_starts(sig)
        size = np.diff(np.append(first, len(sig)))
        large = np.repeat(size > SMALL, size)
        head = np.zeros(len(sig), bool)
        head[first] = True
        bucket = (((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        low = sig & LOW
        star = np.unique(np.stack([np.repeat(u[first], size)[large & ~head], u[large & ~head]], axis=1), axis=0)
        members = np.stack([_signature_key(bucket, low)[large], u[large], spare[np.searchsorted(known, u[large])]], axis=1)
        ship = ~large | head
        bucket, low, u, flag = bucket[ship], low[ship], u[ship], large[ship]
        rows = []
        at = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(at)):
            i = slice(at[b], at[b + 1])
            names, place = np.unique(u[i], return_inverse=True)
            rows.append((int(b), _six(low[i]), place.astype("<u4" if len(names) > 65535 else "<u2").tobytes(), names.tobytes(),
                         spare[np.searchsorted(known, names)].astype("<i4").tobytes(), low[i][flag[i]].tobytes(), b"", b""))
        through = int(np.uint64(mix(np.array(keys[:1], np.int64).astype(np.uint64))[0]) % np.uint64(buckets))
        for part in range(0, max(len(star), len(members)), 100_000):
            rows.append(((through + part // 100_000) % buckets, b"", b"", b"", b"", b"", star[part:part + 100_000].tobytes(),
                         members[part:part + 100_000].tobytes()))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                          [c.split()[0] for c in PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, keys, slacks, seen, total = [], [], [], set(), 0
        for b in batches:
            for t in b.column(0):
                x = shingle_set(t.as_py())
                key = set_key(x)
                if key in seen:
                    continue
                s, slack = signatures(x, frequent)
                if len(s):
                    seen.add(key)
                    sigs.append(s)
                    keys.append(key)
                    slacks.append(slack)
                    total += len(s)
                if total >= PACK:
                    yield pack(sigs, keys, slacks)
                    sigs, keys, slacks, seen, total = [], [], [], set(), 0
        if sigs:
            yield pack(sigs, keys, slacks)

    return texts.mapInArrow(run, PACKED)


def _six(low: np.ndarray) -> bytes:
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def meet(packed: DataFrame) -> DataFrame:
    """(kind, a, b, slack): candidate pairs (kind 0), and members b of large signatures a (kind 1)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lows, us, slacks, large, pairs, members = [], [], [], [np.zeros(0, np.uint64)], [], []
        for r in rows.itertuples():
            if r.low:
                names, low = np.frombuffer(r.keys, np.int64), _from_six(r.low)
                lows.append(low)
                place = np.frombuffer(r.doc, "<u4" if len(names) > 65535 else "<u2")
                us.append(names[place])
                slacks.append(np.frombuffer(r.slack, "<i4")[place])
                large.append(np.frombuffer(r.large, np.uint64))
            if r.star or r.members:
                pairs.append(np.frombuffer(r.star, np.int64).reshape(-1, 2))
                members.append(np.frombuffer(r.members, np.int64).reshape(-1, 3))
        if lows:
            low, u, spare = np.concatenate(lows), np.concatenate(us), np.concatenate(slacks).astype(np.int64)
            order = np.lexsort((u, low))
            low, u, spare = low[order], u[order], spare[order]
            fresh = np.append(True, (low[1:] != low[:-1]) | (u[1:] != u[:-1]))  # one set may come from several tasks
            low, u, spare = low[fresh], u[fresh], spare[fresh]
            first = _group_starts(low)
            size = np.diff(np.append(first, len(low)))
            big = (size > SMALL) | np.isin(low[first], np.concatenate(large))
            for d in range(1, SMALL):  # small groups: every pair
                near = np.flatnonzero((low[d:] == low[:-d]) & ~np.repeat(big, size)[d:])
                pairs.append(np.stack([u[near], u[near + d]], axis=1))
            tail = np.repeat(big, size)
            members.append(np.stack([_signature_key(np.full(int(tail.sum()), rows["bucket"].iloc[0]), low[tail]), u[tail], spare[tail]], axis=1))
            tail[first] = False
            pairs.append(np.stack([np.repeat(u[first], size)[tail], u[tail]], axis=1))
        found = np.unique(np.sort(np.concatenate(pairs), axis=1), axis=0)
        found = found[found[:, 0] != found[:, 1]]
        member = np.concatenate(members)
        both = np.concatenate([np.insert(found, 2, 0, axis=1), member])
        return pd.DataFrame({"kind": np.repeat([0, 1], [len(found), len(member)]).astype(np.int32),
                             "a": both[:, 0], "b": both[:, 1], "slack": both[:, 2]})

    return packed.groupBy("bucket").applyInPandas(run, "kind int, a long, b long, slack long")


def _checked(pairs: DataFrame, left: DataFrame, right: DataFrame, test) -> DataFrame:
    """The pairs (a, b) that pass ``test`` on the columns that come with a and b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [test(*(c.as_py() for c in row)) for row in zip(*(b.column(i) for i in range(2, b.num_columns)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", *left.columns[1:], *right.columns[1:]).mapInArrow(run, "a long, b long")


def _similar(x: bytes, y: bytes) -> bool:
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    same = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
    return DEN * same >= NUM * (len(p) + len(q) - same)


def verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of keys whose sets are similar: first by sizes and
    parities, a thirtieth of the sets, then by the sets themselves, built anew
    from the texts of what is left."""
    side = lambda x, y: firsts.select(F.col("u").alias(x), *[F.col(c).alias(f"{c}{y}") for c in ("bits", "n")])
    likely = stored(_checked(pairs, side("a", 1), side("b", 2), lambda p, n, q, m: _may_be_similar(p, q, n, m)), "likely")
    keys = likely.select(F.col("a").alias("u")).union(likely.select("b")).distinct()
    first = firsts.join(keys, "u").select(F.col("d.id").alias("first_id"), F.col("d.text_hash").alias("first_hash"))
    wanted = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).join(
        first, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))).select("text")
    sets = stored(_sets(wanted).dropDuplicates(["u"]), "sets")
    members = lambda x, y: sets.select(F.col("u").alias(x), F.col("members").alias(y))
    return stored(_checked(likely, members("a", "x"), members("b", "y"), _similar), "linked")


def links(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) between the keys of different sets that give all components."""
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")).first()
    frequent = frequent_tokens(texts, counts.rows)
    # a bucket fits a task whatever the input; a task takes one bucket after the other
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(counts.tokens or 0) // BUCKET))
    packed = packed_signatures(texts, buckets, frequent).repartition(min(buckets, PARTITIONS), "bucket")
    met = stored(meet(packed), "met")
    pairs = stored(met.filter("kind = 0").select("a", "b").distinct(), "candidates")
    firsts = stored(rows.groupBy("u").agg(F.min(F.struct("id", "text_hash")).alias("d"), F.first("n").alias("n"), F.first("bits").alias("bits")), "firsts")
    linked = verified(pairs, firsts, docs, id_col, text_col)
    # large signatures whose sets are in several components are open. A set that its other
    # signatures suffice for is safe; the others are compared across components
    members = met.filter("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("u"), "slack").distinct()
    rooted = members.join(components(linked).withColumnRenamed("node", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))
    rooted = stored(rooted, "members")
    several = (rooted.groupBy("sig").agg(F.count(F.lit(1)).alias("copies"), F.min("root").alias("lo"), F.max("root").alias("hi"))
               .filter("lo != hi").select("sig", "copies"))
    open_ = stored(keyed(rooted, stored(several, "open-signatures"), ["sig"], rooted.count()).drop("copies"), "open")
    rest = stored(unfinished(open_), "unsafe")
    if rest.isEmpty():
        return linked
    across = across_roots(rest, firsts).join(pairs, ["a", "b"], "left_anti")
    return linked.unionByName(verified(across, firsts, docs, id_col, text_col))


def unfinished(open_: DataFrame) -> DataFrame:
    """(sig, u, root, unsafe): the open signatures (sig, u, root, slack) that an unsafe set has, with all
    their sets. A similar pair is found if the one of its sets that stops at the first level is safe."""
    marks = open_.groupBy("u").agg((F.count(F.lit(1)) > F.min("slack")).alias("unsafe"))
    marked = open_.join(marks, "u")
    return marked.join(marked.filter("unsafe").select("sig").distinct(), "sig").select("sig", "u", "root", "unsafe")


def across_roots(rest: DataFrame, firsts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different roots, one of them unsafe, within the clusters
    that signatures of unsafe sets join (sig, u, root, unsafe), as far as sizes
    and parities allow.

    Sets of one cluster share many signatures, so each cluster is compared
    once, in blocks against blocks, instead of once per signature; only the
    pairs that may be similar leave a task. Safe sets come with every cluster
    that has one of their signatures, in blocks of their own, which are
    compared with the blocks of unsafe sets only.
    """
    needy = rest.filter("unsafe")
    lead = needy.groupBy("sig").agg(F.min("u").alias("b"))
    joined = components(needy.join(lead, "sig").select(F.col("u").alias("a"), "b")).select(F.col("node").alias("b"), F.col("root").alias("cluster"))
    clusters = lead.join(joined, "b", "left").select("sig", F.coalesce("cluster", "b").alias("cluster"))
    slim = stored(rest.join(clusters, "sig").select("cluster", "u", "root", "unsafe").distinct(), "clusters")
    blocks = slim.groupBy("cluster").agg(*[F.ceil(F.count_if(c) / BLOCK).cast("int").alias(k) for k, c in (("first", F.col("unsafe")), ("more", ~F.col("unsafe")))])
    turn = lambda k: F.pmod(F.xxhash64("u"), F.col(k)).cast("int")
    spread = slim.join(firsts.select("u", "n", "bits"), "u").join(blocks, "cluster")
    spread = spread.withColumn("own", F.when(F.col("unsafe"), turn("first")).otherwise(F.col("first") + turn("more")))
    upto = F.when(F.col("unsafe"), F.col("first") + F.col("more")).otherwise(F.col("first"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), upto - 1)))
    spread = spread.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        u, root, n, own = (rows[c].to_numpy() for c in ("u", "root", "n", "own"))
        odd = np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, BITS // 64), axis=0) for b in rows["bits"]])
        signs = 1 - 2 * np.unpackbits(odd.view(np.uint8), axis=1).astype(np.float32)
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        out = [np.zeros((0, 2), np.int64)]
        for at in range(0, len(left), 512):
            few = left[at:at + 512]
            differing = (BITS - signs[few] @ signs[right].T) / 2
            a, b = n[few][:, None], n[right][None]
            may = ((differing <= (a + b) * (DEN - NUM) // (DEN + NUM)) & (np.minimum(a, b) * DEN >= NUM * np.maximum(a, b))
                   & (root[few][:, None] != root[right][None]))
            if i == j:
                may &= u[few][:, None] < u[right][None]
            x, y = np.nonzero(may)
            out.append(np.sort(np.stack([u[few][x], u[right][y]], axis=1), axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    return (spread.select("cluster", "i", "j", "own", "u", "root", "n", "bits").groupBy("cluster", "i", "j")
            .applyInPandas(run, "a long, b long"))


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n, component, first_id, first_hash) per document: the size
    of its set, the smallest id of its component, and the row that stands for it
    (nulls last)."""
    rows = stored(set_rows(docs, id_col, text_col), "set-rows")
    roots = components(links(docs, rows, id_col, text_col))
    key = F.when(F.col("n") > 0, F.coalesce("root", "u"))
    rows = rows.join(roots.withColumnRenamed("node", "u"), "u", "left").withColumn("key", key).select("id", "text_hash", "n", "key")
    rows = stored(rows, "rooted")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    firsts = stored(rows.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), best), "component-firsts")
    return (keyed(rows, firsts, ["key"], rows.count(), "left")
            .select("id", "text_hash", "n", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component"),
                    F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("first_id"),
                    F.when(F.col("key").isNull(), F.col("text_hash")).otherwise(F.col("best.text_hash")).alias("first_hash")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each component; rows without a word all stay."""
    found = similarity_components(docs, id_col, text_col)
    stay = found.filter(F.col("id").eqNullSafe(F.col("first_id")) & F.col("text_hash").eqNullSafe(F.col("first_hash")))
    stay = stay.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("_copies"), F.max("n").alias("_n"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_h"))
    kept = whole.join(stay, F.col("_i").eqNullSafe(F.col("_id")) & F.col("_h").eqNullSafe(F.col("_hash")))
    single = kept.filter("_copies = 1 or _n = 0").select("doc.*")
    repeated = kept.filter("_copies > 1 and _n > 0").dropDuplicates(["_i", "_h"]).select("doc.*")
    return single.unionByName(repeated)


def op1_segment_join(spark, sf_dir):
    found = similarity_components(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
