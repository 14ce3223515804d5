import collections
import random
import re

import numpy as np
from cases import SMOKE, awkward, empty, smoke_texts

from benchtrail.llm import jaccard_join as J
from benchtrail.llm.components import components
from benchtrail.llm.shingles import mix, shingle_set


def brute(docs):
    """Component (smallest position) of each text, from sets of word tuples."""
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def shingles(text):
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, parent = [shingles(t) for t in docs], list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        shared = collections.Counter()
        for x in s:
            shared.update(holders[x])
            holders[x].append(i)
        for k, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[k]) - n):
                a, b = find(i), find(k)
                parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(docs))]


def test_similar_sets_share_a_signature_whatever_is_frequent():
    rng = np.random.default_rng(7)
    for trial in range(700):
        n = int(rng.choice([3, 4, 5, 6, 7, 9, 10, 13, 14, 20, 46, 47, 100, 153, 300, 700]))
        pool = mix(rng.integers(1, 2**62, 3 * n + 10).astype(np.uint64))
        a = pool[:n]
        drop = int(rng.integers(0, n // 4 + 1))
        add = int(rng.integers(0, n // 3 + 1))
        b = np.concatenate([a[drop:], pool[n:n + add]])
        a, b = np.sort(a), np.sort(b)
        inter = len(np.intersect1d(a, b))
        if not len(b) or 100 * inter < 75 * (len(a) + len(b) - inter) or len(a) == len(b) == inter:
            continue
        frequent = np.sort(rng.choice(pool, int(len(pool) * rng.choice([0, 0.1, 0.3, 0.7, 1.0])), replace=False))
        assert len(np.intersect1d(J.signatures(a, frequent)[0], J.signatures(b, frequent)[0])) > min(J.signatures(a, frequent)[1], J.signatures(b, frequent)[1]), (n, drop, add)


def test_parities_never_refuse_similar_sets():
    rng = np.random.default_rng(3)
    refused = 0
    for trial in range(600):
        n = int(rng.integers(1, 900))
        pool = mix(rng.integers(1, 2**62, 2 * n + 5).astype(np.uint64))
        a, b = np.unique(pool[:n]), np.unique(pool[int(rng.integers(0, n // 2 + 1)):n + int(rng.integers(0, n // 3 + 1))])
        inter = len(np.intersect1d(a, b))
        may = J._may_be_similar(J.parity_bits(a), J.parity_bits(b), len(a), len(b))
        if 100 * inter >= 75 * (len(a) + len(b) - inter):
            assert may
        refused += not may
    assert refused > 100


def test_pair_at_the_threshold_links():
    assert J.differ(4, 4) == 1 and J.differ(7, 7) == 2
    for k in range(len(J.EDGES) - 2):  # similar sets lie in the same or in neighbouring bands
        assert (J.EDGES[k + 1] - 1) * J.DEN // J.NUM < J.EDGES[k + 2]


def test_op1_matches_brute_force_on_smoke_documents(spark):
    docs = smoke_texts()
    sizes, comps = brute([t for _, t in docs])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op1_segment_join(spark, SMOKE).collect()}
    assert got == {d: (n, docs[c][0]) for (d, _), n, c in zip(docs, sizes, comps)}


def test_families_passages_and_frequent_tokens(spark):
    """Chains of near copies, large groups, and a passage in all documents."""
    r = random.Random(11)
    passage = [f"p{i}" for i in range(25)]
    texts = []
    for family in range(12):
        base = [f"f{family}_{r.randrange(10**6)}" for _ in range(r.choice([8, 30, 120, 400]))]
        for copy in range(r.choice([2, 3, 9, 25])):
            w = list(base)
            for _ in range(max(1, len(w) // r.choice([15, 25, 60]))):
                w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(w + passage if family % 2 else passage + w))
            if copy % 3 == 0:
                base = w  # drift: the ends of the chain needn't be similar
    sizes, comps = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {x.id: x.component for x in J.similarity_components(df).collect()}
    assert got == dict(enumerate(comps))
    assert len(set(comps)) < len(texts) / 2


def test_awkward_rows_and_one_per_group(spark):
    df = awkward(spark)
    found = J.similarity_components(df).collect()
    by = collections.defaultdict(set)
    for x in found:
        by[x.id].add((x.n, x.component))
    assert by[2] == {(by[1].copy().pop()[0], 1)} and {c for _, c in by[3]} == {1} and {c for _, c in by[4]} == {4}
    assert by[5] == {(0, 5)} and by[7] == {(0, 7)} and by[9] == {(1, 8)} and by[10] == {(1, 10)}
    assert {c for _, c in by[None]} == {1, None}
    kept = J.one_per_group(df)
    assert kept.columns == df.columns
    ids = sorted((x.doc_id is None, x.doc_id or 0) for x in kept.select("doc_id").collect())
    assert ids == [(False, i) for i in (1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15)] + [(True, 0)]
    assert J.one_per_group(empty(spark)).count() == 0 and J.similarity_components(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_shingles_of_short_texts():
    assert [len(shingle_set(t)) for t in (None, "", " ", "a", "a b c d", "a b c d e", "a a a a a a a")] == [0, 0, 0, 1, 1, 1, 1]
    assert (shingle_set("A É") == shingle_set("a É")).all() and (shingle_set("É") != shingle_set("é")).all()


def test_open_groups_in_blocks(spark, monkeypatch):
    """Families of one base that drift apart: signatures stay shared, components differ."""
    monkeypatch.setattr(J, "BLOCK", 7)
    r = random.Random(23)
    texts = []
    for _ in range(4):
        base = [f"b{r.randrange(10**6)}" for _ in range(90)]
        for _ in range(22):
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(90)] = f"e{r.randrange(10**6)}"
            texts.append(" ".join(w))
    _, comps = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {x.id: x.component for x in J.similarity_components(df).collect()} == dict(enumerate(comps))
    assert 4 < len(set(comps)) < 60


def test_unsafe_sets_meet_safe_ones_of_their_open_signatures(spark, monkeypatch):
    """Sets of 10 and 13 (Jaccard 10/13): the one that stops at level 0 is unsafe, the one that goes on counts as safe."""
    rng = np.random.default_rng(5)
    found = []
    while len(found) < 3:
        pool = mix(rng.integers(1, 2**62, 13).astype(np.uint64))
        x, y = np.sort(pool), np.sort(pool[:10])
        frequent = np.sort(rng.choice(pool, int(rng.integers(1, 9)), replace=False))
        (s, spare), (t, other) = J.signatures(x, frequent), J.signatures(y, frequent)
        shared = np.intersect1d(s, t).view(np.int64)
        if other < len(shared) <= spare:
            found.append((x, y, shared, spare, other))
    rows, firsts, want = [], [], set()
    for k, (x, y, shared, spare, other) in enumerate(found):
        a, b = 10 * k + 1, 10 * k + 2
        want.add((a, b))
        firsts += [(u, len(z), bytearray(J.parity_bits(z))) for u, z in ((a, x), (b, y))]
        rows += [(int(sig), u, u, slack) for sig in shared for u, slack in ((a, spare), (b, other))]
    open_ = spark.createDataFrame(rows, "sig long, u long, root long, slack long")
    firsts = spark.createDataFrame(firsts, "u long, n long, bits binary")
    for block in (J.BLOCK, 1):
        monkeypatch.setattr(J, "BLOCK", block)
        rest = J.unfinished(open_)
        assert {r.u for r in rest.filter("unsafe").collect()} == {b for _, b in want}
        assert {tuple(p) for p in J.across_roots(rest, firsts).collect()} == want
