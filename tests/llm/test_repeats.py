import hashlib
import random

import numpy as np
from cases import SMOKE, awkward, awkward_rows, empty, smoke_texts

from benchtrail.llm import run_index as R


def brute(raws, size=R.LENGTH):
    seen, covered = {}, [np.zeros(len(r), bool) for r in raws]
    for i, r in enumerate(raws):
        for p in range(len(r) - size + 1):
            seen.setdefault(r[p:p + size], []).append((i, p))
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p:p + size] = True
    return covered


def expected(raws):
    out = []
    for raw, c in zip(raws, brute(raws)):
        kept = np.frombuffer(raw, np.uint8)[~c].tobytes()
        out.append((len(raw), int(c.sum()), int((np.diff(c.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got(df, key="id"):
    return {r[key]: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def pieces(r, alphabet, n):
    base = ["".join(r.choices(alphabet, k=r.randint(300, 1400))) for _ in range(4)]
    return ["".join(r.choice(base)[r.randint(0, 200):r.randint(250, 1400)] for _ in range(r.randint(1, 4))) for _ in range(n)]


def test_index_finds_all_repeated_windows():
    r = random.Random(5)
    for alphabet in ("ab", "a", "abcdefgh"):
        for _ in range(6):
            segments = [s.encode() for s in pieces(r, alphabet, 6) if len(s) >= R.LENGTH]
            if segments:
                for raw, starts, c in zip(segments, R.repeated_windows(segments), brute(segments)):
                    mine = np.zeros(len(raw), bool)
                    for x, y in R.spans_of(starts):
                        mine[x:y] = True
                    assert (mine == c).all()


def test_index_is_sampled_at_the_ends_of_runs():
    text = np.frombuffer(b"banana" * 200, np.uint8).astype(np.int64)
    index = R.RunIndex(text)
    assert index.runs < 20 and len(index.starts) == len(index.ends) == index.runs
    assert index.matching_statistics()[0] == len(text) - 6


def test_every_window_has_one_anchor_that_its_bytes_decide():
    b = np.frombuffer("".join(random.Random(1).choices("abc ", k=6000)).encode(), np.uint8)
    fp, place, first, last = R.anchors(b)
    assert first[0] == 0 and last[-1] == len(b) - R.LENGTH and (first[1:] == last[:-1] + 1).all()
    assert (place >= last).all() and (place + R.GRAM <= first + R.LENGTH).all()
    again = R.anchors(b[1000:4000])
    assert set(again[0][1:-1].tolist()) <= set(fp.tolist())


def test_op2_matches_brute_force_on_smoke_documents(spark):
    docs = smoke_texts()
    assert got(R.op2_run_index_repeats(spark, SMOKE), "doc_id") == dict(zip((d for d, _ in docs), expected([t.encode() for _, t in docs])))


def test_shared_passages_in_one_index_and_split(spark, monkeypatch):
    r = random.Random(9)
    passage = "".join(r.choices("abcdefg é", k=900))
    texts = ["".join(r.choices("xyz uvw", k=r.randint(0, 700))) + passage[r.randint(0, 60):r.randint(500, 900)] + "".join(r.choices("klm nop", k=300))
             for _ in range(25)] + pieces(r, "abé", 15) + ["é" * 900, "short"]
    want = dict(enumerate(expected([t.encode() for t in texts])))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert got(R.remove_repeats(df)) == want
    monkeypatch.setattr(R, "MANY", 3)
    assert got(R.remove_repeats(df)) == want
    monkeypatch.setattr(R, "MANY", 1)  # down to single windows
    assert got(R.remove_repeats(df)) == want


def test_passage_in_a_third_of_all_texts_splits_at_its_anchors(spark, monkeypatch):
    """Passages below, at and above the length, with other bytes before and after each; and a text that repeats one gram."""
    r = random.Random(31)
    rand = lambda n: "".join(r.choices("qwertzuiop asdfgh", k=n))
    passages = [rand(n) for n in (390, R.LENGTH, 460, 700)]
    texts = [rand(r.randint(0, 500)) + r.choice(passages) + rand(r.randint(0, 500)) if i % 3 == 0 else rand(r.randint(0, 900)) for i in range(150)]
    texts += ["ab" * 700, "ab" * 500 + rand(30), rand(30) + "ab" * 600]
    want = dict(enumerate(expected([t.encode() for t in texts])))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(R, "MANY", 4)
    assert got(R.remove_repeats(df)) == want
    assert sum(x[1] > 0 for x in want.values()) > 30


def test_passages_of_over_50_words_go_by_their_bytes(spark):
    """A shared passage of over 50 words goes if it has a 400-byte string and stays if not; n_bytes tells neither."""
    r = random.Random(41)
    words = lambda n, size: " ".join("".join(r.choices("abcdefghij", k=size)) for _ in range(n))
    passages = [words(60, 4), words(60, 7)]  # 299 and 479 bytes
    texts = [words(40, 5) + f" {p} " + words(k, 5) for p in passages for k in (10, 200)] + [words(150, 5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = got(R.remove_repeats(df))
    assert found == dict(enumerate(expected([t.encode() for t in texts])))
    assert [found[i][0] for i in range(5)] == [len(t) for t in texts]
    assert [found[i][1] > 0 for i in range(5)] == [False, False, True, True, False] and min(found[2][1], found[3][1]) >= 479


def test_halves_hold_every_window_once(spark):
    raw = random.Random(3).randbytes(2000)
    fp, place, first, last = R.anchors(np.frombuffer(raw, np.uint8))
    rows = [(int(a), 0, R.LENGTH - R.GRAM + 1, raw[a:b + R.LENGTH]) for a, b in zip(first, last)]
    for _ in range(10):
        parts = spark.createDataFrame([(0, 0, lo, x, y, True, b) for lo, x, y, b in rows],
                                      "t1 long, t2 long, lo long, x int, y int, single boolean, bytes binary")
        halves = R._halves(parts).collect()
        assert all(bytes(h.bytes) == raw[h.lo:h.hi] for h in halves)
        assert sorted(s for h in halves for s in range(h.lo, h.hi - R.LENGTH + 1)) == sorted(
            s for lo, *_, b in rows for s in range(lo, lo + len(b) - R.LENGTH + 1))
        rows = [(h.lo, h.x, h.y, bytes(h.bytes)) for h in halves if h.y - h.x > 1]
        if not rows:
            break
    assert not rows


def test_awkward_rows(spark):
    texts = [(r[0], r[1]) for r in awkward_rows()]
    want = sorted(((i, *e) for (i, _), e in zip(texts, expected([(t or "").encode() for _, t in texts]))), key=repr)
    found = R.remove_repeats(awkward(spark), with_kept=True).collect()
    assert sorted(((x.id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in found), key=repr) == want
    assert all(hashlib.sha256(bytes(x.kept)).hexdigest() == x.kept_sha256 for x in found)
    assert R.remove_repeats(empty(spark)).count() == 0
