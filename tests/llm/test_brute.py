"""Verdicts, added spans, language votes and text statistics against plain loops."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import zstandard
from cases import SMOKE, awkward_rows, smoke_texts

from benchtrail.llm import language_id as L
from benchtrail.llm import quality_model as Q
from benchtrail.llm import quality_rules as R
from benchtrail.llm import secret_scan as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ratio(raw):
    return len(zstandard.compress(raw, 3)) / len(raw)


def brute_kept(text):
    """The verdict from the text alone: base rules, band of the whole length, every byte in a judged chunk."""
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return False
    raw = text.encode()
    low, high = next((lo, hi) for at, lo, hi in reversed(R.BANDS) if at <= len(raw))
    if not low <= ratio(raw) <= high:
        return False
    starts = [i for i in range(0, len(raw), R.CHUNK) if i + R.CHUNK <= len(raw)]
    if starts and starts[-1] + R.CHUNK < len(raw):
        starts.append(len(raw) - R.CHUNK)
    outside = [i for i in starts if not R.CHUNK_BAND[0] <= ratio(raw[i:i + R.CHUNK]) <= R.CHUNK_BAND[1]]
    return 4 * len(outside) <= len(starts)


def test_op3_kept_matches_brute_force(spark):
    texts = dict(smoke_texts("/root/testdata/sf0.01"))
    found = R.op3_compression_bands(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.kept for r in found} == {i: brute_kept(t) for i, t in texts.items()}
    assert {r.kept for r in found} == {True, False}


def test_kept_of_awkward_and_mixed_texts():
    codec, r = zstandard.ZstdCompressor(level=R.LEVEL), random.Random(3)
    syllables = [a + b for a in "bcdfghlmnprst" for b in "aeiou"]
    parts = [lambda n: " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n)),
             lambda n: "".join(r.choices("ABCDEFGHabcdefgh0123456789+/é", k=4 * n)), lambda n: "la " * n, lambda n: "\n" * n]
    texts = [t for _, t, *_ in awkward_rows()] + [" ".join(r.choice(parts)(r.randint(1, 900)) for _ in range(r.randint(1, 4))) for _ in range(150)]
    verdicts = [R.measure(t, codec)[-1] for t in texts]
    assert verdicts == [brute_kept(t) for t in texts] and set(verdicts) == {True, False}


# secrets

def base62(n):
    digits = ["0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[n // 62**k % 62] for k in range(5, -1, -1)]
    return "".join(digits)


def brute_added(text):
    out = []
    for kind, prefix in (("github", "gh[pousr]"), ("npm", "npm")):
        for m in re.finditer(f"{prefix}_([0-9A-Za-z]{{36}})(?![0-9A-Za-z])", text or ""):
            if base62(zlib.crc32(m[1][:30].encode())) == m[1][30:]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def added(spans):
    return [(start, kind, end) for start, _, end, kind in spans if kind in ("github", "npm")]


def test_added_spans_match_brute_force(spark):
    r, found = random.Random(5), 0
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for _ in range(3000):
        text = ""
        for _ in range(r.randint(0, 5)):
            body = "".join(r.choices(alphabet, k=30))
            tail = base62(zlib.crc32(body.encode())) if r.random() < 0.7 else "".join(r.choices(alphabet, k=6))
            text += r.choice(["", " ", "token=", "é", "x", "ghp_", "_", "İ"]) + r.choice(["ghp_", "gho_", "ghs_", "npm_", "NPM_", "ghx_"]) + body + tail
            text += r.choice(["", " ", "z", "-", "\n", "_"])
        assert added(S.scan(text)) == brute_added(text), text
        found += len(brute_added(text))
    assert found > 500
    texts = dict(smoke_texts("/root/testdata/sf0.01"))
    for x in S.op10_secret_scan(spark, "/root/testdata/sf0.01").collect():
        spans = [s.split(":") for s in x.spans.split(",") if s]
        assert [(int(a), k, int(b)) for k, a, b in spans if k in ("github", "npm")] == brute_added(texts[x.doc_id])


# languages

def brute_features(text):
    if not any(c.isalpha() for c in text):
        return None
    b = [x if ord("a") <= x <= ord("z") or x > 127 else 32 for x in f" {text.lower()} ".encode(errors="replace")]
    grams = list(b) + [p * 257 + q for p, q in zip(b, b[1:])] + [(p * 257 + q) * 263 + s + 2**24 for p, q, s in zip(b, b[1:], b[2:])]
    counts = Counter((g * 2654435761 % 2**32) >> 20 for g in grams)
    return [math.sqrt(counts[i] / len(grams)) for i in range(L.DIMS)]


def brute_vote(vote, row):
    votes = [0.0] * len(vote.classes)
    for (i, j), w in zip(vote.pairs, vote.weights):
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, 4 * sum(float(a) * float(b) for a, b in zip(w, row) if b)))))
        votes[i] += p
        votes[j] += 1 - p
    best = max(range(len(votes)), key=lambda i: (votes[i], -i))
    return best, votes[best] / (len(votes) - 1) if len(votes) > 1 else 1.0


def test_features_and_votes_match_brute_force():
    texts = ["der und die das", "the and of in", "el de los que", "le et les des", "il di che non", "Łódź, 12!", "", " 1 ", "ÀÉ x"] + [
        t for _, t in smoke_texts()[:20] if t]
    for t in texts:
        want, got = brute_features(t), L.features(t)
        assert (got is None) == (want is None) and (want is None or np.allclose(got, want, atol=1e-6))
    langs = ["de", "en", "es", "fr", "it"]
    x = np.array([L.features(t) for t in texts[:5]] * 3)
    model = L.Model(x, np.array(langs * 3, object))
    asked = np.array([L.features(t) for t in texts if L.features(t) is not None])
    names, scores = model.predict(asked)
    for row, name, score in zip(asked, names, scores):
        f, s = brute_vote(model.family, row)
        vote = model.within[f]
        k, inner = brute_vote(vote, row)
        assert name == vote.classes[k] and abs(score - s * inner) < 1e-5


def test_the_most_frequent_languages_are_learned(spark, monkeypatch):
    rows = [(i, f"{w} number {i}", lang) for i, (lang, w) in enumerate([("de", "der und")] * 6 + [("en", "the of")] * 4 + [("fr", "le et")] * 2 + [("es", "el de")] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most, want in ((2, {"de", "en"}), (3, {"de", "en", "es"}), (9, {"de", "en", "es", "fr"})):
        monkeypatch.setattr(L, "MAX_LANGUAGES", most)
        model = L.learn(df, "doc_id", "text", "lang")
        assert {c for v in model.within for c in v.classes} == want


def test_samples_do_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE", 12)
    monkeypatch.setattr(Q, "SAMPLE", 40)
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    docs = docs.unionByName(docs).unionByName(docs)  # repeated rows
    stats, labels = Q.document_statistics(docs), spark.read.parquet(f"{SMOKE}/labels.parquet")
    models = [L.learn(docs.repartition(n), "doc_id", "text", "lang") for n in (1, 7)]
    assert np.array_equal(models[0].family.weights, models[1].family.weights)
    trees = [Q.learn(stats.repartition(n), labels) for n in (1, 7)]
    assert np.array_equal(trees[0].threshold, trees[1].threshold) and np.array_equal(trees[0].leaf, trees[1].leaf)


# quality statistics

def brute_statistics(text):
    raw = (text or "").encode(errors="replace")
    words = [w.encode() for w in WORD.findall(raw.decode())]
    if not words:
        return [0.0] * len(Q.STATISTICS)
    n, k = len(raw), len(words)
    share = lambda keep: sum(map(keep, raw)) / n
    mean = sum(map(len, words)) / k
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    sign = set(b"#*$%&|<>@^~=_{}[]\\")
    return [math.log(n + 1), math.log(k + 1), mean, math.sqrt(sum((len(w) - mean) ** 2 for w in words) / k), max(map(len, words)),
            len(set(words)) / k, max(Counter(words).values()) / k, sum(a == b for a, b in zip(words, words[1:])) / k,
            share(lambda c: c in sign), share(lambda c: 65 <= c <= 90), share(lambda c: 48 <= c <= 57),
            share(lambda c: c in b".,;:?!'\"()-"), share(lambda c: c == 33), share(lambda c: c == 124), share(lambda c: c in b" \t\n\x0b\x0c\r"),
            share(lambda c: c > 127), -sum(m / n * math.log2(m / n) for m in Counter(raw).values()), len(zlib.compress(raw, 1)) / n,
            math.log(k / len(lines) + 1), 1 - len(set(lines)) / len(lines), sum(chr(x[-1]).isalpha() and x[-1] < 128 for x in lines) / len(lines),
            sum(w[-1] in sign for w in words) / k]


def test_statistics_match_brute_force():
    texts = [t for _, t, *_ in awkward_rows()] + [t for _, t in smoke_texts()] + ["é! |x| <b>\n\nA1 = b_\né! |x|", "?", "a\rb\x0bc\x1cd"]
    for t in texts:
        assert np.allclose(Q.statistics(t), brute_statistics(t), atol=1e-9), t
