"""Language identification in two steps: family, then language.

A text is a vector of hashed letter 1- to 3-grams. Linear support vector
machines, one for each pair of families, vote on the family; then those for
each pair of languages of that family vote on the language, so close
languages are only ever told apart from each other. The score is the product
of the two steps' mean votes.

Labels are learned from about ``SAMPLE`` rows (twice as many at most), those
of the smallest hashes, balanced over the languages; a larger table changes
which rows, not how many. Of more than ``MAX_LANGUAGES`` languages the most
frequent are learned, ties by code.

Defined results: a null text, or one without a letter, is ``und`` with score
0, as is every text if nothing could be learned; repeated rows get equal
predictions; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents, fold

DIMS = 4096
#: bound of the rows that are fitted, and of the languages they are balanced over
SAMPLE = 4000
MAX_LANGUAGES = 200
ROUNDS, PENALTY = 300, 1e-3
#: fixed values: families of language codes; a code that isn't listed is a family of its own
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nds nl nn no sv yi",
    "romance": "ast ca es fr gl it la lmo oc pt ro sc scn vec wa",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "turkic": "az kk ky tr tt ug uz",
    "uralic": "et fi hu",
    "sinitic": "wuu yue zh",
}
UNKNOWN = "und"
LETTERS = np.full(256, 32, np.uint8)
for _c in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    LETTERS[_c] = _c


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


def features(text: str) -> np.ndarray | None:
    """Square roots of hashed n-gram counts, of length 1; None without a letter."""
    if not any(map(str.isalpha, text)):
        return None
    b = LETTERS[np.frombuffer(f" {text.lower()} ".encode(errors="replace"), np.uint8)].astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:] + np.uint32(1 << 24)
    grams = np.concatenate([b, two, three]) * np.uint32(2654435761) >> np.uint32(20)
    v = np.sqrt(np.bincount(grams, minlength=DIMS).astype(np.float32))
    return v / np.linalg.norm(v)


class Vote:
    """One-versus-one linear support vector machines over some classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.classes = sorted(set(y.tolist()))
        self.pairs = list(combinations(range(len(self.classes)), 2))
        fits = []
        for i, j in self.pairs:
            a, b = x[y == self.classes[i]], x[y == self.classes[j]]
            fits.append(svm(np.concatenate([a, b]), np.concatenate([np.ones(len(a)), -np.ones(len(b))])))
        self.weights = np.array(fits, np.float32).reshape(len(self.pairs), x.shape[1])

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the class, mean vote for it) per row."""
        if len(self.classes) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        votes = np.zeros((len(x), len(self.classes)))
        for (i, j), m in zip(self.pairs, (x @ self.weights.T).T.astype(float)):
            p = 1 / (1 + np.exp(-np.clip(4 * m, -30, 30)))
            votes[:, i] += p
            votes[:, j] += 1 - p
        best = votes.argmax(axis=1)
        return best, votes[np.arange(len(x)), best] / (len(self.classes) - 1)


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine, by subgradients over all rows; both classes weigh the same."""
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, ROUNDS + 1):
        wrong = y * (x @ w) < 1
        w = (1 - 1 / t) * w + ((cost * y)[wrong] @ x[wrong]) / (PENALTY * t)
        if t > ROUNDS // 2:
            mean += w
    return mean / (ROUNDS - ROUNDS // 2)


class Model:
    def __init__(self, x: np.ndarray, langs: np.ndarray):
        family = np.array([family_of(v) for v in langs.tolist()], object)
        self.family = Vote(x, family)
        self.within = [Vote(x[family == f], langs[family == f]) for f in self.family.classes]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        best, score = self.family(x)
        out = np.empty(len(x), object)
        for f, vote in enumerate(self.within):
            rows = np.flatnonzero(best == f)
            if len(rows):
                k, s = vote(x[rows])
                out[rows] = [vote.classes[i] for i in k]
                score[rows] *= s
        return out.tolist(), score


def learn(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model | None:
    """Fit on a bounded, balanced sample of the rows with a language."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       (F.xxhash64(F.col(id_col), F.col(text_col)).bitwiseAND(F.lit(2**40 - 1)) / 2.0**40).alias("turn"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return None
    each = SAMPLE // len(counts)
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(*r, v.astype(np.float16).tobytes()) for r in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(1))
                     if (v := features(r[2].as_py())) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.float64()),
                                              pa.array([r[3] for r in found], pa.binary())], ["lang", "turn", "v"])

    sample = (rows.withColumn("turn", F.col("turn") / share[F.col("lang")]).filter("turn < 1").mapInArrow(run, "lang string, turn double, v binary")
              .orderBy("turn", "lang", "v").limit(2 * SAMPLE).collect())  # the shares give about SAMPLE rows
    if not sample:
        return None
    sample.sort(key=lambda r: (r.lang, r.turn, r.v))
    x = np.array([np.frombuffer(r.v, np.float16) for r in sample], np.float32)
    return Model(x, np.array([r.lang for r in sample], object))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                vectors = [None if model is None or not t.is_valid else features(t.as_py()) for t in b.column(1)]
                rows = [i for i, v in enumerate(vectors) if v is not None]
                lang, score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
                if rows:
                    found, score[rows] = model.predict(np.array([vectors[i] for i in rows]))
                    for i, v in zip(rows, found):
                        lang[i] = v
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")


def op9_family_then_pairs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = learn(docs.filter(fold(F.col("doc_id"), 5) != 0), "doc_id", "text", "lang")
    out = identify(docs, model)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "lang_pred", "score")
