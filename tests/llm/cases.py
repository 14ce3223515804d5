"""Small documents that hold the awkward cases, and rows from the test tables."""

import random

import duckdb

SMOKE = "/root/testdata/sf0.001"
#: columns whose names the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, hash long, u long, doc string, `the id` string"


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}x" for _ in range(n)]


def awkward_rows():
    base = words(300, 1)
    near = base[:150] + ["changed"] + base[151:]
    far = base[:200] + words(120, 2)
    texts = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, " \n\t "),
             (8, "one"), (9, "ONE"), (10, "a b c d"), (11, "a b c d e"), (None, " ".join(base)), (None, None), (12, "x" * 50_000),
             (13, " ".join(words(30_000, 3))), (14, "\n".join(["same line here"] * 40)), (1, " ".join(base)), (15, " ".join(words(80, 4)))]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 1, 2, 3, "d", "x") for k, (i, t) in enumerate(texts)]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def smoke_texts(sf=SMOKE):
    return duckdb.sql(f"select doc_id, text from read_parquet('{sf}/documents.parquet') order by doc_id").fetchall()


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
