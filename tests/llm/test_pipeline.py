"""The pipeline's rows against the same stages by brute force."""

import duckdb
import pandas as pd
import zstandard
from cases import SMOKE, awkward, empty
from test_jaccard import brute
from test_rows import check_packing

import corpus_pipeline
from benchtrail.llm import mixing, quality_rules, secret_scan


def expected_texts():
    docs = duckdb.sql(f"select doc_id, text, source from read_parquet('{SMOKE}/documents.parquet') order by doc_id").fetchall()
    codec = zstandard.ZstdCompressor(level=quality_rules.LEVEL)
    docs = [d for d in docs if quality_rules.measure(d[1], codec)[-1]]
    _, components = brute([t for _, t, _ in docs])
    docs = [(i, secret_scan.redacted(t), s) for k, (i, t, s) in enumerate(docs) if components[k] == k]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "source"]))
    times = {r[0]: r[4] // r[1] for r in con.execute(mixing.OP4_SQL).fetchall()}
    return [(i, t) for i, t, _ in docs for _ in range(times[i])]


def test_pipeline_matches_brute_force(spark):
    sequences, least = check_packing(corpus_pipeline.run(spark, SMOKE).collect(), expected_texts())
    assert sequences <= least * 1.05 + 2


def test_stages_keep_the_columns_and_take_awkward_rows(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "secret_scan", "mixing", "packing"]
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMOKE)
            assert out.columns == docs.columns or name == "packing"
            out.count()
