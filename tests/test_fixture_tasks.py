"""Windows of the run fixtures: dealt over tasks of bounded size, with the same rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from benchtrail import fixtures as X

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def test_windows_over_runs_sort_bounded_rows(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=17 * (i % 3000)), i * 7 % 900, "ab"[i % 2], i % 50 * 0.5, "{}") for i in range(4000)]
    spark.createDataFrame(rows + rows[:20], SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    for name, lines in (("f1_runs", 4020), ("f2_profile_lines", 6 * 4020)):
        monkeypatch.setattr(X, "TASK_ROWS", 1 << 30)
        left = sorted(map(str, X.fixture(spark, str(tmp_path), name).collect()))
        monkeypatch.setattr(X, "TASK_ROWS", 200)
        dealt = X.fixture(spark, str(tmp_path), name)
        largest = dealt.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert sorted(map(str, dealt.collect())) == left and len(left) == lines
        assert largest < lines / 8
