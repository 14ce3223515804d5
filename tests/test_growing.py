"""Logs that grow and compaction: equal to one batch, whole after a loss, bounded."""

import os
import random

import pytest
from pyspark.sql import functions as F

from benchtrail.sources import logs as L
from benchtrail.streaming import growing as G


def report(seed, n):
    r = random.Random(seed)
    out = ["preamble é"]
    for i in range(n):
        out += [f"Node Name        : node_{i}"] + [f"{k:17s}: {r.randint(1, 999)} cycles" for k in ("Total", "Max", "Min", "Avg")] + ["Number of Calls  : 3"][: r.randint(0, 1)]
        out += ["noise"] * r.randint(0, 3)
    return out


def grow(folder, texts, cuts):
    """Write the next piece of every text; cuts are in bytes and fall anywhere."""
    for name, (data, low, high) in zip(texts, cuts):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "ab") as f:
            f.write(data[low:high])


def opens():
    return F.col("line").startswith("Node Name")


def parse(lines):
    return L.parse_profile_report(lines)


def whole(spark, folder):
    lines = L.read_log_lines(spark, folder, "*.log")
    return sorted(map(tuple, parse(lines).drop("file").withColumn("f", F.lit(0)).collect()), key=repr), lines


@pytest.mark.parametrize("split", [64 << 20, 37])
def test_log_appended_in_pieces_equals_one_scan(spark, tmp_dir, split):
    data = {"a.log": "\n".join(report(1, 9)).encode(), "sub/b.log": ("\r\n".join(report(2, 5)) + "\r\n").encode(), "c.log": b""}
    folder, state = f"{tmp_dir}/logs", f"{tmp_dir}/state"
    r = random.Random(3)
    edges = {n: [0, *sorted(r.sample(range(len(d)), 2)), len(d)] if len(d) > 2 else [0, 0, 0, len(d)] for n, d in data.items()}
    logs = G.GrowingLogs(spark, folder, state, split=split)
    for step in range(3):
        grow(folder, data, [(data[n], edges[n][step], edges[n][step + 1]) for n in data])
        assert logs.take(parse, opens(), final=step == 2) == step + 1
        taken = {os.path.basename(x.file): (x.bytes, x.lines) for x in logs.ledger().collect()}
        for n, d in data.items():
            part = d[:edges[n][step + 1]]
            end = part.rfind(b"\n") + 1 if step < 2 else len(part)
            assert taken.get(os.path.basename(n), (0, 0)) == (end, part[:end].count(b"\n") + (step == 2 and not part.endswith(b"\n") and bool(part)))
    expected, lines = whole(spark, folder)
    assert sorted(map(tuple, logs.rows().drop("file").select("node_ix", "name", "total", "max", "min", "avg", "num_calls").withColumn("f", F.lit(0)).collect()), key=repr) == expected
    logs.take(parse, opens())  # nothing new
    assert logs.rows().count() == len(expected)


def test_lost_batch_is_done_anew_and_shrunk_log_is_an_error(spark, tmp_dir, monkeypatch):
    folder, state = f"{tmp_dir}/logs", f"{tmp_dir}/state"
    text = ("\n".join(report(4, 4)) + "\n").encode()
    logs = G.GrowingLogs(spark, folder, state)
    grow(folder, ["a.log"], [(text, 0, 200)])
    logs.take(parse, opens())
    grow(folder, ["a.log"], [(text, 200, len(text))])
    commit = G.VersionLog.commit
    monkeypatch.setattr(G.VersionLog, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        logs.take(parse, opens())
    monkeypatch.setattr(G.VersionLog, "commit", commit)
    assert logs.ledger().first().bytes == text[:200].rfind(b"\n") + 1
    logs.take(parse, opens())
    assert logs.rows().count() == 4
    with open(f"{folder}/a.log", "wb") as f:
        f.write(text[:50])
    with pytest.raises(ValueError):
        logs.take(parse, opens())


def test_compaction_keeps_the_newest_and_bounds_what_is_read(spark, tmp_dir, monkeypatch):
    store = G.Compacted(spark, f"{tmp_dir}/c", ["k"], every=3)
    want = {}
    for batch in range(9):
        rows = [(k, f"{batch}") for k in range(batch % 3, 9, 3)]
        want.update(dict(rows))
        store.add(spark.createDataFrame(rows, "k int, v string"), batch)
        assert len(store.paths()) <= 3
    assert dict(map(tuple, store.read().collect())) == want
    store.add(spark.createDataFrame([(0, "replayed")], "k int, v string"), 8)
    assert dict(map(tuple, store.read().collect())) == want
    commit = G.VersionLog.commit
    monkeypatch.setattr(G.VersionLog, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the switch")))
    for batch in (9, 10):
        with pytest.raises(RuntimeError):
            store.add(spark.createDataFrame([(0, f"{batch}")], "k int, v string"), batch)
    monkeypatch.setattr(G.VersionLog, "commit", commit)
    assert dict(map(tuple, store.read().collect())) == want
    store.add(spark.createDataFrame([(0, "20")], "k int, v string"), 9)
    assert dict(map(tuple, store.read().collect())) == want | {0: "20"}


def test_small_logs_are_read_by_few_tasks(spark, tmp_dir):
    grow(f"{tmp_dir}/logs", names := [f"{i}.log" for i in range(60)], [(b"Node Name        : n\n", 0, 21)] * len(names))
    logs = G.GrowingLogs(spark, f"{tmp_dir}/logs", f"{tmp_dir}/state")
    lines, _ = logs.new_lines()
    assert lines.count() == 60 and logs.take(parse, opens()) == 1 and logs.rows().count() == 60
    import glob
    written = glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/new-lines-*/part-*")
    newest = max({os.path.dirname(x) for x in written}, key=os.path.getmtime)
    assert sum(os.path.dirname(x) == newest for x in written) <= spark.sparkContext.defaultParallelism
