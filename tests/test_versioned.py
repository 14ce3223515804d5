"""Versioned tables: defaults, keys, partial rewrites, lost and competing writers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchtrail.sinks import versioned as V
from benchtrail.sinks import writers as K

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("p", T.StringType()), T.StructField("state", T.StringType()), T.StructField("n", T.LongType())])


def table(spark, root):
    return V.VersionedTable(spark, root, SCHEMA, ["k"], {"state": "new", "n": 3}, "p")


def rows(t, **kw):
    return sorted(map(tuple, t.read(**kw).collect()), key=repr)


def test_defaults_keys_and_versions(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t")
    assert rows(t) == [] and t.directories() == {}
    t.append(spark.createDataFrame([(1, "a", "extra"), (2, None, "extra")], "k long, p string, unknown string"))
    t.append(spark.createDataFrame([(3, "a", 9)], "k long, p string, n long"))
    assert rows(t) == sorted([(1, "a", "new", 3), (2, None, "new", 3), (3, "a", "new", 9)], key=repr)
    for bad in ([(1, "b")], [(7, "b"), (7, "c")]):
        with pytest.raises(V.DuplicateKey):
            t.append(spark.createDataFrame(bad, "k long, p string"))
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("b",)], "p string"))
    assert len(rows(t)) == 3 and rows(t, version=1) == sorted([(1, "a", "new", 3), (2, None, "new", 3)], key=repr)
    assert rows(t, partitions=[None]) == [(2, None, "new", 3)] and rows(t, partitions=["zz"]) == []


def test_update_rewrites_only_touched_partitions(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t")
    t.append(spark.createDataFrame([(i, p, "x" if i % 2 else None) for i, p in enumerate("aabbc/")], "k long, p string, state string"))
    before = t.directories()
    t.update((F.col("p") == "b") & (F.col("state") == "x"), {"n": F.col("n") + 1, "state": "done"})
    after = t.directories()
    assert {p for p in before if before[p] != after[p]} == {"vb"}
    assert rows(t, partitions=["b"]) == [(2, "b", None, 3), (3, "b", "done", 4)] and rows(t, partitions=["/"]) == [(5, "/", "x", 3)]
    t.update(F.col("n") > 100, {"state": "never"})
    assert t.directories() == after
    with pytest.raises(ValueError):
        t.update(F.lit(True), {"p": "z"})


def test_lost_and_competing_writers(spark, tmp_dir):
    t = table(spark, f"{tmp_dir}/t")
    t.append(spark.createDataFrame([(1, "a")], "k long, p string"))
    t._write(t.shaped(spark.createDataFrame([(2, "a")], "k long, p string")))  # lost before its version was added
    assert rows(t) == [(1, "a", "new", 3)]
    log = t.log
    version, state = log.latest()
    spark.createDataFrame([(version + 1, "", '{"parts": {}}')], V.LOG).write.mode("append").parquet(f"{log.root}/log")  # another writer, smallest token
    with pytest.raises(V.Conflict):
        log.commit(version + 1, state)
    assert rows(t) == []


def test_known_tables(spark, tmp_dir):
    for name, (schema, keys) in K.SCHEMAS.items():
        assert set(keys) <= set(schema.names) and set(K.DEFAULTS.get(name, {})) <= set(schema.names)
    prefix = "v_" + tmp_dir.rsplit("-", 1)[1] + "_"
    names = K.create_tables(spark, tmp_dir, ["notification"], prefix=prefix)
    spark.sql(f"insert into {names[0]} (changelist, author) values (5, 'x')")
    assert spark.table(names[0]).select("emailed", "ack", "jira").first() == ("NO", "NO", None)
