"""Scale properties of the physical plans that must not regress."""

from pyspark.sql import functions as F

from benchtrail.fixtures import fixture, raw
from benchtrail.operators import compat as C
from benchtrail.operators import coverage as V
from benchtrail.plans import regression as R
from conftest import SMOKE


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top2_per_series_is_limited_before_the_shuffle(spark):
    plan = R.slower_than_previous(fixture(spark, SMOKE, "f1_runs"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_text_match_and_expectation_have_no_keyless_join(spark):
    docs = raw(spark, SMOKE, "documents")
    apis = docs.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]+"), 0)).alias("api")).distinct()
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    plan = _plan(V.token_match(apis, lines, covered=F.length("line") > 40))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    b = fixture(spark, SMOKE, "f4_builds")
    exp = b.select(F.col("config").alias("line"))
    plan = _plan(C.expectation_check(b, exp, mode="contains"))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
