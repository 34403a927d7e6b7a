"""Plan checks: no Python UDF in any registered query plan; W1 uses a partial
WindowGroupLimit; the composed job pre-aggregates before its shuffle; the
skew-safe row numbering equals row_number() (brute force) when one document
holds most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators.ordering import ordered_row_number
from ledgerline.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_in_plans(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), name


def test_w1_window_group_limit(spark):
    plan = _plan(catalog.queries()["w1_latest"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_partial_aggregation_before_shuffle(spark):
    df = catalog.queries()["a1_extraction_date"](spark, SF_SMALL)
    df.explain()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_skew_safe_row_number_matches_window(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts")
    # One hot group: about two thirds of all rows land in user 0.
    hot = ev.withColumn("g", F.when(F.col("event_id") % 3 != 0, F.lit(0)).otherwise(F.col("user_id")))
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    got = ordered_row_number(hot, ["g"], order, out="rn", num_partitions=8)
    want = hot.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    key = ["event_id", "g", "rn"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
