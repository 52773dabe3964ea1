import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orefold.operators import first_rows, global_rank, ordinal, top_k

from .conftest import plan_of, rows


def both(df, digits):
    expected = F.rank().over(Window.orderBy(F.desc("s")))
    return rows(global_rank(df, "s", "r")), rows(df.withColumn("r", expected))


def test_ties_gaps_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 3.0), (4, None), (5, None), (6, 1.0)], "k int, s double")
    got = global_rank(df, "s", "r")
    assert dict(got.dtypes)["r"] == "int"
    assert {r.k: r.r for r in got.collect()} == {2: 1, 3: 1, 1: 3, 6: 4, 4: 5, 5: 5}


def test_scores_far_apart_and_special_values(spark):
    scores = [0.0, -0.0, 1e12, -1e12, 12345.6, 12345.7, 999.9, 1000.0, 1000.1, math.nan, math.inf, -math.inf, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "k int, s double")
    got, wanted = both(df, 1)
    assert repr(got) == repr(wanted)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-40_000, 40_000)), min_size=1, max_size=60))
def test_equals_rank_over_the_whole_table(spark, scores):
    data = [(i, None if s is None else s / 10) for i, s in enumerate(scores)]
    got, wanted = both(spark.createDataFrame(data, "k int, s double"), 1)
    assert got == wanted


def test_no_row_of_the_table_goes_to_a_single_task(spark):
    stored = spark.range(5000).selectExpr("id k", "round(id % 300 / 10, 1) s")
    plan = plan_of(global_rank(stored, "s", "r"))
    assert "SinglePartition" not in plan and "Window" not in plan
    assert "BroadcastHashJoin" in plan


def test_top_k_is_a_per_task_heap(spark):
    df = spark.range(1000).selectExpr("id k", "id % 10 s")
    top = top_k(df, [F.desc("s"), "k"], 3)
    assert "TakeOrderedAndProject" in plan_of(top)
    assert [tuple(r) for r in top.collect()] == [(9, 9), (19, 9), (29, 9)]


def test_first_rows(spark):
    got = first_rows(spark.range(100).selectExpr("id", "id + 1 b"), ["b"], 5)
    assert got.columns == ["b"] and got.count() == 5


@pytest.mark.parametrize("value, place", [("low", 1), ("high", 2), ("other", 3), (None, 3)])
def test_ordinal(spark, value, place):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(ordinal("v", ["low", "high"])).first()[0] == place


def test_unrounded_scores_over_a_wide_range(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 12)).alias("s"))
    stored = spark.createDataFrame(df.collect(), "k long, s double")
    got, wanted = both(stored, 1)
    assert got == wanted


def test_a_single_task_gets_a_row_per_range(spark, conf, monkeypatch):
    from orefold.operators import ranking

    seen = []
    plain = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, label: seen.append(plan_of(df)) or plain(df, label))
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 1e6).alias("s"))
    global_rank(df, "s", "r")
    ranges, ranks = seen
    assert "SinglePartition" not in ranges and "rangepartitioning" in ranges
    single = ranks.index("SinglePartition")
    assert "partial_sum" in ranks[:single] or "sum(_rows" in ranks[:single]
