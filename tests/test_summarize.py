import pytest

from orefold.operators import Measure, summarize

from .conftest import rows


def test_measures_with_nulls_and_a_null_group(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True), ("a", None, False), ("a", 2.5, True), (None, 4.0, False), ("b", None, False)],
        "k string, v double, f boolean",
    )
    measures = [
        Measure("n", "rows"),
        Measure("mean_v", "mean", "v", 1),
        Measure("low_v", "low", "v", 0),
        Measure("high_v", "high", "v", 0),
        Measure("f_rows", "true_rows", "f"),
        Measure("f_pct", "true_percent", "f", 1),
    ]
    got = summarize(df, ["k"], measures)
    assert got.columns == ["k", "n", "mean_v", "low_v", "high_v", "f_rows", "f_pct"]
    assert rows(got) == [
        ("a", 3, 1.8, 1.0, 3.0, 2, 66.7),
        ("b", 1, None, None, None, 0, 0.0),
        (None, 1, 4.0, 4.0, 4.0, 0, 0.0),
    ]


def test_types_of_counts(spark):
    df = spark.createDataFrame([(1, True)], "k int, f boolean")
    got = summarize(df, ["k"], [Measure("n", "rows"), Measure("t", "true_rows", "f")])
    assert dict(got.dtypes) == {"k": "int", "n": "bigint", "t": "bigint"}


def test_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError, match="unknown measure"):
        summarize(spark.range(1), ["id"], [Measure("x", "median", "id")])


def test_same_result_for_any_number_of_partitions(spark, conf):
    df = spark.range(20_000).selectExpr("id % 7 k", "round(id * 0.05 + 0.05, 2) v")
    measures = [Measure("m", "mean", "v", 1)]
    seen = set()
    for parts in ("1", "3", "16"):
        conf("spark.sql.shuffle.partitions", parts)
        seen.add(tuple(rows(summarize(df.repartition(int(parts)), ["k"], measures))))
    assert len(seen) == 1
