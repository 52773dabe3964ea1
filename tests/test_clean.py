import pytest
from pyspark.sql import functions as F

from orefold.operators import (
    cast_columns,
    count_rejects,
    dedupe,
    dedupe_audit,
    dedupe_by_fingerprint,
    fingerprint,
    normalize_text,
    rejected_values,
    sentinel_to_null,
)

from .conftest import plan_of, rows


def test_sentinel_in_all_or_listed_columns(spark):
    df = spark.createDataFrame([("?", "?", 1), ("a", " ?", 2)], "a string, b string, n int")
    assert rows(sentinel_to_null(df)) == [("a", " ?", 2), (None, None, 1)]
    assert rows(sentinel_to_null(df, ["a"])) == [("a", " ?", 2), (None, "?", 1)]
    assert sentinel_to_null(df, []).columns == df.columns
    other = spark.createDataFrame([("NA",)], "a string")
    assert rows(sentinel_to_null(other, sentinel="NA")) == [(None,)]


def test_strict_cast_accepts_padding_and_raises_on_junk(spark):
    good = spark.createDataFrame([(" 3 ", "1.5"), (None, None)], "i string, d string")
    kinds = {"i": "int", "d": "double"}
    assert rows(cast_columns(good, kinds)) == [(3, 1.5), (None, None)]
    for bad in ("?", "3.0"):
        df = spark.createDataFrame([(bad, "1")], "i string, d string")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            cast_columns(df, kinds).collect()


def test_lenient_cast_counts_what_it_drops(spark):
    df = spark.createDataFrame(
        [("1", "x"), ("oops", "2.5"), (None, None), ("3.0", "nan")], "i string, d string"
    )
    kinds = {"i": "int", "d": "double"}
    cast = cast_columns(df, kinds, lenient=True).collect()
    assert [r.i for r in cast] == [1, None, None, None]
    assert rows(count_rejects(df, kinds)) == [(2, 1)]


def test_dedupe_after_normalising_is_null_safe(spark):
    df = spark.createDataFrame(
        [(" BMW", None, "1.0"), ("bmw ", None, "1"), ("bmw", "x", "1")],
        "make string, doors string, n string",
    )
    kept = df.transform(cast_columns, {"n": "double"}).transform(normalize_text, ["make"])
    assert rows(dedupe(kept)) == [("bmw", "x", 1.0), ("bmw", None, 1.0)]


def test_dedupe_collapses_copies_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"))
    plan = plan_of(dedupe(df))
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange") >= 1


def test_dedupe_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(dedupe_audit(df, ["a", "b"])) == [(5, 3, 2)]
    assert rows(dedupe_audit(df.limit(0), ["a", "b"])) == [(0, 0, 0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_the_session(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame([("1",), ("x",)], "i string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"i": "int"}).collect()
    assert rows(cast_columns(df, {"i": "int"}, lenient=True)) == [(1,), (None,)]


ODD_ROWS = [
    (None, "a", 0.0, [1]), ("a", None, -0.0, [1]), (None, "a", -0.0, [1]), ("a", "", None, None), ("a", None, None, None),
    ("", "a", float("nan"), []), ("", "a", float("nan"), []), (None, None, None, None), (None, None, None, None),
    ("ab", "c", 1.0, [None]), ("a", "bc", 1.0, [None]), ("a", "bc", 1.0, []), ("a", "bc", 1.0, [None]),
]


def test_fingerprints_keep_what_dedupe_keeps(spark):
    df = spark.createDataFrame(ODD_ROWS, "a string, b string, v double, l array<int>").repartition(3)

    def kept(one):
        return rows(one.select("a", "b", (F.col("v") + 0.0).cast("string"), "l"))

    wanted = kept(dedupe(df))
    assert len(wanted) == 9 and kept(dedupe_by_fingerprint(df)) == wanted
    # All or many rows share a fingerprint: nothing but time is lost.
    for prints in (lambda _: [F.lit(1).alias("_print_a"), F.lit(2).alias("_print_b")],
                   lambda c: [F.length(F.coalesce("a", F.lit(""))).cast("long").alias("_print_a"), F.lit(0).alias("_print_b")]):
        assert kept(dedupe_by_fingerprint(df, prints)) == wanted
    assert dedupe_by_fingerprint(df).columns == df.columns
    assert dedupe_by_fingerprint(df.limit(0)).count() == 0


def test_fingerprints_tell_the_place_of_a_null(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "a string, b string")
    assert df.select(*fingerprint(df.columns)).distinct().count() == 2


def test_fingerprints_shuffle_less(spark, tmp_path):
    wide = spark.range(3000).select("id", *[F.sha2(F.concat(F.lit(str(i)), "id"), 256).alias(f"c{i}") for i in range(12)])
    wide.union(wide.limit(20)).write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))

    plan = plan_of(dedupe_by_fingerprint(stored))
    moved = [line for line in plan.splitlines() if "Arguments: hashpartitioning" in line]
    # One shuffle is left, of the rows that share a fingerprint.
    assert len(moved) == 1 and "BroadcastHashJoin LeftSemi" in plan and "BroadcastHashJoin LeftAnti" in plan
    assert rows(dedupe_by_fingerprint(stored)) == rows(dedupe(stored))


def test_rejected_values_come_with_their_row(spark):
    df = spark.createDataFrame(
        [("1", "x", "f1"), ("oops", "y", "f2"), (None, "2.5", "f3"), ("3", "4", "f4")], "i string, d string, src string"
    )
    got = rejected_values(df, {"i": "int", "d": "double"}, ["src"], ["i", "d"])
    assert got.columns == ["column", "value", "row", "src"]
    assert rows(got) == [
        ("d", "x", '{"i":"1","d":"x"}', "f1"),
        ("d", "y", '{"i":"oops","d":"y"}', "f2"),
        ("i", "oops", '{"i":"oops","d":"y"}', "f2"),
    ]
    assert rejected_values(df, {}).count() == 0
    assert got.count() == sum(count_rejects(df, {"i": "int", "d": "double"}).first())
