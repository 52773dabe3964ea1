import pytest
from pyspark.sql import functions as F

from orefold.operators import dimension_snapshot, enrich_left, hot_keys, require_unique
from orefold.session import materialize

from .conftest import plan_of, rows


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [("bmw", 1), ("bmw", 2), ("lada", 3), (None, 4)], "make string, n int"
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("bmw", "luxury"), ("audi", "luxury")], "make string, seg string")


def test_snapshot_filters_drops_and_renames(spark):
    raw = spark.createDataFrame(
        [("bmw", 1985, 20, "x"), ("bmw", 1986, 21, "x")],
        "make string, year int, mpg int, junk string",
    )
    made = dimension_snapshot(raw, F.col("year") == 1985, {"mpg": "fe_mpg"}, ["year", "junk"])
    assert made.columns == ["make", "fe_mpg"]
    assert rows(made) == [("bmw", 20)]


def test_left_join_keeps_unmatched_and_null_keys(facts, dim):
    got = enrich_left(facts, dim, "make")
    assert got.columns == ["make", "n", "seg"]
    assert rows(got) == [("bmw", 1, "luxury"), ("bmw", 2, "luxury"), ("lada", 3, None), (None, 4, None)]


def test_two_dimension_rows_for_one_key_fail(facts, dim):
    twice = dim.union(dim.filter("make = 'bmw'"))
    with pytest.raises(Exception, match="dimension key make is not unique"):
        enrich_left(facts, twice, "make").collect()
    assert enrich_left(facts, twice, "make", unique=False).count() == 6


def test_null_keys_in_the_dimension_are_no_duplicates(spark, facts, dim):
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "make string, seg string")
    assert enrich_left(facts, dim.union(nulls), "make").count() == 4


def test_empty_dimension(facts, dim):
    assert enrich_left(facts, dim.limit(0), "make").filter("seg is null").count() == 4
    assert require_unique(dim.limit(0), "make").count() == 0


def skewed(spark):
    """A third of the rows has key 7, another tenth has none."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 10 != 1, F.col("id") % 200)
        .cast("long")
        .alias("k"),
        F.col("id").alias("n"),
    )


def test_hot_keys_come_first(spark):
    got = spark.range(1).select(hot_keys(skewed(spark), "k", 3)).first()[0]
    assert got[0] == 7 and len(got) == 3


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_salted_join_equals_plain_join(spark, conf, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    facts = skewed(spark)
    dim = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    plain = enrich_left(facts, dim, "k")
    salted = enrich_left(facts, dim, "k", salt_buckets=8, hot_limit=5)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    assert plain.count() == 3000


def test_salting_spreads_the_hot_key(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    dim = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))

    def biggest(df):
        sizes = df.groupBy(F.spark_partition_id()).count()
        return sizes.agg(F.max("count")).first()[0]

    plain = enrich_left(skewed(spark), dim, "k")
    salted = enrich_left(skewed(spark), dim, "k", salt_buckets=32)
    assert biggest(plain) > 1000
    assert biggest(salted) < 700


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, conf, facts, dim):
    def join(plan):
        return "BroadcastHashJoin" if "BroadcastHashJoin" in plan else "SortMergeJoin"

    dim = materialize(dim, "dim")  # gives it a known size
    assert join(plan_of(enrich_left(facts, dim, "make"))) == "BroadcastHashJoin"
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(enrich_left(facts, dim, "make"))
    assert join(plan) == "SortMergeJoin" and "Cartesian" not in plan


def test_frequent_keys_are_observed_within_the_stated_error(spark):
    from pyspark.sql import Observation

    from orefold.operators import frequent_keys

    n = F.col("id")
    # A third of the rows has one key, a tenth another, a hundredth each three more; the rest are single.
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, "warm").when(n % 100 < 3, F.concat(F.lit("w"), n % 100)).otherwise(n.cast("string"))
    rows_in = spark.range(90_000).select(key.alias("k")).repartition(7)
    exact = {r["k"]: r["count"] for r in rows_in.groupBy("k").count().orderBy(F.desc("count")).limit(20).collect()}
    seen = Observation()
    rows_in.observe(seen, frequent_keys(F.col("k"), 100, 1000).alias("top")).write.format("noop").mode("overwrite").save()
    got = {r["item"]: r["count"] for r in seen.get["top"]}
    error = 3.5 / 1000 * 90_000
    assert all(abs(got[k] - exact[k]) <= error for k in got if k in exact)
    assert {k for k, c in exact.items() if c > 2 * error} <= set(got) and list(got)[0] == "hot"
    few = Observation()
    spark.range(5000).select((n % 50).alias("k")).observe(few, frequent_keys(F.col("k"), 100).alias("top")).collect()
    assert {r["item"]: r["count"] for r in few.get["top"]} == dict.fromkeys(range(50), 100)


def test_known_hot_keys_need_no_count(spark):
    facts = spark.range(1000).selectExpr("if(id % 3 = 0, 1, id) k", "if(id % 11 = 0, null, id) v")
    dim = spark.range(900).selectExpr("id k", "id * 2 d")
    salted = enrich_left(facts, dim, "k", salt_buckets=8, hot=[1])
    assert rows(salted) == rows(enrich_left(facts, dim, "k"))
    counted = plan_of(enrich_left(facts, dim, "k", salt_buckets=8))
    assert "collect_list" in counted
    assert "collect_list" not in plan_of(enrich_left(facts, dim, "k", salt_buckets=8, hot=[1]))
    assert rows(enrich_left(facts, dim, "k", salt_buckets=8, hot=[])) == rows(salted)
