"""Sums and means that do not depend on the order of their terms."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orefold.functions.exact import mean_of_parts, mean_parts, with_limbs
from orefold.operators import Measure, summarize

from .conftest import plan_of


def means(df, column, *keys):
    """The unrounded mean of `column`."""
    kind = dict(df.dtypes)[column]
    cut = with_limbs(df, [column] if kind == "double" else [])
    parts = [part.over_rows().alias(part.name) for part in mean_parts(column, kind)]
    merged = cut.groupBy(*keys).agg(*parts)
    return merged.select(*keys, mean_of_parts(column, kind).alias("mean"))


def one_mean(spark, values, kind="double"):
    return means(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v").first()[0]


def test_identical_bits_for_any_partitioning(spark):
    n = F.col("id")
    sign = F.when(n % 3 == 0, -1.0).otherwise(1.0)
    value = sign * (F.pmod(F.xxhash64(n), F.lit(10**9)) / 7.0) * F.pow(F.lit(10.0), (n % 16) - 12)
    df = spark.range(60_000).select((n % 5).alias("k"), value.alias("v"))
    assert df.agg(F.max(F.abs("v"))).first()[0] > 1e11
    seen, plain = set(), set()
    for parts in (1, 7, 200):
        spread = df.repartition(parts, F.xxhash64("v", F.lit(parts)))
        seen.add(tuple(sorted((k, m.hex()) for k, m in means(spread, "v", "k").collect())))
        plain.add(tuple(sorted((k, m.hex()) for k, m in spread.groupBy("k").agg(F.avg("v")).collect())))
    assert len(seen) == 1 and len(plain) > 1


@pytest.mark.parametrize("seed", range(3))
def test_means_are_those_of_the_exact_sum(spark, seed):
    rng = random.Random(seed)
    # Multiples of 2^-37, which count in full: mixed signs, magnitudes up to 10^12.
    values = [math.ldexp(rng.randrange(-(2**52), 2**52), rng.choice((-37, -30, -20, -12))) for _ in range(500)]
    exact = sum(map(Fraction, values)) / len(values)
    got = one_mean(spark, values)
    assert abs(Fraction(got) - exact) <= abs(exact) * Fraction(1, 2**52)
    halves = [v for v in values for _ in (0, 1)] + [-v for v in values]
    assert abs(Fraction(one_mean(spark, halves)) - exact / 3) <= abs(exact) * Fraction(1, 2**52)


def test_cancellation_leaves_no_error(spark):
    assert one_mean(spark, [1e12, 0.5, -1e12]) == 0.5 / 3
    assert one_mean(spark, [2.0**62, 1.0, -(2.0**62), -0.25]) == 0.1875
    assert one_mean(spark, [0.1] * 10) == pytest.approx(0.1, abs=2**-38)
    assert one_mean(spark, [-0.1, 0.1, 0.0]) == 0.0


def test_nulls_and_values_beyond(spark):
    assert one_mean(spark, [None, None]) is None and one_mean(spark, []) is None
    assert one_mean(spark, [None, 3.0]) == 3.0
    assert one_mean(spark, [1.0, math.inf]) == math.inf and math.isnan(one_mean(spark, [1.0, math.nan]))
    assert math.isnan(one_mean(spark, [math.inf, -math.inf]))
    assert one_mean(spark, [1e300, 1e300]) == 1e300


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint"])
def test_whole_numbers(spark, kind):
    most = {"int": 2**31 - 1, "bigint": 2**63 - 1, "smallint": 2**15 - 1}[kind]
    values = [most, most, -most - 1, 5, None]
    exact = Fraction(sum(v for v in values if v is not None), 4)
    assert one_mean(spark, values, kind) == float(exact)
    assert one_mean(spark, [most] * 9, kind) == float(most)


def test_decimals(spark):
    from decimal import Decimal

    assert one_mean(spark, [Decimal("0.10"), Decimal("0.20"), None], "decimal(10,2)") == 0.15


def test_ties_do_not_flip_at_large_magnitudes(spark):
    n = F.col("id")
    # Means end in exactly 0.25, far from where a double sum of these holds its last bits.
    df = spark.range(40_000).select((F.lit(9e11) + (n % 2) * 0.5 - (n % 7) + (n % 7)).alias("v"))
    seen = {
        summarize(df.repartition(p, F.xxhash64("v", F.lit(p))), [], [Measure("m", "mean", "v", 1)]).first()[0] for p in (1, 3, 50)
    }
    assert seen == {900000000000.3}


def test_no_double_sum_is_left(spark):
    text = plan_of(summarize(spark.range(3).select(F.col("id").cast("double").alias("v")), [], [Measure("m", "mean", "v", 1)]))
    assert "avg(" not in text and "partial_sum(_upper:v" in text
