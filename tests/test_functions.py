import math

import pytest
from pyspark.sql import functions as F

from orefold.functions import (
    band,
    flag,
    normalized,
    round_mean,
    round_value,
    safe_ratio,
    unmasked,
    weighted_blend,
)

CUTS = ((8000, "economy"), (15000, "mid-range"), (25000, "premium"))


def values(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_unmasked_is_an_exact_match(spark):
    data = [("?",), (" ?",), ("??",), (None,), ("",)]
    assert values(spark, data, "v string", unmasked(F.col("v"))) == [None, " ?", "??", None, ""]


def test_normalized_strips_spaces_only(spark):
    data = [("  BMW ",), ("\tAudi",), (None,)]
    assert values(spark, data, "v string", normalized(F.col("v"))) == ["bmw", "\taudi", None]


def test_safe_ratio(spark):
    data = [(100.0, 3), (100.0, 0), (100.0, -5), (100.0, None), (None, 3), (1.005, 1)]
    got = values(spark, data, "p double, h int", safe_ratio("p", "h", 2))
    assert got == [33.33, None, None, None, None, 1.01]


def test_band_limits_null_and_nan(spark):
    data = [(7999.99,), (8000.0,), (15000.0,), (25000.0,), (None,), (math.nan,)]
    got = values(spark, data, "v double", band("v", CUTS, "luxury", "unknown"))
    assert got == ["economy", "mid-range", "premium", "luxury", "unknown", "luxury"]


def test_weighted_blend(spark):
    data = [(21, 27), (19, 26), (None, 20)]
    blend = weighted_blend({"c": 0.55, "h": 0.45}, 1)
    assert values(spark, data, "c int, h int", blend) == [23.7, 22.2, None]


def test_flag_is_never_null(spark):
    data = [("turbo",), ("std",), (None,)]
    assert values(spark, data, "v string", flag("v", "turbo")) == [True, False, False]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_round_value_equals_round(spark, digits):
    n = F.col("id")
    anywhere = (n * 0.618034 % 1) * F.pow(F.lit(10.0), n % 16 - 3)
    ties = n * 0.005
    quotients = (n + 1) / (n % 97 + 1)
    special = F.element_at(
        F.array(*[F.lit(v) for v in (0.0, -0.0, math.inf, -math.inf, math.nan, 1e300, 0.49999999, 1e7)]),
        (n % 8 + 1).cast("int"),
    )
    df = spark.range(100_000)
    for made in (anywhere, ties, quotients, special):
        for value in (made, -made):
            got = round_value(F.col("v"), digits)
            plain = F.round("v", digits)
            differs = ~got.eqNullSafe(plain) | ~got.cast("string").eqNullSafe(plain.cast("string"))
            assert df.select(value.alias("v")).filter(differs).isEmpty()
    assert spark.range(1).select(round_value(F.lit(None).cast("double"), digits)).first()[0] is None


@pytest.mark.parametrize(
    "value, digits, wanted",
    [
        (20.15, 1, 20.2),
        (20.149999999999999, 1, 20.2),
        (20.14, 1, 20.1),
        (-2.5, 0, -3.0),
        (2.5, 0, 3.0),
        (1e300, 1, 1e300),
        (-1e300, 1, -1e300),
        (float(2**52), 2, float(2**52)),
        (math.inf, 1, math.inf),
        (None, 1, None),
    ],
)
def test_round_mean(spark, value, digits, wanted):
    assert values(spark, [(value,)], "v double", round_mean(F.col("v"), digits)) == [wanted]


def test_round_mean_keeps_nan(spark):
    assert math.isnan(values(spark, [(math.nan,)], "v double", round_mean(F.col("v"), 1))[0])


def test_round_mean_does_not_depend_on_the_order_of_summation(spark):
    # 0.1 + 0.2 + 0.3 and 0.3 + 0.2 + 0.1 differ in the last bit.
    forward, backward = (0.1 + 0.2 + 0.3) / 3 + 0.05, (0.3 + 0.2 + 0.1) / 3 + 0.05
    assert forward != backward
    got = values(spark, [(forward,), (backward,)], "v double", round_mean(F.col("v"), 1))
    assert got == [0.3, 0.3]
