"""Gold tables that are summed up together."""

import random

import pytest
from pyspark.sql import functions as F

from orefold.operators import Measure
from orefold.plans.gold import GoldTable, RankBy, build_gold, build_gold_tables, group_finest
from orefold.plans.layers import Layers, run_layers

from .conftest import rows

MEASURES = (
    Measure("n", "rows"),
    Measure("mean_v", "mean", "v", 2),
    Measure("mean_i", "mean", "i", 1),
    Measure("low_v", "low", "v", 1),
    Measure("high_v", "high", "v", 1),
    Measure("yes", "true_rows", "f"),
    Measure("pct", "true_percent", "f", 1),
)
TABLES = (
    GoldTable("by_a", ("a",), MEASURES),
    GoldTable("by_a_known", ("a",), MEASURES[:3], where=lambda: F.col("v").isNotNull()),
    GoldTable("by_ab", ("a", "b"), MEASURES[1:5], where=lambda: F.col("b") != "x", rank=RankBy("mean_v", "place")),
    GoldTable("by_b", ("b",), MEASURES[4:], where=lambda: F.lit(None).cast("boolean") | (F.col("i") > 3)),
    GoldTable("empty", ("i",), MEASURES, where=lambda: F.col("i") > 100),
)


@pytest.fixture(scope="module")
def silver(spark):
    rng = random.Random(3)
    data = [
        (rng.choice((None, 1, 2, 3)), rng.choice((None, "x", "y", "z")), rng.choice((None, rng.random() * 10)),
         rng.choice((None, rng.randrange(9))), rng.choice((None, True, False)))
        for _ in range(400)
    ]
    return spark.createDataFrame(data, "a int, b string, v double, i int, f boolean").repartition(3).cache()


@pytest.mark.parametrize("pre_aggregate", [False, True])
def test_together_as_one_by_one(silver, pre_aggregate):
    together = build_gold_tables(silver, TABLES, pre_aggregate=pre_aggregate)
    assert list(together) == [table.name for table in TABLES]
    for table in TABLES:
        alone = build_gold(silver, table)
        assert together[table.name].dtypes == alone.dtypes
        assert rows(together[table.name]) == rows(alone)
    assert rows(together["empty"]) == []
    assert {r[0] for r in rows(together["by_a"])} == {None, 1, 2, 3}


def test_of_no_rows_and_no_tables(silver):
    assert build_gold_tables(silver, ()) == {}
    for pre_aggregate in (False, True):
        none = build_gold_tables(silver.limit(0), TABLES, pre_aggregate=pre_aggregate)
        assert all(rows(df) == [] for df in none.values())


def test_the_finest_groups_are_counted_on_the_way(silver):
    groups = silver.agg(F.approx_count_distinct(group_finest(TABLES))).first()[0]
    assert 150 < groups < 350  # 4 * 4 * 10 keys, and whether v is known


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_builds_either_way(spark, tmp_path, monkeypatch, share):
    from orefold.plans.car_market import CAR_MARKET, FUEL_RANKING, csv_sources
    from orefold.plans.gold import read_gold

    from .test_layers import CAR_ROWS, FUEL_COLUMNS, FUEL_ROWS, write, write_cars

    monkeypatch.setattr("orefold.plans.layers._FEW_GROUPS", share)
    raw = write_cars(tmp_path / "cars.csv", CAR_ROWS), write(tmp_path / "fuel.csv", FUEL_COLUMNS, FUEL_ROWS)
    layers = Layers(f"g{int(share)}_b", f"g{int(share)}_s", f"g{int(share)}_g", str(tmp_path / "lake"))
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    assert [r["efficiency_rank"] for r in read_gold(spark, layers.gold, FUEL_RANKING).collect()] == [1, 1, 3]
