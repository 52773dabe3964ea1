"""The car market build on hand-written CSV files."""

import csv
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orefold.plans.car_market import (
    BODY_STYLES,
    CAR_COLUMNS,
    CAR_MARKET,
    CARS,
    FUEL,
    FUEL_COLUMNS,
    FUEL_RANKING,
    PRICE_BY_MAKE,
    PRICE_SEGMENTS,
    csv_sources,
    dashboard,
)
from orefold.plans.gold import read_gold
from orefold.plans.layers import Layers, TooManyRejects, run_layers
from orefold.sinks import ensure_layer
from orefold.sources import drop_bronze_audit, read_table
from orefold.workload import queries

from .conftest import rows

DEFAULTS = {
    "symboling": "0", "normalized_losses": "?", "fuel_type": "gas", "aspiration": "std",
    "num_doors": "four", "body_style": "sedan", "drive_wheels": "fwd",
    "engine_location": "front", "wheel_base": "95.5", "length": "170", "width": "65",
    "height": "54", "curb_weight": "2000", "engine_type": "ohc", "num_cylinders": "four",
    "engine_size": "100", "fuel_system": "mpfi", "bore": "3.1", "stroke": "3.2",
    "compression_ratio": "9", "horsepower": "100", "peak_rpm": "5000", "city_mpg": "20",
    "highway_mpg": "30", "price": "10000",
}

CAR_ROWS = [
    {"make": "acme", "price": "7000", "horsepower": "70"},
    # The same car once more, and again with padding, case and another spelling.
    {"make": "acme", "price": "7000", "horsepower": "70"},
    {"make": " ACME ", "price": "7000.0", "horsepower": " 70", "fuel_type": "GAS"},
    {"make": "acme", "price": "9001", "horsepower": "90", "aspiration": "turbo"},
    {"make": "acme", "price": "?", "horsepower": "80"},
    {"make": "bolt", "price": "26000", "horsepower": "0", "body_style": "Wagon"},
    {"make": "bolt", "price": "15000", "horsepower": "?", "fuel_type": "diesel",
     "city_mpg": "21", "highway_mpg": "27", "aspiration": "?"},
    # No row in the dimension for the snapshot year.
    {"make": "lone", "price": "24999.99", "horsepower": "123", "city_mpg": "?"},
]

FUEL_ROWS = [
    ("Acme ", "1985", "20", "30", "150", "1500", "economy", "80", "4"),
    ("acme", "1986", "22", "31", "140", "1400", "economy", "81", "4"),
    ("bolt", "1985", "18", "25", "200", "2001", "luxury", "91", "5"),
    ("lone", "1987", "18", "25", "200", "2000", "luxury", "90", "5"),
]


def write(path, header, lines):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(lines)
    return str(path)


def write_cars(path, cars):
    return write(path, CAR_COLUMNS, [[{**DEFAULTS, **c}[n] for n in CAR_COLUMNS] for c in cars])


@pytest.fixture
def raw(tmp_path):
    return (
        write_cars(tmp_path / "cars.csv", CAR_ROWS),
        write(tmp_path / "fuel.csv", FUEL_COLUMNS, FUEL_ROWS),
    )


@pytest.fixture
def layers(request, tmp_path):
    name = request.node.name.lower()[:30].rstrip("[]-")
    return Layers(f"{name}_bronze", f"{name}_silver", f"{name}_gold", str(tmp_path / "lake"))


def silver_of(spark, layers):
    return spark.table(f"{layers.silver}.automobiles_enriched")


def gold_of(spark, layers):
    return {t.name: read_gold(spark, layers.gold, t) for t in CAR_MARKET.gold}


def bare(df):
    return df.drop("_gold_timestamp")


def test_whole_build(spark, raw, layers):
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)

    assert report.bronze[CARS.name].rows == 8 and report.bronze[FUEL.name].rows == 4
    assert report.silver.rows == 6 and report.removed_copies(CAR_MARKET) == 2
    bronze = spark.table(f"{layers.bronze}.{CARS.name}")
    assert len(bronze.columns) == 29 and {t for _, t in bronze.dtypes} == {"string", "timestamp"}

    silver = silver_of(spark, layers)
    assert len(silver.columns) == 39
    assert silver.columns[0] == "make" and silver.columns[26:32] == [
        "price_per_hp", "price_category", "combined_mpg", "is_turbo",
        "_silver_timestamp", "_silver_version",
    ]
    derived = silver.select(
        "make", "price", "price_per_hp", "price_category", "combined_mpg", "is_turbo",
        "fe_market_segment", "fe_popularity_score",
    )
    assert rows(derived) == sorted(
        [
            ("acme", 7000.0, 100.0, "economy", 24.5, False, "economy", 80),
            ("acme", 9001.0, 100.01, "mid-range", 24.5, True, "economy", 80),
            ("acme", None, None, "unknown", 24.5, False, "economy", 80),
            ("bolt", 26000.0, None, "luxury", 24.5, False, "luxury", 91),
            ("bolt", 15000.0, None, "premium", 23.7, False, "luxury", 91),
            ("lone", 24999.99, 203.25, "premium", None, False, None, None),
        ],
        key=repr,
    )

    gold = gold_of(spark, layers)
    assert {n: p.rows for n, p in report.gold.items()} == {n: d.count() for n, d in gold.items()}
    assert [tuple(r) for r in bare(gold[PRICE_BY_MAKE.name]).collect()] == [
        ("lone", None, 25000.0, 25000.0, 25000.0, 1, 123.0, None, None, None),
        ("bolt", "luxury", 20500.0, 15000.0, 26000.0, 2, 0.0, 24.1, 91.0, 5.0),
        ("acme", "economy", 8001.0, 7000.0, 9001.0, 2, 80.0, 24.5, 80.0, 4.0),
    ]
    assert [tuple(r) for r in bare(gold[BODY_STYLES.name]).collect()] == [
        ("sedan", 5, 14000.0, 2000.0, 24.3, 91.0, 1),
        ("wagon", 1, 26000.0, 2000.0, 24.5, 0.0, 0),
    ]
    ranking = bare(gold[FUEL_RANKING.name])
    assert rows(ranking) == [
        ("acme", "gas", 24.5, 20.0, 30.0, 150.0, 1500.0, 3, 1),
        ("bolt", "diesel", 23.7, 21.0, 27.0, 200.0, 2001.0, 1, 3),
        ("bolt", "gas", 24.5, 20.0, 30.0, 200.0, 2001.0, 1, 1),
    ]
    assert [r.efficiency_rank for r in ranking.collect()] == [1, 1, 3]
    segments = bare(gold[PRICE_SEGMENTS.name])
    assert [r.price_category for r in segments.collect()] == [
        "economy", "mid-range", "premium", "premium", "luxury",
    ]
    assert ("mid-range", "economy", 1, 9001.0, 90.0, 24.5, 100.0, 4.0, 80.0, 100.0) in rows(segments)
    assert ("premium", None, 1, 25000.0, 123.0, None, 100.0, None, None, 0.0) in rows(segments)


def test_gold_counts_add_up(spark, raw, layers):
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    silver, gold = silver_of(spark, layers), gold_of(spark, layers)

    def total(name, column):
        return gold[name].agg(F.sum(column)).first()[0]

    assert total(PRICE_BY_MAKE.name, "total_models") == silver.filter("price is not null").count()
    assert total(BODY_STYLES.name, "total_autos") == silver.count()
    assert total(FUEL_RANKING.name, "num_models") == silver.filter("combined_mpg is not null").count()
    known = silver.filter("price_category <> 'unknown'").count()
    assert total(PRICE_SEGMENTS.name, "total_autos") == known


def test_dashboard(spark, raw, layers):
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    panel = {n: [tuple(r) for r in d.collect()] for n, d in dashboard(gold_of(spark, layers)).items()}
    assert panel["brands"] == [(3,)]
    assert panel["overall_price"] == [(17833.67,)]
    assert [r[0] for r in panel["price_by_make"]] == ["lone", "bolt", "acme"]
    assert panel["body_styles"] == [("sedan", 5, 83.33), ("wagon", 1, 16.67)]
    assert panel["most_efficient"][0] == ("acme", 24.5, "gas")
    assert len(panel["co2_and_cost"]) == 3
    matrix = {r[0]: r[1:] for r in panel["segments"]}
    # premium: 15000 and 25000 (24999.99 rounded), one safety rating known.
    assert matrix["premium"] == (20000.0, 123.0, 5.0, 0.0)
    assert dict(panel["segment_volume"]) == {"economy": 1, "mid-range": 1, "premium": 2, "luxury": 1}


def test_second_run_from_the_bronze_tables_is_the_same(spark, raw, layers):
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    before = {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()}
    tables = {
        n: drop_bronze_audit(spark.table(f"{layers.bronze}.{n}")) for n in (CARS.name, FUEL.name)
    }
    report = run_layers(spark, CAR_MARKET, tables, layers)
    assert report.bronze[CARS.name].rows == 8
    assert {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()} == before


def test_build_in_place_from_loaded_tables(spark, raw, layers):
    ensure_layer(spark, layers.bronze, layers.folder(layers.bronze))
    for name, df in csv_sources(spark, *raw).items():
        df.write.saveAsTable(f"{layers.bronze}.{name}")
    loaded = {n: spark.table(f"{layers.bronze}.{n}") for n in (CARS.name, FUEL.name)}
    report = run_layers(spark, CAR_MARKET, loaded, layers)
    assert (report.bronze[CARS.name].rows, report.silver.rows) == (8, 6)
    bronze = spark.table(f"{layers.bronze}.{CARS.name}")
    assert bronze.select("_source_file", "_source_layer").distinct().collect() == [
        ("automobiles.csv", "raw")
    ]


def test_settings_do_not_change_results(spark, raw, layers, conf):
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    before = {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()}
    conf("spark.sql.shuffle.partitions", "13")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers, salt_buckets=4)
    assert report.hot_keys[0] == "acme" and sorted(report.hot_keys) == ["acme", "bolt", "lone"]
    assert {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()} == before


@pytest.fixture
def with_junk(tmp_path, raw):
    cars = [*CAR_ROWS, {"make": "acme", "price": "12k", "horsepower": "fast"}]
    return write_cars(tmp_path / "junk.csv", cars), raw[1]


def test_strict_build_stops_on_malformed_numbers(spark, with_junk, layers):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_layers(spark, CAR_MARKET, csv_sources(spark, *with_junk), layers)
    assert not spark.catalog.tableExists(f"{layers.silver}.automobiles_enriched")


def test_lenient_build_within_and_beyond_the_limit(spark, raw, with_junk, layers):
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers, max_rejects=0)
    assert silver_of(spark, layers).count() == 6
    with pytest.raises(TooManyRejects, match="'horsepower': 1, 'price': 1"):
        run_layers(spark, CAR_MARKET, csv_sources(spark, *with_junk), layers, max_rejects=1)
    assert silver_of(spark, layers).count() == 6
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *with_junk), layers, max_rejects=2)
    assert report.silver.rows == 7
    assert silver_of(spark, layers).filter("make = 'acme' and price is null").count() == 2


def test_two_dimension_rows_for_one_key_stop_the_build(spark, raw, layers, tmp_path):
    twice = [*FUEL_ROWS, ("ACME", "1985", "1", "1", "1", "1", "economy", "1", "1")]
    fuel = write(tmp_path / "twice.csv", FUEL_COLUMNS, twice)
    with pytest.raises(Exception, match="dimension key make is not unique"):
        run_layers(spark, CAR_MARKET, csv_sources(spark, raw[0], fuel), layers)


def test_reordered_header_stops_the_build(spark, raw, layers, tmp_path):
    header = (CAR_COLUMNS[1], CAR_COLUMNS[0], *CAR_COLUMNS[2:])
    cars = write(tmp_path / "swapped.csv", header, [["0"] * len(header)])
    with pytest.raises(Exception, match="header|Header"):
        run_layers(spark, CAR_MARKET, csv_sources(spark, cars, raw[1]), layers)


def test_frequent_keys_are_counted_on_the_key_column_alone(spark):
    from orefold.plans.layers import build_silver
    from orefold.workload.lines import LINES, given, named_lines, raw_lines

    from .conftest import plan_of

    folder = "/root/testdata/sf0.001"
    facts, parts = named_lines(raw_lines(spark, folder)), given(spark, folder, "part")
    salted = build_silver(facts, parts, LINES, salt_buckets=4)
    text = plan_of(salted)
    main, extra = text.split("===== Subqueries =====")
    assert "ReadSchema: struct<l_partkey:bigint>" in extra
    whole_row = "l_orderkey"
    assert whole_row in main and whole_row not in extra
    plain = build_silver(facts, parts, LINES)
    assert rows(salted.drop("_silver_timestamp")) == rows(plain.drop("_silver_timestamp"))


def test_rejects_are_listed_beside_silver(spark, with_junk, layers):
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *with_junk), layers, max_rejects=2)
    rejects = spark.table(f"{layers.silver}.{CAR_MARKET.rejects}")
    assert report.rejects.rows == 2
    got = rejects.select("source_table", "column", "value", "_source_file", F.get_json_object("row", "$.make"))
    assert rows(got) == [
        (CARS.name, "horsepower", "fast", "automobiles.csv", "acme"),
        (CARS.name, "price", "12k", "automobiles.csv", "acme"),
    ]


def test_a_run_without_rejects_lists_none(spark, raw, layers):
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers, max_rejects=5)
    assert report.rejects.rows == 0 and spark.table(f"{layers.silver}.{CAR_MARKET.rejects}").count() == 0


def test_malformed_dimension_values_count(spark, raw, layers, tmp_path):
    odd = [*FUEL_ROWS, ("new", "19x5", "1", "1", "1", "1", "economy", "many", "1")]
    fuel = write(tmp_path / "odd.csv", FUEL_COLUMNS, odd)
    sources = csv_sources(spark, raw[0], fuel)
    with pytest.raises(TooManyRejects, match="'fuel_economy_raw.model_year': 1, 'fuel_economy_raw.popularity_score': 1"):
        run_layers(spark, CAR_MARKET, sources, layers, max_rejects=1)
    assert not spark.catalog.tableExists(f"{layers.silver}.automobiles_enriched")
    report = run_layers(spark, CAR_MARKET, csv_sources(spark, raw[0], fuel), layers, max_rejects=2)
    assert report.rejects.rows == 2 and report.silver.rows == 6


def test_the_typed_dimension_is_stored_by_snapshot(spark, raw, layers):
    from orefold.plans.layers import join_side

    from .conftest import plan_of

    report = run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    stored = spark.table(f"{layers.silver}.{CAR_MARKET.silver_dimension}")
    assert report.silver_dimension.rows == 4 and dict(stored.dtypes)["model_year"] == "int"
    text = plan_of(join_side(stored, CAR_MARKET))
    assert "PartitionFilters: [isnotnull(model_year" in text and "= 1985)]" in text
    assert rows(join_side(stored, CAR_MARKET).select("make", "fe_popularity_score")) == [("acme", 80), ("bolt", 91)]


def test_silver_by_fingerprint_and_in_buckets(spark, raw, layers):
    from orefold.plans.gold import build_gold
    from orefold.sinks import Layout
    from orefold.sources import read_table

    from .conftest import plan_of

    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers)
    before = {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()}
    by_make = Layout(bucket_by=["make"], buckets=4)
    run_layers(spark, CAR_MARKET, csv_sources(spark, *raw), layers, by_fingerprint=True, silver_layout=by_make)
    assert {n: rows(bare(d)) for n, d in gold_of(spark, layers).items()} == before
    silver = read_table(spark, f"{layers.silver}.automobiles_enriched")
    for table in (PRICE_BY_MAKE, FUEL_RANKING):
        assert "Exchange" not in plan_of(build_gold(silver, replace(table, rank=None)))


def test_rows_of_a_key_are_stored_together(spark, conf, monkeypatch):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr("orefold.plans.layers._MANY_KEYS", 1, raising=False)
    monkeypatch.setattr(queries, "_built", {})
    layers = queries.built_layers(spark, "/root/testdata/sf0.001")
    silver = read_table(spark, f"{layers.silver}.{queries.LINES.silver}")
    placed = silver.select("l_partkey", F.col("_metadata.file_path").alias("file"))
    assert placed.select("file").distinct().count() > 1
    assert placed.distinct().count() == placed.select("l_partkey").distinct().count()


def test_one_shuffle_by_key_serves_copies_and_join_unless_a_key_is_hot(spark, monkeypatch):
    from orefold.plans import layers as module

    from .conftest import plan_of

    built, make = [], module._silver
    monkeypatch.setattr(module, "_silver", lambda *a, **k: built.append(make(*a, **k)) or built[-1])
    monkeypatch.setattr(module, "_MANY_KEYS", 1)

    def shuffles_and_rows():
        monkeypatch.setattr(queries, "_built", {})
        stored = rows(queries.built_silver(spark, "/root/testdata/sf0.001"))
        moved = [line for line in plan_of(built[-1]).splitlines() if line.startswith("Arguments: hashpartitioning(")]
        return sum("qty" in line or "l_partkey" in line for line in moved), stored

    once, together = shuffles_and_rows()
    monkeypatch.setattr(module, "_TASK_ROWS", 2)  # every key is hot now
    twice, apart = shuffles_and_rows()
    # The dimension moves too, and once more to see that its keys are unique.
    assert (once, twice) == (3, 4) and together == apart
