"""The car market build: raw columns, cleaning rules, gold tables and panels."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import band, flag, safe_ratio, weighted_blend
from ..operators import Measure, ordinal
from . import panels
from .gold import GoldTable, RankBy
from .layers import Build, RawTable, read_raw_csv

# The raw files' headers, the columns that are numbers, the
# price limits, the weights and the names of the published tables and columns.
CAR_COLUMNS = (
    "symboling", "normalized_losses", "make", "fuel_type", "aspiration",
    "num_doors", "body_style", "drive_wheels", "engine_location", "wheel_base",
    "length", "width", "height", "curb_weight", "engine_type", "num_cylinders",
    "engine_size", "fuel_system", "bore", "stroke", "compression_ratio",
    "horsepower", "peak_rpm", "city_mpg", "highway_mpg", "price",
)
CAR_INTS = (
    "symboling", "normalized_losses", "curb_weight", "engine_size",
    "horsepower", "peak_rpm", "city_mpg", "highway_mpg",
)
CAR_DOUBLES = (
    "wheel_base", "length", "width", "height", "bore", "stroke",
    "compression_ratio", "price",
)
CAR_TEXT = ("make", "fuel_type", "body_style", "drive_wheels")
FUEL_COLUMNS = (
    "make", "model_year", "avg_city_mpg", "avg_highway_mpg",
    "co2_emissions_gkm", "fuel_cost_annual_usd", "market_segment",
    "popularity_score", "safety_rating",
)
FUEL_INTS = (
    "model_year", "avg_city_mpg", "avg_highway_mpg", "co2_emissions_gkm",
    "fuel_cost_annual_usd", "popularity_score", "safety_rating",
)
FUEL_YEAR = 1985
FUEL_PREFIX = "fe_"
PRICE_CUTS = ((8000, "economy"), (15000, "mid-range"), (25000, "premium"))
PRICE_TOP = "luxury"
PRICE_MISSING = "unknown"
PRICE_ORDER = ("economy", "mid-range", "premium", "luxury")
MPG_WEIGHTS = {"city_mpg": 0.55, "highway_mpg": 0.45}

CARS = RawTable(
    name="automobiles_raw",
    columns=CAR_COLUMNS,
    types={**dict.fromkeys(CAR_INTS, "int"), **dict.fromkeys(CAR_DOUBLES, "double")},
    text=CAR_TEXT,
    source_file="automobiles.csv",
)
FUEL = RawTable(
    name="fuel_economy_raw",
    columns=FUEL_COLUMNS,
    types=dict.fromkeys(FUEL_INTS, "int"),
    text=("make",),
    masked=(),
    source_file="fuel_economy.csv",
)

PRICE_BY_MAKE = GoldTable(
    name="avg_price_by_make",
    keys=("make", "fe_market_segment"),
    where=lambda: F.col("price").isNotNull(),
    measures=(
        Measure("avg_price", "mean", "price", 0),
        Measure("min_price", "low", "price", 0),
        Measure("max_price", "high", "price", 0),
        Measure("total_models", "rows"),
        Measure("avg_horsepower", "mean", "horsepower", 0),
        Measure("avg_combined_mpg", "mean", "combined_mpg", 1),
        Measure("avg_popularity", "mean", "fe_popularity_score", 0),
        Measure("avg_safety_rating", "mean", "fe_safety_rating", 1),
    ),
    order=lambda: F.desc("avg_price"),
)
BODY_STYLES = GoldTable(
    name="body_style_summary",
    keys=("body_style",),
    measures=(
        Measure("total_autos", "rows"),
        Measure("avg_price", "mean", "price", 0),
        Measure("avg_weight_kg", "mean", "curb_weight", 0),
        Measure("avg_mpg", "mean", "combined_mpg", 1),
        Measure("avg_hp", "mean", "horsepower", 0),
        Measure("total_turbo", "true_rows", "is_turbo"),
    ),
    order=lambda: F.desc("total_autos"),
)
FUEL_RANKING = GoldTable(
    name="fuel_efficiency_ranking",
    keys=("make", "fuel_type"),
    where=lambda: F.col("combined_mpg").isNotNull(),
    measures=(
        Measure("avg_combined_mpg", "mean", "combined_mpg", 1),
        Measure("avg_city_mpg", "mean", "city_mpg", 1),
        Measure("avg_highway_mpg", "mean", "highway_mpg", 1),
        Measure("avg_co2_gkm", "mean", "fe_co2_emissions_gkm", 0),
        Measure("avg_fuel_cost_usd", "mean", "fe_fuel_cost_annual_usd", 0),
        Measure("num_models", "rows"),
    ),
    rank=RankBy("avg_combined_mpg", "efficiency_rank"),
    order=lambda: F.asc("efficiency_rank"),
)
PRICE_SEGMENTS = GoldTable(
    name="price_segment_analysis",
    keys=("price_category", "fe_market_segment"),
    where=lambda: F.col("price_category") != PRICE_MISSING,
    measures=(
        Measure("total_autos", "rows"),
        Measure("avg_price", "mean", "price", 0),
        Measure("avg_hp", "mean", "horsepower", 0),
        Measure("avg_mpg", "mean", "combined_mpg", 1),
        Measure("avg_engine_cc", "mean", "engine_size", 0),
        Measure("avg_safety", "mean", "fe_safety_rating", 1),
        Measure("avg_popularity", "mean", "fe_popularity_score", 0),
        Measure("pct_turbo", "true_percent", "is_turbo", 1),
    ),
    order=lambda: ordinal("price_category", PRICE_ORDER),
)

CAR_MARKET = Build(
    facts=CARS,
    dimension=FUEL,
    key="make",
    derived={
        "price_per_hp": partial(safe_ratio, "price", "horsepower", 2),
        "price_category": partial(band, "price", PRICE_CUTS, PRICE_TOP, PRICE_MISSING),
        "combined_mpg": partial(weighted_blend, MPG_WEIGHTS, 1),
        "is_turbo": partial(flag, "aspiration", "turbo"),
    },
    snapshot=lambda: F.col("model_year") == FUEL_YEAR,
    snapshot_drop=("model_year",),
    snapshot_rename={
        name: FUEL_PREFIX + name
        for name in FUEL_COLUMNS
        if name not in ("make", "model_year")
    },
    silver="automobiles_enriched",
    silver_dimension="fuel_economy",
    snapshot_columns=("model_year",),
    gold=(PRICE_BY_MAKE, BODY_STYLES, FUEL_RANKING, PRICE_SEGMENTS),
)


def csv_sources(spark: SparkSession, cars: str, fuel: str) -> dict[str, DataFrame]:
    """Raw frames for `run_layers` from the two CSV paths.

    The rows of a folder or pattern carry the path of their file.
    """

    def source(raw: RawTable, path: str) -> DataFrame:
        scan = read_raw_csv(spark, raw, path)
        one_file = path.lower().endswith(".csv") and "*" not in path
        return scan if one_file else scan.withColumn("_source_file", F.col("_metadata.file_path"))

    return {CARS.name: source(CARS, cars), FUEL.name: source(FUEL, fuel)}


def dashboard(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight panels, from the published gold tables by name."""
    prices = gold[PRICE_BY_MAKE.name]
    styles = gold[BODY_STYLES.name]
    ranking = gold[FUEL_RANKING.name]
    segments = gold[PRICE_SEGMENTS.name]
    return {
        "brands": panels.distinct_kpi(prices, "make", "brands"),
        "overall_price": panels.mean_kpi(prices, "avg_price", "overall_price"),
        "price_by_make": panels.bars(prices, "make", "avg_price", "fe_market_segment"),
        "body_styles": panels.donut(styles, "body_style", "total_autos"),
        "most_efficient": panels.top_bars(ranking, "make", "avg_combined_mpg", "fuel_type"),
        "co2_and_cost": panels.scatter(
            ranking, "avg_co2_gkm", "avg_fuel_cost_usd", "num_models", "make"
        ),
        "segments": panels.matrix(
            segments,
            "price_category",
            "total_autos",
            {"avg_price": 0, "avg_hp": 0, "avg_safety": 1, "pct_turbo": 1},
        ),
        "segment_volume": panels.treemap(segments, "price_category", "total_autos"),
    }
