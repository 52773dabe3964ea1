"""Order lines as the fact table and parts as the dimension.

The given tables are clean, so `raw_lines` first turns the lines into the kind
of text a raw load brings: numbers as strings, a masked null, padding.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import band, flag, safe_ratio, weighted_blend
from ..operators import (
    Measure,
    cast_columns,
    enrich_left,
    normalize_text,
    ordinal,
    sentinel_to_null,
)
from ..plans.gold import GoldTable, RankBy
from ..plans.layers import Build, RawTable, clean_dimension

# Shared with the SQL in `oracle.py`.
MASKED_LINE_NUMBER = 7
LINE_CUTS = ((27000, "economy"), (53000, "mid-range"), (79000, "premium"))
ORDER_CUTS = ((125000, "economy"), (250000, "mid-range"), (375000, "premium"))
BAND_TOP = "luxury"
BAND_MISSING = "unknown"
BAND_ORDER = ("economy", "mid-range", "premium", "luxury")
BLEND_WEIGHTS = {"qty": 0.55, "l_linenumber": 0.45}
DIMENSION_MAX_SIZE = 25
ROW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

GOLD_BY_KEY = GoldTable(
    name="price_by_supplier",
    keys=("l_suppkey", "d_type"),
    where=lambda: F.col("price").isNotNull(),
    measures=(
        Measure("avg_price", "mean", "price", 0),
        Measure("min_price", "low", "price", 0),
        Measure("max_price", "high", "price", 0),
        Measure("total_lines", "rows"),
        Measure("avg_qty", "mean", "qty", 0),
        Measure("avg_blended", "mean", "blended", 1),
        Measure("avg_retail", "mean", "d_retail", 0),
        Measure("avg_size", "mean", "d_size", 1),
    ),
    order=lambda: F.desc("avg_price"),
)
GOLD_BY_STYLE = GoldTable(
    name="flag_summary",
    keys=("flag",),
    measures=(
        Measure("total_lines", "rows"),
        Measure("avg_price", "mean", "price", 0),
        Measure("avg_unit_price", "mean", "unit_price", 0),
        Measure("avg_blended", "mean", "blended", 1),
        Measure("avg_qty", "mean", "qty", 0),
        Measure("total_open", "true_rows", "is_open"),
    ),
    order=lambda: F.desc("total_lines"),
)
EFFICIENCY_FACT_MEASURES = (
    Measure("avg_blended", "mean", "blended", 1),
    Measure("avg_qty", "mean", "qty", 1),
    Measure("avg_linenumber", "mean", "l_linenumber", 1),
    Measure("num_lines", "rows"),
)
GOLD_EFFICIENCY = GoldTable(
    name="blend_ranking",
    keys=("l_partkey", "l_linestatus"),
    where=lambda: F.col("blended").isNotNull(),
    measures=(
        *EFFICIENCY_FACT_MEASURES,
        Measure("avg_retail", "mean", "d_retail", 0),
        Measure("avg_size", "mean", "d_size", 0),
    ),
    rank=RankBy("avg_blended", "efficiency_rank"),
    order=lambda: F.asc("efficiency_rank"),
)
GOLD_BY_SEGMENT = GoldTable(
    name="band_analysis",
    keys=("band", "d_type"),
    where=lambda: F.col("band") != BAND_MISSING,
    measures=(
        Measure("total_lines", "rows"),
        Measure("avg_price", "mean", "price", 0),
        Measure("avg_qty", "mean", "qty", 0),
        Measure("avg_blended", "mean", "blended", 1),
        Measure("avg_unit_price", "mean", "unit_price", 0),
        Measure("avg_size", "mean", "d_size", 1),
        Measure("avg_retail", "mean", "d_retail", 0),
        Measure("pct_open", "true_percent", "is_open", 1),
    ),
    order=lambda: ordinal("band", BAND_ORDER),
)

LINES = Build(
    facts=RawTable(
        name="lines_raw",
        columns=(*ROW_KEYS, "qty", "price", "flag", "l_linestatus"),
        types={
            "l_orderkey": "bigint",
            "l_linenumber": "int",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "qty": "int",
            "price": "double",
        },
        text=("flag",),
        source_file="lines.csv",
    ),
    dimension=RawTable(
        name="parts_raw",
        columns=("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        types={"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"},
        text=(),
        masked=(),
        declared=False,
    ),
    key="l_partkey",
    dimension_key="p_partkey",
    derived={
        "unit_price": partial(safe_ratio, "price", "qty", 2),
        "band": partial(band, "price", LINE_CUTS, BAND_TOP, BAND_MISSING),
        "blended": partial(weighted_blend, BLEND_WEIGHTS, 1),
        "is_open": partial(flag, "l_linestatus", "O"),
    },
    snapshot=lambda: F.col("p_size") <= DIMENSION_MAX_SIZE,
    snapshot_drop=("p_name", "p_brand"),
    snapshot_rename={"p_type": "d_type", "p_retailprice": "d_retail", "p_size": "d_size"},
    silver="lines_enriched",
    silver_dimension="parts",
    snapshot_columns=("p_size",),
    gold=(GOLD_BY_KEY, GOLD_BY_STYLE, GOLD_EFFICIENCY, GOLD_BY_SEGMENT),
)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("l_linenumber") == MASKED_LINE_NUMBER, "?").otherwise(
        F.col("l_extendedprice").cast("string")
    )
    return given(spark, sf_dir, "lineitem").select(
        *ROW_KEYS,
        F.col("l_quantity").cast("int").cast("string").alias("qty_s"),
        price.alias("price_s"),
        F.concat(F.lit(" "), "l_returnflag", F.lit(" ")).alias("flag_s"),
        "l_linestatus",
    )


def named_lines(raw: DataFrame) -> DataFrame:
    """Raw lines under the column names of the build."""
    return raw.withColumnsRenamed({"qty_s": "qty", "price_s": "price", "flag_s": "flag"})


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        named_lines(raw_lines(spark, sf_dir))
        .transform(sentinel_to_null)
        .transform(cast_columns, {"qty": "int", "price": "double"})
        .transform(normalize_text, ["flag"])
    )


def with_derived(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumns({name: make() for name, make in LINES.derived.items()})


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_derived(clean_lines(spark, sf_dir))


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_dimension(given(spark, sf_dir, "part"), LINES)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_left(line_facts(spark, sf_dir), part_dim(spark, sf_dir), LINES.key)
