"""One query per operator; each reads the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import band, normalized, round_mean
from ..operators import (
    Measure,
    cast_columns,
    count_rejects,
    dedupe,
    dedupe_audit,
    dedupe_by_fingerprint,
    enrich_left,
    first_rows,
    frequent_keys,
    global_rank,
    ordinal,
    rejected_values,
    sentinel_to_null,
    summarize,
    top_k,
)
from ..plans import panels
from ..plans.gold import GoldTable, build_gold, build_gold_tables, read_gold
from ..plans.layers import Layers, build_silver, join_side, read_raw_csv, run_layers
from ..session import materialize, scratch_path
from ..sinks import Layout, publish
from ..sources import (
    count_malformed,
    read_csv_declared,
    read_csv_flagged,
    read_csv_strings,
    read_layer,
    read_table,
    with_bronze_audit,
    with_gold_audit,
    with_silver_audit,
)
from .lines import (
    BAND_MISSING,
    BAND_ORDER,
    BAND_TOP,
    EFFICIENCY_FACT_MEASURES,
    GOLD_BY_KEY,
    GOLD_BY_SEGMENT,
    GOLD_BY_STYLE,
    GOLD_EFFICIENCY,
    LINES,
    ORDER_CUTS,
    ROW_KEYS,
    clean_lines,
    enriched,
    given,
    line_facts,
    named_lines,
    part_dim,
    raw_lines,
    with_derived,
)

Query = Callable[[SparkSession, str], DataFrame]


# --- sources and sinks ------------------------------------------------------


def write_csv(df: DataFrame, label: str) -> str:
    """A raw CSV drop made from a given table, padding kept."""
    path = scratch_path(df.sparkSession, label)
    (
        df.select(*[F.col(name).cast("string") for name in df.columns])
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def fresh_layer(spark: SparkSession) -> tuple[str, str]:
    """A schema name and folder of their own for one run."""
    name = f"orefold_{uuid.uuid4().hex[:12]}"
    return name, scratch_path(spark, name)


def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_strings(spark, write_csv(given(spark, sf_dir, "orders"), "orders-csv"))


def csv_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer")
    return read_csv_declared(spark, write_csv(customer, "customer-csv"), customer.columns)


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer, folder = fresh_layer(spark)
    part = given(spark, sf_dir, "part")
    publish(part, layer, "part", location=folder)
    wider = part.withColumn("p_large", F.col("p_size") > 25)
    publish(wider, layer, "part", location=folder)
    return read_table(spark, f"{layer}.part")


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = with_bronze_audit(given(spark, sf_dir, "supplier"), "supplier.csv")
    audited = bronze.transform(with_silver_audit).transform(with_gold_audit)
    stamps = ["_ingestion_timestamp", "_silver_timestamp", "_gold_timestamp"]
    stamped = F.lit(True)
    for name in stamps:
        stamped = stamped & F.col(name).isNotNull()
    return audited.withColumn("stamped", stamped).drop(*stamps)


def rewrite_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer, folder = fresh_layer(spark)
    spark.sql(f"CREATE SCHEMA {layer} LOCATION '{folder}'")
    name = f"{layer}.customer"
    given(spark, sf_dir, "customer").write.saveAsTable(name)
    audited = with_bronze_audit(read_table(spark, name), "customer.csv")
    publish(audited, layer, "customer")
    return read_table(spark, name).drop("_ingestion_timestamp")


# --- cleaning ---------------------------------------------------------------


def sentinel_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentinel_to_null(raw_lines(spark, sf_dir))


def sentinel_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentinel_to_null(raw_lines(spark, sf_dir), ["price_s"]).select(*ROW_KEYS, "price_s")


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(spark, sf_dir).select(*ROW_KEYS, "qty", "price")


# The masked prices are still in: they are what a lenient cast rejects.
_RAW_TYPES = {"qty_s": "int", "price_s": "double"}


def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_columns(raw_lines(spark, sf_dir), _RAW_TYPES, lenient=True)


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rejects(raw_lines(spark, sf_dir), _RAW_TYPES)


def rejected_raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each malformed value with the row it stands in."""

    def of_row(name: str) -> Column:
        return F.get_json_object("row", f"$.{name}")

    rejected = rejected_values(raw_lines(spark, sf_dir), _RAW_TYPES, ["l_orderkey"])
    return rejected.select(
        "l_orderkey", of_row("l_linenumber").cast("int").alias("l_linenumber"), "column", "value", of_row("qty_s").alias("qty_s")
    )


def normalize_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    return (
        given(spark, sf_dir, "events")
        .groupBy(normalized(padded).alias("event_type_clean"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        given(spark, sf_dir, "documents")
        .select(normalized(F.col("text")).alias("text"), "lang")
        .transform(dedupe)
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("distinct_texts"))
    )


def dedupe_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    kept = dedupe_by_fingerprint(rows)
    return kept.select(F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


def dedupe_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


def dedupe_line_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_audit(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer, folder = fresh_layer(spark)
    published = publish(given(spark, sf_dir, "lineitem"), layer, "lineitem", location=folder)
    return spark.range(1).select(F.lit(published.rows).cast("bigint").alias("rows_written"))


# --- filters and derived columns --------------------------------------------


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = line_facts(spark, sf_dir)
    return facts.filter(F.col("price").isNotNull()).select(*ROW_KEYS, "price")


def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


def filter_not_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = line_facts(spark, sf_dir)
    return facts.filter(F.col("band") != BAND_MISSING).select(*ROW_KEYS, "band")


def _derived(column: str) -> Query:
    return lambda spark, sf_dir: line_facts(spark, sf_dir).select(*ROW_KEYS, column)


def order_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = band("o_totalprice", ORDER_CUTS, BAND_TOP, BAND_MISSING)
    return given(spark, sf_dir, "orders").select("o_orderkey", made.alias("band"))


# --- enrichment -------------------------------------------------------------


def enrich_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = given(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return enrich_left(facts, part_dim(spark, sf_dir), LINES.key).drop("d_retail")


def enrich_lines_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = given(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    dim = part_dim(spark, sf_dir)
    return enrich_left(facts, dim, LINES.key, salt_buckets=16).drop("d_retail")


def enrich_lines_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salted by the keys that were observed while the lines were published."""
    layer, folder = fresh_layer(spark)
    lines = given(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    seen = Observation()
    publish(lines.observe(seen, frequent_keys(F.col("l_partkey"), 100).alias("frequent")), layer, "lines", location=folder)
    hot = [row["item"] for row in seen.get["frequent"] if row["item"] is not None]
    facts = read_table(spark, f"{layer}.lines")
    return enrich_left(facts, part_dim(spark, sf_dir), LINES.key, salt_buckets=16, hot=hot).drop("d_retail")


def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = named_lines(raw_lines(spark, sf_dir))
    silver = build_silver(raw, given(spark, sf_dir, "part"), LINES)
    return silver.drop("_silver_timestamp")


def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV drop of the orders in which some rows have a field too many or too few."""
    fields = ["o_orderkey", "o_custkey", "o_orderstatus"]
    parts = [F.col(name).cast("string") for name in fields]
    line = (
        F.when(F.col("o_orderkey") % 7 == 0, F.concat_ws(",", *parts, F.lit("extra")))
        .when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", *parts[:2]))
        .otherwise(F.concat_ws(",", *parts))
    )
    path = scratch_path(spark, "ragged-csv")
    raw = given(spark, sf_dir, "orders").select(line.alias(",".join(fields)))
    raw.write.option("header", True).option("sep", "\u0001").csv(path)
    return count_malformed(read_csv_flagged(spark, path, fields))


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of several folders of files each row came from."""
    path = scratch_path(spark, "supplier-drops")
    drops = given(spark, sf_dir, "supplier").select("s_suppkey", "s_name", (F.col("s_suppkey") % 3).alias("drop"))
    drops.write.option("header", True).partitionBy("drop").csv(path)
    scan = read_csv_strings(spark, [f"{path}/drop={i}" for i in range(3)])
    audited = with_bronze_audit(scan)
    return audited.select(
        "s_suppkey", "s_name", F.regexp_extract("_source_file", "drop=([0-9]+)/", 1).alias("source_drop"), "_source_layer"
    )


# --- gold -------------------------------------------------------------------


def gold_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(enriched(spark, sf_dir), GOLD_BY_KEY)


def gold_by_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(enriched(spark, sf_dir), GOLD_BY_STYLE)


def _efficiency_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of the ranking, still without rank.

    The group key contains the dimension key, so each group has one dimension
    row: aggregating first and joining the groups gives the same table, and a
    hot part key is reduced to a few rows before any shuffle.
    """
    facts = line_facts(spark, sf_dir).filter(GOLD_EFFICIENCY.where())
    groups = summarize(facts, GOLD_EFFICIENCY.keys, EFFICIENCY_FACT_MEASURES)
    dim = part_dim(spark, sf_dir).select(
        "l_partkey",
        round_mean(F.col("d_retail"), 0).alias("avg_retail"),
        round_mean(F.col("d_size").cast("double"), 0).alias("avg_size"),
    )
    return enrich_left(groups, dim, LINES.key)


def gold_efficiency_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = build_gold(enriched(spark, sf_dir), GOLD_EFFICIENCY)
    return ranked.orderBy(GOLD_EFFICIENCY.rank.name, *GOLD_EFFICIENCY.keys)


def gold_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(enriched(spark, sf_dir), GOLD_BY_SEGMENT)


def gold_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables whose keys make few groups, from one scan, summed up before they are told apart."""
    gold = build_gold_tables(enriched(spark, sf_dir), (GOLD_BY_STYLE, GOLD_BY_SEGMENT), pre_aggregate=True)
    return gold[GOLD_BY_SEGMENT.name]


def gold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier table over enriched lines stored in buckets by supplier."""
    layer, folder = fresh_layer(spark)
    by_supplier = Layout(bucket_by=["l_suppkey"], buckets=16, sort_by=["l_suppkey"])
    publish(enriched(spark, sf_dir), layer, "lines", location=folder, layout=by_supplier)
    return build_gold(read_table(spark, f"{layer}.lines"), GOLD_BY_KEY)


def exact_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values whose sums leave the whole numbers that a double can hold."""
    lines = given(spark, sf_dir, "lineitem")
    large = lines.select("l_returnflag", (F.rint(F.col("l_extendedprice") * 100) * 1e7).alias("large"))
    return summarize(large, ["l_returnflag"], [Measure("mean_large", "mean", "large", 1), Measure("total_lines", "rows")])


def pct_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = next(m for m in GOLD_BY_SEGMENT.measures if m.name == "pct_open")
    return summarize(enriched(spark, sf_dir), ["l_suppkey"], [percent])


def rank_all_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced_qty = F.when(F.col("price").isNotNull(), F.col("qty"))
    groups = (
        clean_lines(spark, sf_dir)
        .groupBy("l_partkey", "flag")
        .agg(round_mean(F.avg(priced_qty), 1).alias("score"))
    )
    return global_rank(materialize(groups, "score-groups"), "score", "score_rank")


def rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score without bound or rounding, over every order."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(orders, "o_totalprice", "price_rank", "bigint")


def business_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = ordinal("band", BAND_ORDER).alias("band_order")
    placed = gold_by_segment(spark, sf_dir).select("band", "d_type", place)
    return placed.orderBy("band_order", "d_type")


# --- dashboard panels -------------------------------------------------------


def topk_efficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _efficiency_groups(spark, sf_dir)
    return panels.top_bars(groups, "l_partkey", "avg_blended", "l_linestatus", 10)


def kpi_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.distinct_kpi(gold_by_key(spark, sf_dir), "l_suppkey", "suppliers")


def kpi_mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.mean_kpi(gold_by_key(spark, sf_dir), "avg_price", "overall_price")


def panel_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.bars(gold_by_key(spark, sf_dir), "l_suppkey", "avg_price", "d_type")


def panel_donut(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = materialize(gold_by_style(spark, sf_dir), GOLD_BY_STYLE.name)
    return panels.donut(gold, "flag", "total_lines")


def panel_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _efficiency_groups(spark, sf_dir)
    return panels.scatter(groups, "avg_retail", "avg_size", "num_lines", "l_partkey")


def panel_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"avg_price": 0, "avg_qty": 0, "avg_size": 1, "pct_open": 1}
    return panels.matrix(gold_by_segment(spark, sf_dir), "band", "total_lines", values)


def panel_treemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.treemap(gold_by_segment(spark, sf_dir), "band", "total_lines")


def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The order uses cleaned columns only, so the ten rows are picked before the
    # derived columns and the join, which neither drop nor repeat rows.
    order = [*ROW_KEYS, "price", "qty", "flag", "l_linestatus"]
    picked = with_derived(top_k(clean_lines(spark, sf_dir), order, 10))
    shown = [*ROW_KEYS, "price", "band", "blended", "is_open", "d_type", "d_size"]
    return first_rows(enrich_left(picked, part_dim(spark, sf_dir), LINES.key), shown, 10)


# --- everything in one run --------------------------------------------------


def layered_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to published gold; returns the published band analysis."""
    lines = write_csv(named_lines(raw_lines(spark, sf_dir)), "lines-csv")
    parts = write_csv(given(spark, sf_dir, "part"), "parts-csv")
    sources = {
        LINES.facts.name: read_raw_csv(spark, LINES.facts, lines),
        LINES.dimension.name: read_raw_csv(spark, LINES.dimension, parts),
    }
    run, folder = fresh_layer(spark)
    layers = Layers(f"{run}_bronze", f"{run}_silver", f"{run}_gold", location=folder)
    run_layers(spark, LINES, sources, layers)
    return read_gold(spark, layers.gold, GOLD_BY_SEGMENT).drop("_gold_timestamp")


_built: dict[tuple[str, str], Layers] = {}


def built_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The published layers of one `run_layers`, shared by the queries below."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        lines = write_csv(named_lines(raw_lines(spark, sf_dir)), "lines-csv")
        parts = write_csv(given(spark, sf_dir, "part"), "parts-csv")
        sources = {
            LINES.facts.name: read_raw_csv(spark, LINES.facts, lines),
            LINES.dimension.name: read_raw_csv(spark, LINES.dimension, parts),
        }
        run, folder = fresh_layer(spark)
        layers = Layers(f"{run}_bronze", f"{run}_silver", f"{run}_gold", location=folder)
        run_layers(spark, LINES, sources, layers)
        _built[key] = layers
    return _built[key]


def built_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = built_layers(spark, sf_dir)
    return read_table(spark, f"{layers.silver}.{LINES.silver}").drop("_silver_timestamp")


def _built_gold(table: GoldTable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = built_layers(spark, sf_dir).gold
        return read_gold(spark, gold, table).drop("_gold_timestamp")

    return query


def stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What facts join to, from the typed dimension of a build."""
    layers = built_layers(spark, sf_dir)
    return join_side(read_table(spark, f"{layers.silver}.{LINES.silver_dimension}"), LINES)


def committed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each gold table of one commit."""
    tables = read_layer(spark, built_layers(spark, sf_dir).gold)
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.union, counts)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lenient build lists beside Silver if the mask is not known as one."""
    lines = write_csv(named_lines(raw_lines(spark, sf_dir)), "lines-csv")
    parts = write_csv(given(spark, sf_dir, "part"), "parts-csv")
    build = replace(LINES, sentinel="masked", gold=())
    sources = {
        LINES.facts.name: read_raw_csv(spark, LINES.facts, lines),
        LINES.dimension.name: read_raw_csv(spark, LINES.dimension, parts),
    }
    run, folder = fresh_layer(spark)
    layers = Layers(f"{run}_bronze", f"{run}_silver", f"{run}_gold", location=folder)
    run_layers(spark, build, sources, layers, max_rejects=2**62)
    rejects = read_table(spark, f"{layers.silver}.{build.rejects}")
    keys = [F.get_json_object("row", f"$.{name}").cast("bigint").alias(name) for name in ("l_orderkey", "l_linenumber")]
    return rejects.select("source_table", *keys, "column", "value", "_source_file")


def rebuilt_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of a second run whose sources are the Bronze tables of the first."""
    first = built_layers(spark, sf_dir)
    names = (LINES.facts.name, LINES.dimension.name)
    sources = {name: read_table(spark, f"{first.bronze}.{name}") for name in names}
    run, folder = fresh_layer(spark)
    layers = Layers(f"{run}_bronze", f"{run}_silver", f"{run}_gold", location=folder)
    run_layers(spark, LINES, sources, layers)
    return read_table(spark, f"{layers.silver}.{LINES.silver}").drop("_silver_timestamp")


QUERIES: dict[str, Query] = {
    "q01_csv_header_scan": csv_header_scan,
    "q02_csv_schema_scan": csv_schema_scan,
    "q02b_ragged_rows": ragged_rows,
    "q03_publish_roundtrip": publish_roundtrip,
    "q04_audit_columns": audit_columns,
    "q04b_source_lineage": source_lineage,
    "q05_rewrite_in_place": rewrite_in_place,
    "q06_sentinel_to_null": sentinel_all_strings,
    "q06b_sentinel_listed": sentinel_listed,
    "q07_typed_cast": typed_cast,
    "q07b_lenient_cast": lenient_cast,
    "q07c_cast_rejects": cast_rejects,
    "q07d_rejected_values": rejected_raw_values,
    "q08_normalize_text": normalize_event_types,
    "q09_dedupe_rows": dedupe_documents,
    "q09b_dedupe_line_keys": dedupe_line_keys,
    "q09c_dedupe_wide": dedupe_wide_rows,
    "q10_dedupe_audit": dedupe_line_audit,
    "q10b_observed_count": observed_count,
    "q11_filter_not_null": filter_not_null,
    "q12_filter_equals": filter_equals,
    "q13_filter_not_equals": filter_not_equals,
    "q14_unit_price": _derived("unit_price"),
    "q15_price_band": _derived("band"),
    "q15b_order_band": order_band,
    "q16_blended_score": _derived("blended"),
    "q17_open_flag": _derived("is_open"),
    "q18_dim_snapshot": part_dim,
    "q19_enrich_left": enrich_lines,
    "q19b_enrich_left_salted": enrich_lines_salted,
    "q19c_enrich_left_sketched": enrich_lines_sketched,
    "q20_silver_enriched": silver_enriched,
    "q21_gold_by_key": gold_by_key,
    "q21b_gold_bucketed": gold_bucketed,
    "q22_gold_by_style": gold_by_style,
    "q22b_exact_means": exact_means,
    "q23_gold_efficiency_rank": gold_efficiency_rank,
    "q24_gold_by_segment": gold_by_segment,
    "q24b_gold_together": gold_together,
    "q25_pct_flag": pct_flag,
    "q26_global_rank": rank_all_groups,
    "q26b_rank_orders": rank_orders,
    "q27_business_order": business_order,
    "q28_topk_efficient": topk_efficient,
    "q29_kpi_distinct": kpi_distinct,
    "q30_kpi_mean_of_means": kpi_mean_of_means,
    "q31_bar": panel_bars,
    "q32_donut": panel_donut,
    "q33_scatter": panel_scatter,
    "q34_matrix": panel_matrix,
    "q35_treemap": panel_treemap,
    "q36_sample_limit": sample_limit,
    "q37_layered_build": layered_build,
    "q37a_built_silver": built_silver,
    "q37b_built_by_key": _built_gold(GOLD_BY_KEY),
    "q37c_built_by_style": _built_gold(GOLD_BY_STYLE),
    "q37d_built_ranking": _built_gold(GOLD_EFFICIENCY),
    "q37e_built_by_segment": _built_gold(GOLD_BY_SEGMENT),
    "q37f_rebuilt_from_bronze": rebuilt_from_bronze,
    "q37g_quarantine": quarantine,
    "q37h_committed_rows": committed_rows,
    "q37i_stored_snapshot": stored_snapshot,
}
