"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations


def _mean(expr: str, digits: int) -> str:
    """Rounding of averages: settle at eight decimals, then half up."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def _exact(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal print of one double."""
    text = f"CAST({expr} AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _band(column: str, cuts: tuple[int, int, int]) -> str:
    return f"""CASE WHEN {column} < {cuts[0]} THEN 'economy'
      WHEN {column} < {cuts[1]} THEN 'mid-range'
      WHEN {column} < {cuts[2]} THEN 'premium'
      WHEN {column} IS NOT NULL THEN 'luxury' ELSE 'unknown' END"""


_VIEWS = f"""
WITH raw_lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty_s,
    CASE WHEN l_linenumber = 7 THEN '?'
      ELSE CAST(l_extendedprice AS VARCHAR) END AS price_s,
    ' ' || l_returnflag || ' ' AS flag_s,
    l_linestatus
  FROM lineitem
), clean_lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(nullif(qty_s, '?') AS INTEGER) AS qty,
    CAST(nullif(price_s, '?') AS DOUBLE) AS price,
    lower(trim(flag_s)) AS flag,
    l_linestatus
  FROM raw_lines
), line_facts AS (
  SELECT *,
    CASE WHEN qty > 0 THEN {_exact("price / CAST(qty AS DOUBLE)", 2)} END AS unit_price,
    {_band("price", (27000, 53000, 79000))} AS band,
    {_exact("qty * CAST(0.55 AS DOUBLE) + l_linenumber * CAST(0.45 AS DOUBLE)", 1)} AS blended,
    coalesce(l_linestatus = 'O', false) AS is_open
  FROM clean_lines
), part_dim AS (
  SELECT p_partkey AS l_partkey, p_type AS d_type, p_size AS d_size,
    p_retailprice AS d_retail
  FROM part WHERE p_size <= 25
), enriched AS (
  SELECT f.*, d_type, d_size, d_retail
  FROM line_facts f LEFT JOIN part_dim d ON f.l_partkey = d.l_partkey
), gold_by_key AS (
  SELECT l_suppkey, d_type,
    {_mean("avg(price)", 0)} AS avg_price,
    {_exact("min(price)", 0)} AS min_price,
    {_exact("max(price)", 0)} AS max_price,
    count(*) AS total_lines,
    {_mean("avg(qty)", 0)} AS avg_qty,
    {_mean("avg(blended)", 1)} AS avg_blended,
    {_mean("avg(d_retail)", 0)} AS avg_retail,
    {_mean("avg(d_size)", 1)} AS avg_size
  FROM enriched WHERE price IS NOT NULL GROUP BY l_suppkey, d_type
), gold_by_style AS (
  SELECT flag, count(*) AS total_lines,
    {_mean("avg(price)", 0)} AS avg_price,
    {_mean("avg(unit_price)", 0)} AS avg_unit_price,
    {_mean("avg(blended)", 1)} AS avg_blended,
    {_mean("avg(qty)", 0)} AS avg_qty,
    CAST(sum(CAST(is_open AS INTEGER)) AS BIGINT) AS total_open
  FROM enriched GROUP BY flag
), efficiency_groups AS (
  SELECT l_partkey, l_linestatus,
    {_mean("avg(blended)", 1)} AS avg_blended,
    {_mean("avg(qty)", 1)} AS avg_qty,
    {_mean("avg(l_linenumber)", 1)} AS avg_linenumber,
    {_mean("avg(d_retail)", 0)} AS avg_retail,
    {_mean("avg(d_size)", 0)} AS avg_size,
    count(*) AS num_lines
  FROM enriched WHERE blended IS NOT NULL GROUP BY l_partkey, l_linestatus
), gold_efficiency AS (
  SELECT *, CAST(rank() OVER (ORDER BY avg_blended DESC NULLS LAST) AS INTEGER)
    AS efficiency_rank
  FROM efficiency_groups
), gold_by_segment AS (
  SELECT band, d_type, count(*) AS total_lines,
    {_mean("avg(price)", 0)} AS avg_price,
    {_mean("avg(qty)", 0)} AS avg_qty,
    {_mean("avg(blended)", 1)} AS avg_blended,
    {_mean("avg(unit_price)", 0)} AS avg_unit_price,
    {_mean("avg(d_size)", 1)} AS avg_size,
    {_mean("avg(d_retail)", 0)} AS avg_retail,
    {_mean("sum(CAST(is_open AS INTEGER)) * CAST(100.0 AS DOUBLE) / count(*)", 1)} AS pct_open
  FROM enriched WHERE band <> 'unknown' GROUP BY band, d_type
)
"""

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _rolled(column: str, digits: int) -> str:
    weight = f"CASE WHEN {column} IS NOT NULL THEN total_lines END"
    mean = f"sum({column} * total_lines) / CAST(sum({weight}) AS DOUBLE)"
    return f"{_mean(mean, digits)} AS {column}"


# Without views in front.
_PLAIN = {
    "q01_csv_header_scan": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  CAST(o_orderdate AS VARCHAR) AS o_orderdate,
  o_orderpriority
FROM orders""",
    "q02_csv_schema_scan": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""",
    "q03_publish_roundtrip": "SELECT *, p_size > 25 AS p_large FROM part",
    "q04_audit_columns": """
SELECT *, 'supplier.csv' AS _source_file, 'raw' AS _source_layer,
  '1.0' AS _silver_version, true AS stamped
FROM supplier""",
    "q05_rewrite_in_place": """
SELECT *, 'customer.csv' AS _source_file, 'raw' AS _source_layer FROM customer""",
    "q08_normalize_text": """
SELECT lower(trim('  ' || upper(event_type) || ' ')) AS event_type_clean,
  count(*) AS n
FROM events GROUP BY 1""",
    "q09_dedupe_rows": """
SELECT lang, count(*) AS distinct_texts
FROM (SELECT DISTINCT lower(trim(text)) AS text, lang FROM documents)
GROUP BY lang""",
    "q09b_dedupe_line_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "q10_dedupe_audit": """
SELECT CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_after,
  CAST(sum(copies) - count(*) AS BIGINT) AS rows_removed
FROM (SELECT count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "q10b_observed_count": "SELECT count(*) AS rows_written FROM lineitem",
    "q12_filter_equals": """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "q15b_order_band": f"""
SELECT o_orderkey, {_band("o_totalprice", (125000, 250000, 375000))} AS band
FROM orders""",
}

# On top of the views.
_ON_VIEWS = {
    "q06_sentinel_to_null": f"""
SELECT {_KEYS}, nullif(qty_s, '?') AS qty_s, nullif(price_s, '?') AS price_s,
  nullif(flag_s, '?') AS flag_s, nullif(l_linestatus, '?') AS l_linestatus
FROM raw_lines""",
    "q06b_sentinel_listed": f"""
SELECT {_KEYS}, nullif(price_s, '?') AS price_s FROM raw_lines""",
    "q07_typed_cast": f"SELECT {_KEYS}, qty, price FROM clean_lines",
    "q07b_lenient_cast": f"""
SELECT {_KEYS}, TRY_CAST(qty_s AS INTEGER) AS qty_s,
  TRY_CAST(price_s AS DOUBLE) AS price_s, flag_s, l_linestatus
FROM raw_lines""",
    "q07c_cast_rejects": """
SELECT
  count(*) FILTER (WHERE qty_s IS NOT NULL AND TRY_CAST(qty_s AS INTEGER) IS NULL) AS qty_s,
  count(*) FILTER (WHERE price_s IS NOT NULL AND TRY_CAST(price_s AS DOUBLE) IS NULL) AS price_s
FROM raw_lines""",
    "q11_filter_not_null": f"SELECT {_KEYS}, price FROM line_facts WHERE price IS NOT NULL",
    "q13_filter_not_equals": f"SELECT {_KEYS}, band FROM line_facts WHERE band <> 'unknown'",
    "q14_unit_price": f"SELECT {_KEYS}, unit_price FROM line_facts",
    "q15_price_band": f"SELECT {_KEYS}, band FROM line_facts",
    "q16_blended_score": f"SELECT {_KEYS}, blended FROM line_facts",
    "q17_open_flag": f"SELECT {_KEYS}, is_open FROM line_facts",
    "q18_dim_snapshot": "SELECT * FROM part_dim",
    "q19_enrich_left": """
SELECT l_partkey, l_orderkey, l_linenumber, d_type, d_size FROM enriched""",
    "q19b_enrich_left_salted": """
SELECT l_partkey, l_orderkey, l_linenumber, d_type, d_size FROM enriched""",
    "q20_silver_enriched": "SELECT DISTINCT *, '1.0' AS _silver_version FROM enriched",
    "q21_gold_by_key": "SELECT * FROM gold_by_key",
    "q22_gold_by_style": "SELECT * FROM gold_by_style",
    "q23_gold_efficiency_rank": "SELECT * FROM gold_efficiency",
    "q24_gold_by_segment": "SELECT * FROM gold_by_segment",
    "q25_pct_flag": f"""
SELECT l_suppkey,
  {_mean("sum(CAST(is_open AS INTEGER)) * CAST(100.0 AS DOUBLE) / count(*)", 1)} AS pct_open
FROM enriched GROUP BY l_suppkey""",
    "q26_global_rank": f"""
SELECT *, CAST(rank() OVER (ORDER BY score DESC NULLS LAST) AS INTEGER) AS score_rank
FROM (
  SELECT l_partkey, flag,
    {_mean("avg(CASE WHEN price IS NOT NULL THEN qty END)", 1)} AS score
  FROM clean_lines GROUP BY l_partkey, flag)""",
    "q27_business_order": """
SELECT band, d_type, CAST(CASE band WHEN 'economy' THEN 1 WHEN 'mid-range' THEN 2
  WHEN 'premium' THEN 3 WHEN 'luxury' THEN 4 ELSE 5 END AS INTEGER) AS band_order
FROM gold_by_segment""",
    "q28_topk_efficient": """
SELECT l_partkey, avg_blended, l_linestatus FROM gold_efficiency
ORDER BY avg_blended DESC NULLS LAST, l_partkey, l_linestatus LIMIT 10""",
    "q29_kpi_distinct": "SELECT count(DISTINCT l_suppkey) AS suppliers FROM gold_by_key",
    "q30_kpi_mean_of_means": f"""
SELECT {_mean("avg(avg_price)", 2)} AS overall_price FROM gold_by_key""",
    "q31_bar": "SELECT l_suppkey, avg_price, d_type FROM gold_by_key",
    "q32_donut": f"""
SELECT flag, total_lines,
  {_mean("total_lines * CAST(100.0 AS DOUBLE) / sum(total_lines) OVER ()", 2)} AS share_pct
FROM gold_by_style""",
    "q33_scatter": """
SELECT l_partkey, avg_retail, avg_size, num_lines FROM gold_efficiency
WHERE avg_retail IS NOT NULL AND avg_size IS NOT NULL""",
    "q34_matrix": f"""
SELECT band, {_rolled("avg_price", 0)}, {_rolled("avg_qty", 0)},
  {_rolled("avg_size", 1)}, {_rolled("pct_open", 1)}
FROM gold_by_segment GROUP BY band""",
    "q35_treemap": """
SELECT band, CAST(sum(total_lines) AS BIGINT) AS total_lines
FROM gold_by_segment GROUP BY band""",
    "q36_sample_limit": f"""
SELECT {_KEYS}, price, band, blended, is_open, d_type, d_size FROM enriched
ORDER BY {_KEYS}, price NULLS FIRST, qty, flag, l_linestatus LIMIT 10""",
    "q37_layered_build": """
SELECT band, d_type, total_lines, avg_price, avg_qty, avg_blended, avg_unit_price,
  avg_size, avg_retail, pct_open
FROM gold_by_segment""",
}

ORACLE: dict[str, str] = {
    **{name: sql.strip() for name, sql in _PLAIN.items()},
    **{name: f"{_VIEWS.strip()}\n{sql.strip()}" for name, sql in _ON_VIEWS.items()},
}

ORACLE |= {
    "q02b_ragged_rows": """
SELECT count(*) AS rows_read, count(*) FILTER (WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) AS rows_malformed
FROM orders""",
    "q04b_source_lineage": """
SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, (s_suppkey % 3)::VARCHAR AS source_drop, 'raw' AS _source_layer
FROM supplier""",
    "q26b_rank_orders": """
SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM orders""",
    "q37a_built_silver": ORACLE["q20_silver_enriched"],
    "q37b_built_by_key": ORACLE["q21_gold_by_key"],
    "q37c_built_by_style": ORACLE["q22_gold_by_style"],
    "q37d_built_ranking": ORACLE["q23_gold_efficiency_rank"],
    "q37e_built_by_segment": ORACLE["q24_gold_by_segment"],
    "q37f_rebuilt_from_bronze": ORACLE["q20_silver_enriched"],
}

ORACLE |= {
    "q07d_rejected_values": """
SELECT l_orderkey, l_linenumber, 'price_s' AS "column", '?' AS value, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty_s
FROM lineitem WHERE l_linenumber = 7""",
    "q09c_dedupe_wide": """
SELECT md5(text) AS text_md5, lang, source, n_chars FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)""",
    "q19c_enrich_left_sketched": ORACLE["q19_enrich_left"],
    "q21b_gold_bucketed": ORACLE["q21_gold_by_key"],
    "q22b_exact_means": """
SELECT l_returnflag, count(*) AS total_lines,
  round(CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT) * 10000000) AS DOUBLE) / count(*), 1) AS mean_large
FROM lineitem GROUP BY l_returnflag""",
    "q24b_gold_together": ORACLE["q24_gold_by_segment"],
    "q37g_quarantine": """
SELECT 'lines_raw' AS source_table, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, 'price' AS "column",
  '?' AS value, 'lines.csv' AS _source_file
FROM lineitem WHERE l_linenumber = 7""",
    "q37h_committed_rows": f"""{_VIEWS.strip()}
SELECT 'price_by_supplier' AS table_name, count(*) AS total_rows FROM gold_by_key
UNION ALL SELECT 'flag_summary', count(*) FROM gold_by_style
UNION ALL SELECT 'blend_ranking', count(*) FROM gold_efficiency
UNION ALL SELECT 'band_analysis', count(*) FROM gold_by_segment""",
    "q37i_stored_snapshot": ORACLE["q18_dim_snapshot"],
}
