"""Price and product queries over the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.functions.ids import PRODUCT_PREFIX, date_key, prefixed
from basketgraph.operators import orders as order_ops
from basketgraph.operators import prices as ops
from basketgraph.plans.registry import register
from basketgraph.sources import tables as tb

_OBS_SQL = """
    SELECT l_partkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS d,
           l_extendedprice / NULLIF(l_quantity, 0) AS price
    FROM lineitem
"""

_LATEST_SQL = f"""
    WITH obs AS ({_OBS_SQL}),
    per_day AS (SELECT k, d, MAX(price) AS price FROM obs WHERE price IS NOT NULL AND d IS NOT NULL GROUP BY k, d),
    last_day AS (SELECT k, MAX(d) AS d FROM per_day GROUP BY k)
    SELECT p.k, p.d, p.price FROM per_day p JOIN last_day l ON p.k = l.k AND p.d = l.d
"""


@register(
    "price_history",
    f"""
    SELECT 'P' || CAST(o.k AS VARCHAR) AS product_id, strftime(o.d, '%Y%m%d') AS date_id, o.price AS marketpriceEU
    FROM ({_OBS_SQL}) o JOIN part p ON p.p_partkey = o.k
    WHERE o.price IS NOT NULL AND o.d IS NOT NULL
    """,
    "J2",
)
def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.price_history(tb.price_observations(spark, sf_dir), tb.products(spark, sf_dir))


@register(
    "latest_price",
    f"""
    SELECT 'P' || CAST(l.k AS VARCHAR) AS product_id, p.p_name AS product_name,
           strftime(l.d, '%Y%m%d') AS date_id, l.price AS price
    FROM ({_LATEST_SQL}) l JOIN part p ON p.p_partkey = l.k
    """,
    "A7 J1",
)
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.latest_price(tb.price_observations(spark, sf_dir))
    prods = tb.products(spark, sf_dir)
    j = latest.join(prods.select("product_id", "product_name"), "product_id", "inner")
    return j.select(
        prefixed("product_id", PRODUCT_PREFIX).alias("product_id"),
        "product_name",
        date_key("price_date").alias("date_id"),
        "price",
    )


@register(
    "product_nodes",
    f"""
    WITH sold AS (
        SELECT DISTINCT l_partkey AS k FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IS NOT NULL)),
    sold_named AS (
        SELECT s.k, MIN(CASE WHEN length(trim(p.p_name)) > 0 THEN p.p_name END) AS description
        FROM sold s LEFT JOIN part p ON p.p_partkey = s.k GROUP BY s.k),
    market AS (
        SELECT l.k, p.p_name AS name, l.price FROM ({_LATEST_SQL}) l JOIN part p ON p.p_partkey = l.k)
    SELECT 'P' || CAST(s.k AS VARCHAR) AS product_id, COALESCE(m.name, s.description) AS nameproduct,
           COALESCE(m.price, 0.0) AS marketpriceEU
    FROM sold_named s LEFT JOIN market m ON m.k = s.k
    """,
    "A9 J4 X15 X16",
)
def product_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tb.invoice_lines(spark, sf_dir)
    invoices = tb.invoices(spark, sf_dir)
    prods = tb.products(spark, sf_dir)
    # Distinct sold stock codes first, then names: the join moves one row per product.
    sold_codes = order_ops.restrict_to_invoices(lines.select("invoice_no", "stock_code"), invoices).select("stock_code").distinct()
    named = sold_codes.join(
        prods.select(F.col("product_id").alias("stock_code"), F.col("product_name").alias("description")),
        "stock_code",
        "left",
    )
    sold = ops.sold_products(named)
    market = ops.market_products(ops.latest_price(tb.price_observations(spark, sf_dir)), prods)
    return ops.product_nodes(sold, market)


@register(
    "product_category",
    """
    SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, 'CAT_' || p_type AS category_id
    FROM part WHERE length(trim(p_type)) > 0
    """,
    "J3",
)
def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    prods = tb.products(spark, sf_dir)
    return ops.belongs_to_edges(prods, ops.category_nodes(prods))


@register(
    "category_nodes",
    "SELECT DISTINCT 'CAT_' || p_type AS category_id, p_type AS categoryname FROM part WHERE length(trim(p_type)) > 0",
    "S5 J3",
)
def category_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.category_nodes(tb.products(spark, sf_dir))
