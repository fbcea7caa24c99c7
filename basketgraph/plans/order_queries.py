"""Order-side queries over the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.operators import calendar
from basketgraph.operators import orders as ops
from basketgraph.plans.registry import register
from basketgraph.sources import tables as tb

# Invoice lines of invoices that have a customer (the CSV drops rows without one).
_LINES_SQL = """
    SELECT l.* FROM lineitem l
    WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IS NOT NULL)
"""

_PAIRS_SQL = """
    SELECT DISTINCT o_custkey, o_orderkey FROM orders
    WHERE o_custkey IS NOT NULL AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
"""


@register(
    "order_totals",
    f"""
    SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS order_id,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * CAST(0.9 AS DECIMAL(2,1)) AS DOUBLE) AS total_cost,
           CAST(3.0 AS DOUBLE) AS delivery
    FROM ({_LINES_SQL}) t GROUP BY l_orderkey
    """,
    "S1 A1 X2 F5",
)
def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = ops.order_summary(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.order_nodes(summary)


@register(
    "order_latest_date",
    f"""
    SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS order_id, strftime(MAX(l_shipdate), '%Y%m%d') AS date_id
    FROM ({_LINES_SQL}) t GROUP BY l_orderkey
    """,
    "A2 X4",
)
def order_latest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = ops.order_summary(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.in_date_edges(summary)


@register(
    "order_contains",
    f"""
    SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS order_id, 'P' || CAST(l_partkey AS VARCHAR) AS product_id,
           l_linenumber AS line_no, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice / l_quantity AS unitprice, (l_extendedprice / l_quantity) * 0.9 AS costprice
    FROM ({_LINES_SQL}) t
    """,
    "P1 P2 X2",
)
def order_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.contains_edges(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))


@register(
    "customer_orders",
    f"""
    SELECT 'C' || CAST(o_custkey AS VARCHAR) AS customer_id, 'O' || CAST(o_orderkey AS VARCHAR) AS order_id
    FROM ({_PAIRS_SQL}) t
    """,
    "A4 P2",
)
def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.buys_edges(pairs)


@register(
    "distinct_orders",
    f"SELECT DISTINCT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id FROM ({_PAIRS_SQL}) t",
    "A3",
)
def distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.distinct_orders(pairs)


@register(
    "distinct_customers",
    f"SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS customer_id FROM ({_PAIRS_SQL}) t",
    "A5",
)
def distinct_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.distinct_customers(pairs)


@register(
    "customer_segments",
    f"""
    SELECT 'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE WHEN COUNT(*) <= 1 THEN 'S1' WHEN COUNT(*) <= 5 THEN 'S2' ELSE 'S3' END AS segment_id,
           COUNT(*) AS n_orders
    FROM ({_PAIRS_SQL}) t GROUP BY o_custkey
    """,
    "A6 C1",
)
def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.customer_segments(pairs)


@register(
    "date_nodes",
    """
    WITH refs AS (
        SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
        UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem
        UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders),
    b AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM refs),
    days AS (SELECT CAST(g.generate_series AS DATE) AS day FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) g)
    SELECT strftime(day, '%Y%m%d') AS id, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,
           CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day,
           CAST(dayofyear(day) AS INTEGER) AS day_of_year, CAST(week(day) AS INTEGER) AS iso_week,
           CAST(isodow(day) AS INTEGER) AS iso_weekday, isodow(day) >= 6 AS is_weekend,
           monthname(day) AS month_name, dayname(day) AS day_name
    FROM days
    """,
    "date label (S10)",
)
def date_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day referenced by in_date (line dates), price_in_date (price months) and feedback (order dates)."""
    li = tb.table(spark, sf_dir, "lineitem").select("l_shipdate")
    refs = (
        li.select(F.col("l_shipdate").cast("date").alias("d"))
        .unionByName(li.select(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("d")))
        .unionByName(tb.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")))
    )
    return calendar.date_nodes(refs)
