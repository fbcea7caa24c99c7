"""Scans of the parquet tables and their mapping onto the retail vocabulary.

Mapping (one row each): invoice line = ``lineitem``; invoice = ``orders``;
customer = ``customer``; product = ``part``; category = ``part.p_type``;
farmer = ``supplier``; municipality = ``nation``; unit price =
``l_extendedprice / l_quantity``; price observation = (part, month of
``l_shipdate``, unit price); feedback = one edge per ``lineitem`` row from the
order's customer to the part, rating ``1 + (l_quantity mod 5)``, sentiment from
``l_returnflag``; feedback text = ``documents.text``; stream = ``events``.

Every function returns a narrow projection so that the parquet scan reads only
the columns a query uses (``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.session import hashed_if_large

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Sentiment of a feedback edge by return flag, and the rating rule.
RETURNFLAG_SENTIMENT = {"A": "POSITIVE", "N": "NEUTRAL", "R": "NEGATIVE"}
RATING_LEVELS = 5

CATALOG_PREFIX = "catalog:"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table: ``<sf_dir>/<name>.parquet``, or ``<db>.<name>`` when ``sf_dir`` is ``catalog:<db>``.

    Reading through the catalog keeps the tables' bucketing, so tables bucketed
    on the same key join and aggregate without a shuffle.
    """
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    if sf_dir.startswith(CATALOG_PREFIX):
        return spark.table(f"{sf_dir[len(CATALOG_PREFIX):]}.{name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level facts: invoice_no, stock_code, line_no, quantity, unit_price, amount, invoice_ts.

    ``amount`` is quantity x unit price, exact in ``decimal(18,2)`` so that sums do
    not depend on summation order.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("invoice_no"),
        F.col("l_partkey").alias("stock_code"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").alias("invoice_ts"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice headers: invoice_no, customer_id, order_ts."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("invoice_no"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product list: product_id, product_name, product_type, size."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
    )


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations: product_id, price_date (first of month), price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("product_id"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("price_date"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
    )


def farmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("farmer_key"), F.col("s_name").alias("farmer_name"))


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("municipality_key"), F.col("n_name").alias("municipality"))


def sentiment_of_flag(flag_col) -> F.Column:
    expr = None
    for flag, label in RETURNFLAG_SENTIMENT.items():
        expr = F.when(flag_col == flag, label) if expr is None else expr.when(flag_col == flag, label)
    return expr


def rating_of(quantity: str) -> F.Column:
    return F.pmod(F.col(quantity).try_cast("int"), F.lit(RATING_LEVELS)) + 1


def feedback(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, headers: DataFrame | None = None
) -> DataFrame:
    """Feedback edges: customer_id, product_id, edge_order, edge_line, rating, sentiment, feedback_date.

    ``lines`` and ``headers`` give the rows of ``lineitem`` and ``orders`` to use, all by default.
    One edge per line row; parallel edges between one customer and one product
    stay separate rows. ``(edge_order, edge_line)`` are properties only: line
    numbers repeat within an order in the given tables, and the path counts rely
    on edge multiplicities, not on an edge id.
    """
    li = (table(spark, sf_dir, "lineitem") if lines is None else lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"
    )
    o = (hashed_if_large(table(spark, sf_dir, "orders")) if headers is None else headers).select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("edge_order"),
        F.col("l_linenumber").alias("edge_line"),
        rating_of("l_quantity").alias("rating"),
        sentiment_of_flag(F.col("l_returnflag")).alias("sentiment"),
        F.col("o_orderdate").cast("date").alias("feedback_date"),
    )
