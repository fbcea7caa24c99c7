"""Deterministic assignment queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.operators import assign as ops
from basketgraph.operators import orders as order_ops
from basketgraph.plans.registry import register
from basketgraph.sources import tables as tb


def _hash_sql(salt: str, key: str) -> str:
    return f"('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


_GRAPH_ORDERS = """
    SELECT DISTINCT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IS NOT NULL AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
"""


@register(
    "assign_supplier",
    f"""
    WITH s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx FROM supplier),
    n AS (SELECT COUNT(*) AS n FROM supplier)
    SELECT 'O' || CAST(o.o_orderkey AS VARCHAR) AS order_id, 'F' || CAST(s.s_suppkey AS VARCHAR) AS farmer_id
    FROM ({_GRAPH_ORDERS}) o, n JOIN s ON s.idx = {_hash_sql('supplier', 'o.o_orderkey')} % n.n
    """,
    "H1 J5",
)
def assign_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = order_ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    return ops.supplied_by_edges(pairs.select("invoice_no"), tb.farmers(spark, sf_dir))


@register(
    "farmer_table",
    f"""
    WITH m AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS idx FROM nation),
    n AS (SELECT COUNT(*) AS n FROM nation)
    SELECT 'F' || CAST(s.s_suppkey AS VARCHAR) AS farmer_id, s.s_name AS farmername, m.n_name AS location,
           CAST({_hash_sql('experience', 's.s_suppkey')} % 10 AS INTEGER) AS experience
    FROM supplier s, n JOIN m ON m.idx = {_hash_sql('location', 's.s_suppkey')} % n.n
    """,
    "H2 J5",
)
def farmer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.farmer_nodes(tb.farmers(spark, sf_dir), tb.municipalities(spark, sf_dir))


@register(
    "customer_nodes",
    f"""
    SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name,
           CAST({_hash_sql('age', 'c.c_custkey')} % 100 AS INTEGER) AS age,
           CASE WHEN {_hash_sql('gender', 'c.c_custkey')} % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender
    FROM customer c WHERE c.c_custkey IN (SELECT o_custkey FROM ({_GRAPH_ORDERS}) g)
    """,
    "H1 A5",
)
def customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = order_ops.customer_invoices(tb.invoice_lines(spark, sf_dir), tb.invoices(spark, sf_dir))
    c = tb.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("name"))
    in_graph = c.join(pairs.select(F.col("customer_id").alias("customer_key")), "customer_key", "left_semi")
    return ops.customer_nodes(in_graph)
