"""Order-side graph tables: order nodes, in_date, contains, buys, customers, segments.

Inputs:

* ``lines``: one row per invoice line with ``invoice_no``, ``stock_code``,
  ``line_no``, ``quantity``, ``unit_price``, ``amount`` (decimal) and ``invoice_ts``.
* ``invoices``: optional invoice headers ``invoice_no``, ``customer_id``. When
  given, only lines of invoices with a customer count, and that filter is
  applied *after* the line aggregation so that the join moves one row per
  invoice instead of one row per line. When omitted, ``lines`` must already be
  filtered and carry ``customer_id`` (the CSV reader does that).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.functions.ids import (
    CUSTOMER_PREFIX,
    ORDER_PREFIX,
    PRODUCT_PREFIX,
    SEGMENT_PREFIX,
    date_key,
    prefixed,
)

# Commission share kept as cost, flat delivery fee, segment bounds and names.
COMMISSION = "0.9"
DELIVERY_FEE = 3.0
SEGMENT_BOUNDS = ((1, "1"), (5, "2"))  # up to 1 order -> S1, up to 5 -> S2, else S3
SEGMENT_TOP = "3"
SEGMENT_NAMES = (("S1", "Infrequent"), ("S2", "Frequent"), ("S3", "VIP"))


def _valid_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("customer_id").isNotNull()).select("invoice_no", "customer_id")


def restrict_to_invoices(df: DataFrame, invoices: DataFrame | None) -> DataFrame:
    """Keep rows whose invoice has a customer (semi join on invoice_no)."""
    if invoices is None:
        return df
    return df.join(_valid_invoices(invoices).select("invoice_no"), "invoice_no", "left_semi")


def order_summary(lines: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """invoice_no, total (decimal), last_ts: one shuffle feeds order nodes and in_date edges."""
    agg = lines.groupBy("invoice_no").agg(
        F.sum("amount").alias("total"), F.max("invoice_ts").alias("last_ts")
    )
    return restrict_to_invoices(agg, invoices)


def order_nodes(summary: DataFrame, keep_negative: bool = True) -> DataFrame:
    """order_id, total_price, total_cost, delivery.

    Totals are summed exactly in decimal and exported as double. Negative totals
    (returns, cancellations) are kept unless ``keep_negative`` is false.
    """
    if not keep_negative:
        summary = summary.where(F.col("total") >= 0)
    return summary.select(
        prefixed("invoice_no", ORDER_PREFIX).alias("order_id"),
        F.col("total").cast("double").alias("total_price"),
        (F.col("total") * F.lit(COMMISSION).cast("decimal(2,1)")).cast("double").alias("total_cost"),
        F.lit(DELIVERY_FEE).alias("delivery"),
    )


def in_date_edges(summary: DataFrame) -> DataFrame:
    """order_id -> date_id (yyyyMMdd of the latest line timestamp)."""
    return summary.where(F.col("last_ts").isNotNull()).select(
        prefixed("invoice_no", ORDER_PREFIX).alias("order_id"), date_key("last_ts").alias("date_id")
    )


def contains_edges(lines: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """order_id -> product_id per line, with line_no, quantity, unitprice, costprice.

    A multigraph: the same product on two lines of one order gives two edges.
    ``line_no`` is carried when the source has it.
    """
    src = restrict_to_invoices(lines, invoices)
    line_no = ["line_no"] if "line_no" in src.columns else []
    return src.select(
        prefixed("invoice_no", ORDER_PREFIX).alias("order_id"),
        prefixed("stock_code", PRODUCT_PREFIX).alias("product_id"),
        *line_no,
        F.col("quantity").try_cast("int").alias("quantity"),
        F.col("unit_price").alias("unitprice"),
        (F.col("unit_price") * F.lit(float(COMMISSION))).alias("costprice"),
    )


def customer_invoices(lines: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """Distinct (customer_id, invoice_no) pairs of invoices that have lines."""
    if invoices is None:
        return lines.select("customer_id", "invoice_no").distinct()
    # Invoices with at least one line. The line side is de-duplicated first (map-side
    # combine), so an invoice with a huge number of lines is one row per map task.
    line_invoices = lines.select("invoice_no").distinct()
    with_lines = _valid_invoices(invoices).join(line_invoices, "invoice_no", "left_semi")
    return with_lines.select("customer_id", "invoice_no").distinct()


def buys_edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        prefixed("customer_id", CUSTOMER_PREFIX).alias("customer_id"),
        prefixed("invoice_no", ORDER_PREFIX).alias("order_id"),
    )


def distinct_orders(pairs: DataFrame) -> DataFrame:
    return pairs.select(prefixed("invoice_no", ORDER_PREFIX).alias("order_id")).distinct()


def distinct_customers(pairs: DataFrame) -> DataFrame:
    return pairs.select("customer_id").distinct().select(
        prefixed("customer_id", CUSTOMER_PREFIX).alias("customer_id")
    )


def segment_of(n_orders) -> F.Column:
    """S1 for at most 1 order, S2 for at most 5, S3 above."""
    expr = None
    for bound, seg in SEGMENT_BOUNDS:
        cond = n_orders <= bound
        expr = F.when(cond, SEGMENT_PREFIX + seg) if expr is None else expr.when(cond, SEGMENT_PREFIX + seg)
    return expr.otherwise(SEGMENT_PREFIX + SEGMENT_TOP)


def customer_segments(pairs: DataFrame) -> DataFrame:
    """customer_id -> segment_id (classified_as edges) with the order count."""
    counts = pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.select(
        prefixed("customer_id", CUSTOMER_PREFIX).alias("customer_id"),
        segment_of(F.col("n_orders")).alias("segment_id"),
        F.col("n_orders"),
    )


def segment_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEGMENT_NAMES), "id string, segmentName string")
