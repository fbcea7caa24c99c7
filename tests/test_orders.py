"""Invoice CSV reader and the order-side graph tables."""

from __future__ import annotations

from basketgraph.operators import orders as ops
from basketgraph.sources.files import read_invoice_csv

from .conftest import rows

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
LINES = [
    # repeated product in one invoice, two dates in one invoice, times 00:05 and 13:26
    "536365,85123A,WHITE HANGING HEART,6,01/12/2010 00:05,2.55,17850,UK",
    "536365,85123A,WHITE HANGING HEART,2,02/12/2010 13:26,2.55,17850,UK",
    "536365,71053,,6,01/12/2010 12:26,3.39,17850,UK",  # empty description
    "C536379,D,Discount,-1,01/12/2010 09:41,27.5,14527,UK",  # cancelled invoice, kept
    "536370,22728,ALARM CLOCK,24,1/12/2010 8:45,3.75,,France",  # missing customer, dropped
    "536371,22728,ALARM CLOCK,12,01/12/2010 09:00,3.75,12583,France",
]


def _lines(spark, tmp_path):
    p = tmp_path / "retail.csv"
    p.write_text(HEADER + "\n".join(LINES) + "\n")
    return read_invoice_csv(spark, str(p))


def test_reader_drops_missing_customer_and_parses_times(spark, tmp_path):
    df = _lines(spark, tmp_path)
    assert df.count() == 5
    ts = {r.invoice_ts.strftime("%d %H:%M") for r in df.collect()}
    assert {"01 00:05", "02 13:26", "01 12:26"} <= ts  # 24-hour clock: 12:26 stays noon


def test_order_nodes_and_in_date(spark, tmp_path):
    summary = ops.order_summary(_lines(spark, tmp_path))
    nodes = {r.order_id: r for r in ops.order_nodes(summary).collect()}
    # line amounts are exact decimals: 15.30 + 5.10 + 20.34
    assert nodes["O536365"].total_price == 40.74
    assert nodes["O536365"].total_cost == 36.666
    assert nodes["O536365"].delivery == 3.0
    assert nodes["OC536379"].total_price == -27.5  # negative totals kept by default
    assert "OC536379" not in {r.order_id for r in ops.order_nodes(summary, keep_negative=False).collect()}
    dates = dict(rows(ops.in_date_edges(summary)))
    assert dates["O536365"] == "20101202"  # latest line date of the invoice


def test_contains_keeps_parallel_edges(spark, tmp_path):
    edges = ops.contains_edges(_lines(spark, tmp_path)).where("order_id = 'O536365' AND product_id = 'P85123A'")
    assert edges.count() == 2
    r = edges.orderBy("quantity").first()
    assert (r.quantity, r.unitprice) == (2, 2.55)
    assert abs(r.costprice - 2.55 * 0.9) < 1e-12


def test_buys_distinct_and_customers(spark, tmp_path):
    pairs = ops.customer_invoices(_lines(spark, tmp_path))
    assert rows(ops.buys_edges(pairs)) == [("C12583", "O536371"), ("C14527", "OC536379"), ("C17850", "O536365")]
    assert ops.distinct_customers(pairs).count() == 3
    assert ops.distinct_orders(pairs).count() == 3


def test_segments_at_bounds(spark):
    data = [(c, f"{c}-{i}") for c, n in (("a", 1), ("b", 2), ("c", 5), ("d", 6)) for i in range(n)]
    pairs = spark.createDataFrame(data, "customer_id string, invoice_no string")
    seg = rows(ops.customer_segments(pairs), "customer_id", "segment_id", "n_orders")
    assert seg == [("Ca", "S1", 1), ("Cb", "S2", 2), ("Cc", "S2", 5), ("Cd", "S3", 6)]


def test_invoice_filter_applied_after_aggregation(spark):
    lines = spark.createDataFrame(
        [(1, 10, 1, 1.0, 1.0, "1.00", None), (2, 10, 1, 1.0, 1.0, "2.00", None)],
        "invoice_no long, stock_code long, line_no int, quantity double, unit_price double, amount string, invoice_ts timestamp",
    ).selectExpr("*", "CAST(amount AS DECIMAL(18,2)) AS amt").drop("amount").withColumnRenamed("amt", "amount")
    invoices = spark.createDataFrame([(1, 7), (2, None)], "invoice_no long, customer_id long")
    out = rows(ops.order_nodes(ops.order_summary(lines, invoices)), "order_id", "total_price")
    assert out == [("O1", 1.0)]
