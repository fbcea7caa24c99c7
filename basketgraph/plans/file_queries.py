"""File sources and sinks over whole tables: written in the file shapes, read back, then queried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.functions.ids import CUSTOMER_PREFIX, ORDER_PREFIX, date_key, prefixed
from basketgraph.operators import prices as price_ops
from basketgraph.plans.registry import register
from basketgraph.session import shared_path
from basketgraph.sources import files, graph_files
from basketgraph.sources import tables as tb

# All lines as invoices. By rule on the keys, some have no customer or a broken number; returned lines are negative;
# prices have three decimals; descriptions hold commas and quotes.
_INVOICES_SQL = """
    SELECT l_orderkey AS invoice_no, l_partkey AS stock_code, 'SET OF 3 "' || coalesce(p_name, '') || '", BLUE' AS description,
           (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * CAST(l_quantity AS BIGINT) * l_partkey AS thousandths, l_shipdate,
           CASE WHEN o_custkey IS NULL OR l_orderkey % 10 = 0 THEN 'no_customer'
                WHEN l_partkey % 97 = 0 THEN 'bad_quantity' WHEN l_partkey % 89 = 0 THEN 'bad_price' END AS reason
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
"""


def written_invoices(spark: SparkSession, sf_dir: str) -> str:
    """All lines of the tables as an invoice CSV; its path."""
    li, o, p = (tb.table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left").join(p, li["l_partkey"] == p["p_partkey"], "left")
    quantity = F.when(F.col("l_returnflag") == "R", -1).otherwise(1) * F.col("l_quantity").cast("long")
    price = (F.col("l_partkey").cast("decimal(18,0)") / 1000).cast("decimal(18,3)")
    path = shared_path(spark, "invoices-csv")
    joined.select(
        F.col("l_orderkey").alias("InvoiceNo"),
        F.col("l_partkey").alias("StockCode"),
        F.concat(F.lit('SET OF 3 "'), F.coalesce("p_name", F.lit("")), F.lit('", BLUE')).alias("Description"),
        F.when(F.col("l_partkey") % 97 == 0, F.concat(F.lit("x"), quantity.cast("string"))).otherwise(quantity.cast("string")).alias("Quantity"),
        F.date_format("l_shipdate", "d/M/yyyy H:mm").alias("InvoiceDate"),
        F.when((F.col("l_partkey") % 89 == 0) & (F.col("l_partkey") % 97 != 0), "free").otherwise(price.cast("string")).alias("UnitPrice"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("o_custkey")).alias("CustomerID"),
        F.lit("XX").alias("Country"),
    ).write.option("header", True).options(**files.QUOTED).csv(path)
    return path


@register(
    "order_totals_csv",
    f"""
    SELECT 'O' || CAST(invoice_no AS VARCHAR) AS order_id, CAST(SUM(thousandths) AS BIGINT) / 1000.0::DOUBLE AS total_price,
           strftime(MAX(l_shipdate), '%Y%m%d') AS date_id, COUNT(*) AS n_lines
    FROM ({_INVOICES_SQL}) t WHERE reason IS NULL GROUP BY invoice_no
    """,
    "S1 F1 F2 F5 A1 X1 X3",
)
def order_totals_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.read_invoice_csv(spark, written_invoices(spark, sf_dir))
    per_order = lines.groupBy("invoice_no").agg(F.sum("amount").alias("total"), F.max("invoice_ts").alias("last_ts"), F.count("*").alias("n_lines"))
    return per_order.select(
        prefixed("invoice_no", ORDER_PREFIX).alias("order_id"), F.col("total").cast("double").alias("total_price"), date_key("last_ts").alias("date_id"), "n_lines"
    )


@register(
    "invoice_rejects",
    f"""
    SELECT CAST(invoice_no AS VARCHAR) AS invoice_no, CAST(stock_code AS VARCHAR) AS stock_code, description, reason
    FROM ({_INVOICES_SQL}) t WHERE reason IS NOT NULL
    """,
    "S1 F2 X1",
)
def invoice_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = files.parse_invoice_csv(spark, written_invoices(spark, sf_dir))
    return lines.where(F.col("reason").isNotNull()).select("invoice_no", "stock_code", "description", "reason")


@register(
    "graph_table_roundtrip",
    """
    SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id, c_name || '; "' || c_mktsegment || '"' AS name,
           c_acctbal AS balance, c_acctbal >= 0 AS solvent FROM customer
    """,
    "S9 K1 P4 P5 U2 X17",
)
def graph_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.table(spark, sf_dir, "customer")
    nodes = c.select(
        prefixed("c_custkey", CUSTOMER_PREFIX).alias("id"),
        F.concat("c_name", F.lit('; "'), "c_mktsegment", F.lit('"')).alias("name"),
        F.col("c_acctbal").alias("balance"),
        (F.col("c_acctbal") >= 0).alias("solvent"),
    )
    path = shared_path(spark, "customer-nodes")
    graph_files.write_graph_table(nodes, path)
    return graph_files.read_graph_table(spark, path)


# ---------------------------------------------------------------------------
# Market price files of mixed widths
# ---------------------------------------------------------------------------

PRICE_FAMILIES = ("animal", "dairy", "fruit", "vegetable", "vegetal")

# All lines as price rows in five folders. By rule on the keys, rows are short or long, lack a price or a month, or name none.
_PRICE_ROWS_SQL = """
    SELECT 'name "' || CAST(l_partkey AS VARCHAR) || '", fresh' AS product_name, l_linenumber % 5 AS family, l_partkey AS k,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS d, (l_partkey % 5000) / 100.0::DOUBLE AS price,
           CASE WHEN l_orderkey % 23 = 0 THEN 'short_row' WHEN l_partkey % 37 = 0 THEN 'no_price'
                WHEN l_partkey % 31 = 0 THEN 'bad_price' WHEN l_suppkey % 41 = 0 OR l_shipdate IS NULL THEN 'bad_month' END AS reason
    FROM lineitem
"""


def written_prices(spark: SparkSession, sf_dir: str) -> list[str]:
    """The price rows as five folders of comma separated files, each file with a header and rows of 7, 13 or 15 columns."""
    li = tb.table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit('"name ""'), F.col("l_partkey").cast("string"), F.lit('"", fresh"'))
    month = F.when((F.col("l_suppkey") % 41 == 0) | F.col("l_shipdate").isNull(), "2020-13").otherwise(F.date_format("l_shipdate", "yyyy/MM"))
    cents = F.col("l_partkey") % 5000
    price = F.concat((cents / 100).cast("int").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    price = F.when(F.col("l_partkey") % 37 == 0, "").when(F.col("l_partkey") % 31 == 0, "n/a").otherwise(price)
    short = F.concat_ws(",", name, month, *[F.lit("0")] * 5)
    full = F.concat_ws(",", name, month, *[F.lit("0")] * 10, price)
    line = F.when(F.col("l_orderkey") % 23 == 0, short).when(F.col("l_orderkey") % 29 == 0, F.concat(full, F.lit(",9,9"))).otherwise(full)
    header = ",".join(["Product", "Date", *[f"C{i}" for i in range(10)], "ES"])
    base = shared_path(spark, "prices")
    for i, family in enumerate(PRICE_FAMILIES):
        rows = li.where(F.col("l_linenumber") % 5 == i).select(line.alias("value"))
        first = F.monotonically_increasing_id() % (1 << 33) == 0  # the first row of each part file
        rows.select(F.when(first, F.concat(F.lit(header + "\n"), F.col("value"))).otherwise(F.col("value")).alias("value")).write.text(f"{base}/{family}")
    return [f"{base}/{family}" for family in PRICE_FAMILIES]


_FAMILY_SQL = "CASE family " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(PRICE_FAMILIES)) + " END"


@register(
    "price_files",
    f"""
    SELECT product_name, CASE WHEN reason IS NULL THEN strftime(d, '%Y%m%d') END AS date_id, CASE WHEN reason IS NULL THEN price END AS price,
           reason, {_FAMILY_SQL} AS family
    FROM ({_PRICE_ROWS_SQL}) r
    """,
    "S2 U1 F3 X1 X5",
)
def price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of five mixed-width price files, kept or rejected with its file and reason."""
    rows = files.parse_market_prices(spark, written_prices(spark, sf_dir))
    kept = F.col("reason").isNull()
    return rows.select(
        "product_name", F.when(kept, date_key("price_date")).alias("date_id"), F.when(kept, F.col("price")).alias("price"), "reason",
        F.regexp_extract("file", "/([a-z]+)/[^/]+$", 1).alias("family"),
    )


@register(
    "price_history_files",
    f"""
    SELECT 'P' || CAST(k AS VARCHAR) AS product_id, strftime(d, '%Y%m%d') AS date_id, price AS marketpriceEU
    FROM ({_PRICE_ROWS_SQL}) r WHERE reason IS NULL AND k IN (SELECT p_partkey FROM part)
    """,
    "S2 S3 J2 X5",
)
def price_history_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price edges from the price files and a product list file, joined on the name."""
    parts = tb.table(spark, sf_dir, "part")
    path = shared_path(spark, "product-list")
    named = F.concat(F.lit('name "'), F.col("p_partkey").cast("string"), F.lit('", fresh'))
    parts.select(F.col("p_partkey").alias("ProductID"), named.alias("Product"), F.col("p_type").alias("Type")).write.option("header", True).options(**files.QUOTED).csv(path)
    observed = files.read_market_prices(spark, written_prices(spark, sf_dir))
    return price_ops.price_history(observed, files.read_product_list(spark, path), key="product_name")
