"""Market prices and product nodes.

``observations`` has a product key column (named by ``key``), ``price_date``
(date) and ``price`` (double). ``products`` has the same key column plus
``product_id`` and ``product_name``; when prices are keyed by name (the market
files) ``key='product_name'`` joins on the name, as the product list maps names
to ids one to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketgraph.functions.ids import CATEGORY_PREFIX, PRODUCT_PREFIX, date_key, nonempty, prefixed


def price_history(observations: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """product_id -> date_id with the observed price, one edge per observation."""
    obs = observations.where(F.col("price").isNotNull() & F.col("price_date").isNotNull())
    ids = products.select(key, "product_id") if key != "product_id" else products.select("product_id")
    j = obs.join(ids, key, "inner")
    return j.select(
        prefixed("product_id", PRODUCT_PREFIX).alias("product_id"),
        date_key("price_date").alias("date_id"),
        F.col("price").alias("marketpriceEU"),
    )


def latest_price(observations: DataFrame, key: str = "product_id") -> DataFrame:
    """key, price_date, price: the price on the latest date; equal dates keep the highest price.

    Two hash aggregations with map-side combine: first the highest price per
    (key, date), then the row of the latest date per key. Only pre-aggregated
    rows cross the second shuffle, and a hot key is combined before the first.
    """
    obs = observations.where(F.col("price").isNotNull() & F.col("price_date").isNotNull())
    per_day = obs.groupBy(key, "price_date").agg(F.max("price").alias("price"))
    return per_day.groupBy(key).agg(
        F.max("price_date").alias("price_date"),
        F.max_by("price", "price_date").alias("price"),
    )


def market_products(latest: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """product_id, product_name, price for priced products found in the product list."""
    cols = ["product_id", "product_name"] + ([key] if key not in ("product_id", "product_name") else [])
    return latest.join(products.select(*dict.fromkeys(cols)), key, "inner").select(
        "product_id", "product_name", "price"
    )


def sold_products(lines: DataFrame) -> DataFrame:
    """product_id, description: first non-empty description per stock code.

    "First" is the smallest non-empty value, so the result does not depend on
    the order rows arrive in.
    """
    return lines.groupBy(F.col("stock_code").alias("product_id")).agg(
        F.min(nonempty("description")).alias("description")
    )


def product_nodes(sold: DataFrame, market: DataFrame) -> DataFrame:
    """Sold products, overridden by their market row when one exists.

    Name falls back to the description, price to 0. Priced products that were
    never sold are not nodes.
    """
    m = market.select(
        "product_id", F.col("product_name").alias("m_name"), F.col("price").alias("m_price")
    )
    j = sold.join(m, "product_id", "left")
    return j.select(
        prefixed("product_id", PRODUCT_PREFIX).alias("product_id"),
        F.coalesce("m_name", "description").alias("nameproduct"),
        F.coalesce("m_price", F.lit(0.0)).alias("marketpriceEU"),
    )


def category_nodes(products: DataFrame) -> DataFrame:
    """category_id, categoryname: one node per product type."""
    types = products.select(F.col("product_type").alias("categoryname")).where(
        nonempty("categoryname").isNotNull()
    ).distinct()
    return types.select(F.concat(F.lit(CATEGORY_PREFIX), "categoryname").alias("category_id"), "categoryname")


def belongs_to_edges(products: DataFrame, categories: DataFrame) -> DataFrame:
    """product_id -> category_id by type name.

    The category side is one row per type; AQE broadcasts it when its measured
    size is under the broadcast threshold and shuffles otherwise.
    """
    j = products.select("product_id", F.col("product_type").alias("categoryname")).join(
        categories, "categoryname", "inner"
    )
    return j.select(prefixed("product_id", PRODUCT_PREFIX).alias("product_id"), "category_id")
