"""Explicit schemas for every file source. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Invoice lines: comma separated, header row, eight positional columns.
INVOICE_CSV = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# Market price files: product name, month (yyyy/MM), ten unread columns, Spanish price.
MARKET_PRICE_CSV = T.StructType(
    [T.StructField("product_name", T.StringType()), T.StructField("month", T.StringType())]
    + [T.StructField(f"unused_{i}", T.StringType()) for i in range(2, 12)]
    + [T.StructField("price_es", T.StringType())]
)

PRODUCT_LIST_CSV = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("product_type", T.StringType()),
    ]
)

MUNICIPALITY_CSV = T.StructType(
    [
        T.StructField("municipality", T.StringType()),
        T.StructField("comarca", T.StringType()),
        T.StructField("province", T.StringType()),
    ]
)

# Feedback records written by the stream sink and read by the batch job.
FEEDBACK_JSON = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("userid", T.StringType()),
        T.StructField("productid", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("sentAnalysis", T.StringType()),
    ]
)

# One line of the feedback stream.
FEEDBACK_LINE = T.StructType(
    [
        T.StructField("customerid", T.StringType()),
        T.StructField("productid", T.StringType()),
        T.StructField("rating", T.LongType()),
        T.StructField("about", T.StringType()),
        T.StructField("product", T.StringType()),
    ]
)

# Typed graph headers: the property types a node or edge file may declare.
GRAPH_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
}
