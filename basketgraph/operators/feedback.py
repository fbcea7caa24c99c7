"""Feedback records -> feedback edges (S6, X5, P2) and JSON line validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketgraph.functions.ids import CUSTOMER_PREFIX, PRODUCT_PREFIX, prefixed

CORRUPT = "_corrupt_record"
# Reject reasons of the line validator.
NOT_JSON_OBJECT = "not_json_object"
MISSING_FIELD = "missing_field"


def feedback_edges(records: DataFrame) -> DataFrame:
    """customer -> product edges with rating, sentimentalAnalysis and an int yyyyMMdd date.

    ``records`` columns: customer_id, product_id, rating, sentiment, feedback_date (date).
    """
    return records.select(
        prefixed("customer_id", CUSTOMER_PREFIX).alias("customer_id"),
        prefixed("product_id", PRODUCT_PREFIX).alias("product_id"),
        F.col("rating").cast("int").alias("rating"),
        F.col("sentiment").alias("sentimentalAnalysis"),
        F.date_format("feedback_date", "yyyyMMdd").cast("int").alias("date_key"),
    )


def feedback_records_from_json(df: DataFrame) -> DataFrame:
    """Rows of the feedback JSON file (date yyyy-MM-dd, userid, productid, rating, sentAnalysis)."""
    return df.select(
        F.col("userid").alias("customer_id"),
        F.col("productid").alias("product_id"),
        F.col("rating"),
        F.col("sentAnalysis").alias("sentiment"),
        F.try_to_timestamp(F.col("date"), F.lit("yyyy-MM-dd")).cast("date").alias("feedback_date"),
    )


def parse_json_lines(
    df: DataFrame, value_col: str, schema: T.StructType, required: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns, the raw line, ``parsed`` struct and ``reason`` (null when valid).

    A line is valid when it is a JSON object and every ``required`` field is
    present and of the declared type. Text that is not JSON, or JSON that is not
    an object, fills the corrupt-record field; an object missing a field parses
    with a null there. Both are kept as dead letters with their reason.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value_col), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    out = df.select(*keep, F.col(value_col).alias("raw"), parsed.alias("parsed"))
    bad_json = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"parsed.{name}").isNull()
    reason = F.when(bad_json, NOT_JSON_OBJECT).when(missing, MISSING_FIELD)
    return out.select("*", reason.alias("reason"))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rows with a null reason and the rest; counts sum to the input."""
    return parsed.where(F.col("reason").isNull()), parsed.where(F.col("reason").isNotNull())
