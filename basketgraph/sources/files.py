"""Readers for the delimited and JSON files of the retail jobs.

Every reader takes an explicit schema, uses the reader's own header handling
(never a substring test on the line) and returns named, typed columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph import schemas
from basketgraph.functions.ids import nonempty, parse_invoice_ts, parse_month


#: Fields may be quoted; a quote inside one is doubled.
QUOTED = {"quote": '"', "escape": '"'}


# Reject reasons of invoice lines.
NO_CUSTOMER = "no_customer"
BAD_QUANTITY = "bad_quantity"
BAD_PRICE = "bad_price"


def parse_invoice_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All invoice lines: invoice_no, stock_code, description, quantity, invoice_ts,
    unit_price, amount, customer_id and ``reason`` (null when the line counts).

    A line without a customer, or whose quantity or price is no number, is rejected;
    accepted and rejected lines sum to the input.
    """
    raw = (
        spark.read.schema(schemas.INVOICE_CSV)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .options(**QUOTED)
        .csv(path if isinstance(path, str) else list(path))
    )
    reason = (
        F.when(nonempty("customer_id").isNull(), NO_CUSTOMER)
        .when(F.col("quantity").isNull(), BAD_QUANTITY)
        .when(F.col("unit_price").isNull(), BAD_PRICE)
    )
    return raw.select(
        "invoice_no",
        "stock_code",
        "description",
        "quantity",
        parse_invoice_ts("invoice_date").alias("invoice_ts"),
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(28,6)").alias("amount"),
        F.trim("customer_id").alias("customer_id"),
        reason.alias("reason"),
    )


def read_invoice_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of ``parse_invoice_csv`` that count. Negative quantities and cancelled
    invoices (``C`` prefix) are kept, as the totals filter is off by default."""
    return parse_invoice_csv(spark, path).where(F.col("reason").isNull()).drop("reason")


# Reject reasons of market price rows (``BAD_PRICE`` too).
SHORT_ROW = "short_row"
NO_PRICE = "no_price"
BAD_MONTH = "bad_month"


def parse_market_prices(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All rows of all market price files in one scan: product_name, price_date, price, ``reason`` (null when kept), n_columns, file.

    Files may mix widths. A row needs more than twelve columns and a number in the thirteenth; further columns are
    ignored. Rows that miss either, or name no month, are rejected with their file; kept and rejected sum to the input. Header rows are those
    with ``Date`` for a month. The CSV reader fills short rows up, so lines are read as text, the separators
    outside quotes counted, and the fields parsed by ``from_csv``.
    """
    lines = spark.read.text(list(paths)).where(F.length(F.trim("value")) > 0)
    unquoted = F.regexp_replace("value", '"(?:[^"]|"")*"', "")
    n_columns = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    fields = F.from_csv("value", schemas.MARKET_PRICE_CSV.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {**QUOTED, "mode": "PERMISSIVE"})
    # inline keeps the parse apart from the conditions on its fields, which would repeat it each
    raw = lines.select(n_columns.alias("n_columns"), F.col("_metadata.file_path").alias("file"), F.inline(F.array(fields)))
    raw = raw.where(~F.coalesce(F.col("month") == "Date", F.lit(False)))
    price = F.trim("price_es").try_cast("double")
    date = parse_month("month")
    reason = (
        F.when(F.col("n_columns") < len(schemas.MARKET_PRICE_CSV), SHORT_ROW)
        .when(nonempty("price_es").isNull(), NO_PRICE)
        .when(price.isNull() | F.isnan(price), BAD_PRICE)
        .when(date.isNull(), BAD_MONTH)
    )
    return raw.select(
        "product_name", date.alias("price_date"), price.alias("price"), reason.alias("reason"), "n_columns", "file"
    )


def read_market_prices(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The rows of ``parse_market_prices`` that count: product_name, price_date, price. A path list replaces a union of per-file reads."""
    return parse_market_prices(spark, paths).where(F.col("reason").isNull()).select("product_name", "price_date", "price")


def read_product_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT_LIST_CSV).option("header", True).options(**QUOTED).csv(path)


def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(schemas.MUNICIPALITY_CSV)
        .option("header", True)
        .option("encoding", "UTF-8")
        .options(**QUOTED)
        .csv(path)
    )


def read_feedback_json(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Feedback records: date, userid, productid, rating, sentAnalysis."""
    return spark.read.schema(schemas.FEEDBACK_JSON).json(path if isinstance(path, str) else list(path))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> DataFrame(word); surrounding blanks trimmed, blank lines dropped."""
    lines = spark.read.text(path)
    return (
        lines.select(F.trim("value").alias("word"))
        .where(F.length("word") > 0)
        .select("word")
    )
