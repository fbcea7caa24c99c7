"""Id, date-key and emptiness helpers (column expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Node id prefixes of the property graph.
ORDER_PREFIX = "O"
PRODUCT_PREFIX = "P"
CUSTOMER_PREFIX = "C"
FARMER_PREFIX = "F"
SEGMENT_PREFIX = "S"
CATEGORY_PREFIX = "CAT_"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prefixed(col: Column | str, prefix: str) -> Column:
    """Graph node id: ``prefix`` followed by the business key."""
    return F.concat(F.lit(prefix), _c(col).cast("string"))


def strip_prefix(col: Column | str, width: int = 1) -> Column:
    """Business key back from a prefixed node id."""
    return F.substring(_c(col), width + 1, 1 << 30)


def date_key(col: Column | str) -> Column:
    """``yyyyMMdd`` string of a date or timestamp."""
    return F.date_format(_c(col), "yyyyMMdd")


def month_start(col: Column | str) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(_c(col).cast("date"), "month")


def nonempty(col: Column | str) -> Column:
    """Null for null, empty or blank strings; the string otherwise."""
    c = _c(col)
    return F.when(F.length(F.trim(c)) > 0, c)


def parse_invoice_ts(col: Column | str) -> Column:
    """Invoice timestamps ``dd/MM/yyyy hh:mm``.

    Parsed with ``d/M/yyyy H:mm``: padded and unpadded fields are accepted and the
    hour is read on the 24-hour clock, so 13:26 parses and 12:26 stays noon.
    Unparseable values become null instead of failing the job.
    """
    return F.try_to_timestamp(_c(col), F.lit("d/M/yyyy H:mm"))


def parse_month(col: Column | str) -> Column:
    """Price months ``yyyy/MM`` as the first day of that month."""
    return F.try_to_timestamp(F.concat(_c(col), F.lit("/01")), F.lit("yyyy/MM/dd")).cast("date")
