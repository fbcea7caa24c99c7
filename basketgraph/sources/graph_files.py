"""Property-graph node and edge files with a typed header.

Header fields are ``:ID`` (node id), ``:START_ID`` / ``:END_ID`` (edge ends) and
``name:type`` properties, separated by ``;``. Reading parses the header into
column names and casts; writing derives the header from the DataFrame schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketgraph.schemas import GRAPH_TYPES

# Reserved header fields and the column names they map to.
ID_FIELDS = {":ID": "id", ":START_ID": "src", ":END_ID": "dst"}
TYPE_NAMES = {
    T.StringType: "string",
    T.IntegerType: "int",
    T.LongType: "long",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.BooleanType: "boolean",
}


def parse_header_field(field: str) -> tuple[str, str]:
    """``name:type`` -> (name, type); reserved id fields map to id/src/dst."""
    if field in ID_FIELDS:
        return ID_FIELDS[field], "string"
    name, sep, type_name = field.rpartition(":")
    if not sep:
        return field, "string"
    type_name = type_name.lower()
    if type_name not in GRAPH_TYPES:
        raise ValueError(f"unsupported property type {type_name!r} in header field {field!r}")
    return name, type_name


def read_graph_table(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Read a node or edge file; columns renamed and cast by the header types.

    Quoted fields with doubled quotes parse with ``quote='"'`` and ``escape='"'``.
    Values that do not parse as the declared type become null.
    """
    raw = (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    cols = []
    for field in raw.columns:
        name, type_name = parse_header_field(field)
        c = F.col(f"`{field}`")
        if type_name != "string":
            c = c.try_cast(GRAPH_TYPES[type_name])
        cols.append(c.alias(name))
    return raw.select(cols)


def header_fields(df: DataFrame) -> list[str]:
    """Typed header of a node/edge DataFrame (id/src/dst plus typed properties)."""
    reverse = {v: k for k, v in ID_FIELDS.items()}
    out = []
    for f in df.schema.fields:
        if f.name in reverse:
            out.append(reverse[f.name])
            continue
        type_name = TYPE_NAMES.get(type(f.dataType))
        if type_name is None:
            raise ValueError(f"column {f.name!r} of type {f.dataType} has no graph header type")
        out.append(f"{f.name}:{type_name}")
    return out


def write_graph_table(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """Write ``;``-separated text with the typed header as the first line of every part.

    Parallel by default; ``single_file`` coalesces to one part for small exports.
    """
    out = df.select([F.col(f"`{c}`").alias(h) for c, h in zip(df.columns, header_fields(df))])
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("sep", ";").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(path)


def clear_graph_table(spark: SparkSession, like: DataFrame, path: str) -> None:
    """Replace a stored table with an empty one of the same schema (explicit opt-in)."""
    spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(path)
