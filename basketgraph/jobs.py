"""Batch jobs: every graph table of one source family, written in one call.

CLI (one verb, like the original jobs)::

    python -m basketgraph.jobs orders   --invoices retail.csv --out DIR [--farmers f.csv] [--format graph-csv]
    python -m basketgraph.jobs mkt      --prices a.csv,b.csv --products products.csv --invoices retail.csv
                                        --categories categories.csv --municipalities m.txt --out DIR
    python -m basketgraph.jobs feedback --feedback feedback.json --out DIR
    python -m basketgraph.jobs stream   --lines DIR --stop s.txt --positive p.txt --negative n.txt --out DIR
                                        [--available-now] [--source-format text|socket|kafka --option k=v ...]
    python -m basketgraph.jobs compact  --out DIR [--vacuum]             (the daily table that stream writes under DIR)
    python -m basketgraph.jobs dates    --out DIR [--format graph-csv]   (after the other jobs wrote DIR)
    python -m basketgraph.jobs graph    --input DIR --out DIR2 [--format graph-csv] [--categories categories.csv]

Intermediates shared by several outputs are persisted around the writes and
released afterwards (G1). Outputs are parquet by default; ``graph-csv`` writes
``;``-separated files with a typed header, in parallel.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.operators import assign, calendar, graph, orders, prices
from basketgraph.operators import feedback as fb
from basketgraph.sources import files, shared_files
from basketgraph.sources.graph_files import read_graph_table, write_graph_table
from basketgraph.streaming import feedback_stream

# Size of the default farmer table.
DEFAULT_FARMERS = 50


def default_farmers(spark: SparkSession, n: int = DEFAULT_FARMERS) -> DataFrame:
    """``n`` farmers keyed 0..n-1 without names, for when no farmer dimension is given."""
    return spark.range(n).select(F.col("id").alias("farmer_key"), F.lit(None).cast("string").alias("farmer_name"))


def order_tables(
    lines: DataFrame, invoices: DataFrame | None = None, farmers: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """(tables, intermediates to persist) for the order side of the graph."""
    summary = orders.order_summary(lines, invoices)
    pairs = orders.customer_invoices(lines, invoices)
    if customers is None:
        customers = pairs.select(F.col("customer_id").alias("customer_key")).distinct().withColumn(
            "name", F.lit(None).cast("string")
        )
    in_graph = customers.join(pairs.select(F.col("customer_id").alias("customer_key")).distinct(), "customer_key", "left_semi")
    tables = {
        "orderNode": orders.order_nodes(summary),
        "indateEdge": orders.in_date_edges(summary),
        "containsEdge": orders.contains_edges(lines, invoices),
        "customerNode": assign.customer_nodes(in_graph),
        "buysEdge": orders.buys_edges(pairs),
        "classifiedasEdge": orders.customer_segments(pairs).select("customer_id", "segment_id"),
        "segmentNode": orders.segment_nodes(lines.sparkSession),
    }
    if farmers is not None:
        tables["suppliedbyEdge"] = assign.supplied_by_edges(pairs.select("invoice_no"), farmers)
    return tables, [summary, pairs]


def market_tables(
    observations: DataFrame, products: DataFrame, lines: DataFrame, categories: DataFrame,
    farmers: DataFrame, municipalities: DataFrame, key: str = "product_name",
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """(tables, intermediates to persist) for prices, products, categories and farmers."""
    latest = prices.latest_price(observations, key)
    market = prices.market_products(latest, products, key)
    tables = {
        "productNode": prices.product_nodes(prices.sold_products(lines), market),
        "priceInDateEdge": prices.price_history(observations, products, key),
        "belongstoEdge": prices.belongs_to_edges(products, categories),
        "farmerNode": assign.farmer_nodes(farmers, municipalities),
    }
    return tables, [observations]


def feedback_tables(records: DataFrame) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    # The exported property is named ``date`` as in the graph's feedback edge header.
    return {"feedbackEdge": fb.feedback_edges(records).withColumnRenamed("date_key", "date")}, []


# Edge tables written by the other jobs that point at day ids, and their date column.
DATE_EDGES = (("indateEdge", "date_id", "dst"), ("priceInDateEdge", "date_id", "dst"), ("feedbackEdge", "date", "date"))


def date_tables(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> DataFrame:
    """Date nodes covering every day id referenced by the date-bearing edge tables under ``out_dir``."""
    refs = None
    for name, parquet_col, csv_col in DATE_EDGES:
        path = f"{out_dir.rstrip('/')}/{name}"
        try:
            df = read_graph_table(spark, path) if fmt == "graph-csv" else spark.read.parquet(path)
            col = csv_col if fmt == "graph-csv" else parquet_col
            day = F.to_date(F.col(col).cast("string"), "yyyyMMdd").alias("d")
            df = df.select(day)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            continue  # that job has not run; its dates are not referenced
        refs = df if refs is None else refs.unionByName(df)
    if refs is None:
        raise ValueError(f"no date-bearing edge tables under {out_dir}")
    return calendar.date_nodes(refs)


# Node tables by label, and edge tables with the labels of their ends.
GRAPH_NODES = {
    "customer": "customerNode", "segment": "segmentNode", "order": "orderNode", "date": "dateNode", "product": "productNode",
    "category": "categoryNode", "farmer": "farmerNode",
}
GRAPH_EDGES = {
    "classified_as": ("classifiedasEdge", "customer", "segment"), "buys": ("buysEdge", "customer", "order"), "in_date": ("indateEdge", "order", "date"),
    "contains": ("containsEdge", "order", "product"), "supplied_by": ("suppliedbyEdge", "order", "farmer"), "price_in_date": ("priceInDateEdge", "product", "date"),
    "feedback": ("feedbackEdge", "customer", "product"), "belongs_to": ("belongstoEdge", "product", "category"),
}


def _stored_table(spark: SparkSession, in_dir: str, name: str, fmt: str) -> DataFrame | None:
    """A table that another job wrote, with string ids; None if it has not run."""
    path = f"{in_dir.rstrip('/')}/{name}"
    if not shared_files.exists(spark, path):
        return None
    df = read_graph_table(spark, path) if fmt == "graph-csv" else _graph_columns(name, spark.read.parquet(path))
    for end in ("id", "src", "dst"):
        if end in df.columns:
            df = df.withColumn(end, F.col(end).cast("string"))
    return df


def graph_from_files(spark: SparkSession, in_dir: str, fmt: str = "graph-csv", categories: str | None = None) -> graph.Graph:
    """The graph of all node and edge tables under ``in_dir``; edges to nodes that no table holds are rejected."""
    nodes = {label: _stored_table(spark, in_dir, name, fmt) for label, name in GRAPH_NODES.items()}
    if categories:
        nodes["category"] = read_graph_table(spark, categories)
    nodes = {label: spark.createDataFrame([], "id string") if df is None else df for label, df in nodes.items()}
    edges = {}
    for name, (table, src, dst) in GRAPH_EDGES.items():
        df = _stored_table(spark, in_dir, table, fmt)
        if df is not None:
            edges[name] = graph.EdgeSpec(df, src, dst)
    if not edges:
        raise ValueError(f"no edge tables under {in_dir}")
    return graph.assemble_graph(nodes, edges)


def write_tables(
    tables: Mapping[str, DataFrame], shared: list[DataFrame], out_dir: str, fmt: str = "parquet",
    mode: str = "errorifexists", single_file: bool = False,
) -> None:
    """Write every table under ``out_dir/<name>``; shared intermediates are cached only for the duration."""
    for df in shared:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in tables.items():
            path = f"{out_dir.rstrip('/')}/{name}"
            if fmt == "graph-csv":
                write_graph_table(_graph_columns(name, df), path, mode=mode, single_file=single_file)
            elif fmt == "parquet":
                df.write.mode(mode).parquet(path)
            else:
                raise ValueError(f"unknown format {fmt!r}")
    finally:
        for df in shared:
            df.unpersist()


def _graph_columns(name: str, df: DataFrame) -> DataFrame:
    """Node tables (``...Node``) lead with the id; edge tables with their two ends."""
    cols = df.columns
    if name.endswith("Node"):
        return df.withColumnRenamed(cols[0], "id")
    return df.withColumnRenamed(cols[0], "src").withColumnRenamed(cols[1], "dst")


def _categories(spark: SparkSession, path: str) -> DataFrame:
    cat = read_graph_table(spark, path)
    return cat.select(F.col("id").alias("category_id"), "categoryname")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="basketgraph.jobs")
    p.add_argument("job", choices=["orders", "mkt", "feedback", "stream", "compact", "dates", "graph"])
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "graph-csv"])
    p.add_argument("--mode", default="errorifexists")
    p.add_argument("--input", help="graph: folder of the node and edge tables that the other jobs wrote in --format")
    p.add_argument("--single-file", action="store_true", help="one part file per graph-csv table (small exports)")
    p.add_argument("--invoices")
    p.add_argument("--farmers", help="CSV with header farmer_key,farmer_name")
    p.add_argument("--prices", help="comma-separated market price files")
    p.add_argument("--products")
    p.add_argument("--categories")
    p.add_argument("--municipalities")
    p.add_argument("--feedback")
    p.add_argument("--lines", help="stream source path (text format) or omitted for socket/kafka")
    p.add_argument("--source-format", default="text")
    p.add_argument("--option", action="append", default=[], help="source option key=value, repeatable")
    p.add_argument("--stop")
    p.add_argument("--positive")
    p.add_argument("--negative")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--timeout", type=int, default=0, help="seconds to run a continuous stream; 0 = until stopped")
    p.add_argument("--journal", help="compact: export the resolved table of this folder to --out instead")
    p.add_argument("--vacuum", action="store_true", help="compact: also remove what the new generation replaces")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()

    if a.job == "stream":
        return _run_stream(spark, a)
    if a.job == "graph":
        graph.write_graph(graph_from_files(spark, a.input, a.format, a.categories), a.out.rstrip("/"), a.mode)
        return 0
    if a.job == "dates":
        tables = {"dateNode": date_tables(spark, a.out, a.format)}
        write_tables(tables, [], a.out, a.format, a.mode, a.single_file)
        return 0
    if a.job == "compact":
        if a.journal:
            feedback_stream.keyed_feedback(spark, a.journal).read().write.mode("errorifexists").parquet(a.out)
            return 0
        table = feedback_stream.daily_table(spark, a.out)
        table.compact()
        if a.vacuum:
            table.vacuum()
        return 0

    farmers = (
        spark.read.option("header", True).schema("farmer_key long, farmer_name string").csv(a.farmers)
        if a.farmers else default_farmers(spark)
    )
    if a.job == "orders":
        lines = files.read_invoice_csv(spark, a.invoices)
        tables, shared = order_tables(lines, farmers=farmers)
    elif a.job == "mkt":
        products = files.read_product_list(spark, a.products).select(
            F.col("product_id").alias("product_id"), "product_name", "product_type"
        )
        munis = files.read_municipalities(spark, a.municipalities).select(
            F.col("municipality").alias("municipality_key"), "municipality"
        )
        tables, shared = market_tables(
            files.read_market_prices(spark, a.prices.split(",")),
            products,
            files.read_invoice_csv(spark, a.invoices),
            _categories(spark, a.categories),
            farmers,
            munis,
        )
    else:
        records = fb.feedback_records_from_json(files.read_feedback_json(spark, a.feedback))
        tables, shared = feedback_tables(records)
    write_tables(tables, shared, a.out, a.format, a.mode, a.single_file)
    return 0


def _run_stream(spark: SparkSession, a) -> int:
    """The feedback stream: lines -> validated, scored records -> JSON, keyed daily table, dead letters."""
    options = dict(kv.split("=", 1) for kv in a.option)
    lines = feedback_stream.read_lines(spark, a.source_format, a.lines, **options)
    lists = [files.read_word_list(spark, path) for path in (a.stop, a.positive, a.negative)]
    queries = feedback_stream.start_feedback_stream(lines, a.out, *lists, available_now=a.available_now)
    if a.available_now:
        for q in queries:
            feedback_stream.run_to_completion(q, a.timeout or None)
    else:
        spark.streams.awaitAnyTermination(a.timeout or None)
        for q in queries:
            q.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

