"""Scalar helpers, word lists and graph persistence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketgraph.functions import ids
from basketgraph.functions.lexicon import words_of
from basketgraph.operators import assign
from basketgraph.operators import graph as g
from basketgraph.sources.files import read_word_list
from basketgraph.sources.graph_files import clear_graph_table, parse_header_field


def test_prefix_round_trip_and_dates(spark):
    df = spark.createDataFrame([(85123, "2020/05")], "k long, month string")
    r = df.select(
        ids.prefixed("k", "P").alias("id"),
        ids.strip_prefix(ids.prefixed("k", "P")).alias("back"),
        ids.date_key(ids.parse_month("month")).alias("day"),
        ids.parse_month(F.lit("2020/13")).alias("bad"),
    ).first()
    assert (r.id, r.back, r.day, r.bad) == ("P85123", "85123", "20200501", None)


def test_header_fields():
    assert parse_header_field(":START_ID") == ("src", "string")
    assert parse_header_field("quantity:int") == ("quantity", "int")
    with pytest.raises(ValueError):
        parse_header_field("x:decimal")


def test_word_list_reader_and_size_check(spark, tmp_path):
    p = tmp_path / "positive.txt"
    p.write_text("good\n\n all-around \ngreat\n")
    words = read_word_list(spark, str(p))
    assert sorted(words_of(words)) == ["all-around", "good", "great"]
    with pytest.raises(ValueError):
        words_of(words, limit=2)


def test_clear_and_write_graph(spark, tmp_path):
    nodes = {"n": spark.createDataFrame([(1,), (2,)], "id long")}
    edges = {"e": g.EdgeSpec(spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long"), "n", "n")}
    graph = g.assemble_graph(nodes, edges)
    g.write_graph(graph, str(tmp_path / "graph"))
    assert spark.read.parquet(str(tmp_path / "graph/edges/e")).count() == 1
    assert spark.read.parquet(str(tmp_path / "graph/rejects")).count() == 1
    clear_graph_table(spark, graph.nodes["n"], str(tmp_path / "graph/nodes/n"))
    assert spark.read.parquet(str(tmp_path / "graph/nodes/n")).count() == 0


def test_dense_index_and_stable_pick(spark):
    dim = spark.range(0, 1000, 7).select(F.col("id").alias("k")).repartition(5)
    indexed, n = assign.with_dense_index(dim, ["k"])
    got = sorted((r.k, r.idx) for r in indexed.collect())
    assert n == len(got) and got == [(k, i) for i, k in enumerate(range(0, 1000, 7))]
    picks = spark.range(2000).select(assign.stable_pick("id", "s", 10).alias("p"))
    counts = {r.p: r["count"] for r in picks.groupBy("p").count().collect()}
    assert set(counts) == set(range(10)) and min(counts.values()) > 120  # roughly uniform
    again = spark.range(2000).repartition(7).select("id", assign.stable_pick("id", "s", 10).alias("p"))
    first = dict(spark.range(2000).select("id", assign.stable_pick("id", "s", 10).alias("p")).collect())
    assert all(first[r.id] == r.p for r in again.collect())


def test_date_nodes_cover_the_range(spark):
    import datetime as dt

    from basketgraph.operators.calendar import date_nodes

    refs = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2023, 12, 30),)], "d date")
    nodes = {r.id: r for r in date_nodes(refs).collect()}
    assert sorted(nodes) == ["20231230", "20231231", "20240101", "20240102", "20240103", "20240104", "20240105", "20240106"]
    sat = nodes["20240106"]
    assert (sat.iso_weekday, sat.is_weekend, sat.day_name, sat.iso_week, sat.quarter) == (6, True, "Saturday", 1, 1)
    assert len(sat) == 11  # id and ten properties
