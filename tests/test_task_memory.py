"""Joins and shuffles that keep a task's memory and the bytes on disk down."""


import numpy as np

from basketgraph.operators import bounded
from basketgraph.operators import graph as graph_ops
from basketgraph.session import hashed_if_large
from tests.conftest import rows


def test_large_node_sides_are_hashed_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(graph_ops, "hashed_if_large", lambda df, nodes: hashed_if_large(df, nodes, 3), raising=False)
    edges = spark.createDataFrame([(1, 1), (2, 9), (None, 1), (8, 9), (2, 2)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 4, None)], "id long")
    flagged = graph_ops.flag_edges(edges, nodes, nodes)
    assert {tuple(r) for r in flagged.collect()} == {(1, 1, None), (2, 9, "missing_dst"), (None, 1, "missing_src"), (8, 9, "missing_both"), (2, 2, None)}
    plan = flagged._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(graph_ops.valid_edges(edges, nodes, nodes)) == [(1, 1), (2, 2)]


def test_packed_lists_are_small_and_come_back_whole():
    products = np.sort(np.random.default_rng(1).choice(1_000_000, 200, replace=False))
    for values in (products, np.ones(200, np.int64), np.array([2**63 - 1, -(2**63), 0]), np.zeros(0, np.int64)):
        assert bounded.unpack(bounded.pack(values)).tolist() == values.tolist()
    assert len(bounded.pack(products)) < 4 * 200 and len(bounded.pack(np.ones(200, np.int64))) < 200


def test_a_reader_takes_only_its_best_of_a_list(spark):
    edges = spark.createDataFrame([(1, 7, 1, 5), (2, 7, 1, 5), *((2, p, 1, p % 3 if p % 4 else None) for p in range(20, 60))], "customer_key long, product_key long, times long, best int").checkpoint()
    best = bounded.own_best(edges, 10).checkpoint()
    lists = bounded.product_lists(edges, best, 5).checkpoint()
    mine = edges.where("customer_key = 1")
    read = bounded.read_product_lists(mine, best.where("customer_key = 1"), lists, 3)
    assert [tuple(r)[1:] for r in bounded.rec.top_k(read, 99).collect()] == [(23, 2), (26, 2), (29, 2)]
