"""The store of one-customer lookups grows with the edges, not with pairs of products."""

from pyspark.sql import functions as F

from basketgraph.operators import recommend as rec
from basketgraph.plans import graph_queries as gq
from basketgraph.sources.lookup import Clustered
from tests.conftest import rows


def _tables(spark, base):
    # an order of 120 products beside small ones
    lines = [(1, p) for p in range(120)] + [(o, (o * k) % 50) for o in range(2, 60) for k in (1, 2, 3)]
    line = spark.createDataFrame([(o, p, float(o + p), "ANR"[(o + p) % 3]) for o, p in lines], "l_orderkey long, l_partkey long, l_quantity double, l_returnflag string")
    line.withColumn("l_linenumber", F.lit(1)).write.parquet(f"{base}/lineitem.parquet")
    orders = spark.createDataFrame([(o, o % 9 if o % 10 else None) for o in range(1, 60)], "o_orderkey long, o_custkey long")
    orders.withColumn("o_orderdate", F.current_timestamp()).write.parquet(f"{base}/orders.parquet")
    return len(lines)


def test_the_store_holds_edges_not_pairs(spark, tmp_path, monkeypatch):
    n, stored, write = _tables(spark, tmp_path), [], Clustered.write
    monkeypatch.setattr(Clustered, "write", lambda df, *a: stored.append(df.count()) or write(df, *a))
    store = gq.GraphStore(spark, str(tmp_path))
    assert 0 < sum(stored) <= 4 * n
    mc = rec.order_product_counts(gq.contains_keys(spark, str(tmp_path)), gq.buys_keys(spark, str(tmp_path))).checkpoint()
    every, feedback = rec.order_path_scores(mc).checkpoint(), gq.feedback_keys(spark, str(tmp_path))
    for customer in (1, 4):
        assert rows(store.order_scores(customer), "customer_key", "product_key", "score") == rows(every.where(F.col("customer_key") == customer), "customer_key", "product_key", "score")
        want = rec.top_k(rec.rating_scores_for(feedback, F.lit(customer)))
        assert rows(rec.top_k(store.rating_scores(customer)), "product_key", "score") == rows(want, "product_key", "score")
