"""Lookups that prune files and row groups; merges that write only what is new."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from basketgraph.operators import bounded
from basketgraph.operators import recommend as rec
from basketgraph.plans import graph_queries as gq
from basketgraph.sources.lookup import Clustered
from basketgraph.sources.merge_store import MergeStore
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


def files_read(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PartitionFilters: [bucket" in text.replace("isnotnull(bucket", "bucket") or "bucket#" in text
    leaves = (plan.executedPlan() if hasattr(plan, "executedPlan") and plan.nodeName() == "AdaptiveSparkPlan" else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def part_files(path):
    return sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)


def test_lookup_reads_few_files_and_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    df = spark.range(400_000).select((F.col("id") % 20_011).alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    table = Clustered.write(df, path, "k", 400_000)
    assert table.buckets == 20
    got = table.lookup([17, 4242, 10**9])
    assert rows(got, "k", "v") == sorted((i % 20_011, i) for i in range(400_000) if i % 20_011 in (17, 4242))
    assert files_read(got) <= 8 < part_files(path)
    few = many = 0
    for folder, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, f)).metadata
                for g in range(meta.num_row_groups):
                    s = meta.row_group(g).column(0).statistics
                    many += 1
                    few += any(s.min <= k <= s.max for k in (17, 4242)) and f"bucket={bucket_number(spark, 17, 20)}" in folder
                    assert meta.row_group(g).column(0).has_column_index
    assert many >= 40 and few <= 4
    assert table.lookup([]).count() == 0
    wanted = spark.createDataFrame([(5,), (5,), (None,)], "k long")
    assert table.lookup_from(wanted, "k")[0].count() == 20


def bucket_number(spark, key, buckets):
    from basketgraph.sources.lookup import bucket_of

    return spark.range(1).select(bucket_of(F.lit(key), buckets)).first()[0]


def test_more_keys_than_literals_are_joined(spark, tmp_path, monkeypatch):
    from basketgraph.sources import lookup

    monkeypatch.setattr(lookup, "MAX_KEYS", 3)
    table = Clustered.write(spark.range(100).select(F.col("id").alias("k")), str(tmp_path / "t"), "k", 100)
    assert rows(table.lookup_from(spark.range(10, 20).withColumnRenamed("id", "w"), "w")[0]) == [(i,) for i in range(10, 20)]


def test_one_customer_lookup_equals_the_full_scan(spark):
    store = gq.GraphStore.of(spark, SF)
    assert store is gq.GraphStore.of(spark, SF)
    mc = gq.customer_multiplicities(spark, SF, 7)
    want = rec.order_path_scores_for(mc, F.lit(7))
    got = store.order_scores(7)
    assert rows(got, "product_key", "score") == rows(want, "product_key", "score")
    assert rows(rec.top_k(store.rating_scores(7)), "product_key", "score") == rows(rec.top_k(rec.rating_scores_for(gq.liked_near(spark, SF, 7), F.lit(7))), "product_key", "score")
    assert store.order_scores(-1).count() == 0 and store.rating_scores(-1).count() == 0
    # the lists of one customer's products lie in a part of the row groups
    keys = [r["key"] for r in store.weights.lookup([7]).collect()]
    assert store.entries.lookup(keys).count() < store.entries.read().count() / 10
    own = store.feedback.lookup([7])
    assert rows(own, "product_key", "rating") == rows(gq.feedback_keys(spark, SF).where("customer_key = 7"), "product_key", "rating")


SCHEMA = "src long, dst long, source string"


@pytest.fixture
def store(spark, tmp_path):
    return MergeStore(spark, str(tmp_path / "m"), spark.createDataFrame([], SCHEMA).schema, ["src", "dst"], buckets=8)


def test_merge_writes_only_what_is_new(spark, store):
    def batch(found):
        return spark.createDataFrame(found, SCHEMA)

    assert store.read().count() == 0
    first = [(i, i % 5, "a") for i in range(60)]
    assert store.merge(batch(first + first[:10])) == 60
    size = part_files(store.path)
    assert store.merge(batch(first)) == 0 and part_files(store.path) == size
    assert store.merge(batch([(1, 1, "b"), (1, 2, "b"), (1, 2, "b"), (None, 3, "b")])) in (2, 3)
    got = rows(store.read().where("src IS NOT NULL"))
    assert got == sorted([*first, (1, 2, "b")])
    assert 1 <= part_files(store.path) - size <= 2


def test_a_delta_without_its_snapshot_is_not_read(spark, store):
    store.merge(spark.createDataFrame([(1, 1, "a")], SCHEMA))
    lost = spark.createDataFrame([(2, 2, "lost")], SCHEMA).withColumn("bucket", F.lit(0))
    lost.write.partitionBy("bucket").parquet(f"{store.path}/deltas/delta=9999999999-lost")
    assert rows(store.read()) == [(1, 1, "a")]


def test_large_customers_use_lists_too(spark):
    """``scores_from_terms`` over looked-up lists equals the term rows of everybody."""
    mc = rec.order_product_counts(spark.createDataFrame([(o, p) for o in range(20) for p in (o % 7, 3, o % 4)], "order_key long, product_key long"), spark.createDataFrame([(o % 5, o) for o in range(20)], "customer_key long, order_key long")).checkpoint()
    entries, weights = bounded.path_lists(mc, 2)
    got = bounded.scores_from_terms(entries, weights, bounded.own_terms(mc))
    assert rows(got, "customer_key", "product_key", "score") == rows(rec.order_path_scores(mc, 2), "customer_key", "product_key", "score")
