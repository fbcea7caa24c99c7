"""Tables bucketed on the order key: the order-side plans run without a shuffle."""

from __future__ import annotations

from basketgraph.plans import REGISTRY

SF = "/root/testdata/sf0.001"
BUCKETS = 4


def test_bucketed_order_tables_need_no_exchange(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    spark.read.parquet(f"{SF}/lineitem.parquet").write.mode("overwrite").bucketBy(BUCKETS, "l_orderkey").sortBy(
        "l_orderkey"
    ).saveAsTable("bucketed.lineitem")
    spark.read.parquet(f"{SF}/orders.parquet").write.mode("overwrite").bucketBy(BUCKETS, "o_orderkey").sortBy(
        "o_orderkey"
    ).saveAsTable("bucketed.orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join path
    try:
        for name in ("order_totals", "order_latest_date", "order_contains"):
            from_catalog = REGISTRY[name].build(spark, "catalog:bucketed")
            plan = from_catalog._jdf.queryExecution().sparkPlan().toString()
            assert "Exchange" not in plan, f"{name} shuffles on bucketed tables:\n{plan}"
            from_files = REGISTRY[name].build(spark, SF)
            assert sorted(map(tuple, from_catalog.collect())) == sorted(map(tuple, from_files.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
