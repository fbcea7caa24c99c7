"""Deterministic attribute assignment.

A "random" pick is a hash of the row's key and a salt, reduced modulo the
number of choices. It is stable under retries, re-partitioning and executor
loss, unlike ``rand()``. The hash is the first 32 bits of ``md5(salt:key)``,
which any SQL engine with md5 can reproduce.

Picking a row of a dimension table uses a dense 0-based index over that table,
built without a single-partition window: range-partition and sort by the key,
number rows within each partition, then add the row counts of the partitions
before it (one small row per partition, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketgraph.session import ensure_checkpoint_dir

from basketgraph.functions.ids import CUSTOMER_PREFIX, FARMER_PREFIX, prefixed

# Attribute ranges and choices.
AGE_RANGE = 100
EXPERIENCE_RANGE = 10
GENDERS = ("Male", "Female")

_POS_BITS = 33  # monotonically_increasing_id: partition id in the upper bits, row in the lower 33


def stable_hash(key: Column | str, salt: str) -> Column:
    """Unsigned 32-bit hash of ``salt:key`` (first 8 hex digits of its md5)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(salt + ":"), k.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def stable_pick(key: Column | str, salt: str, n: int | Column) -> Column:
    """0 <= pick < n, fixed for a given key and salt."""
    return F.pmod(stable_hash(key, salt), n if isinstance(n, Column) else F.lit(n))


def with_dense_index(df: DataFrame, order_by: Sequence[str], name: str = "idx") -> tuple[DataFrame, int]:
    """(df with a dense 0-based ``name`` in ``order_by`` order, row count).

    The numbered table is checkpointed to the session's checkpoint directory so
    the numbering is computed once and survives executor loss.
    """
    order_by = list(order_by)
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ordered = ordered.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), "_n")
    total = ordered.count()
    # One row per partition: bounded by the partition count, safe to broadcast.
    indexed = ordered.join(F.broadcast(offsets.select("_pid", "_off")), pid == F.col("_pid"))
    return indexed.select(*df.columns, (F.col("_off") + pos).alias(name)), total


def pick_from(
    facts: DataFrame, key: str, dimension: DataFrame, dim_order: Sequence[str], salt: str, name: str = "idx"
) -> DataFrame:
    """Attach to every fact row one dimension row chosen by ``stable_pick(key, salt)``.

    The dimension is joined on the index; AQE broadcasts it when small and
    shuffles otherwise. Hash picks are uniform, so no index value is hot.
    """
    indexed, n = with_dense_index(dimension, dim_order, name)
    if n == 0:
        raise ValueError("cannot pick from an empty dimension")
    with_idx = facts.withColumn(name, stable_pick(key, salt, n))
    return with_idx.join(indexed, name, "inner").drop(name)


def supplied_by_edges(orders: DataFrame, farmers: DataFrame) -> DataFrame:
    """order_id -> farmer_id: each order's farmer picked by hash of the order key (H1)."""
    j = pick_from(orders.select("invoice_no"), "invoice_no", farmers.select("farmer_key"), ["farmer_key"], "supplier")
    return j.select(prefixed("invoice_no", "O").alias("order_id"), prefixed("farmer_key", FARMER_PREFIX).alias("farmer_id"))


def farmer_nodes(farmers: DataFrame, municipalities: DataFrame) -> DataFrame:
    """farmer_id, farmername, location, experience (H2 with J5 for the location)."""
    j = pick_from(
        farmers.select("farmer_key", "farmer_name"),
        "farmer_key",
        municipalities.select("municipality_key", "municipality"),
        ["municipality_key"],
        "location",
    )
    return j.select(
        prefixed("farmer_key", FARMER_PREFIX).alias("farmer_id"),
        F.col("farmer_name").alias("farmername"),
        F.col("municipality").alias("location"),
        stable_pick("farmer_key", "experience", EXPERIENCE_RANGE).cast("int").alias("experience"),
    )


def customer_nodes(customers: DataFrame) -> DataFrame:
    """customer_id, name, age, gender; age and gender picked by hash of the customer key (H1)."""
    gender = F.when(stable_pick("customer_key", "gender", len(GENDERS)) == 0, GENDERS[0]).otherwise(GENDERS[1])
    return customers.select(
        prefixed("customer_key", CUSTOMER_PREFIX).alias("customer_id"),
        F.col("name"),
        stable_pick("customer_key", "age", AGE_RANGE).cast("int").alias("age"),
        gender.alias("gender"),
    )
