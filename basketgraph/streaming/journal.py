"""Keyed last-write-wins table on plain files.

Each micro-batch is written by ``foreachBatch`` into its own ``batch_id``
partition of an append-only journal with dynamic partition overwrite, so a
replayed batch replaces exactly the files it wrote before and nothing else. The
table is a view over the journal: per key, the row with the greatest ordering
columns (event time, then a unique id) wins, independent of arrival order.
Compaction writes the resolved view to a new path as a separate batch job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH_COL = "batch_id"


def write_batch(batch: DataFrame, batch_id: int, journal_path: str) -> None:
    """Idempotent append of one micro-batch: replaces only partition ``batch_id``."""
    (
        batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_COL)
        .parquet(journal_path)
    )


def start_journal_sink(
    df: DataFrame, journal_path: str, checkpoint: str, available_now: bool = False, interval: str = "1 second"
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(lambda b, i: write_batch(b, i, journal_path)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` tuple.

    A ``max`` over a struct that leads with the ordering columns: an aggregation
    with map-side combine, so a key holding a large share of the rows is reduced
    in every map task before the shuffle instead of being sorted in one task.
    """
    key, order = list(key), list(order)
    payload = [c for c in df.columns if c not in key and c not in order]
    best = df.groupBy(*key).agg(F.max(F.struct(*order, *payload)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in order + payload])


def read_table(spark: SparkSession, journal_path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The resolved table; ``order`` may use ``batch_id`` (arrival batch) as a column."""
    journal = spark.read.parquet(journal_path)
    if BATCH_COL not in order:
        journal = journal.drop(BATCH_COL)
    return latest_per_key(journal, key, order)


def compact(spark: SparkSession, journal_path: str, out_path: str, key: Sequence[str], order: Sequence[str]) -> None:
    read_table(spark, journal_path, key, order).write.mode("errorifexists").parquet(out_path)


def daily_key(date_col: str, user_col: str) -> F.Column:
    """``yyyy-MM-dd_user``: one document per user per day; null if either part is null, so unrelated rows never share a key."""
    return F.concat(F.date_format(F.col(date_col), "yyyy-MM-dd"), F.lit("_"), F.col(user_col).cast("string"))
