"""Tables clustered for lookups by key (F6, S11): a reader of a few keys opens a few files and row groups of them.

Rows lie in ``bucket=<hash of the key>`` folders, range-cut and sorted by key inside, in small row groups with column indexes and
a Bloom filter on the key. A lookup filters on the literal buckets of its keys, which prunes folders before any file is
opened, and on the keys, which prunes row groups and pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"
# Rows that a bucket should hold, and the most buckets of a table.
BUCKET_ROWS, MAX_BUCKETS = 20_000, 4096
# Keys that a lookup takes as literals; more are joined.
MAX_KEYS = 5000
ROW_GROUP = {"parquet.block.size": 1 << 18, "parquet.page.row.count.limit": 1000}


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


class Clustered:
    """A written table with an integer key."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int, columns: Sequence[str]):
        self.spark, self.path, self.key, self.buckets, self.columns = spark, path, key, buckets, list(columns)
        self.stored = spark.read.parquet(path)  # folders are listed once, not per lookup

    @classmethod
    def write(cls, df: DataFrame, path: str, key: str, rows: int) -> Clustered:
        """Write ``df``, of about ``rows`` rows. A key of many rows is cut over several files by the other columns."""
        buckets = max(1, min(MAX_BUCKETS, rows // BUCKET_ROWS))
        order = [key, *[f.name for f in df.schema.fields if f.name != key and f.dataType.simpleString() in ("int", "bigint")]]
        placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).repartitionByRange(BUCKET, *order).sortWithinPartitions(BUCKET, *order)
        options = {**ROW_GROUP, f"parquet.bloom.filter.enabled#{key}": True}
        placed.write.partitionBy(BUCKET).options(**options).parquet(path)
        return cls(df.sparkSession, path, key, buckets, df.columns)

    def read(self) -> DataFrame:
        return self.stored.select(*self.columns)

    def lookup(self, keys: Sequence[int]) -> DataFrame:
        """Rows of the given keys."""
        if not keys:
            return self.stored.where(F.lit(False)).select(*self.columns)
        literal = [F.lit(int(k)) for k in keys]
        return self.stored.where(F.col(BUCKET).isin([bucket_of(k, self.buckets) for k in literal]) & F.col(self.key).isin(literal)).select(*self.columns)

    def lookup_from(self, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(rows whose key is in ``key`` of ``wanted``, ``wanted`` ready to be joined with them).

        Few rows are fetched and looked up as literals; the second result then is a small broadcast table. More are semi-joined.
        """
        found = wanted.limit(MAX_KEYS + 1).collect()
        if len(found) <= MAX_KEYS:
            keys = sorted({r[key] for r in found if r[key] is not None})
            return self.lookup(keys), F.broadcast(self.spark.createDataFrame(found, wanted.schema))
        keys = wanted.select(F.col(key).alias(self.key)).distinct()
        return self.read().join(keys, self.key, "left_semi").select(*self.columns), wanted
