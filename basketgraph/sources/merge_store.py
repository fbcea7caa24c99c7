"""Stored edges with insert-if-absent that writes only what is new (K4).

Edges lie in append-only deltas, cut into buckets by key. ``snapshots/<n>.json`` names the deltas of state n, and the newest one is
the table. A merge reads only the buckets that its batch touches, writes what is absent there as one more delta and commits it
under the next snapshot's name, which only one writer can take. A merge that adds nothing writes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketgraph.sources import shared_files as sf

BUCKET = "bucket"


@dataclass(frozen=True)
class MergeStore:
    spark: SparkSession
    path: str
    schema: StructType
    keys: Sequence[str]
    buckets: int = 256

    def _snapshot(self) -> tuple[int, list[str]]:
        found = sf.names(self.spark, f"{self.path}/snapshots")
        return (int(found[-1].split(".")[0]), sf.read_json(self.spark, f"{self.path}/snapshots/{found[-1]}")) if found else (0, [])

    def _stored(self, deltas: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        if not deltas:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, "integer")).option("basePath", f"{self.path}/deltas")
        stored = stored.parquet(*[f"{self.path}/deltas/{d}" for d in deltas])
        return (stored if buckets is None else stored.where(F.col(BUCKET).isin(list(buckets)))).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._stored(self._snapshot()[1])

    def merge(self, batch: DataFrame) -> int:
        """Add the edges of ``batch`` whose key is not stored yet; returns how many. Edges already stored stay as they are."""
        number, deltas = self._snapshot()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)
        new = batch.select(*self.schema.names, bucket).dropDuplicates(list(self.keys)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
            held = self._stored(deltas, touched).select(*self.keys)
            name = f"delta={number + 1:010d}-{uuid.uuid4().hex[:8]}"
            fresh = new.join(held, list(self.keys), "left_anti").select(*self.schema.names, BUCKET).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                added = fresh.count()
                if added:
                    fresh.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/deltas/{name}")
                    sf.write_json(self.spark, f"{self.path}/snapshots/{number + 1:010d}.json", [*deltas, name])
                return added
            finally:
                fresh.unpersist()
        finally:
            new.unpersist()
