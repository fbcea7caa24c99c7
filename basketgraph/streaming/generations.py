"""A keyed last-write-wins table in generations (K2, R5): batches, compacted days and a manifest.

Layout under the table's folder::

    batches/<batch>/day=<d>/...      one row per key of a micro-batch
    commits/<batch>.json             written last: the batch counts, and the days it touches
    generations/<n>-<id>/day=<d>/... resolved rows of the days a compaction rewrote
    manifests/<n>.json               generation n: the batch it reaches and the folder of each day

Readers take the newest manifest plus the committed batches after it. A compaction rewrites only days that later batches touched and
becomes visible by its manifest, under a name that only one can take. A replayed batch replaces its own files; one that a
compaction already holds is not read again. Every step can be repeated after a failure.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketgraph.sources import shared_files as sf
from basketgraph.streaming.journal import BATCH_COL, latest_per_key

DAY = "day"


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    through: int = -1  # the last batch that the generation holds
    days: dict[str, str] = field(default_factory=dict)  # day -> folder, relative to the table


@dataclass(frozen=True)
class KeyedTable:
    """Where a table is and what decides between rows of one key: the greatest ``order``."""

    spark: SparkSession
    path: str
    schema: StructType  # columns of a batch, without the batch and the day
    key: Sequence[str]
    order: Sequence[str]

    # -- writing ------------------------------------------------------------

    def write_batch(self, batch: DataFrame, batch_id: int, day: str) -> None:
        """Write and commit a micro-batch; ``day`` is the column that names the day of a row."""
        rows = latest_per_key(batch.select(*self.schema.names, F.lit(batch_id).cast("long").alias(BATCH_COL), F.col(day).cast("string").alias(DAY)), self.key, self.order)
        folder = f"{self.path}/batches/{batch_id:012d}"
        rows.write.mode("overwrite").partitionBy(DAY).parquet(folder)
        days = sorted(n.removeprefix(f"{DAY}=") for n in sf.names(self.spark, folder) if n.startswith(f"{DAY}="))
        sf.write_json(self.spark, f"{self.path}/commits/{batch_id:012d}.json", {"days": days}, replace=True)

    # -- reading ------------------------------------------------------------

    def manifest(self) -> Manifest:
        found = sf.names(self.spark, f"{self.path}/manifests")
        if not found:
            return Manifest()
        held = sf.read_json(self.spark, f"{self.path}/manifests/{found[-1]}")
        return Manifest(int(found[-1].split(".")[0]), held["through"], held["days"])

    def committed(self, after: int) -> list[int]:
        ids = (int(n.split(".")[0]) for n in sf.names(self.spark, f"{self.path}/commits"))
        return [i for i in ids if i > after]

    def _stored(self, folders: Sequence[str], *more: Column) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(BATCH_COL, "long")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{self.path}/{f}" for f in folders]).select(*schema.names, *more)

    def read(self) -> DataFrame:
        """One row per key: the columns of a batch and the batch that wrote them."""
        now = self.manifest()
        batches = [f"batches/{b:012d}" for b in self.committed(now.through)]
        held = self._stored(list(now.days.values()))
        if not batches:
            return held
        return latest_per_key(held.unionByName(self._stored(batches)), self.key, self.order).select(held.columns)

    # -- compaction ---------------------------------------------------------

    def compact(self) -> Manifest:
        """Fold all committed batches into a new generation; days that none of them touches keep their folder."""
        now = self.manifest()
        batches = self.committed(now.through)
        if not batches:
            return now
        days_of = {b: sf.read_json(self.spark, f"{self.path}/commits/{b:012d}.json")["days"] for b in batches}
        touched = sorted({d for days in days_of.values() for d in days})
        folder = f"generations/{now.number + 1:012d}-{uuid.uuid4().hex[:8]}"
        every = [now.days[d] for d in touched if d in now.days]
        every += [f"batches/{b:012d}/{DAY}={d}" for b, days in days_of.items() for d in days]
        in_day = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), rf"/{DAY}=([^/]+)/", 1).alias(DAY)
        rows = self._stored(every, in_day)
        latest_per_key(rows, self.key, self.order).write.partitionBy(DAY).parquet(f"{self.path}/{folder}")
        days = {**now.days, **{day: f"{folder}/{DAY}={day}" for day in touched}}
        sf.write_json(self.spark, f"{self.path}/manifests/{now.number + 1:012d}.json", {"through": batches[-1], "days": days})
        return Manifest(now.number + 1, batches[-1], days)

    def vacuum(self) -> None:
        """Remove batches that the newest generation holds and generations that it does not use. Run when no reader is on an older one."""
        now = self.manifest()
        used = {f.split("/")[1] for f in now.days.values()}
        for name in sf.names(self.spark, f"{self.path}/batches"):
            if int(name) <= now.through:
                sf.remove_folder(self.spark, f"{self.path}/batches/{name}")
        for name in sf.names(self.spark, f"{self.path}/generations"):
            if name not in used:
                sf.remove_folder(self.spark, f"{self.path}/generations/{name}")
