"""Session construction and the shared scratch location.

Library code never builds its own session; callers pass one in. ``local_session``
is for tests and the benchmark only. ``shared_path`` resolves a location under
the cluster's checkpoint directory (``spark.checkpoint.dir``), which is the one
place a job may write intermediate tables that must survive executor loss.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basketgraph") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    scratch = tempfile.mkdtemp(prefix="basketgraph-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BASKETGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)  # keeps a configured spark.checkpoint.dir; sets a local one only if unset
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is. Only a session without one (a test or a local driver run)
    gets a fresh local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("no checkpoint directory: set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="basketgraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("no checkpoint directory: set spark.checkpoint.dir to a shared folder")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Write ``df`` once to the checkpoint directory and continue from the files.

    For intermediates read by several branches of one plan: the branches scan
    the written table instead of recomputing its lineage, and the data survives
    executor loss. Partitioning is kept, so later joins on the same keys do not
    shuffle again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_freed(df):
    """``materialize``, but the shuffle files it took leave at its end, not when the driver happens to collect its garbage.

    Spark reads the setting when it plans, so the plan is made anew under it. A lost task is computed again from the inputs.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = conf.get(key, None)
    conf.set(key, "true")
    try:
        planned = df.select("*")
    finally:
        conf.unset(key) if was is None else conf.set(key, was)
    return materialize(planned)


def task_slots(spark: SparkSession) -> int:
    """How many tasks run at a time, as far as is known."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect doesn't say
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df):
    """Round-robin ``df`` over all task slots when its scan is narrower than the cluster.

    For row-local but CPU-heavy work (regex cleaning of whole texts) right after a
    scan. A table stored as one large row group scans in one task; on a real
    table with many files and row groups the scan already has more partitions
    than slots and this returns ``df`` unchanged, adding no shuffle.
    """
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        narrow = df.rdd.getNumPartitions() < slots
    except Exception:  # Spark Connect exposes neither; leave the plan as it is
        return df
    return df.repartition(slots) if narrow else df


def hashed_if_large(df, counted=None, max_rows: int = 1_000_000):
    """``df`` as the hashed side of a shuffle join if ``counted`` (``df`` itself by default) has more than ``max_rows`` rows.

    For a side of narrow rows that is the smaller one of each partition: a sort-merge join sorts the rows of the other side too, and
    Spark merges well compressed partitions until a task holds millions of them. Smaller sides are left to Spark, which may broadcast them.
    """
    return df.hint("shuffle_hash") if (df if counted is None else counted).count() > max_rows else df
