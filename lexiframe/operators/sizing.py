"""Size-checked broadcast and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sides up to this many rows are broadcast (query terms, a target vector, 1-row statistics,
# centroids). Beyond it the join is left to Spark (sort-merge, AQE skew handling).
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops the scan early), so a large
    side costs a bounded probe, not a full count.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def broadcast_when(df: DataFrame, rows: int | None, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when a known upper bound of its rows is within ``max_rows``."""
    return F.broadcast(df) if rows is not None and rows <= max_rows else df


def small_count(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> int | None:
    """Row count of ``df`` if it is at most ``max_rows``, else None (bounded probe)."""
    n = df.limit(max_rows + 1).count()
    return n if n <= max_rows else None


def spread(df: DataFrame, min_partitions: int) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` tasks when its input has fewer splits (one big
    file read by one task); a no-op for inputs that are already split finer."""
    if df.rdd.getNumPartitions() < min_partitions:
        return df.repartition(min_partitions)
    return df


@contextmanager
def small_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside reads files in splits of at most ``size`` bytes, for steps that hold a multiple
    of their split: a task then sorts it in memory however large the table is. Only this session's
    split size is set, and put back."""
    largest, per_file = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {name: spark.conf.get(name) for name in (largest, per_file)}
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(largest, str(min(size, as_bytes(before[largest]))))
    spark.conf.set(per_file, str(min(size // 16, as_bytes(before[per_file]))))  # small files still share a task
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (read from the session).

    Only when the cluster names none (local tests) is a temporary folder created and set.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the other executors of a cluster
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="lexiframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back: it is computed once, and later
    joins know its size, so that Spark broadcasts it only below its own threshold."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
