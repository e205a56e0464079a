"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.operators.sizing import checkpoint_dir, scratch_path, spread
from lexiframe.sources.tables import read_table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

__all__ = ["cut", "held_out", "on_workers", "read_docs", "read_table", "save_small", "spread"]


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies on a path they can see (a cluster
    that ships the package with ``--py-files`` needs nothing here)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in have if p]])


def read_docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table over at least as many tasks as there are cores (a single small file is dealt out)."""
    return spread(read_table(spark, sf_dir, name), spark.sparkContext.defaultParallelism)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    c = F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(c, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that the cluster shares."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def save_small(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back: later joins then know its
    size, so that Spark broadcasts it only below spark.sql.autoBroadcastJoinThreshold."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
