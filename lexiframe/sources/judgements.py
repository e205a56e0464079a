"""Relevance judgements (qrels) and judgement-derivation from a collection.

File layouts: ``query iter doc rel`` (current) or ``query doc a b`` (old, blank-padded).
The file is read once for all queries (a join key afterwards, never a rescan per query).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_qrels(spark: SparkSession, path: str, layout: str = "current") -> DataFrame:
    cols = F.split(F.trim(F.col("value")), r"\s+")
    raw = spark.read.text(path).where(F.trim("value") != "")
    if layout == "current":
        return raw.select(
            cols[0].cast("bigint").alias("query_id"), cols[1].cast("int").alias("iter"),
            cols[2].cast("bigint").alias("doc_id"), cols[3].cast("int").alias("rel"))
    if layout == "old":
        return raw.select(
            cols[0].cast("bigint").alias("query_id"), cols[1].cast("bigint").alias("doc_id"),
            cols[2].cast("int").alias("a"), cols[3].cast("double").alias("b"))
    raise ValueError(f"unknown qrels layout {layout!r}")
