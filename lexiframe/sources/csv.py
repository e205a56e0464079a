"""CSV sources: numeric record sets and per-query metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_numeric_csv(spark: SparkSession, path: str, drop: Sequence[str] = ()) -> DataFrame:
    """Header row of attribute names, every value a double; malformed rows fail the read."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.DoubleType(), True) for c in header])
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return df.drop(*[c for c in drop if c in header])


def read_metric_csv(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``queryID, <metric>...`` rows without the ``Mean`` row. An id that is not of ``id_type`` fails
    the read; ``id_type="string"`` takes any id."""
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True) \
        .option("ignoreTrailingWhiteSpace", True).csv(path)
    first = df.columns[0]
    name = F.trim(F.col(first))
    odd = F.raise_error(F.concat(F.lit("not a query id of type "), F.lit(id_type + ": "), F.coalesce(name, F.lit("null")))).cast(id_type)
    out = df.where(F.coalesce(name, F.lit("")) != "Mean").select(
        F.coalesce(name.try_cast(id_type), odd).alias("query_id"),
        *[F.col(c).cast("double").alias(c.strip()) for c in df.columns[1:] if c.strip()],
    )
    return out
