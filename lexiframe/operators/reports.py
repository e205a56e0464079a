"""Report sinks: term lists, hit lists, per-topic metric tables, clustered records.

Reports are DataFrames first; these helpers only write them. ``single_file=True`` gathers a
report into one file (one task) and is meant for bounded reports (per-topic metrics, top-k
lists); large outputs keep one file per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _out(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False,
              decimals: int | None = 3) -> None:
    """CSV sink; doubles are printed with ``decimals`` places (``%.3f`` style) when given."""
    if decimals is not None:
        df = df.select(*[F.format_string(f"%.{decimals}f", F.col(c)).alias(c)
                         if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
    _out(df, single_file).write.mode("overwrite").option("header", header).csv(path)


def write_text(df: DataFrame, path: str, fmt: str, columns: Sequence[str], single_file: bool = False) -> None:
    """Text sink: one ``format_string(fmt, *columns)`` line per row."""
    lines = df.select(F.format_string(fmt, *[F.col(c) for c in columns]).alias("value"))
    _out(lines, single_file).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    _out(df, single_file).write.mode("overwrite").json(path)


def top_n_note(df: DataFrame, n: int) -> DataFrame:
    """``requested, available`` — the "only M available" note of a top-N list."""
    return df.agg(F.lit(n).cast("bigint").alias("requested"),
                  F.least(F.lit(n), F.count(F.lit(1))).cast("bigint").alias("available"))
