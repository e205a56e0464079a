"""SMART text collections: records ``.I <id>`` / ``.W`` / body lines.

The reader splits on the record separator with Hadoop's line reader (``lineSep``), so a
large collection file is split across tasks like any text file; no driver-side parsing.
The id is the number in the ``.I`` header (not the position in the file), and body lines
keep their newlines. A body line that starts with ``.I `` but heads no record cuts its record in two;
such fragments, told by their missing header, are carried back to the record before them in the file,
also where a split ends between the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD_SEPARATOR = "\n.I "
_HEADER = r"^(?:\.I )?(\d+)[ \t]*\n\.W[ \t]*(?:\n|\z)"


def _lines(value: str) -> Column:
    return F.regexp_replace(F.col(value), r"\r\n?", "\n")


def parse_smart(records: DataFrame, value_col: str = "value", id_name: str = "id",
                body_name: str = "body") -> DataFrame:
    """Turn raw records (text between separators) into ``id BIGINT, body STRING``.

    A record needs its whole header, a number and a ``.W`` line; text without one fails the read
    (``read_smart`` carries fragments back to their record before).
    """
    v = _lines(value_col)
    blank = F.rlike(v, F.lit(r"\A\s*\z"))
    rid = F.when(F.rlike(v, F.lit(_HEADER)), F.regexp_extract(v, _HEADER, 1).cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole record header: "), F.substring(v, 1, 60))).cast("bigint"))
    body = F.regexp_replace(F.regexp_replace(v, _HEADER, ""), r"\n+\z", "")
    return records.where(~blank).select(rid.alias(id_name), body.alias(body_name))


def _stitched(raw: DataFrame) -> DataFrame:
    """``value``: records with the headerless fragments behind them put back.

    ``raw`` has ``value, file, split, i`` (file, start of the split, place in it). Owners are found on
    the three numbers alone: the last header before a fragment in its split, or else in the nearest
    split before that has one. Only the texts of fragments and their owners are shuffled."""
    v = _lines("value")
    # an empty file is one blank record
    marked = raw.withColumn("headed", F.rlike(v, F.lit(_HEADER)) | F.rlike(v, F.lit(r"\A\s*\z")))
    narrow = marked.select("file", "split", "i", "headed")
    if narrow.where(~F.col("headed")).isEmpty():
        return raw.select("value")
    inside = Window.partitionBy("file", "split").orderBy("i")
    before = narrow.withColumn("own", F.last(F.when(F.col("headed"), F.col("i")), ignorenulls=True).over(inside))
    lone = before.where(~F.col("headed")).select("file", "split", "i", "own")
    ends = narrow.where("headed").groupBy("file", "split").agg(F.max("i").alias("last"))  # a row per split
    places = ends.select("file", "split", "last").unionByName(
        lone.where("own IS NULL").select("file", "split", F.lit(None).cast("bigint").alias("last")).distinct())
    places = places.groupBy("file", "split").agg(F.max("last").alias("last"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = places.withColumn("at", F.last(F.when(F.col("last").isNotNull(), F.struct("split", "last")), ignorenulls=True).over(earlier))
    lone = lone.join(carry.select("file", "split", "at"), ["file", "split"], "left")
    lone = lone.select("file", "split", "i", F.when(F.col("own").isNotNull(), F.col("split")).otherwise(F.col("at.split")).alias("own_split"),
                       F.coalesce("own", "at.last").alias("own_i"))
    owners = lone.where("own_i IS NOT NULL").select("file", F.col("own_split").alias("split"), F.col("own_i").alias("i")).distinct()
    here = ["file", "split", "i"]
    plain = marked.where("headed").join(owners, here, "left_anti").select("value")
    lost = marked.join(lone.where("own_i IS NULL").select(*here), here, "left_semi").select("value")  # before any header: fails
    parts = marked.where("headed").join(owners, here, "left_semi").select("file", F.col("split").alias("own_split"), F.col("i").alias("own_i"), "split", "i", "value")
    parts = parts.unionByName(marked.join(lone.where("own_i IS NOT NULL"), here).select("file", "own_split", "own_i", "split", "i", "value"))
    whole = parts.groupBy("file", "own_split", "own_i").agg(F.sort_array(F.collect_list(F.struct("split", "i", "value"))).alias("p"))
    joined = whole.select(F.array_join(F.transform("p", lambda x: x["value"]), RECORD_SEPARATOR).alias("value"))
    return plain.unionByName(joined).unionByName(lost)


def read_smart(spark: SparkSession, path: str, id_name: str = "id", body_name: str = "body") -> DataFrame:
    raw = spark.read.option("lineSep", RECORD_SEPARATOR).text(path)
    # a file may start with blank lines before its first header
    raw = raw.select(F.regexp_replace("value", r"^\s*(?=\.I )", "").alias("value"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("i"))
    return parse_smart(_stitched(raw), "value", id_name, body_name)


def render_smart(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One ``value`` row per record, ready for ``write.text``."""
    return df.select(F.concat(F.lit(".I "), F.col(id_col).cast("string"), F.lit("\n.W\n"),
                              F.coalesce(F.col(text_col), F.lit(""))).alias("value"))


def write_smart(df: DataFrame, id_col: str, text_col: str, path: str) -> None:
    render_smart(df, id_col, text_col).write.mode("overwrite").text(path)
