"""Incremental indexing of a growing file tree with Structured Streaming.

The batch upsert (re-run the indexer with ``update``) becomes a stream:

* ``stream_file_tree``   — a file-source stream over the tree (whole files, same subdirectory,
  depth and extension rules as the batch reader);
* ``start_file_ingest``  — appends every new file version to a parquet table through the file
  sink (exactly once: the sink log + checkpoint make replays idempotent);
* ``current_documents``  — the newest version per path (upsert by path, resolved at read time
  with a window partitioned by path), ready for ``build_index``.

Writes stay append-only (no rewrite of the collection per micro-batch); the de-duplication is a
partitioned window over the key, so one hot path never gathers more than its own versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiframe.functions.text import normalize_newlines
from lexiframe.sources.filetree import DEFAULT_EXTENSIONS, filter_paths, relative_path


def stream_file_tree(spark: SparkSession, root: str, extensions: Sequence[str] | None = DEFAULT_EXTENSIONS,
                     depth: int = -1, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(root, wholetext=True)
    df = raw.select(
        F.col("_metadata.file_path").alias("path"),
        normalize_newlines(F.col("value")).alias("text"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).withColumn("rel_path", relative_path(F.col("path"), root))
    if depth == 0:
        return df.where(F.lit(False))
    return filter_paths(df, "rel_path", extensions, depth)


def start_file_ingest(spark: SparkSession, root: str, table_dir: str, checkpoint_location: str,
                      extensions: Sequence[str] | None = DEFAULT_EXTENSIONS, depth: int = -1,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream root → parquet ``table_dir``; ``available_now`` drains what exists and stops."""
    stream = stream_file_tree(spark, root, extensions, depth)
    w = (stream.writeStream.format("parquet").option("path", table_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def current_documents(spark: SparkSession, table_dir: str, key: str = "path") -> DataFrame:
    """Newest version of every document (by modification time) with a stable ``doc_id``."""
    versions = spark.read.parquet(table_dir)
    cols = [c for c in versions.columns if c != key]
    # max_by aggregate (map-side partial) rather than a window: many versions of one path stay cheap
    latest = versions.groupBy(key).agg(
        F.max_by(F.struct(*cols), F.struct("modified", "size_bytes")).alias("_b"))
    latest = latest.select(key, *[F.col(f"_b.{c}").alias(c) for c in cols])
    return latest.withColumn("doc_id", F.xxhash64(F.col(key)))


# ---- incremental index: every micro-batch indexes its own files ------------------------------------

def _index_batch(index_dir: str, extra_fields: Sequence[str] = ()):
    from lexiframe.operators.index import FieldSpec, build_index

    fields = [FieldSpec("text")] + [FieldSpec(f, tokenized=False) for f in extra_fields]

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        docs = batch.select(F.xxhash64("path").alias("doc_id"), "text", "path", "rel_path", "size_bytes",
                            "modified", *extra_fields)
        idx = build_index(docs, "doc_id", fields)
        base = index_dir.rstrip("/")
        # one folder per micro-batch, overwritten on replay: foreachBatch may re-run an epoch after
        # a failure, and the same epoch then rewrites the same folder (idempotent)
        idx.docs.write.mode("overwrite").parquet(f"{base}/docs/batch={epoch_id}")
        idx.postings.write.mode("overwrite").parquet(f"{base}/postings/batch={epoch_id}")
        idx.doc_fields.write.mode("overwrite").parquet(f"{base}/doc_fields/batch={epoch_id}")

    return per_batch


def start_incremental_index(spark: SparkSession, root: str, index_dir: str, checkpoint_location: str,
                            extensions: Sequence[str] | None = DEFAULT_EXTENSIONS, depth: int = -1,
                            available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Index new files of the tree as they arrive; read the result with ``load_incremental_index``."""
    stream = stream_file_tree(spark, root, extensions, depth)
    w = (stream.writeStream.foreachBatch(_index_batch(index_dir))
         .option("checkpointLocation", checkpoint_location))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def load_incremental_index(spark: SparkSession, index_dir: str):
    """The current index: the newest version of every document (modification time, then batch)
    and only that version's postings and lengths (semi-join on document and batch)."""
    from lexiframe.operators.index import CorpusIndex, FieldSpec
    from lexiframe.operators.sizing import broadcast_when, small_count

    base = index_dir.rstrip("/")
    docs = spark.read.parquet(f"{base}/docs")
    cols = [c for c in docs.columns if c != "doc_id"]
    latest = docs.groupBy("doc_id").agg(F.max_by(F.struct(*cols), F.struct("modified", "batch")).alias("_b"))
    latest = latest.select("doc_id", *[F.col(f"_b.{c}").alias(c) for c in cols])
    keys = latest.select("doc_id", "batch")
    keys = broadcast_when(keys, small_count(keys))
    postings = spark.read.parquet(f"{base}/postings").join(keys, ["doc_id", "batch"], "left_semi")
    lengths = spark.read.parquet(f"{base}/doc_fields").join(keys, ["doc_id", "batch"], "left_semi")
    return CorpusIndex(latest.drop("batch"), postings.drop("batch").select("field", "doc_id", "term", "tf", "doc_len"),
                       lengths.drop("batch").select("field", "doc_id", "n_terms", "n_tokens", "tf_sq"),
                       "doc_id", (FieldSpec("text"),))
