"""Incremental file-tree ingestion with Structured Streaming (availableNow trigger)."""

import os
import tempfile
import time

from lexiframe.operators import terms as tm
from lexiframe.operators.index import FieldSpec, build_index
from lexiframe.streaming import current_documents, start_file_ingest


def _write(root, rel, text, mtime=None):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(p, (mtime, mtime))


def test_stream_ingest_then_index(spark):
    base = tempfile.mkdtemp(prefix="lexiframe-stream-")
    src, table, ckpt = (os.path.join(base, d) for d in ("src", "table", "ckpt"))
    _write(src, "top.txt", "ignored at the root")
    _write(src, "a/x.txt", "alpha beta")
    _write(src, "a/nodot", "skipped")
    q = start_file_ingest(spark, src, table, ckpt)
    q.awaitTermination(120)
    assert {r.rel_path for r in current_documents(spark, table).collect()} == {"a/x.txt"}

    # a second run picks up only the new file (the checkpoint remembers the first)
    _write(src, "b/c/y.java", "beta gamma gamma")
    q = start_file_ingest(spark, src, table, ckpt)
    q.awaitTermination(120)
    docs = current_documents(spark, table)
    assert {r.rel_path for r in docs.collect()} == {"a/x.txt", "b/c/y.java"}
    idx = build_index(docs.select("doc_id", "text"), fields=[FieldSpec("text")])
    assert {r.term: r.df for r in tm.doc_freqs(idx).collect()} == {"alpha": 1, "beta": 2, "gamma": 1}


def test_latest_version_wins(spark):
    base = tempfile.mkdtemp(prefix="lexiframe-stream2-")
    table = os.path.join(base, "t")
    now = time.time()
    rows = [("f:/r/a/x.txt", "a/x.txt", "old", 3, now - 100), ("f:/r/a/x.txt", "a/x.txt", "new text", 8, now)]
    df = spark.createDataFrame(rows, "path string, rel_path string, text string, size_bytes long, t double") \
        .selectExpr("path", "rel_path", "text", "size_bytes", "timestamp_seconds(t) AS modified")
    df.write.parquet(table)
    got = current_documents(spark, table).collect()
    assert len(got) == 1 and got[0].text == "new text"


def test_incremental_index(spark):
    from lexiframe.streaming import load_incremental_index, start_incremental_index

    base = tempfile.mkdtemp(prefix="lexiframe-inc-")
    src, idx_dir, ckpt = (os.path.join(base, d) for d in ("src", "index", "ckpt"))
    _write(src, "a/x.txt", "alpha beta beta")
    start_incremental_index(spark, src, idx_dir, ckpt).awaitTermination(120)
    _write(src, "b/y.txt", "beta gamma")
    start_incremental_index(spark, src, idx_dir, ckpt).awaitTermination(120)
    idx = load_incremental_index(spark, idx_dir)
    assert idx.docs.count() == 2
    assert {r.term: r.df for r in tm.doc_freqs(idx).collect()} == {"alpha": 1, "beta": 2, "gamma": 1}
    stats = tm.field_stats(idx, "text").collect()[0]
    assert (stats.doc_count, stats.sum_total_term_freq) == (2, 5)


def test_incremental_index_upsert_by_path(spark):
    from lexiframe.streaming import load_incremental_index
    from lexiframe.streaming.file_indexer import _index_batch

    idx_dir = tempfile.mkdtemp(prefix="lexiframe-inc2-")
    schema = "path string, rel_path string, text string, size_bytes long, t double"
    now = time.time()

    def batch(rows):
        return spark.createDataFrame(rows, schema).selectExpr(
            "path", "rel_path", "text", "size_bytes", "timestamp_seconds(t) AS modified")

    per_batch = _index_batch(idx_dir)
    per_batch(batch([("f:/r/a/x.txt", "a/x.txt", "old words", 9, now - 60)]), 0)
    per_batch(batch([("f:/r/a/x.txt", "a/x.txt", "new", 3, now)]), 1)
    per_batch(batch([("f:/r/a/x.txt", "a/x.txt", "new", 3, now)]), 1)  # replayed epoch: idempotent
    idx = load_incremental_index(spark, idx_dir)
    assert [r.text for r in idx.docs.collect()] == ["new"]
    assert {r.term: r.df for r in tm.doc_freqs(idx).collect()} == {"new": 1}
