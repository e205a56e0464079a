"""Findings of round 3: file trees of many files, scores without a shuffle of query postings, index writes."""

import os
import tempfile

from pyspark.sql import functions as F

import pytest

from lexiframe.operators import index as ix
from lexiframe.operators import search as se
from lexiframe.operators.index import CorpusIndex, build_index
from lexiframe.operators.sizing import small_splits
from lexiframe.sources.filetree import read_file_tree, write_file_tree


def test_tree_files_are_written_by_the_tasks(spark):
    root = tempfile.mkdtemp(prefix="lexiframe-tree-")
    rows = [(1, "a", "one\r\ntwo"), (2, "a", None), (3, "b c", "drei"), (4, None, "four"), (5, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)
    write_file_tree(docs, f"file://{root}", ["source", "doc_id"], "text")
    names = [n for _, _, files in os.walk(root) for n in files]
    assert len(names) == 5 and not any(n.endswith(".crc") for n in names)  # Hadoop's local client adds them, a process each
    tree = read_file_tree(spark, f"file://{root}", depth=2).select(
        F.regexp_extract("rel_path", r"doc_id=(-?\d+)/", 1).cast("int"), "text", "size_bytes")
    assert {tuple(r) for r in tree.collect()} == {(1, "one\ntwo", 9), (2, "", 1), (3, "drei", 5), (4, "four", 5), (5, "", 1)}


def _saved_index(spark, n=400):
    docs = spark.range(n).select(
        ((F.col("id") * 7919) % n).alias("doc_id"), F.concat(F.lit("the word"), F.col("id") % 13, F.lit(" of "), F.col("id")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source")).repartition(5)
    path = "file://" + tempfile.mkdtemp(prefix="lexiframe-idx-")
    build_index(docs).save(path)
    return CorpusIndex.load(spark, path), path


def test_scores_do_not_shuffle_query_postings(spark):
    idx, _ = _saved_index(spark)
    topics = spark.createDataFrame([(1, "the word1"), (2, "of the the"), (3, "word2 of")], "query_id bigint, text string")
    qt = se.query_terms(topics)
    # every document holds `the` and `of`, so that all topics match all of them
    for scores, rows in ((se.score_jm(idx, qt, 0.5), 1200), (se.score_tfidf(idx, qt), 1200), (se.score_jm_grid(idx, qt), 12000)):
        plan = scores._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(query_id" not in plan and "hashpartitioning(doc_id" in plan
        assert scores.count() == rows
    assert se.score_jm(idx, qt, 0.5).groupBy("query_id", "doc_id").count().where("count > 1").count() == 0


def test_new_documents_are_dealt_by_key_before_they_are_analysed(spark):
    idx, path = _saved_index(spark)
    files = spark.read.parquet(f"{path}/seg-*/docs").groupBy(F.input_file_name().alias("f")).agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("lo").collect()
    assert len(files) > 4 and all(a["hi"] < b["lo"] for a, b in zip(files, files[1:]))
    vectors = spark.read.parquet(f"{path}/seg-*/term_vectors/field=text").select("doc_id", F.input_file_name().alias("f"))
    for name in [r["f"] for r in vectors.select("f").distinct().collect()]:
        keys = [r["doc_id"] for r in spark.read.parquet(name).select("doc_id").coalesce(1).collect()]
        assert keys == sorted(keys)
    assert idx.forward.where("field = 'text'").count() == 400 and idx.terms.where("term = 'the'").first()["df"] == 400


@pytest.mark.parametrize("broadcast", [True, False])
def test_postings_are_sorted_and_shuffled_once(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ix, "BLOCK_DOCS", 2)  # many blocks, so that `the` lies in several buckets
    if not broadcast:
        monkeypatch.setattr(ix, "small_count", lambda df: None)
    idx, path = _saved_index(spark)
    stored = spark.read.parquet(f"{path}/seg-*/postings")
    # a term and block lie in one bucket, where one row holds their largest share: no aggregate over postings is needed
    by_block = stored.groupBy("field", "term", "block").agg(F.countDistinct("bucket").alias("b"), F.sum(F.col("peak").cast("int")).alias("p"))
    assert by_block.where("b <> 1 or p <> 1").count() == 0
    dense = stored.groupBy("field", "term").count().where(F.col("count") >= ix.DENSE_DF).select("field", "term")
    tops = stored.join(dense, ["field", "term"]).groupBy("field", "bucket", "term", "block").agg(F.max(F.col("tf") / F.col("doc_len")).alias("top"))
    got = spark.read.parquet(f"{path}/seg-*/impacts").select(*tops.columns)
    assert got.count() == tops.count() > 40 and got.exceptAll(tops).count() == 0
    ranges = stored.groupBy("field", "bucket").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
    found = spark.read.parquet(f"{path}/seg-*/ranges").select(*ranges.columns)
    assert found.where("lo = hi and lo = 'the'").count() > 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, ranges.collect()))
    plan = ix._ranged(idx.postings, "doc_id", 400, 2400)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Sort [") == 1


def test_splits_are_small_for_one_step_only(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), small_splits(spark, 4096):
        assert spark.conf.get(name) == "4096"
        with small_splits(spark, 1 << 40):  # never larger ones
            assert spark.conf.get(name) == "4096"
        raise ZeroDivisionError
    assert spark.conf.get(name) == before
