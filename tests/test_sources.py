"""File tree, SMART text, judgements, CSV readers and line slices (temporary folders)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lexiframe.functions.text import line_slice
from lexiframe.sources import (
    read_file_tree,
    read_metric_csv,
    read_numeric_csv,
    read_qrels,
    read_smart,
)


def _write(root, rel, text, mode="w"):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, mode, newline="") as f:
        f.write(text)
    return p


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="lexiframe-tree-")
    _write(root, "top.txt", "ignored\n")
    _write(root, "a/x.txt", "hello world\r\nsecond line\n")
    _write(root, "a/b/y.java", "class Y {}\n")
    _write(root, "a/nodot", "no extension\n")
    _write(root, "a/b/z.TXT", "upper-case extension is not whitelisted\n")
    _write(root, "c d/e f.txt", "a space in the path\n")
    return root


def test_file_tree_unlimited(spark, tree):
    rows = read_file_tree(spark, tree).select("rel_path", "text").collect()
    got = {r.rel_path: r.text for r in rows}
    assert set(got) == {"a/x.txt", "a/b/y.java", "c d/e f.txt"}  # Q10: no-dot file skipped, siblings kept
    assert got["a/x.txt"] == "hello world\nsecond line"  # CRLF normalised, final newline dropped


def test_file_tree_depth(spark, tree):
    assert sorted(r.rel_path for r in read_file_tree(spark, tree, depth=1).collect()) == ["a/x.txt", "c d/e f.txt"]
    assert read_file_tree(spark, tree, depth=0).count() == 0


def test_file_tree_metadata(spark, tree):
    r = read_file_tree(spark, tree, depth=1).where("rel_path = 'a/x.txt'").collect()[0]
    assert r.size_bytes == len("hello world\r\nsecond line\n")
    assert len(r.last_modified_fmt) == 19 and len(r.last_modified_ms_fmt) == 17
    assert r.type == "isRegularFile"
    assert read_file_tree(spark, tree, provenance=True).where("task IS NULL").count() == 0


def test_line_slices(spark):
    df = spark.createDataFrame([("l1\nl2\nl3\nl4\nl5",)], "t string")

    def s(t, b):
        return df.select(line_slice(F.col("t"), t, b).alias("x")).collect()[0].x

    assert s(2, 2) == "l1\nl2\nl4\nl5"
    assert s(4, 3) == "l1\nl2\nl3\nl4\nl5"  # Q11: overlap keeps every line once
    assert s(0, 2) == "l4\nl5"               # Q11: bottom-only works
    assert s(2, 0) == "l1\nl2"


def test_smart_reader(spark):
    d = tempfile.mkdtemp(prefix="lexiframe-smart-")
    _write(d, "c.all", ".I 1\n.W\nfoo bar\nbaz\n.I 2\n.W\nqux i.I 3\n.I 10\n.W\nlast\n")
    rows = read_smart(spark, os.path.join(d, "c.all")).orderBy("id").collect()
    assert [(r.id, r.body) for r in rows] == [(1, "foo bar\nbaz"), (2, "qux i.I 3"), (10, "last")]  # Q05


def test_smart_body_lines_that_look_like_separators(spark):
    d = tempfile.mkdtemp(prefix="lexiframe-smart-")
    records = {1: "one\n.I think so\nand\n.I am", 2: "two", 3: ".I 5 is no header\nthree\n.I \nx"}
    records |= {i: f"filler {i}\n" + "\n".join(f".I line {j} of {i}" for j in range(i % 4)) for i in range(4, 200)}
    records = {i: t.rstrip("\n") for i, t in records.items()}
    _write(d, "c.all", "".join(f".I {i}\n.W\n{t}\n" for i, t in records.items()))
    assert {r.id: r.body for r in read_smart(spark, os.path.join(d, "c.all")).collect()} == records
    conf = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "97")  # splits end inside records, and many hold fragments only
    try:
        assert read_smart(spark, os.path.join(d, "c.all")).rdd.getNumPartitions() > 1
        assert {r.id: r.body for r in read_smart(spark, os.path.join(d, "c.all")).collect()} == records
    finally:
        spark.conf.set(conf, old)


def test_smart_topics_keep_line_breaks(spark):  # Q06: words at line ends do not fuse
    from lexiframe.operators.search import query_terms

    d = tempfile.mkdtemp(prefix="lexiframe-qry-")
    _write(d, "q.qry", ".I 1\n.W\n concentrations\nor levels\n")
    t = read_smart(spark, os.path.join(d, "q.qry"), "query_id", "text")
    terms = {r.term for r in query_terms(t).collect()}
    assert terms == {"concentrations", "or", "levels"}


def test_qrels_layouts(spark):
    d = tempfile.mkdtemp(prefix="lexiframe-rel-")
    _write(d, "cur", "1 0 13 1\n1 0 14 1\n2 0 13 1\n")
    _write(d, "old", "1   13   0   0.000000\n2  13 0 0.000000\n")
    cur = read_qrels(spark, os.path.join(d, "cur"))
    assert cur.count() == 3 and cur.where("query_id = 1").count() == 2
    old = read_qrels(spark, os.path.join(d, "old"), layout="old")
    assert [(r.query_id, r.doc_id) for r in old.orderBy("query_id").collect()] == [(1, 13), (2, 13)]


def test_csv_sources(spark):
    d = tempfile.mkdtemp(prefix="lexiframe-csv-")
    _write(d, "n.csv", "x,y,Class\n1.0,2.0,0\n3.0,4.5,1\n")
    df = read_numeric_csv(spark, os.path.join(d, "n.csv"), drop=["Class"])
    assert df.columns == ["x", "y"] and df.agg(F.max("y")).collect()[0][0] == 4.5
    _write(d, "m.csv", "queryID,P@10,RECALL@10,APN@10\n1,0.5,0.25,0.3\n2,0.1,0.2,0.1\nMean,0.3,0.225,0.2\n")
    m = read_metric_csv(spark, os.path.join(d, "m.csv"))
    assert m.count() == 2 and m.columns[0] == "query_id"
