"""Large or awkward inputs: ranks over many partitions, tails, small distances, readers that lose nothing."""

import math
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexiframe.functions.stats import normal_cdf, student_t_two_sided_p
from lexiframe.operators import kmeans as km
from lexiframe.operators import significance as sg
from lexiframe.operators.terms import _distributed_rank
from lexiframe.sources import read_file_tree, read_metric_csv, read_smart


def test_signed_ranks_of_many_values_add_up(spark):
    n = 100_000
    d = spark.range(n).select((F.when(F.rand(1) < 0.6, 1).otherwise(-1) * (F.col("id") + 1)).cast("double").alias("d"))
    r = sg.signed_rank_sums(d.checkpoint()).first()
    assert r["n"] == n and r["w_plus"] + r["w_minus"] == n * (n + 1) / 2


def test_distributed_rank_is_dense(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).alias("v"))
    got = _distributed_rank(df, [F.col("v")]).agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
    assert tuple(got) == (1, 50_000, 50_000)


def test_tails_keep_their_size(spark):
    row = spark.range(1).select(*[normal_cdf(F.lit(z)).alias(f"z{i}") for i, z in enumerate((-3.0, -5.0, -20.0, -30.0, 5.0, 0.0))]).first()
    want = [0.5 * math.erfc(x / math.sqrt(2)) for x in (3, 5, 20, 30, -5, 0)]
    assert all(abs(a - b) <= 1e-9 * b for a, b in zip(row, want))


@pytest.mark.parametrize("t, df, p", [(2.0, 1, 0.29516723530086653), (2.0, 2, 0.18350341907227397), (2.0, 10, 0.07338803477074039),
                                      (6.0, 30, 1.394276876e-06), (0.0, 5, 1.0), (-2.0, 10, 0.07338803477074039)])
def test_student_t(spark, t, df, p):
    got = spark.range(1).select(student_t_two_sided_p(F.lit(t), F.lit(df))).first()[0]
    assert got == pytest.approx(p, rel=1e-6)


def test_student_t_of_many_pairs_is_nearly_normal(spark):
    a, b = spark.range(1).select(student_t_two_sided_p(F.lit(3.0), F.lit(99_999)), student_t_two_sided_p(F.lit(3.0), F.lit(100_001))).first()
    assert a == pytest.approx(b, rel=1e-6)


def test_clusters_do_not_depend_on_the_unit(spark):
    pts = [(0, 0.0), (1, 10.0), (2, 0.1), (3, 10.1)]
    out = []
    for scale in (1.0, 1e-6):
        df = spark.createDataFrame([(i, [x * scale]) for i, x in pts], "vec_id bigint, embedding array<double>")
        out.append({r["vec_id"]: r["cluster"] for r in km.kmeans(df, 2, iterations=None).assignments.collect()})
    assert out[0] == out[1] == {0: 0, 1: 1, 2: 0, 3: 1}


def test_records_without_terms_are_clustered(spark):
    v = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0), (3, "a", 0.9)], "doc_id bigint, term string, w double")
    ids = spark.createDataFrame([(i,) for i in range(1, 6)], "doc_id bigint")
    got = km.sparse_kmeans(v, 2, 2, ids=ids).assignments.collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3, 4, 5]


def _file(text, name="f.txt"):
    root = tempfile.mkdtemp(prefix="lexiframe-src-")
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return root, path


@pytest.mark.parametrize("body", [".I think this stays\nlast line", ".I 7 apples\nlast line"])
def test_smart_reader_loses_no_text(spark, body):
    _, path = _file(f".I 1\n.W\nfirst\n{body}\n.I 2\n.W\nsecond\n")
    got = {r["id"]: r["body"] for r in read_smart(spark, path).collect()}
    assert got == {1: f"first\n{body}", 2: "second"}  # the cut-off text is put back
    _, path = _file("no header\n.I 2\n.W\nsecond\n")
    with pytest.raises(PySparkException):  # text before the first record has no place
        read_smart(spark, path).collect()


def test_metric_csv_drops_the_mean_only(spark):
    _, path = _file("queryID,P\n1,0.5\nq7,0.25\nMean,0.375\n", "m.csv")
    assert [r["query_id"] for r in read_metric_csv(spark, path, "string").collect()] == ["1", "q7"]
    with pytest.raises(PySparkException):
        read_metric_csv(spark, path).collect()


def test_hidden_files_are_not_lost_silently(spark):
    root, _ = _file("text", "a/_x.txt")
    _file("ok")
    with open(os.path.join(root, "a", "y.txt"), "w") as f:
        f.write("shown")
    with pytest.raises(ValueError):
        read_file_tree(spark, root)
    assert [r["rel_path"] for r in read_file_tree(spark, root, hidden="skip").collect()] == ["a/y.txt"]
