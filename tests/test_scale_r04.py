"""Findings of round 4: rounds of k-means, evaluation over an index, trees of many files."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.functions import text as tx
from lexiframe.operators import kmeans as km
from lexiframe.operators.evaluation import derive_qrels
from lexiframe.sources import filetree as ft


def _numpy_sse(x, centers, k, rounds):
    c, out = centers.copy(), []
    for _ in range(rounds):
        a = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(k)])
        out.append(((x - c[a]) ** 2).sum())
    return out


def test_a_round_of_kmeans_is_one_pass(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6)) + 1e3
    path = str(tmp_path / "vectors")
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").write.parquet(path)
    df = spark.read.parquet(path)
    passes = []
    assign = km.assign_nearest
    monkeypatch.setattr(km, "assign_nearest", lambda *a, **b: passes.append(1) or assign(*a, **b))
    monkeypatch.setattr(km, "_sse_against", None)  # regular vectors need no second pass
    res = km.kmeans(df, 4, iterations=None)
    sse = [r["sse"] for r in res.sse.orderBy("iteration").collect()]
    assert len(passes) == len(sse) + 1  # the last one is that of the assignments
    assert "FileScan" not in res.sse._jdf.queryExecution().executedPlan().toString()
    assert np.allclose(sse, _numpy_sse(x, x[:4], 4, len(sse)), rtol=1e-11, atol=0)
    far = spark.createDataFrame([(j, (x[j] * 1e6).tolist()) for j in range(2)], "cluster int, center array<double>")
    monkeypatch.undo()  # a fall by many orders is summed up, not subtracted
    sse = [r["sse"] for r in km.kmeans(df, 2, 2, seeds=far).sse.orderBy("iteration").collect()]
    assert np.allclose(sse, _numpy_sse(x, x[:2] * 1e6, 2, 2), rtol=1e-11, atol=0)


def test_kmeans_of_odd_vectors(spark):
    rows = [(0, [0.0, 0.0]), (1, [10.0, 0.0]), (2, [1.0, None]), (3, None), (4, [9.0, 1.0]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    some = df.where("vec_id <> 5")
    res = km.kmeans(some, 2, iterations=None)
    # a vector with a null lies in the first cluster and counts for the dimensions that it has, not for the SSE
    assert {r["cluster"]: r["center"] for r in res.centroids.collect()} == {0: [0.5, 0.0], 1: [9.5, 0.5]}
    assert [r["sse"] for r in res.sse.collect()][-1] == 0.25 + 0.5 + 0.5
    # a vector of another length is infinitely far: the SSE cannot fall, and the loop ends
    assert [r["sse"] for r in km.kmeans(df, 2, iterations=None).sse.collect()] == [float("inf")]
    assert km.kmeans(df.limit(0), 2, iterations=None).sse.collect() == [(1, None)]
    assert some.join(res.assignments, "vec_id").where(F.col("cluster") == 1).count() == 2


def test_plain_words_are_tokens_of_the_rules(spark):
    rng = random.Random(4)
    alphabet = list("abzAZ019 \n\t\r.,:;!?()\"'-_·/") + ["é", "ß", "÷", "ÿ", "ª", "ā", "\u0301", "\u00ad", "\u200d", "\u2019", "\u00a0",
                                                           "я", "ö", "漢", "ア", "ー", "ก", "א", "\u203f", "İ", "😀"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 40)))) for i in range(4000)] + [(-1, None)]
    low = F.lower("text")
    df = spark.createDataFrame(rows, "i int, text string").select(
        "text", F.regexp_extract_all(low, F.lit(tx.JAVA_TOKEN_PATTERN), 0).alias("a"), F.regexp_extract_all(low, F.lit(tx.RULES_PATTERN), 0).alias("b"))
    assert df.where("NOT (a <=> b)").collect() == []
    assert df.where("size(a) > 3").count() > 1000


def test_long_tokens_and_counts(spark):
    rows = [(0, None, None), (1, "", False), (2, "a" * 255, False), (3, "b " + "a" * 256, True), (4, "a" * 256 + "\n", True),
            (5, ("a" * 255 + "\t") * 300, False), (6, " " * 999, False), (7, "x " * 100_000 + "é" * 256, True)]
    df = spark.createDataFrame(rows, "i int, text string, long boolean")
    assert df.where(~tx.may_be_long(F.col("text")).eqNullSafe(F.col("long"))).count() == 0
    toks = spark.createDataFrame([(0, None), (1, []), (2, ["a"]), (3, ["b", "a", "b", "c", "b", "a"])], "i int, t array<string>")
    got = {r["i"]: [tuple(x) for x in r["terms"]] for r in tx.with_term_counts(toks, "t").collect()}
    assert got == {0: [], 1: [], 2: [("a", 1)], 3: [("a", 2), ("b", 3), ("c", 1)]}


def test_judgements_build_no_string_per_shingle(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "b a"), (3, "c"), (4, None), (5, "x a b y c d"), (5, "a b")], "doc_id bigint, text string")
    topics = spark.createDataFrame([(10, "a b"), (11, "c d e"), (12, "c"), (13, None)], "item_id bigint, text string")
    q = derive_qrels(docs, topics, 2)
    assert "array_join" not in q._jdf.queryExecution().optimizedPlan().toString()  # an expression tree evaluated per token
    assert sorted(map(tuple, q.collect())) == [(10, 0, 1, 1), (10, 0, 5, 1), (11, 0, 1, 1), (11, 0, 5, 1)]
    assert sorted((r[0], r[2]) for r in derive_qrels(docs, topics, 1).collect()) == [
        (10, 1), (10, 2), (10, 5), (11, 1), (11, 3), (11, 5), (12, 1), (12, 3), (12, 5)]
    for k in (1, 2, 3):
        rows = docs.select("doc_id", tx.tokens("text").alias("t"))
        parts = [F.col(f"sh.t{j}") for j in range(k)]
        new = tx.shingle_rows(rows, "t", k).select("doc_id", F.concat_ws(" ", *parts).alias("sh"))
        old = rows.select("doc_id", F.explode(tx.shingles("t", k)).alias("sh"))
        assert sorted(map(tuple, new.collect())) == sorted(map(tuple, old.collect()))


def test_local_trees_are_listed_by_tasks_as_spark_lists_them(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tree")
    names = ["a/x.txt", "a/empty.txt", "a/b/y.java", "a/no", "a/z.TXT", "c d/e f.txt", "a+b/p+q.txt", "p%20/q%.txt", "ü/日本 x.txt",
             "k=v/_m=1/f.txt", "_metadata_x/f.txt", "a/_metadata.txt", "a/_h.txt", ".hid/g.txt", "a/.q.txt", "a/w._COPYING_",
             "a/[1]{2}.txt", "a/tab\tq.txt", "top.txt", "a/x#y?z.txt", "a/'(q)!;,.txt", "a/b/c/d.txt"]
    for n in names:
        os.makedirs(os.path.dirname(f"{root}/{n}"), exist_ok=True)
        with open(f"{root}/{n}", "wb") as f:
            f.write(b"" if "empty" in n else b"\xef\xbb\xbfa\r\nb\xc3" + n.encode() + b"\n\n")
    os.symlink(f"{root}/a/b", f"{root}/c d/link")
    os.symlink(f"{root}/nothing", f"{root}/a/broken.txt")

    def rows(**kinds):
        return sorted(map(tuple, ft.read_file_tree(spark, root, hidden="skip", **kinds).collect()))

    kinds = [{}, {"extensions": None}, {"depth": 2}, {"extensions": (".txt",), "depth": 1}]
    monkeypatch.setattr(ft, "FILES_PER_TASK", 3)
    own = [rows(**k) for k in kinds]
    plan = ft.read_file_tree(spark, root, hidden="skip")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan  # whose list of all files the driver holds
    monkeypatch.setattr(ft, "_local_folder", lambda *a: None)
    assert own == [rows(**k) for k in kinds] and len(own[0]) > 12


def test_hidden_files_deep_in_a_local_tree(spark, tmp_path):
    (tmp_path / "a/_b/c").mkdir(parents=True)
    (tmp_path / "a/_b/c/x.pdf").write_text("x")
    (tmp_path / "a/y.txt").write_text("y")
    with pytest.raises(ValueError, match="a/_b/c/x.pdf"):
        ft.read_file_tree(spark, str(tmp_path), depth=1)
    assert [r["rel_path"] for r in ft.read_file_tree(spark, f"file://{tmp_path}/", extensions=(".txt",)).collect()] == ["a/y.txt"]
