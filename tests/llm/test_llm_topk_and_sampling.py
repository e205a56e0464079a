"""Dual-tree search and lattice sampling against exhaustive versions; registry and pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.llm import dualtree as d, registry, spsample as s


def plain_top(rows, is_query, k):
    vs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    vs = [(i, list(v)) for i, v in {(i, tuple(v)) for i, v in vs}]
    out = set()
    for q, x in vs:
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vs if i != q)[:k]
            out |= {(q, r + 1, i, -sc) for r, (sc, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("copies", [1, 40])
def test_top_k_matches_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", 50)
    monkeypatch.setattr(d, "QUERY_GROUP", 7)
    monkeypatch.setattr(d, "SAMPLE", 20)
    monkeypatch.setattr(d, "LEAF", 8)
    rng = np.random.default_rng(copies)
    base = rng.normal(size=(300 // copies + 3, 6)).round(2)
    rows = [(i, [float(x) for x in base[i % len(base)]]) for i in range(300)]
    rows += [(900, None), (950, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (951, [float("nan")] * 6), (None, [1.0] * 6), (952, [float("inf")] + [0.0] * 5), rows[0], rows[50]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1)).withColumn("id", F.lit(2)).repartition(5)
    got = {tuple(x) for x in d.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()}
    assert got == plain_top(rows, lambda i: i % 50 == 0, 5)


def test_top_k_with_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (50, [0.5, 0.5]), (3, [1.0])], schema)
    assert {tuple(x)[:3] for x in d.top_k(few, F.col("vec_id") % 50 == 0, 5).collect()} == {(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)}
    assert d.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert d.top_k(few.limit(1), F.col("vec_id") == 0, 5).count() == 0


def test_tree_covers_its_points():
    x = np.random.default_rng(1).normal(size=(700, 5))
    t = d.Tree(x)
    for i, kids in enumerate(t.kids):
        pts = t.order[t.start[i] : t.end[i]]
        assert t.centre[i] in pts and (np.sqrt(((x[pts] - x[t.centre[i]]) ** 2).sum(1)) <= t.radius[i]).all()
        assert not kids or sorted(np.concatenate([t.order[t.start[c] : t.end[c]] for c in kids])) == sorted(pts)


@pytest.fixture(scope="module")
def lattices():
    return s.Lattices(s.Vocabulary(s.MODEL_PATH))


def every_way(text, vocab):
    """All segmentations of one unit with their weights."""
    ends = np.full(len(text), len(text))
    a, b, piece, w = vocab.edges(text, ends)
    out, todo = {}, [(0, (), 0.0)]
    while todo:
        at, got, total = todo.pop()
        if at == len(text):
            out[got] = total
            continue
        todo += [(int(y), (*got, int(p)), total + v) for x, y, p, v in zip(a, b, piece, w) if x == at]
    z = np.logaddexp.reduce(list(out.values()))
    return {k: v - z for k, v in out.items()}


def test_probabilities_and_first_draw(lattices):
    for text in (" ab", " thé", " tests"):
        exact = every_way(text, lattices.vocab)
        n = 6000
        res = s.sample([[text]] * n, np.arange(n).astype(np.int64) * 31337, 3, lattices)
        for r in res[:300]:
            ways = [tuple(int(p) for p in x[0]) for x in r]
            assert len(set(ways)) == min(3, len(exact))
            assert all(abs(x[1] - exact[w]) < 1e-9 for x, w in zip(r, ways))
            assert [x[2] for x in r] == sorted((x[2] for x in r), reverse=True) and all(0 < x[3] <= 1 for x in r)
        first = Counter(tuple(int(p) for p in r[0][0]) for r in res)
        for w, lp in exact.items():
            assert abs(first[w] / n - math.exp(lp)) < 0.03


def test_k_beyond_all_returns_every_segmentation(lattices):
    for text in ("a", " a", " cat", " dogs", " the", "  x", "\n\n\n", " é", " tests", " a1b2c", " zzzz", "日本", " ing", " aaaaa"):
        exact = every_way(text, lattices.vocab)
        for r in s.sample([[text]] * 5, np.arange(5).astype(np.int64) * 104729, len(exact) + 2, lattices):
            assert {tuple(int(p) for p in x[0]) for x in r} == set(exact) and len(r) == len(exact), text
            assert all(x[3] == 1.0 for x in r)
    two = s.sample([["a", " a"]] * 20, np.arange(20).astype(np.int64), 5, lattices)
    n = len(every_way("a", lattices.vocab)) * len(every_way(" a", lattices.vocab))
    assert all(len(r) == min(5, n) for r in two)


def test_pairs_follow_gumbel_top_k(lattices):
    """Ordered pairs have the probabilities of drawing twice without replacement, over two units."""
    one = every_way(" the", lattices.vocab)
    both = {(*a, *b): x + y for a, x in one.items() for b, y in one.items()}
    n = 12000
    res = s.sample([[" the", " the"]] * n, np.arange(n).astype(np.int64) * 7919, 2, lattices)
    seen = Counter(tuple(tuple(int(p) for p in x[0]) for x in r) for r in res)
    for (a, b), c in seen.most_common(12):
        want = math.exp(both[a]) * math.exp(both[b]) / (1 - math.exp(both[a]))
        assert abs(c / n - want) < 0.02
    weights = [sum(math.exp(x[1]) / x[3] for x in r) for r in res]  # Horvitz-Thompson estimate of 1
    assert abs(np.mean(weights) - 1) < 0.02


def test_results_depend_on_keys_only(lattices):
    docs = [s.UNITS.findall(f" some words {i} here\nand more") for i in range(20)]
    keys = np.arange(20).astype(np.int64)
    together = s.sample(docs, keys, 2, lattices)
    apart = [s.sample([x], keys[i : i + 1].copy(), 2, s.Lattices(lattices.vocab))[0] for i, x in enumerate(docs)]
    for a, b in zip(together, apart):
        assert [list(x[0]) for x in a] == [list(x[0]) for x in b] and [x[2] for x in a] == pytest.approx([x[2] for x in b])


def test_forgetting_keeps_results(lattices, monkeypatch):
    docs = [s.UNITS.findall(f" w{i} the cat{i % 7}") for i in range(400)]
    keys = np.arange(400).astype(np.int64)
    want = s.sample(docs, keys, 2, s.Lattices(lattices.vocab))
    monkeypatch.setattr(s, "CACHE_EDGES", 500)
    small, got = s.Lattices(lattices.vocab), []
    for a in range(0, 400, 20):
        got += s.sample(docs[a : a + 20], keys[a : a + 20].copy(), 2, small)
    assert [[list(x[0]) for x in r] for r in want] == [[list(x[0]) for x in r] for r in got]


def test_encode_odd_rows(spark, odd, empty):
    out = s.encode(odd, k=3, name="out")
    assert out.columns == [*odd.columns, "out"]
    rows = out.collect()
    assert len(rows) == 9 and all(x["round_trip"] for r in rows for x in r["out"])
    by = {r["doc_id"]: r for r in rows}
    assert len(by[2]["out"]) == 1 and by[2]["out"][0]["inclusion"] == 1.0
    assert len({bytes(x["ids"]) for x in by[8]["out"]}) == 3
    back = s.decode(out.select("doc_id", "text", F.explode("out.ids").alias("ids")), "ids").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    five = [r["out"] for r in rows if r["doc_id"] == 5]
    assert five[0] == five[1]
    assert s.encode(empty).count() == 0


def test_registry_and_pipeline(spark):
    names = set(registry.LLM_QUERIES)
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.schema)
        assert after.columns == docs.columns and after.count() <= docs.count()
        if name == "secret_scan":
            assert after.count() == docs.count()
        docs = after
        none = stage(spark, docs.limit(0), "/root/testdata/sf0.001")
        assert none.columns == docs.columns and none.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert len(last) == docs.count() and all(r["round_trip"] for r in last)
