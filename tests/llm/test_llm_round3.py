"""BPE, whitening and Merkle manifests against the library, exact integers and a plain tree."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.llm import bpe_segtree, merkle, registry, whitening


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_segtree.MODEL_PATH)


def _texts(seed, n):
    rnd = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "\r\n", "<|endoftext|>", "<|endoftext|", "'s", "'", "12", "é", "é", "the ", "ing", "\t", "日本", "😀", "\x1c", " "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_bpe_equals_the_library(library):
    c = bpe_segtree.Codec(bpe_segtree.MODEL_PATH)
    for t in [*_texts(1, 3000), "a" * 5000, " " * 3000, "ab" * 3001]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(c.encode(t), "<u4").tolist() == ids, t
        assert c.decode(c.encode(t)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_decodes_broken_bytes_as_the_library(library):
    c = bpe_segtree.Codec(bpe_segtree.MODEL_PATH)
    rnd = random.Random(2)
    for _ in range(500):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        assert c.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_merge_takes_the_leftmost_lowest_rank():
    ranks, made = {0 * 10 + 0: 0, 1 * 10 + 1: 1}, [1, 2]  # 0 0 -> 1, 1 1 -> 2
    assert bpe_segtree.merge([0] * 5, ranks, made, 10) == [2, 0]
    assert bpe_segtree.merge([0] * 7, ranks, made, 10) == [2, 1, 0]
    assert bpe_segtree.merge([], ranks, made, 10) == []


def test_bpe_odd_rows(odd, empty, library):
    back = bpe_segtree.decode(bpe_segtree.encode(odd, name="e").select("doc_id", "e.ids"), name="back").collect()
    rows = bpe_segtree.encode(odd, name="e", with_text=True).select(F.col("text").alias("src"), "e.*").collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = bpe_segtree.unpack(r["ids"])
        assert ids == library.encode(r["src"] or "", add_special_tokens=False).ids and r["n"] == len(ids)
        assert r["text"] == (r["src"] or "")
    assert sorted(r["back"] for r in back) == sorted(r["src"] or "" for r in rows)
    assert bpe_segtree.encode(empty).count() == 0


def _brute(vectors):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = np.array([[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) / n**3 for j in range(d)] for i in range(d)])
    return n, s, [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x], v


def test_whitening_equals_exact_integers(spark):
    rng = np.random.default_rng(3)
    good = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 5).tolist()
    good += good[:20]  # repeated rows count
    bad = [None, [1.0, None, 0.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0]]
    rows = [(i, v, 1, "x") for i, v in enumerate(good + bad)] + [(None, good[0], 1, "x")]
    good.append(good[0])
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, id int, v string").repartition(3)
    n, s, dev, v = _brute(good)
    m = whitening.fit(df)
    assert m.n == n and [int(x * n) for x in m.mean] == s
    assert np.allclose(m.covariance, v, rtol=1e-12)
    assert np.allclose(m.values, np.linalg.eigvalsh(v)[::-1])
    out = whitening.whiten(df, m, components=4)
    got = out.collect()
    assert sorted(r["deviation"] for r in got) == sorted(dev) and len(got) == n
    assert {len(r["whitened"]) for r in got} == {4}
    w = np.array([r["whitened"] for r in got])
    assert np.abs(w.T @ w / n - np.eye(4)).max() < 1e-9
    assert whitening.identity_error(out, n) < 1e-9
    x0 = np.array([math.floor(64 * c) + 1_000_000 for c in good[7]], float)
    mine = next(r["whitened"] for r in got if r["id"] == 7)
    assert np.allclose(mine, (x0 - np.array(s) / n) @ m.vectors[:, :4] / np.sqrt(m.values[:4]), rtol=1e-6)


def test_whitening_odd_rows(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.fit(spark.createDataFrame([], kind)) is None
    assert whitening.whiten(spark.createDataFrame([], kind), None).count() == 0
    assert whitening.fit(spark.createDataFrame([(1, []), (2, None)], kind)) is None
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])], kind)
    m = whitening.fit(one)
    rows = whitening.whiten(one, m).collect()
    assert [r["deviation"] for r in rows] == [0, 0, 0] and all(set(r["whitened"]) == {0.0} for r in rows)
    assert whitening.identity_error(whitening.whiten(one, m), 3) == 1.0
    ragged = spark.createDataFrame([(1, [1.0]), (2, [0.0, 1.0]), (3, [1e300, 1.0])], kind.replace("float", "double"))
    m = whitening.fit(ragged)
    assert m.sums[0] == 64 + int(whitening.MOST) and m.sums[1] == 128
    assert None in [r["deviation"] for r in whitening.whiten(ragged, m).collect()]


def test_scatter_of_wide_values():
    rng = np.random.default_rng(4)
    x = rng.integers(-(2**50), 2**50, size=(130, 3))
    sums, product = whitening.scatter(x)
    assert sums == [sum(map(int, x[:, i])) for i in range(3)]
    assert all(product[i][j] == sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for i in range(3) for j in range(i, 3))
    for v in (0, 5, -5, 2**40, -(2**40), 2**39, 10**30, -(10**30)):
        assert sum(y << (whitening.LIMB * at) for _, _, at, y in whitening._limbs(0, 0, v)) == v


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(hashes, fan=3):
    """Root, and per leaf the list of (left, right) up to it."""
    level, members = list(hashes), [[i] for i in range(len(hashes))]
    paths = [[] for _ in hashes]
    while len(level) > 1:
        up, mem = [], []
        for a in range(0, len(level), fan):
            run = level[a : a + fan]
            for j in range(len(run)):
                for leaf in members[a + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(_h(*run))
            mem.append([x for m in members[a : a + fan] for x in m])
        level, members = up, mem
    return level[0], paths


@pytest.mark.parametrize("fan,depth", [(3, 2), (2, 3), (3, 6)])
def test_merkle_equals_a_plain_tree(spark, fan, depth):
    rnd = random.Random(5)
    rows = [(i, "hot", f"{rnd.random()}") for i in range(100)] + [(i, "b", "x") for i in range(10)] + [(7, None, "n"), (8, None, "n")]
    rows += [(i, f"s{i}", "y") for i in range(11)] + [(None, "b", "z"), (5, "b", "x"), (5, "b", "other")] + [(500 + i, "é", "q") for i in range(9)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(4)
    df = df.withColumn("leaf", merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("text"))).withColumn("r", F.lit(1)).withColumn("h", F.lit("k"))
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for i, s, t in rows:
        groups[s].append((-1 if i is None else i, _h(enc(i), enc(s), enc(t))))
    names = sorted(groups, key=lambda s: b"" if s is None else b"\1" + s.encode())
    subs = {s: _tree([h for _, h in sorted(groups[s])], fan) for s in names}
    root, tops = _tree([subs[s][0] for s in names], fan)
    want = []
    for at, s in enumerate(names):
        for (i, h), p in zip(sorted(groups[s]), subs[s][1]):
            want.append((s, i, h, subs[s][0], root, tuple(p + tops[at])))
    got = merkle.manifest(df, "source", "doc_id", "leaf", carry=("text",), fan=fan, depth=depth)
    have = [(r["source"], -1 if r["doc_id"] is None else r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((x["l"], x["r"]) for x in r["path"])) for r in got.collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert got.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert got.where(merkle.fold(F.lit("0"), F.col("path")) == F.col("root")).count() == 0


def test_merkle_edges(spark):
    kind = "source string, doc_id bigint, leaf string"
    assert merkle.manifest(spark.createDataFrame([], kind), "source", "doc_id", "leaf").count() == 0
    one = merkle.manifest(spark.createDataFrame([(None, None, "ab")], kind), "source", "doc_id", "leaf").first()
    assert (one["subroot"], one["root"], one["path"]) == ("ab", "ab", [])
    same = merkle.manifest(spark.createDataFrame([("s", 1, "ab")] * 5, kind), "source", "doc_id", "leaf", depth=1)
    assert same.count() == 5 and same.select("root").distinct().count() == 1


def test_op12_has_no_join_in_its_proofs(spark):
    rows = spark.createDataFrame([("s", i, str(i)) for i in range(30)], "source string, doc_id bigint, leaf string")
    plan = merkle.manifest(rows, "source", "doc_id", "leaf", depth=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_new_queries_on_an_odd_table(spark, odd, empty, tmp_path):
    for name, df in (("odd", odd), ("empty", empty)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, [0.5, 2.0])] if name == "odd" else [], "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        for q in ("op12_merkle", "op13_bpe"):
            assert registry.LLM_QUERIES[q](spark, f"{tmp_path}/{name}").count() == df.count()
        assert registry.LLM_QUERIES["op11_whitening"](spark, f"{tmp_path}/{name}").count() == (2 if name == "odd" else 0)
