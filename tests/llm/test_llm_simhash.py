"""SimHash near-duplicates against all pairs, and the key guarantee of the Golay code."""

import random
import re

import numpy as np
import xxhash

from lexiframe.llm import graph, simhash_golay as s


def plain_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, fps, bits=3):
    root = list(range(len(ids)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    return [min((ids[j] for j in groups[find(i)] if ids[j] is not None), default=None) for i in range(len(ids))]


def test_every_pair_within_three_bits_shares_a_key():
    rng, r = np.random.default_rng(3), random.Random(3)
    a = rng.integers(-(2**63), 2**63 - 1, 4000, dtype=np.int64)
    b = a.copy().view(np.uint64)
    for i in range(len(b)):
        for x in r.sample(range(64), i % 4):
            b[i] ^= np.uint64(1) << np.uint64(x)
    keys = []
    for v in (a, b.view(np.int64)):
        own = [set() for _ in v]
        for i, k in zip(*s.fuzzy_keys(v)):
            own[i].add(int(k))
        keys.append(own)
    assert all(x & y for x, y in zip(*keys))


def test_matches_brute_force(spark, rows_of):
    r = random.Random(5)
    texts = []
    for _ in range(12):
        words = [f"w{r.randrange(400)}" for _ in range(120)]
        for _ in range(8):
            copy = list(words)
            for _ in range(r.randrange(3)):
                copy[r.randrange(len(copy))] = f"w{r.randrange(400)}"
            texts.append(" ".join(copy))
    pairs = [(100 - i, t) for i, t in enumerate(texts)] + [(200, ""), (201, None), (150, "Two words"), (151, "two WORDS")]
    fps = [plain_fp(t) for _, t in pairs]
    want = {(i, f"{f:016x}", c) for (i, _), f, c in zip(pairs, fps, components([i for i, _ in pairs], fps))}
    got = {tuple(x) for x in s.near_duplicates(rows_of(pairs)).collect()}
    assert got == want


def test_dense_group_in_small_blocks(spark):
    r = random.Random(1)
    base = r.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in r.sample(range(64), r.randrange(3))) for _ in range(300)} | {r.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    want = components(signed, fps)
    roots = {x["node"]: x["root"] for x in graph.connected_components(s.close_links(nodes, 3, block=16)).collect()}
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(roots.get(f, f), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_odd_rows_and_empty_table(odd, empty):
    got = s.near_duplicates(odd).collect()
    assert len(got) == 9
    by = {(x["doc_id"], x["fingerprint"], x["component_id"]) for x in got}
    assert {(1, "0" * 16, 1), (2, "0" * 16, 1), (3, "0" * 16, 1)} <= by
    assert any(x["doc_id"] is None for x in got)
    assert s.near_duplicates(empty).count() == 0
    kept = s.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    ids = sorted(x["doc_id"] if x["doc_id"] is not None else -1 for x in kept.collect())
    assert ids == [-1, 1, 4, 5, 7, 8]
    assert s.keep_one_per_group(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {x["node"]: x["root"] for x in graph.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_one_id_on_two_texts_loses_no_group(rows_of):
    x, y, z = (" ".join(f"{k}{i}" for i in range(60)) for k in "xyz")
    kept = s.keep_one_per_group(rows_of([(3, y), (5, x), (5, y), (9, x), (9, z), (9, z), (None, x)]))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, x), (3, y), (5, x), (9, z)]
