"""SimHash near-duplicates, with Golay-code fuzzy keys for the search of close fingerprints.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits (the last padded with zeros).
The binary Golay code of length 23 is perfect: every 23-bit word lies within 3 bits of exactly
one of 4,096 codewords. A word whose centre is 3 bits away has 5 more codewords at 4 bits.

*One error.* Two words one bit apart differ in parity. Words of even parity take the index of
their centre as key, words of odd parity those of all codewords within 4 bits: the centre of the
even word is within 4 bits of the odd one, so that they share a key. Equal words share all keys.

*Pigeonhole.* At most 3 differing bits over 3 segments leave either (a) a segment without error
and another with at most one, or (b) one error in each. For (a) the key is the exact segment with
a one-error key of another (30 or 35 bits, 6 ordered pairs); for (b) it is three one-error keys
(36 bits). No pair within 3 bits is missed; pairs that share a key are verified on all 64 bits.

Fingerprints that share a key are compared in blocks: a key with more than ``BLOCK`` different
fingerprints is cut into chunks, and every pair of chunks is a task of its own, so a hot key
never meets in one task. A block emits a star per local component, not its pairs: rows stay in
proportion to the members, and chains over blocks are closed by ``connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import cut, on_workers
from lexiframe.llm.graph import connected_components

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (shift, width)
BLOCK = 512  # different fingerprints compared with each other in one block
MAX_BITS = 3


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits; per syndrome the error patterns of up to
    4 bits (padded with -1), the first of them the coset leader."""
    def rem(v: int) -> int:
        for b in range(22, 10, -1):
            if v >> b & 1:
                v ^= GENERATOR << (b - 11)
        return v

    low = np.array([rem(v) for v in range(1 << 12)], np.int64)
    high = np.array([rem(v << 12) for v in range(1 << 11)], np.int64)
    unit = [rem(1 << b) for b in range(23)]
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    level = [(0, 0, 0)]  # (pattern, syndrome, next bit)
    for _ in range(5):
        for e, s, _n in level:
            found[s].append(e)
        level = [(e | 1 << b, s ^ unit[b], b + 1) for e, s, n in level for b in range(n, 23)]
    width = max(map(len, found))
    patterns = np.full((1 << 11, width), -1, np.int64)
    for s, es in enumerate(found):
        patterns[s, : len(es)] = es
    return low, high, patterns, np.array([len(es) for es in found])


def one_error_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices (the upper 12 bits of a codeword), -1 where a word has fewer."""
    low, high, patterns, _ = _tables()
    e = patterns[low[words & 0xFFF] ^ high[words >> 12]]
    keys = np.where(e >= 0, (words[:, None] ^ e) >> 11, -1)
    even = np.bitwise_count(words.astype(np.uint64)) % 2 == 0
    keys[even, 1:] = -1
    return keys


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, key) for all keys of all fingerprints (int64)."""
    u = fps.astype(np.int64).view(np.uint64)
    seg = [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    near = [one_error_keys(x) for x in seg]
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                r, c = np.nonzero(near[j] >= 0)
                rows.append(r)
                keys.append((3 * i + j) << 40 | seg[i][r] << 12 | near[j][r, c])
    r, c = np.nonzero(near[0] >= 0)
    k = near[0][r, c]
    for x in near[1:]:
        pick, c = np.nonzero(x[r] >= 0)
        r, k = r[pick], k[pick] << 12 | x[r[pick], c]
    rows.append(r)
    keys.append(np.int64(9) << 40 | k)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of the word shingles of one text (repeats count); 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and \x20\x09-\x0D only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = words[at : at + (1 << 14) + shingle - 1]
        if len(words) < shingle:
            h = [xxh64_intdigest(b" ".join(words), 42)]
        else:
            h = [xxh64_intdigest(b" ".join(t), 42) for t in zip(*(part[i:] for i in range(shingle)), strict=False)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp bigint) for every row of ``docs``, repeated rows and null ids included. A null or
    blank text has fingerprint 0; a text of fewer than ``shingle`` words is one shingle."""
    return _fingerprints(docs, id_col, text_col, shingle).select(id_col, "fp")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``simhash`` with the hash of the whole text, which names a row's text beside its id."""
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "_lx_hash": b["hash"], "fp": np.fromiter((fingerprint(t, shingle) for t in b["text"]), np.int64, len(b))})

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("hash"))
    return rows.mapInPandas(run, "id bigint, _lx_hash bigint, fp bigint").withColumnRenamed("id", id_col)


def _local_stars(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Links a-b reduced to one link per value, to the smallest value it hangs together with."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(names))
    return pd.DataFrame({"u": names[keep], "v": names[root[keep]]})


def _compare(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, ci, cj): links within ``max_bits`` in each run, as stars per batch. A
    run has at most two chunks; it is carried on until it has ended."""
    def links(run: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        a, b, d = [], [], 1
        u = fp.view(np.uint64)
        while len(at := np.flatnonzero(run[d:] == run[:-d])) if d < len(run) else False:
            at = at[np.bitwise_count(u[at] ^ u[at + d]) <= max_bits]
            a.append(fp[at])
            b.append(fp[at + d])
            d += 1
        return _local_stars(np.concatenate(a), np.concatenate(b)) if a else pd.DataFrame({"u": [], "v": []}, dtype="int64")

    rest = None
    for b in batches:
        if not len(b):
            continue
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        run = ((b[["key", "ci", "cj"]].diff() != 0).any(axis=1)).cumsum().to_numpy()
        ended = run < run[-1]
        rest = b[~ended]
        if ended.any():
            yield links(run[ended], b["fp"].to_numpy(np.int64)[ended])
    if rest is not None and len(rest):
        yield links(np.zeros(len(rest), np.int64), rest["fp"].to_numpy(np.int64))


def close_links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v): links that join the fingerprints of ``nodes`` (distinct ``fp``) into the same groups
    as all pairs within ``max_bits`` (at most 3) would."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys hold for up to {MAX_BITS} differing bits")
    on_workers(nodes.sparkSession)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = b["fp"].to_numpy(np.int64)
            for at in range(0, len(fps), 2000):
                part = fps[at : at + 2000]
                r, k = fuzzy_keys(part)
                yield pd.DataFrame({"key": k, "fp": part[r]})

    keyed = nodes.select("fp").mapInPandas(keys, "key bigint, fp bigint")
    shared = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("n > 1")
    chunks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    shared = shared.withColumn("chunks", chunks).withColumn("mine", mine)
    dealt = shared.select("key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("mine", "other").alias("ci"), F.greatest("mine", "other").alias("cj"), "fp")
    runs = dealt.repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj")
    return runs.mapInPandas(lambda b: _compare(b, max_bits), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest id that is reached over fingerprints at most ``max_bits``
    apart, the row's own included; rows without words have fingerprint 0 and link like any
    others. Repeated rows each get a row; null ids join groups but are no component id (a group
    of null ids only has a null one). An empty table gives an empty result.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits).drop("_lx_hash")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    fps = cut(_fingerprints(docs, id_col, text_col, shingle))
    nodes = cut(fps.groupBy("fp").agg(F.min(id_col).alias("low")))
    roots = connected_components(close_links(nodes, max_bits))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = cut(named.join(lows, "root").select("fp", "component_id"))
    return fps.join(classes, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "_lx_hash")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is their group's component id, with all their columns. A row
    is judged by its id and text: an id that stands on several texts keeps those whose group it
    names. Rows that repeat id and text are one document; a row with a null id, which no group can
    be named by, stays."""
    out = _grouped(docs, id_col, text_col, shingle, max_bits)
    gone = out.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_lx_gone"), F.col("_lx_hash").alias("_lx_text")).distinct()
    kept = docs.join(gone, (F.col(id_col) == F.col("_lx_gone")) & (_text_hash(text_col) == F.col("_lx_text")), "left_anti")
    return kept.dropDuplicates([id_col, text_col])
