"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is split at the vocabulary's added tokens, each piece is split into words by the byte-level
pattern, and each word's bytes are merged: the leaves of a segment tree hold rank * span + position of
every adjacent pair, so that its root is the leftmost pair of lowest rank. A merge changes the pair
itself and its two neighbours: three point updates of logarithmic cost. It ends when the root holds no
mergeable pair. A word of n bytes takes O(n log n), however long it is.

Words of up to ``CACHE_CHARS`` characters are remembered (at most ``CACHE_WORDS`` of them per Python
worker, then the memory starts anew); longer ones are merged each time.

Null texts count as empty: no tokens, decoded to the empty text. Repeated rows are encoded one by one
and an empty table gives an empty one. ``ids`` are little-endian unsigned 32-bit integers. Only the
names given as ``name`` are added to the columns of the input.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers

MODEL_PATH = "/opt/tokenizers/byte_bpe_50k.json"
CACHE_WORDS = 400_000
CACHE_CHARS = 32
STRIDE = 200_000  # words of one text that are looked up at a time

# Fixed value: the word pattern of byte-level BPE vocabularies.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes for themselves, the
    others, in order, for the characters from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def merge(ids: list[int], ranks: dict[int, int], made: list[int], width: int) -> list[int]:
    """``ids`` after all merges. ``ranks`` maps left * width + right to the pair's rank, ``made`` a
    rank to the id it makes."""
    n = len(ids)
    if n < 2:
        return ids
    span = 1 << (n - 2).bit_length() if n > 2 else 1
    none = len(made) * span
    rank = ranks.get
    tree = [none] * (2 * span)
    for i in range(n - 1):
        r = rank(ids[i] * width + ids[i + 1])
        if r is not None:
            tree[span + i] = r * span + i
    for p in range(span - 1, 0, -1):
        a, b = tree[2 * p], tree[2 * p + 1]
        tree[p] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        p = span + i
        tree[p] = value
        p >>= 1
        while p:
            a, b = tree[2 * p], tree[2 * p + 1]
            least = a if a < b else b
            if tree[p] == least:
                return
            tree[p] = least
            p >>= 1

    while tree[1] < none:
        r, i = divmod(tree[1], span)
        j = after[i]
        k = after[j]
        ids[i], ids[j] = made[r], -1
        after[i] = k
        if k < n:
            before[k] = i
            put(j, none)
            s = rank(ids[i] * width + ids[k])
            put(i, none if s is None else s * span + i)
        else:
            put(i, none)
        h = before[i]
        if h >= 0:
            s = rank(ids[h] * width + ids[i])
            put(h, none if s is None else s * span + h)
    return [x for x in ids if x >= 0]


class Words(dict):
    """Word -> packed ids; a miss is merged, and remembered if short."""

    def __init__(self, first: list[int], ranks: dict[int, int], made: list[int], width: int) -> None:
        self.first, self.ranks, self.made, self.width = first, ranks, made, width

    def __missing__(self, word: str) -> bytes:
        first = self.first
        ids = merge([first[b] for b in word.encode()], self.ranks, self.made, self.width)
        packed = np.array(ids, "<u4").tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """A byte-level BPE vocabulary file in the JSON format of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE vocabulary without normalizer and prefix space")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take neighbouring characters")
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        chars = byte_chars()
        self.added = {t["content"]: int(t["id"]) for t in spec["added_tokens"] if t["content"]}
        self.size = 1 + max([*vocab.values(), *self.added.values()])
        ranks = {vocab[a] * self.size + vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.words = Words([vocab[c] for c in chars], ranks, [vocab[a + b] for a, b in pairs], self.size)
        self.find = regex.compile(WORD)
        self.split = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        byte_of = {c: b for b, c in enumerate(chars)}
        token = [b""] * self.size
        for t, i in vocab.items():
            token[i] = bytes(byte_of[c] for c in t)
        for t, i in self.added.items():
            token[i] = t.encode()
        self.flat = np.frombuffer(b"".join(token), np.uint8)
        self.length = np.array([len(t) for t in token], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def _piece(self, text: str) -> bytes:
        look = self.words.__getitem__
        if len(text) <= STRIDE:
            return b"".join(map(look, self.find.findall(text)))
        out, some = [], []
        for m in self.find.finditer(text):
            some.append(m.group())
            if len(some) == STRIDE:
                out.append(b"".join(map(look, some)))
                some = []
        return b"".join([*out, *map(look, some)])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.split is None or not (found := list(self.split.finditer(text))):
            return self._piece(text)
        out, a = [], 0
        for m in found:
            out += [self._piece(text[a : m.start()]), np.array([self.added[m.group()]], "<u4").tobytes()]
            a = m.end()
        return b"".join([*out, self._piece(text[a:])])

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD, ids beyond the vocabulary nothing."""
        i = np.frombuffer(ids or b"", "<u4").astype(np.int64)
        i = i[i < self.size]
        if not len(i):
            return ""
        n = self.length[i]
        shift = self.start[i] - (np.cumsum(n) - n)
        return self.flat[np.repeat(shift, n) + np.arange(n.sum())].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per vocabulary and Python worker."""
    return Codec(path)


def _coder(path: str, with_text: bool):
    kind = "struct<n:bigint,ids:binary,text:string>" if with_text else "struct<n:bigint,ids:binary>"

    @F.pandas_udf(kind)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for batch in texts:
            ids = [c.encode(t) for t in batch]
            out = {"n": [len(i) // 4 for i in ids], "ids": ids}
            if with_text:
                out["text"] = [c.decode(i) for i in ids]
            yield pd.DataFrame(out)

    return run


def encode(docs: DataFrame, path: str = MODEL_PATH, text: str = "text", name: str = "bpe", with_text: bool = False) -> DataFrame:
    """``docs`` with ``name``: struct(n tokens, packed ids and, with ``with_text``, the text that these
    ids decode to) of each whole text."""
    on_workers(docs.sparkSession)
    return docs.withColumn(name, _coder(path, with_text)(F.col(text)))


def decode(df: DataFrame, path: str = MODEL_PATH, ids: str = "ids", name: str = "text") -> DataFrame:
    """``df`` with ``name``: the text of the packed ids; null ids give the empty text."""
    on_workers(df.sparkSession)

    @F.pandas_udf("string")
    def run(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for batch in packed:
            yield pd.Series([c.decode(i) for i in batch], dtype=object)

    return df.withColumn(name, run(F.col(ids)))


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()
