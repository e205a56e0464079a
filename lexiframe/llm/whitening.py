"""Embedding whitening from a bit-sliced scatter.

Each entry c becomes the integer x = floor(64 c) + 1,000,000. The scatter is exact: a task turns a
block of rows into bit planes of the entries, shifted by the block's least value in each dimension,
packs every plane across the rows into 64-bit words, and sums 2^(a+b) popcount(plane a of i AND plane
b of j). Tasks emit one row per pair of dimensions and 40-bit limb of their sums; Spark adds these up.
The driver gets d² numbers, bounded by the width of the vectors, centres them as integers
(n P - S Sᵀ) and takes eigenvectors. Covariances do not change with the offset, which is therefore
left out of the products and comes back in ``mean``.

Rows whose vector is null or holds null or non-finite entries are dropped. Repeated rows and rows with
a null id count and come back like any other. A vector shorter than the longest one ends in entries
c = 0. Entries beyond 2^55 are held at that. Components whose eigenvalue is zero (below rounding) have
whitened values of 0, and the identity error then says 1. ``deviation`` is null where it would not
fit a long. An empty table gives an empty one. Extra columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers

SCALE = 64.0
OFFSET = 1_000_000
MOST = 2.0**55
BLOCK = 8192  # rows whose planes are held at a time
LIMB = 40
LONG = 2**63 - 1


@dataclass
class Model:
    n: int
    sums: list[int]          # of floor(64 c), per dimension
    vectors: np.ndarray      # dimension x component, unit columns
    values: np.ndarray       # eigenvalues, falling
    trace: float
    covariance: np.ndarray

    @property
    def mean(self) -> list[Fraction]:
        return [Fraction(s, self.n) + OFFSET for s in self.sums]

    @property
    def explained(self) -> list[float]:
        return [float(e) / self.trace if self.trace > 0 else 0.0 for e in self.values]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(fit, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))


def entries(v: pd.Series, width: int) -> np.ndarray:
    """floor(64 c) as int64, rows x width."""
    size = np.fromiter((len(x) for x in v), np.int64, len(v))
    flat = np.concatenate([np.asarray(x, np.float64) for x in v]) if len(v) else np.zeros(0)
    whole = np.floor(np.clip(flat, -MOST, MOST) * SCALE).clip(-MOST, MOST).astype(np.int64)
    if len(size) and (size == width).all():
        return whole.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = whole
    return out


def planes(y: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit planes of non-negative entries as words: plane a of dimension i is row i * bits + a."""
    bits = max(1, int(y.max(initial=0)).bit_length())
    rows = -(-len(y) // 64) * 64
    out = np.zeros((y.shape[1] * bits, rows // 8), np.uint8)
    for a in range(bits):
        plane = np.packbits(((y >> a) & 1).astype(np.uint8).T, axis=1)
        out[a::bits, : plane.shape[1]] = plane
    return out.view(np.uint64), bits


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross products (upper triangle) of the rows of ``x``."""
    low = x.min(axis=0)
    words, bits = planes(x - low)
    d, m = x.shape[1], len(x)
    pair = np.zeros((d, d, bits, bits), np.int64)
    for p in range(d * bits):  # one plane against all planes from its dimension on
        i, a = divmod(p, bits)
        count = np.bitwise_count(words[p] & words[i * bits :]).sum(axis=1, dtype=np.int64)
        pair[i, i:, a, :] = count.reshape(d - i, bits)
    weight = [[1 << (a + b) for b in range(bits)] for a in range(bits)]
    if 2 * bits + m.bit_length() < 63:
        product = np.einsum("ijab,ab->ij", pair, np.array(weight, np.int64)).tolist()
    else:
        product = (pair.astype(object) * np.array(weight, object)).sum(axis=(2, 3)).tolist()
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).reshape(d, bits).tolist()
    rest = [sum(c << a for a, c in enumerate(r)) for r in ones]
    at = low.tolist()
    sums = [r + m * lo for r, lo in zip(rest, at, strict=True)]
    for i in range(d):  # undo the block's shift
        for j in range(i, d):
            product[i][j] += at[i] * rest[j] + at[j] * rest[i] + m * at[i] * at[j]
    return sums, product


def _limbs(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    """``value`` as digits of 40 bits, the last one signed."""
    at = 0
    while True:
        low = value if -(1 << LIMB) < value < (1 << LIMB) else value & ((1 << LIMB) - 1)
        if low:
            yield i, j, at, low
        value = (value - low) >> LIMB
        at += 1
        if not value:
            return


def _scatter_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (i, j, limb, value) of a task: products at i <= j, sums at j = -1, the count at i = -1."""
    total: dict[tuple[int, int], int] = defaultdict(int)
    width = 0
    for b in batches:
        for a in range(0, len(b), BLOCK):
            v = b["v"].iloc[a : a + BLOCK]
            d = max((len(x) for x in v), default=0)
            width = max(width, d)
            total[-1, -1] += len(v)
            if not d:
                continue
            sums, product = scatter(entries(v, d))
            for i in range(d):
                total[i, -1] += sums[i]
                for j in range(i, d):
                    total[i, j] += product[i][j]
    rows = [r for (i, j), x in total.items() for r in _limbs(i, j, x)]
    rows += [(i, -1, 0, 0) for i in range(width)]  # all dimensions are named, also those of zeros only
    yield pd.DataFrame(rows, columns=["i", "j", "limb", "value"])


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Model | None:
    """The exact scatter of all usable rows and its eigenvectors; None without a usable row or dimension."""
    on_workers(vectors.sparkSession)
    part = usable(vectors, id_col, vector_col).select("v").mapInPandas(_scatter_rows, "i int, j int, limb int, value bigint")
    total: dict[tuple[int, int], int] = defaultdict(int)
    for r in part.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():  # d² rows
        total[r["i"], r["j"]] += int(r["value"]) << (LIMB * r["limb"])
    n, d = total.pop((-1, -1), 0), 1 + max((i for i, _ in total), default=-1)
    if not n or not d:
        return None
    s = [total[i, -1] for i in range(d)]
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * total[i, j] - s[i] * s[j]) / (n * n)  # integers, rounded once
    e, u = np.linalg.eigh(v)
    return Model(n, s, u[:, ::-1].copy(), np.maximum(e[::-1], 0.0), float(np.trace(v)), v)


def _whiten(model: Model, most: int):
    n, s, d = model.n, model.sums, len(model.sums)
    k = min(most, d)
    low = model.values[0] * d * np.finfo(float).eps
    with np.errstate(divide="ignore"):
        scale = np.where(model.values > low, 1.0 / np.sqrt(np.where(model.values > low, model.values, 1.0)), 0.0)[:k]
    project = model.vectors[:, :k]

    def run(v: pd.Series) -> tuple[list[int | None], np.ndarray]:
        x = entries(v, d)
        reach = int(np.abs(x).max(initial=0)) * n + max(abs(y) for y in s)
        if reach * reach * d <= LONG:
            c = x * n - np.array(s, np.int64)
            dev = (c * c).sum(axis=1).tolist()
        else:
            c = x.astype(object) * n - np.array(s, object)
            dev = [y if y <= LONG else None for y in (c * c).sum(axis=1).tolist()]
        return dev, (c.astype(np.float64) / n) @ project * scale

    return run


def whiten(vectors: DataFrame, model: Model | None, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened array<double>) of every usable row: map-only."""
    rows = usable(vectors, id_col, vector_col)
    kind = f"id {rows.schema['id'].dataType.simpleString()}, deviation bigint, whitened array<double>"
    if model is None:
        return rows.limit(0).select("id", F.lit(0).cast("bigint").alias("deviation"), F.col("v").alias("whitened"))
    run = _whiten(model, components)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                dev, w = run(b["v"])
                yield pd.DataFrame({"id": b["id"], "deviation": pd.array(dev, "Int64"), "whitened": list(w)})

    return rows.mapInPandas(task, kind)


def identity_error(whitened: DataFrame, n: int) -> float:
    """Largest entry, by size, of the covariance of ``whitened`` minus the identity. The rows have had
    the exact mean taken off; k² sums are added up by Spark and come to the driver."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if len(b):
                w = np.vstack(b["whitened"])
                total = (0 if total is None else total) + w.T @ w
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    sums = whitened.select("whitened").mapInPandas(task, "i int, j int, value double")
    gap = F.abs(F.sum("value") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return sums.groupBy("i", "j").agg(gap.alias("gap")).agg(F.max("gap")).first()[0]
