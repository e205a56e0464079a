"""Exact top-k inner products of a query set by dual cover trees.

Components become floor(256 x). Candidates are dealt into blocks by the hash of their id, queries
into groups, and every (group, block) pair is a task that indexes both sides: a cover tree over
each, whose nodes hold a centre that is one of their points, their true covering radius and
children that are at least that child's covering radius apart. A pair of nodes is pruned if

    <cq, cp> + rq |cp| + rp |cq| + rq rp  <  the worst k-th score of the group's queries in the node,

a bound on every inner product between the two. The k-th scores start from a bounded sample of the
candidates, which every query may have, and rise while the trees are walked. Ties are never pruned.

Copies of one vector are interchangeable but for their ids, so that only the k + 1 smallest ids of
each vector take part (a query may be one of them): exact, and no hot vector meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import cut, on_workers

LEAF = 64
FAN = 24
QUERY_GROUP = 1024
BLOCK = 4096
SAMPLE = 2048  # candidates that give the first k-th scores
LIMIT = 2**63 - 1


class Tree:
    """Nodes in arrays; ``start[i]:end[i]`` are the points of node i in ``order``."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x.astype(np.float64)
        self.order = np.arange(len(x))
        self.start, self.end, self.radius, self.centre, self.kids = [], [], [], [], []
        self._add(0, len(x))
        self.norm = np.sqrt((self.x[self.centre] ** 2).sum(axis=1))
        self.radius = np.array(self.radius) * (1 + 1e-9) + 1e-6

    def _add(self, a: int, b: int) -> int:
        me = len(self.start)
        pts = self.order[a:b]
        c = pts[0]
        d = np.sqrt(((self.x[pts] - self.x[c]) ** 2).sum(axis=1))
        self.start.append(a)
        self.end.append(b)
        self.centre.append(c)
        self.radius.append(float(d.max()))
        self.kids.append([])
        if b - a <= LEAF or d.max() == 0:
            return me
        near, goal, own = d, d.max() / 2, np.zeros(b - a, np.int64)
        n = 1
        while near.max() > goal and n < FAN:  # the farthest point becomes the next centre
            f = int(near.argmax())
            e = np.sqrt(((self.x[pts] - self.x[pts[f]]) ** 2).sum(axis=1))
            own[e < near] = n
            near = np.minimum(near, e)
            pts_first = f
            own[pts_first] = n
            n += 1
        by = np.lexsort((near, own))  # the centre comes first in its child
        self.order[a:b] = pts[by]
        cuts = np.searchsorted(own[by], np.arange(n + 1))
        self.kids[me] = [self._add(a + int(s), a + int(e)) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e > s]
        return me


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; those beyond 64 bits are held at their limits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.minimum(np.maximum(exact, -LIMIT), LIMIT).astype(np.int64)


def _merge(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    by = np.lexsort((ids, -score), axis=-1)[:, :k]
    return np.take_along_axis(score, by, 1), np.take_along_axis(ids, by, 1)


def dual_search(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k best (score, id) of ``p`` with another id; missing ones have id -1 and the
    lowest score. Candidates below a query's ``floor`` need not be found."""
    score = np.full((len(q), k), -LIMIT, np.int64)
    ids = np.full((len(q), k), -1, np.int64)
    tq, tp = Tree(q), Tree(p)
    kth = floor.astype(np.float64)

    def bound(a: int, b: np.ndarray) -> np.ndarray:
        cq = tq.x[tq.centre[a]]
        top = tp.x[np.array(tp.centre)[b]] @ cq
        return top + tq.radius[a] * tp.norm[b] + tp.radius[b] * tq.norm[a] + tq.radius[a] * tp.radius[b]

    stack = [(0, 0, float(bound(0, np.array([0]))[0]))]
    while stack:
        a, b, most = stack.pop()
        rows = tq.order[tq.start[a] : tq.end[a]]
        if most * (1 + 1e-12) + 1 < kth[rows].min():
            continue
        if not tq.kids[a] and not tp.kids[b]:
            cols = tp.order[tp.start[b] : tp.end[b]]
            s = _product(q[rows], p[cols])
            i = np.broadcast_to(p_ids[cols], s.shape)
            s = np.where(i == q_ids[rows][:, None], -LIMIT, s)
            i = np.where(i == q_ids[rows][:, None], -1, i)
            score[rows], ids[rows] = _merge(np.hstack([score[rows], s]), np.hstack([ids[rows], np.where(i < 0, np.int64(LIMIT), i)]), k)
            kth[rows] = np.maximum(kth[rows], np.where(ids[rows, -1] >= 0, score[rows, -1], -np.inf))
        elif tp.kids[b] and (not tq.kids[a] or tp.radius[b] >= tq.radius[a]):
            kids = np.array(tp.kids[b])
            of = bound(a, kids)
            stack += [(a, int(kids[j]), float(of[j])) for j in np.argsort(of)]  # the most promising is walked first
        else:
            stack += [(x, b, float(bound(x, np.array([b]))[0])) for x in tq.kids[a]]
    return score, np.where(ids == LIMIT, -1, ids)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<bigint>) of the usable rows, repeated ones once. Vectors that are null or hold
    null or non-finite components are left out, as are null ids; empty vectors score 0."""
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = float(2**62)
    whole = F.transform(v, lambda x: F.greatest(F.least(F.floor(x * 256.0), F.lit(most)), F.lit(-most)).cast("bigint"))
    return vectors.where(v.isNotNull() & fit & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v")).distinct()


def _matrix(v: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(v), max(1, width)), np.int64)  # shorter vectors end in zeros
    for i, x in enumerate(v):
        out[i, : len(x)] = x
    return out


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row chosen by ``queries``, a condition on ``id_col``,
    the k other ids with the highest inner products, ties to the smaller id; all, if fewer."""
    on_workers(vectors.sparkSession)
    usable = cut(quantised(vectors, id_col, vector_col))
    asked = usable.withColumnRenamed("id", id_col).where(queries).withColumnRenamed(id_col, "id")
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = cut(usable.withColumn("n", rank).where(F.col("n") <= k + 1).drop("n"))
    n_q, n_p = asked.count(), kept.count()
    groups, blocks = max(1, -(-n_q // QUERY_GROUP)), max(1, -(-n_p // BLOCK))
    first = kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()  # SAMPLE rows

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            low = np.full(len(b), -np.inf)
            if len(first) > k and len(b):
                width = max(first["v"].map(len).max(), b["v"].map(len).max())
                s = _product(_matrix(b["v"], width), _matrix(first["v"], width)).astype(np.float64)
                s[b["id"].to_numpy()[:, None] == first["id"].to_numpy()[None, :]] = -np.inf
                low = -np.partition(-s, k - 1, axis=1)[:, k - 1]
            yield b.assign(low=low)

    q = asked.mapInPandas(floors, "id bigint, v array<bigint>, low double")
    q = q.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    p = kept.withColumn("b", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "h": [], "vec_id": [], "score": []}).astype("int64")
        width = max(left["v"].map(len).max(), right["v"].map(len).max())
        q_ids = left["id"].to_numpy(np.int64)
        score, ids = dual_search(_matrix(left["v"], width), q_ids, left["low"].to_numpy(), _matrix(right["v"], width), right["id"].to_numpy(np.int64), k)
        r, c = np.nonzero(ids >= 0)
        return pd.DataFrame({"query_id": q_ids[r], "h": left["h"].to_numpy(np.int64)[r], "vec_id": ids[r, c], "score": score[r, c]})

    found = q.withColumn("h", F.xxhash64("v")).groupBy("g", "b").cogroup(p.groupBy("g", "b")).applyInPandas(
        search, "query_id bigint, h bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
