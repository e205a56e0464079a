"""Quality classifier by co-training of two views.

The *text* view sees what stands in a document, the *metadata* view only its other columns
(language, source, recorded length). Each view has a classifier fitted on a bounded labelled
sample. Over some rounds, each view labels the documents of a bounded unlabelled pool that it is
most sure of, per class, and hands them to the other view's training set. Labelled rows kept
aside then calibrate both views (Platt scaling) and fit their combination, which scores every
document in one pass.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers
from lexiframe.llm.fit import logistic, sigmoid

LABELLED = 4000  # labelled documents, half of each class at most
POOL = 4000  # unlabelled documents
ROUNDS = 5
CONFIDENT = 0.95  # least confidence of a pseudo-label
PER_ROUND = 200  # pseudo-labels per view, class and round
META_BUCKETS = 64
LETTERS = re.compile(r"[^\W\d_]+")
DIGIT = re.compile(r"[0-9]+")
ODD = re.compile(r"[^\w\s.,;:!?'\"()\-]")


def text_features(text: str | None) -> list[float]:
    """Shape of a whole text; an empty or null one has zeros but for its length."""
    t = text or ""
    words = t.split()
    n, c = len(words), len(t)
    if not n:
        return [0.0] * 15 + [math.log1p(c)]
    count = Counter(words)
    letters = sum(map(len, LETTERS.findall(t)))
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    odd = len(ODD.findall(t))
    bare = sum(1 for w in words if not any(map(str.isalnum, w)))
    lines = t.split("\n")
    stops = sum(1 for w in words if w[-1] in ".!?")
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    marked = sum(1 for w in words if w[-3:] in ("!!!", "###", "***", "$$$", "%%%", "&&&") or w.endswith("!!"))
    return [letters / c, upper / n, odd / c, bare / n, len(count) / n, count.most_common(1)[0][1] / n, runs / n, marked / n, stops / n,
            len(set(lines)) / len(lines), len(DIGIT.findall(t)) / (n + 20), math.log1p(n / len(lines)), c / n / 10, t.count("|") / n,
            math.log1p(n), math.log1p(c)]


def meta_features(lang: str | None, source: str | None, chars: float | None) -> np.ndarray:
    out = np.zeros(META_BUCKETS + 2)
    for name, v in (("lang", lang), ("source", source)):
        out[zlib.crc32(f"{name}={v}".encode()) % META_BUCKETS] += 1
    n = 0.0 if chars is None or chars != chars else max(0.0, float(chars))
    out[META_BUCKETS] = math.log1p(n) / 10
    out[META_BUCKETS + 1] = out[META_BUCKETS] ** 2
    return out


def text_matrix(texts) -> np.ndarray:
    x = np.array([text_features(t) for t in texts], float).reshape(-1, 16)
    return np.hstack([x, np.square(x[:, :14])])


def meta_matrix(lang, source, chars) -> np.ndarray:
    return np.array([meta_features(a, b, c) for a, b, c in zip(lang, source, chars, strict=True)], float).reshape(-1, META_BUCKETS + 2)


@dataclass
class Model:
    """Per view: means, scales, weights; Platt weights; and the weights of the combination."""
    views: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    platt: list[np.ndarray]
    both: np.ndarray

    def margins(self, xs: list[np.ndarray]) -> np.ndarray:
        z = [((x - m) / s) @ w[:-1] + w[-1] for x, (m, s, w) in zip(xs, self.views, strict=True)]
        return np.stack([np.clip(v * a[0] + a[1], -30, 30) for v, a in zip(z, self.platt, strict=True)], axis=1)

    def score(self, xs: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self.margins(xs) @ self.both[:-1] + self.both[-1])


def _fit_view(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m, s = x.mean(axis=0), x.std(axis=0)
    s = np.where(s < 1e-9, 1.0, s)
    return m, s, logistic((x - m) / s, y, ridge=1e-3)


def co_train(xs: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], aside: np.ndarray, share: float, rounds: int = ROUNDS) -> Model:
    """``aside`` marks the labelled rows that calibrate; ``share`` is the positive share of all labels."""
    fit = ~aside if (~aside).any() and aside.any() else np.ones(len(y), bool)
    cal = aside if aside.any() else fit
    sets = [[x[fit]] for x in xs]
    labels = [[y[fit]], [y[fit]]]
    free = np.ones(len(pool[0]), bool)
    views = [_fit_view(x[fit], y[fit]) for x in xs]
    for _ in range(rounds):
        given = 0
        for v in (0, 1):
            m, s, w = views[v]
            p = sigmoid(((pool[v] - m) / s) @ w[:-1] + w[-1])
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                at = np.flatnonzero(free & (sure >= CONFIDENT))
                at = at[np.argsort(-sure[at], kind="stable")][:PER_ROUND]
                if len(at):
                    free[at] = False
                    sets[1 - v].append(pool[1 - v][at])
                    labels[1 - v].append(np.full(len(at), label))
                    given += len(at)
        if not given:
            break
        views = [_fit_view(np.vstack(sets[v]), np.concatenate(labels[v])) for v in (0, 1)]
    part = y[cal]
    weight = np.where(part > 0, share / max(part.mean(), 1e-9), (1 - share) / max(1 - part.mean(), 1e-9))
    platt = [logistic((((x[cal] - m) / s) @ w[:-1] + w[-1])[:, None], part, weight, ridge=1e-4) for x, (m, s, w) in zip(xs, views, strict=True)]
    model = Model(views, platt, np.zeros(3))
    model.both = logistic(model.margins([x[cal] for x in xs]), part, weight, ridge=1e-4)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          meta: tuple[str, str, str] = ("lang", "source", "n_chars"), train_rows: Column | None = None,
          labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """Fits on at most ``labelled`` labelled documents and a pool of at most ``pool`` others of the
    training rows, chosen by the hash of their id; one in four labelled ones calibrates. Labels of
    documents in the pool are not read, so that the views also exchange labels where ``labels`` covers
    every document. Of several rows of one id the one with the smallest hash counts. None if no
    document is labelled, as in an empty table."""
    on_workers(docs.sparkSession)
    mark = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if train_rows is not None:
        mark = mark.where(train_rows)
    mark = mark.groupBy(F.col(id_col).alias("_lx_id")).agg(F.max(label_col).cast("int").alias("_lx_y"))
    each = [mark.where(F.col("_lx_y") == y).orderBy(F.xxhash64("_lx_id"), "_lx_id").limit(labelled // 2) for y in (0, 1)]
    chosen = each[0].unionByName(each[1])
    free = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_lx_id"))
    if train_rows is not None:
        free = docs.where(F.col(id_col).isNotNull() & train_rows).select(F.col(id_col).alias("_lx_id"))
    free = free.join(F.broadcast(chosen.select("_lx_id")), "_lx_id", "left_anti").distinct().orderBy(F.xxhash64("_lx_id"), "_lx_id").limit(pool)
    some = F.broadcast(chosen.unionByName(free.withColumn("_lx_y", F.lit(None).cast("int"))))  # labelled + pool ids
    rows = docs.join(some, F.col(id_col) == F.col("_lx_id")).select(
        "_lx_id", "_lx_y", F.col(text_col).cast("string").alias("text"), F.col(meta[0]).cast("string").alias("lang"),
        F.col(meta[1]).cast("string").alias("source"), F.col(meta[2]).cast("double").alias("chars"))
    rows = rows.withColumn("h", F.xxhash64("text", "lang", "source", "chars"))

    def shape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["_lx_id"].astype("int64"), "h": b["h"], "y": b["_lx_y"].astype("float64"), "t": list(text_matrix(b["text"])),
                                "m": list(meta_matrix(b["lang"], b["source"], b["chars"]))})

    got = rows.mapInPandas(shape, "id long, h long, y double, t array<double>, m array<double>")
    one = got.groupBy("id").agg(F.min_by(F.struct("y", "t", "m"), "h").alias("x"))  # copies are put together before the shuffle
    got = one.select("id", "x.*").toPandas().sort_values("id")  # bounded as the sample is
    known = got["y"].notna().to_numpy()
    if not known.any():
        return None
    xs = [np.array(got[c].tolist(), float) for c in ("t", "m")]
    y = got["y"].to_numpy(float)[known]
    aside = np.array([zlib.crc32(f"aside {i}".encode()) % 4 == 0 for i in got["id"][known]])
    share = mark.agg(F.avg("_lx_y")).first()[0]
    width = [x.shape[1] for x in xs]
    return co_train([x[known] for x in xs], y, [x[~known].reshape(-1, n) for x, n in zip(xs, width, strict=True)], aside, share)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", meta: tuple[str, str, str] = ("lang", "source", "n_chars"),
          name: str = "score") -> DataFrame:
    """Adds the probability of label 1; 0.5 everywhere without a model. Null texts count as empty,
    null metadata as a value of its own; rows and columns stay."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    on_workers(docs.sparkSession)

    @F.pandas_udf("double")
    def run(text: pd.Series, lang: pd.Series, source: pd.Series, chars: pd.Series) -> pd.Series:
        return pd.Series(model.score([text_matrix(text), meta_matrix(lang, source, chars)]), dtype="float64")

    return docs.withColumn(name, run(F.col(text_col).cast("string"), F.col(meta[0]).cast("string"), F.col(meta[1]).cast("string"), F.col(meta[2]).cast("double")))
