"""Retrieval evaluation: relevance flags, P@n, R@n, AP@n, means, λ sweep, train/test.

Definitions (per judged topic, i.e. a topic with at least one relevant document; run cut at n):
  P   relevant retrieved / returned documents (returned ≤ n; ``denominator='cut'`` divides by n)
  R   relevant retrieved / relevant documents
  AP  Σ over relevant retrieved at rank k of (relevant within the first k) / k, divided by the
      number of relevant documents (ranks start at 1)
A judged topic without any hit scores 0. Means are over the evaluated (judged) topics.

Per-topic work is bounded by the cut (≤ n rows per topic), so the windows here partition by
topic over n rows; topics themselves are spread over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions.text import shingle_rows, tokens
from lexiframe.operators.sizing import broadcast_when, small_count

METRICS = ("P", "R", "MAP")


def derive_qrels(docs: DataFrame, topics: DataFrame, k: int = 8, key: str = "doc_id",
                 topic_id: str = "item_id", text: str = "text", topic_text: str = "text") -> DataFrame:
    """Judgements from shared passages: a document is relevant to a topic when it contains at
    least one k-token shingle of the topic. ``query_id, iter, doc_id, rel``.

    Topic shingles are the small side (size-checked broadcast); document shingles are produced
    in-row and probed against them, so the collection is never shuffled — only the matching
    (topic, document) pairs are de-duplicated.
    """
    tsh = shingle_rows(topics.select(F.col(topic_id).alias("query_id"), tokens(topic_text).alias("_toks")), "_toks", k).distinct()
    tsh = broadcast_when(tsh, small_count(tsh))
    dsh = shingle_rows(docs.select(F.col(key), tokens(text).alias("_toks")), "_toks", k)
    return (dsh.join(tsh, "sh").select("query_id", key).distinct()
            .select("query_id", F.lit(0).alias("iter"), key, F.lit(1).alias("rel")))


def qrels_by_query(qrels: DataFrame) -> DataFrame:
    """``query_id, n_rel``: relevant documents per topic."""
    return (qrels.where(F.col("rel") > 0).select("query_id", "doc_id").distinct()
            .groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel")))


def qrels_pool(qrels: DataFrame, first: int, last: int, distinct: bool = False) -> DataFrame:
    """Pooled judgements of a topic range (both ends inclusive): ``doc_id, n`` (bag counts)."""
    q = qrels.where((F.col("rel") > 0) & F.col("query_id").between(first, last))
    if distinct:
        q = q.select("query_id", "doc_id").distinct()
    return q.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def topics_subset(topics: DataFrame, spec: str, id_col: str = "query_id") -> DataFrame:
    """``all``, ``n`` or ``a-b`` (inclusive)."""
    spec = spec.strip()
    if spec == "all":
        return topics
    if "-" in spec:
        a, b = (int(x) for x in spec.split("-", 1))
        return topics.where(F.col(id_col).between(a, b))
    return topics.where(F.col(id_col) == int(spec))


def relevance_flags(run: DataFrame, qrels: DataFrame, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Run rows with ``is_rel`` (0/1) and ``cum_rel`` (relevant within the first k)."""
    rel = qrels.where(F.col("rel") > 0).select("query_id", "doc_id").distinct().withColumn("_r", F.lit(1))
    flagged = run.join(rel, ["query_id", "doc_id"], "left").withColumn(
        "is_rel", F.coalesce(F.col("_r"), F.lit(0)).cast("bigint")).drop("_r")
    w = Window.partitionBy(*by).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn("cum_rel", F.sum("is_rel").over(w).cast("bigint"))


def per_query_metrics(run: DataFrame, qrels: DataFrame, cut: int, by: Sequence[str] = ("query_id",),
                      denominator: str = "returned", topics: DataFrame | None = None) -> DataFrame:
    """``*by, n_rel, returned, rel_ret, p, r, ap`` for every judged topic (× extra keys such as λ).

    ``topics``: when the run carries extra keys (λ), a DataFrame of all key combinations to
    evaluate (e.g. judged topics × λ grid); otherwise the judged topics.
    """
    if denominator not in ("returned", "cut"):
        raise ValueError("denominator must be 'returned' or 'cut'")
    cut_run = run.where(F.col("rank") <= cut)
    flags = relevance_flags(cut_run, qrels, by)
    agg = flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("returned"),
        F.sum("is_rel").alias("rel_ret"),
        F.sum(F.col("is_rel") * F.col("cum_rel") / F.col("rank")).alias("ap_num"))
    nrel = qrels_by_query(qrels)
    base = nrel if topics is None else topics.join(nrel, "query_id")
    m = base.join(agg, list(by), "left")
    den = F.col("returned") if denominator == "returned" else F.lit(float(cut))
    return m.select(
        *by, "n_rel",
        F.coalesce("returned", F.lit(0)).cast("bigint").alias("returned"),
        F.coalesce("rel_ret", F.lit(0)).cast("bigint").alias("rel_ret"),
        F.coalesce(F.col("rel_ret") / den, F.lit(0.0)).alias("p"),
        F.coalesce(F.col("rel_ret") / F.col("n_rel"), F.lit(0.0)).alias("r"),
        F.coalesce(F.col("ap_num") / F.col("n_rel"), F.lit(0.0)).alias("ap"))


def metric_column(metric: str) -> str:
    m = metric.upper()
    if m in ("P", "PRECISION"):
        return "p"
    if m in ("R", "RECALL"):
        return "r"
    if m in ("MAP", "AP", "APN"):
        return "ap"
    raise ValueError(f"metric must be one of {METRICS}")


def means(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean P, R, AP (MAP) over the evaluated topics (NaN-safe)."""
    return metrics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("p").alias("p"), F.avg("r").alias("r"), F.avg("ap").alias("map"))


def metrics_with_mean(metrics: DataFrame, decimals: int = 6) -> DataFrame:
    """Per-topic rows plus a final ``Mean`` row: ``query_id STRING, p, r, ap`` (CSV sink shape)."""
    rows = metrics.select(F.col("query_id").cast("string").alias("query_id"), "p", "r", "ap")
    mean = metrics.agg(F.avg("p").alias("p"), F.avg("r").alias("r"), F.avg("ap").alias("ap")) \
        .select(F.lit("Mean").alias("query_id"), "p", "r", "ap")
    out = rows.unionByName(mean)
    return out.select("query_id", *[F.round(c, decimals).alias(c) for c in ("p", "r", "ap")])


def lambda_sweep(metrics_by_lambda: DataFrame, metric: str = "MAP") -> DataFrame:
    """``lambda, mean`` — mean of a metric per λ over the topics in ``metrics_by_lambda``."""
    col = metric_column(metric)
    return metrics_by_lambda.groupBy("lambda").agg(F.avg(col).alias("mean"))


def best_lambda(sweep: DataFrame, decimals: int = 9) -> DataFrame:
    """One row ``lambda, mean``: the λ with the largest mean; on ties the first (smallest) λ."""
    return sweep.agg(F.max_by(F.struct("lambda", "mean"),
                              F.struct(F.round("mean", decimals), -F.col("lambda"))).alias("b")) \
        .select(F.col("b.lambda").alias("lambda"), F.col("b.mean").alias("mean"))


def lambda_matrix(metrics_by_lambda: DataFrame, lambdas: Sequence[float], metric: str = "MAP",
                  decimals: int = 6) -> DataFrame:
    """Topic rows × one column per λ (``l01`` … ``l10``) plus a ``Mean`` row."""
    col = metric_column(metric)
    names = [f"l{int(round(lam * 10)):02d}" for lam in lambdas]
    wide = metrics_by_lambda.groupBy("query_id").pivot("lambda", list(lambdas)).agg(F.first(col))
    renamed = wide.select(F.col("query_id").cast("string").alias("query_id"),
                          *[F.col(f"`{c}`").alias(n) for c, n in zip(wide.columns[1:], names)])
    mean = renamed.agg(*[F.avg(n).alias(n) for n in names]).select(F.lit("Mean").alias("query_id"), *names)
    return renamed.unionByName(mean).select("query_id", *[F.round(n, decimals).alias(n) for n in names])
