"""Ranked retrieval over the index: Jelinek-Mercer language model and classic TF-IDF.

A topic is a bag of words (same analyzer as the documents); repeated words add up (qtf).
Scores (sums over terms t shared by query q and document d):

  JM(λ)      Σ qtf · ln(1 + ((1−λ) · tf/dl) / (λ · (cf+1)/(T+1)))        0 < λ ≤ 1
  TF-IDF(p)  Σ qtf · sqrt(tf) · idf^p / sqrt(dl),  idf = 1 + ln((N+1)/(df+1))

dl = document length in tokens, cf = collection frequency, T = tokens in the collection,
N = documents, df = document frequency. Scores are rounded to 9 decimals, which only
takes away differences of summation order; ties go to the smaller doc id.

Plan: query terms meet the stored term dictionary (or statistics aggregated for that vocabulary
only), and the result, written once, selects the matching postings in one join, which Spark
broadcasts by its known size: postings then do not shuffle for the look-up, and on a saved index only
the folders of the query vocabulary are read. The matching postings, one row each whatever the number
of queries with the term, are dealt by document, weighed once and only then met with the queries:
``groupBy(query_id, doc_id)`` finds every document in one task and ships nothing — for a λ grid all λ
sums in the same aggregate. The number of tasks follows documents × queries. The per-query top-k uses
a window whose ``row_number() <= k`` filter Spark turns into a partial per-partition limit before the
shuffle (WindowGroupLimit), so a query matching a third of the collection ships only k rows
per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions.text import tokens, with_term_counts
from lexiframe.operators.index import CorpusIndex
from lexiframe.operators.sizing import broadcast_if_small, saved

SCORE_DECIMALS = 9  # fine enough to rank by; reports round what they show
SLACK = 1e-8  # of a bound, above the rounding of scores and sums
FIRST = 16    # blocks per query that give the threshold
PAIRS = 250_000  # of a document and a query that one task scores, at most about: their sums stay near the CPU
# Fixed value: the smoothing grid 0.1 … 1.0.
LAMBDA_GRID = tuple(round(0.1 * i, 1) for i in range(1, 11))


def query_terms(topics: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """``query_id, term, qtf`` from the whole topic text."""
    toks = tokens(F.col(text_col))
    staged = topics.select(F.col(id_col).alias("query_id"), toks.alias("_toks"))
    return (with_term_counts(staged, "_toks", "t")
            .select("query_id", F.inline_outer("t")).where(F.col("term").isNotNull())
            .select("query_id", "term", F.col("tf").alias("qtf")))


def _wanted(index: CorpusIndex, qterms: DataFrame, field: str) -> DataFrame:
    """``query_id, term, qtf, df, cf`` of the query terms that the collection has, written once."""
    if index.terms is not None:
        stats = index.terms.where(F.col("field") == field).select("term", "df", "cf")
    else:
        vocab = qterms.select("term").distinct()
        stats = index.lookup(vocab, field).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf"))
    return saved(saved(qterms, "query-terms").join(stats, "term"), "query-statistics")


def _score(index: CorpusIndex, qterms: DataFrame, field: str, weights: dict[str, Column]) -> DataFrame:
    """``query_id, key`` and per name of ``weights`` the sum of qtf · weight over the shared terms.

    Topics meet the dictionary first; that table, as large as the topics, is written once. The postings
    of its terms are read in one join, pruned on a saved index, and dealt by document before the
    queries multiply them."""
    wanted = _wanted(index, qterms, field)
    found = index.lookup(wanted.select("term", "df", "cf").distinct(), field)
    pairs = index.docs.count() * wanted.select("query_id").distinct().count()
    tasks = max(index.docs.sparkSession.sparkContext.defaultParallelism, -(-pairs // PAIRS))
    weighed = found.repartition(tasks, index.key).select(index.key, "term", *[w.alias(name) for name, w in weights.items()])
    rows = weighed.join(broadcast_if_small(wanted.select("query_id", "term", "qtf")), "term")
    return rows.groupBy("query_id", index.key).agg(
        *[F.round(F.sum(F.col("qtf") * F.col(name)), SCORE_DECIMALS).alias(name) for name in weights])


def _blocks(index: CorpusIndex, wanted: DataFrame, field: str) -> list[DataFrame]:
    """Per segment ``query_id, block, qtf, df, cf, tf, doc_len``: for every query term and block the largest
    share of the term, as tf of a document of length 1. Terms without impacts give it from their
    postings, which are few."""
    out = []
    cols = ["query_id", "term", "block", "qtf", "df", "cf"]
    for s in index.segments:
        dense = index.segment_rows(s, s.impacts, wanted, field).select(*cols, "top")
        have = index.segment_rows(s, s.impacts, wanted.select("term").distinct(), field).select("term").distinct()
        few = index.segment_rows(s, s.postings, wanted.join(have, "term", "left_anti"), field)
        rows = dense.unionByName(few.select(*cols, (F.col("tf") / F.col("doc_len")).alias("top")))
        tops = rows.groupBy(*cols).agg(F.max("top").alias("tf"))  # a term may lie in several buckets
        out.append(tops.withColumn("doc_len", F.lit(1.0)))
    return out


def block_bounds(index: CorpusIndex, wanted: DataFrame, term: Column, field: str = "text") -> DataFrame:
    """``query_id, part, block, bound``: no document of the block of segment ``part`` scores higher."""
    parts = [b.groupBy("query_id", "block").agg((F.sum(term) * (1 + SLACK) + SLACK).alias("bound")).withColumn("part", F.lit(i))
             for i, b in enumerate(_blocks(index, wanted, field))]
    return reduce(DataFrame.unionByName, parts).select("query_id", "part", "block", "bound")


def _score_blocks(index: CorpusIndex, wanted: DataFrame, keep: DataFrame, term: Column, field: str) -> DataFrame:
    """Scores of the documents in the (query, segment, block) rows of ``keep``."""
    parts = []
    for i, s in enumerate(index.segments):
        rows = index.segment_rows(s, s.postings, wanted, field)
        mine = keep.where(F.col("part") == i).select("query_id", "block")
        parts.append(rows.join(mine, ["query_id", "block"], "left_semi").select("query_id", index.key, "qtf", "tf", "doc_len", "df", "cf"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("query_id", index.key).agg(F.round(F.sum(term), SCORE_DECIMALS).alias("score"))


@dataclass
class BoundedSearch:
    hits: DataFrame    # query_id, key, score, rank
    bounds: DataFrame  # query_id, part, block, bound
    kept: DataFrame    # query_id, part, block: those that were scored in the end


def bounded_search(index: CorpusIndex, qterms: DataFrame, n: int, term: Column, field: str = "text") -> BoundedSearch:
    """The same top ``n`` as scoring every matching document, ties included, from the blocks that can
    hold one of them.

    Both models grow with tf / doc_len, so that a block's largest share per term bounds its documents.
    The ``FIRST`` blocks of highest bound per query are scored first; their n-th score is a threshold,
    and only blocks whose bound reaches it are scored in the second pass. A query with fewer than n
    hits in its first blocks has no threshold and keeps all its blocks."""
    if not index.segments:
        raise ValueError("bounds are stored with a saved index")
    wanted = _wanted(index, qterms, field)
    bounds = saved(block_bounds(index, wanted, term, field), "block-bounds")
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "part", "block")
    first = bounds.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= FIRST).drop("_n")
    low = top_hits(_score_blocks(index, wanted, saved(first, "first-blocks"), term, field), n, index.key)
    low = saved(low.where(F.col("rank") == n).select("query_id", F.col("score").alias("low")), "thresholds")
    kept = saved(bounds.join(low, "query_id", "left").where(F.col("low").isNull() | (F.col("bound") >= F.col("low"))).select(
        "query_id", "part", "block"), "kept-blocks")
    hits = top_hits(_score_blocks(index, wanted, kept, term, field), n, index.key)
    return BoundedSearch(hits.select("query_id", index.key, "score", "rank"), bounds, kept)


def _jm_weight(lam: float, total_tokens):
    return F.log(
        1.0 + ((1.0 - lam) * F.col("tf") / F.col("doc_len"))
        / (lam * (F.col("cf") + 1.0) / (total_tokens + 1.0)))


def _jm_term(lam: float, total_tokens):
    return F.col("qtf") * _jm_weight(lam, total_tokens)


def _tfidf_weight(power: float, n_docs):
    idf = 1.0 + F.log((n_docs + 1.0) / (F.col("df") + 1.0))
    return F.sqrt(F.col("tf")) * F.pow(idf, float(power)) / F.sqrt(F.col("doc_len"))


def _tfidf_term(power: float, n_docs):
    return F.col("qtf") * _tfidf_weight(power, n_docs)


def score_jm(index: CorpusIndex, qterms: DataFrame, lam, field: str = "text") -> DataFrame:
    """JM scores; ``lam`` is a number in (0, 1] or a Column (e.g. a tuned λ as a scalar subquery)."""
    if not isinstance(lam, Column) and not 0.0 < lam <= 1.0:
        raise ValueError("lambda must be in (0, 1]")
    return _score(index, qterms, field, {"score": _jm_weight(lam, index.total_tokens(field))})


def score_jm_grid(index: CorpusIndex, qterms: DataFrame, lambdas: Sequence[float] = LAMBDA_GRID,
                  field: str = "text") -> DataFrame:
    """``query_id, doc_id, lambda, score`` for every λ of the grid from one aggregate."""
    total = index.total_tokens(field)
    wide = _score(index, qterms, field, {f"s{i}": _jm_weight(lam, total) for i, lam in enumerate(lambdas)})
    stack = ", ".join(f"CAST({lam!r} AS DOUBLE), s{i}" for i, lam in enumerate(lambdas))
    return wide.selectExpr("query_id", index.key, f"stack({len(lambdas)}, {stack}) AS (lambda, score)")


def score_tfidf(index: CorpusIndex, qterms: DataFrame, power: float = 1.0, field: str = "text") -> DataFrame:
    return _score(index, qterms, field, {"score": _tfidf_weight(power, index.num_docs())})


def top_hits(scores: DataFrame, n: int, key: str = "doc_id", by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Top ``n`` per query (or per query and λ): adds ``rank`` (1-based, BIGINT)."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col(key).asc())
    return (scores.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .withColumn("rank", F.col("rank").cast("bigint")))


def search(index: CorpusIndex, topics: DataFrame, model: str = "jm", n: int = 10, lam: float = 0.5,
           power: float = 1.0, field: str = "text", id_col: str = "query_id", text_col: str = "text",
           bounded: bool = False) -> DataFrame:
    """Run every topic: ``query_id, doc_id, score, rank``. ``bounded`` (on a saved index) skips blocks of
    documents that cannot reach the top ``n``; the hits are the same."""
    qt = query_terms(topics, id_col, text_col)
    if bounded:
        if model not in ("jm", "tfidf"):
            raise ValueError("model must be 'jm' or 'tfidf'")
        term = _jm_term(lam, index.total_tokens(field)) if model == "jm" else _tfidf_term(power, index.num_docs())
        return bounded_search(index, qt, n, term, field).hits
    if model == "jm":
        scores = score_jm(index, qt, lam, field)
    elif model == "tfidf":
        scores = score_tfidf(index, qt, power, field)
    else:
        raise ValueError("model must be 'jm' or 'tfidf'")
    return top_hits(scores, n, index.key).select("query_id", index.key, "score", "rank")
