"""Field and term statistics over the index: df, idf, tf×idf, best terms, field statistics, dump.

Orderings (ties always broken by term ascending, so top-k is reproducible):
  tf, df   descending (largest first)
  idf, tfxidf  ascending by default (the most common / lightest terms first), ``ascending=False``
  gives the rarest / heaviest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.operators.index import CorpusIndex
from lexiframe.operators.sizing import checkpoint_dir, saved

ORDERS = ("tf", "df", "idf", "tfxidf")
_DEFAULT_ASC = {"tf": False, "df": False, "idf": True, "tfxidf": True}


def idf_expr(n_docs, df_col="df"):
    """round(log10(N / df), 2), HALF_UP as in the reports."""
    return F.round(F.log10(n_docs / F.col(df_col).cast("double")), 2)


def field_stats(index: CorpusIndex, field: str | None = None) -> DataFrame:
    """``field, doc_count, max_doc, sum_doc_freq, sum_total_term_freq`` per indexed field.

    From the per-document field lengths (no distinct count, no pass over the postings).
    A field without terms yields no row.
    """
    df = index.doc_fields
    if field is not None:
        df = df.where(F.col("field") == field)
    return df.groupBy("field").agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.sum("n_terms").cast("bigint").alias("sum_doc_freq"),
        F.sum("n_tokens").cast("bigint").alias("sum_total_term_freq"),
    ).select("field", "doc_count", index.num_docs().cast("bigint").alias("max_doc"),
             "sum_doc_freq", "sum_total_term_freq")


def doc_freqs(index: CorpusIndex, field: str = "text") -> DataFrame:
    """``term, df, cf`` over the whole vocabulary of a field (partial aggregation map-side)."""
    return index.term_dictionary().where(F.col("field") == field).select("term", "df", "cf")


def vocabulary(index: CorpusIndex, field: str = "text") -> DataFrame:
    return index.field_postings(field).select("term").distinct()


def _ranked_top(df: DataFrame, sort_cols, top: int | None) -> DataFrame:
    """Global order + top: ``orderBy().limit()`` (TakeOrderedAndProject), then rank the kept rows."""
    if top is not None:
        df = df.orderBy(*sort_cols).limit(top)
        # rank over at most ``top`` rows
        w = Window.orderBy(*sort_cols)
        return df.withColumn("rank", F.row_number().over(w).cast("bigint"))
    # whole table: rank without a single-partition window
    return _distributed_rank(df, sort_cols)


def _distributed_rank(df: DataFrame, sort_cols) -> DataFrame:
    """Dense 1..n ranks of a whole table by a total order, without a one-partition window.

    Range-partition by the order, number rows inside each partition, add the row counts of
    the preceding partitions (a tiny per-partition table, broadcast).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: exchanges planned twice may sample different range boundaries
    checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(n, *sort_cols).withColumn("_pid", F.spark_partition_id()).checkpoint()
    w = Window.partitionBy("_pid").orderBy(*sort_cols)
    local = ordered.withColumn("_rn", F.row_number().over(w))
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn("rank", (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_pid", "_rn", "_off"))


def best_terms_collection(index: CorpusIndex, by: str = "df", top: int | None = 50, field: str = "text",
                          ascending: bool | None = None) -> DataFrame:
    """Collection terms ranked by df (descending) or idf (ascending unless ``ascending=False``)."""
    by = by.lower()
    if by not in ("df", "idf"):
        raise ValueError("by must be 'df' or 'idf'")
    asc = _DEFAULT_ASC[by] if ascending is None else ascending
    terms = doc_freqs(index, field).select("term", "df")
    if by == "idf":
        terms = terms.select("term", idf_expr(index.num_docs()).alias("idf"))
    key = F.col(by).asc() if asc else F.col(by).desc()
    return _ranked_top(terms, [key, F.col("term").asc()], top)


def best_terms_document(index: CorpusIndex, doc_id, order: str = "tf", top: int | None = None,
                        field: str = "text", ascending: bool | None = None) -> DataFrame:
    """Terms of one document with ``tf, df, idf, tfxidf`` and their rank under ``order``.

    The document is one pushed range of the term vectors and df comes from the stored dictionary;
    without them, from the postings of the document's own terms.
    """
    order = order.lower()  # the order name is case-insensitive everywhere
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    asc = _DEFAULT_ASC[order] if ascending is None else ascending
    target = saved(index.vector(doc_id, field), "document-terms")
    if index.terms is not None:
        dfs = doc_freqs(index, field).select("term", "df")
    else:
        dfs = index.lookup(target.select("term"), field).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rows = (target.join(dfs, "term")
            .withColumn("idf", idf_expr(index.num_docs()))
            .withColumn("tfxidf", F.col("tf") * F.col("idf")))
    key = F.col(order).asc() if asc else F.col(order).desc()
    ranked = _ranked_top(rows, [key, F.col("term").asc()], top) if top is not None else \
        rows.withColumn("rank", F.row_number().over(Window.orderBy(key, F.col("term").asc())).cast("bigint"))
    return ranked.select("term", F.col("tf").cast("bigint"), F.col("df").cast("bigint"), "idf",
                         F.round("tfxidf", 6).alias("tfxidf"), "rank")


def stored_fields_dump(index: CorpusIndex, columns=None) -> DataFrame:
    """Every stored field of every document as ``doc_id, field, value`` (strings)."""
    key = index.key
    cols = [c for c in (columns or index.docs.columns) if c != key]
    return index.docs.select(key, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        key, cols, "field", "value")
