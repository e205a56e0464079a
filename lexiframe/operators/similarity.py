"""Documents most similar to one target document under several vector representations.

Representations (weights of term t in document d):
  tf          raw term frequency
  tfxidf      tf · round(log10(N/df), 2)
  bin         coverage of the target's terms: sqrt(|d ∩ t| / |t|)   (candidate vectors only
              carry the target's terms — kept as the reference behaviour)
  bin_cosine  textbook binary cosine |d ∩ t| / sqrt(|d| · |t|)

Cosine is scale-invariant, so L1 normalisation of the vectors (``tf_l1_vectors``) does not change
it and is not applied before the cosine. Vectors stay sparse (long tables); the target vector is
written once and joined on term; only postings that share a term with the target are read (on a
saved index) and move through a shuffle. Norms come from the per-document field lengths of the index
(tf) or a table that a saved index keeps per version (tfxidf). A document sharing no term with the
target gets similarity 0; NaN (zero norm) becomes 0. Similarities are rounded to 3 decimals
(HALF_UP), ordered by similarity descending then doc id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.operators.index import CorpusIndex
from lexiframe.operators.sizing import broadcast_when, saved, small_count
from lexiframe.operators.terms import doc_freqs, idf_expr

REPRESENTATIONS = ("tf", "tfxidf", "bin", "bin_cosine")
DICTIONARY_BROADCAST_ROWS = 1_000_000
SALT_BUCKETS = 64


def _safe_div(a, b):
    return F.when(b != 0, a / b)


def tfxidf_weights(index: CorpusIndex, field: str = "text",
                   broadcast_rows: int = DICTIONARY_BROADCAST_ROWS) -> DataFrame:
    """``doc_id, term, w`` with w = tf · round(idf, 2) for every posting of the field.

    The dictionary is broadcast when the vocabulary is within ``broadcast_rows``. Otherwise the
    join is a shuffle on term, and hot terms — in at least 1/SALT_BUCKETS of the documents, so at
    most SALT_BUCKETS × (average terms per document) of them — are salted: their postings are
    spread over SALT_BUCKETS partitions by document hash and their dictionary rows replicated
    once per bucket, so a term present in a third of the collection does not land in one task.
    """
    key = index.key
    p = index.field_postings(field)
    n_docs = index.num_docs()
    dfs = doc_freqs(index, field).select("term", "df", idf_expr(n_docs).alias("idf"))
    n = small_count(dfs, broadcast_rows)
    if n is not None:
        return p.join(F.broadcast(dfs.select("term", "idf")), "term").select(
            key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    hot = dfs.where(F.col("df") * SALT_BUCKETS >= n_docs).select("term", F.lit(True).alias("_hot"))
    hot = broadcast_when(hot, small_count(hot))
    salted_p = p.join(hot, "term", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(key), F.lit(SALT_BUCKETS))).otherwise(F.lit(0).cast("bigint")))
    salted_d = dfs.join(hot, "term", "left").select(
        "term", "idf", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"),
                                                                  F.lit(SALT_BUCKETS - 1).cast("bigint")))
                                 .otherwise(F.array(F.lit(0).cast("bigint")))).alias("_salt"))
    return salted_p.join(salted_d, ["term", "_salt"]).select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))


def tf_l1_vectors(index: CorpusIndex, field: str = "text") -> DataFrame:
    """``doc_id, term, w`` with w = tf / Σ tf of the document (L1-normalised tf)."""
    key = index.key
    p = index.field_postings(field)
    return p.select(key, "term", (F.col("tf") / F.col("doc_len")).alias("w"))


def tfxidf_norms(index: CorpusIndex, field: str = "text", dictionary_broadcast_rows: int = DICTIONARY_BROADCAST_ROWS) -> DataFrame:
    """``doc_id, norm`` of the tf×idf vectors: one aggregate over the postings per version of a saved
    index, which keeps the table; other calls read it."""
    w = tfxidf_weights(index, field, dictionary_broadcast_rows)
    # a weight has two decimals, its square four: the exact sum does not depend on the order of the index's files
    square = (F.col("w") * F.col("w")).cast("decimal(28,4)")
    return index.stored(f"norms-{field}", w.groupBy(index.key).agg(F.sqrt(F.sum(square).cast("double")).alias("norm")))


def matched_scores(index: CorpusIndex, doc_id, rep: str = "tf", field: str = "text",
                   dictionary_broadcast_rows: int = DICTIONARY_BROADCAST_ROWS) -> DataFrame:
    """``doc_id, sim`` for every other document that shares a term with the target.

    The target is one document of the term vectors, written once (its terms and weights); the postings
    of its terms are one pruned look-up. Norms are read from the length table, or the stored tf×idf ones."""
    rep = rep.lower()
    if rep not in REPRESENTATIONS:
        raise ValueError(f"rep must be one of {REPRESENTATIONS}")
    key = index.key
    target = index.vector(doc_id, field).select("term", F.col("tf").alias("tft"))
    if rep == "tfxidf":
        dfs = doc_freqs(index, field).select("term", idf_expr(index.num_docs()).alias("idf"))
        target = target.join(dfs, "term").withColumn("wt", F.col("tft") * F.col("idf"))
    target = saved(target, "target-vector")
    shared = index.lookup(target, field).where(F.col(key) != F.lit(doc_id)).groupBy(key)
    if rep == "tfxidf":
        tnorm = target.select(F.sqrt(F.sum(F.col("wt") * F.col("wt")))).scalar()
        per_doc = shared.agg(F.sum(F.col("tf") * F.col("idf") * F.col("wt")).alias("dot")).join(
            tfxidf_norms(index, field, dictionary_broadcast_rows), key)
        sim = _safe_div(F.col("dot"), F.col("norm") * tnorm)
    elif rep == "tf":
        tnorm = target.select(F.sqrt(F.sum(F.col("tft") * F.col("tft")).cast("double"))).scalar()
        per_doc = shared.agg(F.sum(F.col("tf") * F.col("tft")).alias("dot")).join(index.field_lengths(field).select(key, "tf_sq"), key)
        sim = _safe_div(F.col("dot").cast("double"), F.sqrt(F.col("tf_sq")) * tnorm)
    else:
        n_target = target.select(F.count(F.lit(1)).cast("double")).scalar()
        per_doc = shared.agg(F.count(F.lit(1)).cast("double").alias("n_shared"))
        if rep == "bin":
            sim = F.sqrt(_safe_div(F.col("n_shared"), n_target))
        else:  # bin_cosine
            per_doc = per_doc.join(index.field_lengths(field).select(key, "n_terms"), key)
            sim = _safe_div(F.col("n_shared"), F.sqrt(F.col("n_terms").cast("double") * n_target))
    return per_doc.select(key, F.coalesce(F.round(F.nanvl(sim, F.lit(0.0)), 3), F.lit(0.0)).alias("sim"))


def similarity_scores(index: CorpusIndex, doc_id, rep: str = "tf", field: str = "text",
                      dictionary_broadcast_rows: int = DICTIONARY_BROADCAST_ROWS) -> DataFrame:
    """``doc_id, sim`` for every document except the target; 0 where no term is shared."""
    key = index.key
    scored = matched_scores(index, doc_id, rep, field, dictionary_broadcast_rows)
    others = index.docs.select(key).where(F.col(key) != F.lit(doc_id))
    return others.join(scored, key, "left").select(key, F.coalesce("sim", F.lit(0.0)).alias("sim"))


def similar_docs(index: CorpusIndex, doc_id, rep: str = "tf", top: int = 10, field: str = "text",
                 show: Sequence[str] = ()) -> DataFrame:
    """Top ``top`` documents most similar to ``doc_id``: ``doc_id, sim, rank`` (rank from 1), and the
    stored columns named by ``show`` (a path, say).

    Documents with a positive similarity are ranked first; only if they are too few, the documents
    with none follow by id, which takes no more than an anti-join with the few found."""
    key = index.key
    order = [F.col("sim").desc(), F.col(key).asc()]
    scored = matched_scores(index, doc_id, rep, field).where(F.col("sim") > 0)
    best = saved(scored.orderBy(*order).limit(top), "similar")  # at most ``top`` rows
    found = best.count()
    if found < top:
        rest = index.docs.select(key).where(F.col(key) != F.lit(doc_id)).join(F.broadcast(best.select(key)), key, "left_anti")
        best = best.unionByName(rest.orderBy(key).limit(top - found).withColumn("sim", F.lit(0.0)))
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    if not show:
        return ranked
    return index.docs.select(key, *show).join(F.broadcast(ranked), key).select(key, "sim", "rank", *show)


def euclidean_to_target(vectors: DataFrame, target_id, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, dist``: Euclidean distance of every vector to one target vector (+inf on length mismatch)."""
    from lexiframe.functions.stats import sq_euclidean

    target = vectors.where(F.col(id_col) == F.lit(target_id)).select(F.col(vec_col).alias("_t"))
    tvec = target.select(F.first("_t")).scalar()
    staged = vectors.select(id_col, F.col(vec_col).alias("_v"), tvec.alias("_t"))  # subquery as a column
    return staged.select(id_col, F.sqrt(sq_euclidean(F.col("_v"), F.col("_t"))).alias("dist"))
