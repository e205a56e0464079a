"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver tables.

Every computed column is aliased to the name used by the SQL oracle in ``plans.oracle``.
Doubles are rounded at the edge (6 decimals; similarities 3) so results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.functions.text import line_slice
from lexiframe.operators import evaluation as ev
from lexiframe.operators import kmeans as km
from lexiframe.operators import search as se
from lexiframe.operators import significance as sg
from lexiframe.operators import similarity as sim
from lexiframe.operators import terms as tm
from lexiframe.operators import index as idxmod
from lexiframe.operators.index import (
    build_index,
    merge_indexes,
    postings_with_positions,
)
from lexiframe.operators.reports import write_csv, write_text
from lexiframe.operators.sizing import scratch_path
from lexiframe.plans.context import (
    CUT,
    DOC_CLUSTERS,
    KMEANS_ITER,
    KMEANS_K,
    KMEANS_SEED,
    SUBSET,
    TARGET_DOC,
    TARGET_VEC,
    TEST,
    TOP_DOC_TERMS,
    TOP_SIMILAR,
    TOP_TERMS,
    TRAIN,
    context,
)
from lexiframe.sources.filetree import DEFAULT_EXTENSIONS, filter_paths, read_file_tree, write_file_tree
from lexiframe.sources.csv import read_metric_csv, read_numeric_csv
from lexiframe.sources.judgements import read_qrels
from lexiframe.sources.smart import read_smart, write_smart

Query = Callable[[SparkSession, str], DataFrame]
R6 = 6


def _r(c, d=R6):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---- text analysis / index ---------------------------------------------------------------------

def tokenize_docs(spark, sf_dir):
    ctx = context(spark, sf_dir)
    lengths = ctx.index.field_lengths("text")
    return ctx.index.docs.select("doc_id").join(lengths, "doc_id", "left").select(
        "doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce("n_terms", F.lit(0)).cast("bigint").alias("n_terms"))


def term_vectors(spark, sf_dir):
    return context(spark, sf_dir).index.field_postings("text").select("doc_id", "term", "tf")


def postings_positions(spark, sf_dir):
    docs = context(spark, sf_dir).documents_spread
    return postings_with_positions(docs).select("doc_id", "term", "tf", "first_pos", "last_pos")


def token_offsets(spark, sf_dir):
    return idxmod.token_offsets(context(spark, sf_dir).documents_spread)


def index_summary(spark, sf_dir):
    """Collection size report: documents, documents with text, postings, terms, tokens."""
    idx = context(spark, sf_dir).index
    n_terms = tm.doc_freqs(idx, "text").select(F.count(F.lit(1))).scalar()
    return idx.field_lengths("text").agg(
        F.count(F.lit(1)).alias("n_docs_with_text"),
        F.sum("n_terms").cast("bigint").alias("n_postings"),
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
    ).select(idx.num_docs().cast("bigint").alias("n_docs"), "n_docs_with_text", "n_postings",
             n_terms.cast("bigint").alias("n_terms"), "n_tokens")


def vocabulary(spark, sf_dir):
    return tm.vocabulary(context(spark, sf_dir).index)


def field_stats(spark, sf_dir):
    return tm.field_stats(context(spark, sf_dir).index, "text")


def field_stats_all(spark, sf_dir):
    return tm.field_stats(context(spark, sf_dir).index)


def coll_terms_df(spark, sf_dir):
    return tm.best_terms_collection(context(spark, sf_dir).index, "df", TOP_TERMS)


def coll_terms_idf(spark, sf_dir):
    return tm.best_terms_collection(context(spark, sf_dir).index, "idf", TOP_TERMS)


def _doc_terms(order):
    def q(spark, sf_dir):
        return tm.best_terms_document(context(spark, sf_dir).index, TARGET_DOC, order, TOP_DOC_TERMS)
    q.__name__ = f"doc_terms_{order}"
    return q


def stored_fields_dump(spark, sf_dir):
    return tm.stored_fields_dump(context(spark, sf_dir).index, ["text", "lang", "source", "n_chars"])


# ---- sources ------------------------------------------------------------------------------------

def _virtual_paths(docs: DataFrame) -> DataFrame:
    """A file-tree layout derived from each document: ``source/[lang/]doc<id><ext>``.

    Documents of ``src0`` sit directly in the root (ignored by the tree rule); long documents
    (over 1000 characters) sit one level deeper; the extension follows the language, French
    documents have none.
    """
    ext = (F.when(F.col("lang") == "en", ".txt").when(F.col("lang") == "de", ".java")
           .when(F.col("lang") == "es", ".c").otherwise(""))
    sub = F.when(F.col("source") == "src0", F.lit("")).otherwise(F.concat(F.col("source"), F.lit("/")))
    deeper = F.when(F.col("n_chars") > 1000, F.concat(F.col("lang"), F.lit("/"))).otherwise(F.lit(""))
    return docs.select("doc_id", F.concat(sub, deeper, F.lit("doc"), F.col("doc_id").cast("string"), ext)
                       .alias("path"))


def scan_ext_filter(spark, sf_dir):
    paths = _virtual_paths(context(spark, sf_dir).documents)
    return filter_paths(paths, "path", DEFAULT_EXTENSIONS, depth=-1)


def scan_depth_limit(spark, sf_dir):
    paths = _virtual_paths(context(spark, sf_dir).documents)
    return filter_paths(paths, "path", DEFAULT_EXTENSIONS, depth=1)


def lines_top_bottom(spark, sf_dir):
    docs = context(spark, sf_dir).documents
    return docs.select("doc_id", line_slice(F.col("text"), 2, 2).alias("body"))


def _smart_round_trip(spark, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    path = scratch_path(spark, "smart")
    write_smart(df, id_col, text_col, path)
    return read_smart(spark, path, "id", "body")


def smart_parse_docs(spark, sf_dir):
    return _smart_round_trip(spark, context(spark, sf_dir).documents, "doc_id", "text")


def smart_parse_topics(spark, sf_dir):
    return _smart_round_trip(spark, context(spark, sf_dir).table("benchmark"), "item_id", "text")


def smart_separator_lines(spark, sf_dir):
    """Documents whose lines are cut at commas, each rest starting like a record, written and read back."""
    docs = context(spark, sf_dir).documents.select("doc_id", F.replace("text", F.lit(", "), F.lit("\n.I ")).alias("text"))
    return _smart_round_trip(spark, docs, "doc_id", "text")


def timestamp_formats(spark, sf_dir):
    ev_ = context(spark, sf_dir).table("events")
    return ev_.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("local_fmt"),
                      F.date_format("ts", "yyyyMMddHHmmssSSS").alias("ms_fmt"))


# ---- write modes --------------------------------------------------------------------------------

def index_upsert(spark, sf_dir):
    ctx = context(spark, sf_dir)
    path = scratch_path(spark, "index-upsert")
    idxmod.write_index(spark, ctx.documents_spread.select("doc_id", "text", "lang", "source", F.lit(1).alias("version")), path)
    labels = ctx.table("labels")
    updates = (ctx.documents.join(labels, "doc_id")
               .select("doc_id",
                       F.concat(F.col("text"), F.lit("\nquality="), F.col("quality").cast("string"),
                                F.lit(" toxic="), F.col("toxic").cast("string")).alias("text"),
                       "lang", "source", F.lit(2).alias("version")))
    older = updates.withColumn("version", F.lit(1)).withColumn("text", F.lit("superseded"))
    out = idxmod.write_index(spark, updates.unionByName(older), path, "update", order_col="version")
    return tm.doc_freqs(out).select("term", "df", "cf")


def index_append(spark, sf_dir):
    ctx = context(spark, sf_dir)
    path = scratch_path(spark, "index-append")
    docs = ctx.documents_spread.select("doc_id", "text", "lang", "source", F.lit(1).alias("batch"))
    idxmod.write_index(spark, docs, path)
    offset = docs.select(F.max("doc_id") + 1).scalar()
    pages = ctx.table("pages").select((F.col("page_id") + offset).alias("doc_id"), F.col("html").alias("text"),
                                      F.lit(None).cast("string").alias("lang"), F.lit("pages").alias("source"),
                                      F.lit(2).alias("batch"))
    again = docs.join(ctx.table("labels").select("doc_id"), "doc_id", "left_semi").withColumn("batch", F.lit(2))
    out = idxmod.write_index(spark, pages.unionByName(again), path, "append", on_duplicate="skip")
    return tm.doc_freqs(out).select("term", "df", "cf")


def partial_merge_df(spark, sf_dir):
    docs = context(spark, sf_dir).documents.select("doc_id", "text", "lang", "source")
    langs = ["en", "fr", "de", "es"]
    parts = [build_index(docs.where(F.col("lang") == lang)) for lang in langs]
    parts.append(build_index(docs.where(~F.col("lang").isin(langs) | F.col("lang").isNull())))
    merged = merge_indexes(parts, check_keys=False)
    return tm.doc_freqs(merged, "text").select("term", "df")


# ---- vectors and similarity --------------------------------------------------------------------

def tf_l1_vectors(spark, sf_dir):
    v = sim.tf_l1_vectors(context(spark, sf_dir).index)
    return v.select("doc_id", "term", _r("w").alias("w"))


def _similar(rep):
    def q(spark, sf_dir):
        return sim.similar_docs(context(spark, sf_dir).index, TARGET_DOC, rep, TOP_SIMILAR)
    q.__name__ = f"similar_{rep}"
    return q


def euclidean_to_target(spark, sf_dir):
    e = context(spark, sf_dir).table("embeddings")
    return sim.euclidean_to_target(e, TARGET_VEC).select("vec_id", _r("dist").alias("dist"))


# ---- numeric record sets and k-means ---------------------------------------------------------------

PROFILE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile(df: DataFrame, cols) -> DataFrame:
    """min / max / mean per attribute from ONE aggregate pass, unpivoted afterwards (1 row)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), F.avg(c).alias(f"{c}__mean")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`, `{c}__mean`" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (attr, min, max, mean)").select(
        "attr", _r("min").alias("min"), _r("max").alias("max"), _r("mean").alias("mean"))


def numeric_profile(spark, sf_dir):
    li = context(spark, sf_dir).table("lineitem").select(*PROFILE_COLUMNS)
    return _profile(li, PROFILE_COLUMNS)


def numeric_drop_profile(spark, sf_dir):
    li = context(spark, sf_dir).table("lineitem").select(*PROFILE_COLUMNS).drop("l_tax")
    return _profile(li, li.columns)


def _embeddings(spark, sf_dir):
    return context(spark, sf_dir).table("embeddings").select("vec_id", "embedding")


def kmeans_seed_distances(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    seeds = km.seeds_smallest_ids(e, KMEANS_K)
    centers = seeds.select(F.sort_array(F.collect_list(F.struct("cluster", "center")))).scalar()
    return km.min_distance_to(e, centers).select("vec_id", _r("min_dist2", 9).alias("min_dist2"))


def _kmeans(spark, sf_dir):
    ctx = context(spark, sf_dir)
    if "kmeans" not in ctx.memo:
        ctx.memo["kmeans"] = km.kmeans(_embeddings(spark, sf_dir), KMEANS_K, KMEANS_ITER)
    return ctx.memo["kmeans"]


def kmeans_assign(spark, sf_dir):
    return _kmeans(spark, sf_dir).assignments.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"))


def kmeans_centroids(spark, sf_dir):
    c = _kmeans(spark, sf_dir).centroids
    return c.select(F.col("cluster").cast("bigint").alias("cluster"), F.posexplode("center").alias("dim", "value")) \
        .select("cluster", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value"))


def kmeans_sse(spark, sf_dir):
    return _kmeans(spark, sf_dir).sse.select(F.col("iteration").cast("bigint").alias("iteration"),
                                             _r("sse").alias("sse"))


def kmeans_converged(spark, sf_dir):
    """Lloyd until the SSE stops falling: iteration, sse."""
    res = km.kmeans(_embeddings(spark, sf_dir), KMEANS_K, iterations=None)
    return res.sse.select(F.col("iteration").cast("bigint").alias("iteration"), _r("sse").alias("sse"))


def kmeanspp_seeds(spark, sf_dir):
    """The K centers of a seeded D² draw, one row per dimension."""
    c = km.kmeanspp_seeds(_embeddings(spark, sf_dir), KMEANS_K, KMEANS_SEED)
    return c.select(F.col("cluster").cast("bigint").alias("cluster"), F.posexplode("center").alias("dim", "value")) \
        .select("cluster", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value"))


def cluster_similar_docs(spark, sf_dir):
    ctx = context(spark, sf_dir)
    top = sim.similar_docs(ctx.index, TARGET_DOC, "tf", TOP_SIMILAR).select("doc_id")
    vectors = sim.tf_l1_vectors(ctx.index).join(F.broadcast(top), "doc_id")  # TOP_SIMILAR rows
    res = km.sparse_kmeans(vectors, DOC_CLUSTERS, KMEANS_ITER, "doc_id", ids=top)
    return res.assignments.select("doc_id", F.col("cluster").cast("bigint").alias("cluster"))


# ---- search ------------------------------------------------------------------------------------------

def search_stats(spark, sf_dir):
    return context(spark, sf_dir).term_stats


def _search(model, lam=0.5, power=1.0):
    def q(spark, sf_dir):
        ctx = context(spark, sf_dir)
        run = ctx.eval_run_jm(lam) if model == "jm" else ctx.eval_run_tfidf(power)
        return run.select("query_id", "doc_id", _r("score").alias("score"), "rank")
    return q


def search_jm_bounded(spark, sf_dir):
    """The hits of ``search_jm_05`` from the blocks of documents that can hold one."""
    ctx = context(spark, sf_dir)
    run = se.search(ctx.index, ctx.topics, "jm", CUT, lam=0.5, bounded=True)
    return run.select("query_id", "doc_id", _r("score").alias("score"), "rank")


def search_hits_text(spark, sf_dir):
    """The hit report with stored text and the metrics of the hit's topic."""
    ctx = context(spark, sf_dir)
    flags = ev.relevance_flags(ctx.eval_run_jm(0.5), ctx.qrels)
    rows = flags.join(ctx.index.docs.select("doc_id", "text"), "doc_id").join(_eval_metrics(spark, sf_dir), "query_id")
    return rows.select("query_id", "rank", "doc_id", "text", (F.col("is_rel") == 1).alias("relevant"),
                       _r("p").alias("p"), _r("r").alias("r"), _r("ap").alias("ap"))


def file_tree_documents(spark, sf_dir):
    """Every document written as a file of its own below its source's folder, and the tree read back."""
    root = scratch_path(spark, "tree")
    docs = context(spark, sf_dir).documents
    write_file_tree(docs, root, ["source", "doc_id"], "text")
    tree = read_file_tree(spark, root, depth=2)
    return tree.select(F.regexp_extract("rel_path", r"doc_id=(-?\d+)/", 1).cast("bigint").alias("doc_id"), "text",
                       F.col("size_bytes").cast("bigint").alias("n_bytes"), F.col("type"),
                       (F.size(F.split("rel_path", "/")) - 1).cast("bigint").alias("level"))


def similar_docs_report(spark, sf_dir):
    """The similar documents with their stored fields."""
    return sim.similar_docs(context(spark, sf_dir).index, TARGET_DOC, "tf", TOP_SIMILAR, show=("source", "lang"))


def search_hits_report(spark, sf_dir):
    ctx = context(spark, sf_dir)
    flags = ev.relevance_flags(ctx.eval_run_jm(0.5), ctx.qrels)
    return (flags.join(ctx.index.docs.select("doc_id", "lang", "source"), "doc_id")
            .select("query_id", "rank", "doc_id", _r("score").alias("score"), "lang", "source",
                    F.when(F.col("is_rel") == 1, "relevant").otherwise("not relevant").alias("relevance")))


def topics_subset(spark, sf_dir):
    return ev.topics_subset(context(spark, sf_dir).topics, f"{SUBSET[0]}-{SUBSET[1]}")


def qrels_by_query(spark, sf_dir):
    return ev.qrels_by_query(context(spark, sf_dir).qrels)


def qrels_pool(spark, sf_dir):
    return ev.qrels_pool(context(spark, sf_dir).qrels, TRAIN[0], TRAIN[1])


def run_relevance_flags(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return ev.relevance_flags(ctx.eval_run_jm(0.5), ctx.qrels).select("query_id", "rank", "doc_id", "is_rel")


def run_cumulative_relevance(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return ev.relevance_flags(ctx.eval_run_jm(0.5), ctx.qrels).select(
        "query_id", "rank", "doc_id", "is_rel", "cum_rel")


def _eval_metrics(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return ctx.persisted("metrics_jm05", lambda: ev.per_query_metrics(ctx.eval_run_jm(0.5), ctx.qrels, CUT))


def _metric(col):
    def q(spark, sf_dir):
        return _eval_metrics(spark, sf_dir).select("query_id", _r(col).alias("value"))
    return q


def eval_means(spark, sf_dir):
    m = ev.means(_eval_metrics(spark, sf_dir))
    return m.selectExpr("stack(3, 'P', p, 'R', r, 'MAP', map) AS (metric, value)").select(
        "metric", _r("value").alias("value"))


def eval_metrics_with_mean(spark, sf_dir):
    return ev.metrics_with_mean(_eval_metrics(spark, sf_dir))


def _sweep_metrics(spark, sf_dir, first, last):
    ctx = context(spark, sf_dir)
    return ctx.persisted(f"sweep_{first}_{last}", lambda: _sweep_metrics_plan(spark, sf_dir, first, last))


def _sweep_metrics_plan(spark, sf_dir, first, last):
    """AP of every judged topic in [first, last] for every λ of the grid (one scoring pass)."""
    ctx = context(spark, sf_dir)
    qt = ctx.eval_terms().where(F.col("query_id").between(first, last))
    scores = se.score_jm_grid(ctx.index, qt)
    run = se.top_hits(scores, CUT, by=("query_id", "lambda"))
    judged = ev.qrels_by_query(ctx.qrels).where(F.col("query_id").between(first, last)).select("query_id")
    # topic × λ keys: each judged topic expanded in-row over the fixed grid (no join)
    keys = judged.select("query_id", F.explode(F.array(*[F.lit(x) for x in se.LAMBDA_GRID])).alias("lambda"))
    return ev.per_query_metrics(run, ctx.qrels, CUT, by=("query_id", "lambda"), topics=keys)


def lambda_sweep_means(spark, sf_dir):
    sw = ev.lambda_sweep(_sweep_metrics(spark, sf_dir, *TRAIN), "MAP")
    return sw.select("lambda", _r("mean").alias("mean"))


def _sweep_means(metric):
    def q(spark, sf_dir):
        sw = ev.lambda_sweep(_sweep_metrics(spark, sf_dir, *TRAIN), metric)
        return sw.select("lambda", _r("mean").alias("mean"))
    return q


def lambda_best(spark, sf_dir):
    b = ev.best_lambda(ev.lambda_sweep(_sweep_metrics(spark, sf_dir, *TRAIN), "MAP"))
    return b.select("lambda", _r("mean").alias("mean"))


def lambda_matrix(spark, sf_dir):
    return ev.lambda_matrix(_sweep_metrics(spark, sf_dir, *TRAIN), se.LAMBDA_GRID, "MAP")


def tune_train_test(spark, sf_dir):
    """Tune λ on the training topics, then run the test topics once with the tuned λ."""
    ctx = context(spark, sf_dir)
    best = ev.best_lambda(ev.lambda_sweep(_sweep_metrics(spark, sf_dir, *TRAIN), "MAP"))
    lam = best.select("lambda").scalar()  # one value, used as a column (no driver round trip)
    qt = ctx.eval_terms().where(F.col("query_id").between(*TEST))
    run = se.top_hits(se.score_jm(ctx.index, qt, lam), CUT)
    m = ev.per_query_metrics(run, ctx.qrels, CUT).where(F.col("query_id").between(*TEST))
    return m.select("query_id", lam.alias("lambda"), _r("ap").alias("value"))


def _tfidf_ap(spark, sf_dir, first=None, last=None):
    ctx = context(spark, sf_dir)
    if first is not None:
        qt = ctx.eval_terms().where(F.col("query_id").between(first, last))
        run = se.top_hits(se.score_tfidf(ctx.index, qt, 1.0), CUT)
        return ev.per_query_metrics(run, ctx.qrels, CUT).where(F.col("query_id").between(first, last))
    return ctx.persisted("metrics_tfidf_p1", lambda: ev.per_query_metrics(ctx.eval_run_tfidf(1.0), ctx.qrels, CUT))


def eval_tfidf_test(spark, sf_dir):
    return _tfidf_ap(spark, sf_dir, *TEST).select("query_id", _r("ap").alias("value"))


def _paired(spark, sf_dir):
    x = _eval_metrics(spark, sf_dir).select("query_id", F.col("ap").alias("value"))
    y = _tfidf_ap(spark, sf_dir).select("query_id", F.col("ap").alias("value"))
    return sg.paired_differences(x, y)


def paired_metric_diff(spark, sf_dir):
    return _paired(spark, sf_dir).select("query_id", _r("x").alias("x"), _r("y").alias("y"), _r("d").alias("d"))


def paired_t_test(spark, sf_dir):
    t = sg.paired_t_test(_paired(spark, sf_dir))
    return t.select(F.col("n").cast("bigint").alias("n"), _r("mean").alias("mean"), _r("sd").alias("sd"),
                    _r("t").alias("t"), F.col("df").cast("bigint").alias("df"), _r("p").alias("p"))


def wilcoxon_test(spark, sf_dir):
    w = sg.wilcoxon_test(_paired(spark, sf_dir))
    return w.select(F.col("n").cast("bigint").alias("n"), _r("w_plus").alias("w_plus"),
                    _r("w_minus").alias("w_minus"), _r("w").alias("w"), _r("z").alias("z"), _r("p").alias("p"))


def numeric_csv_profile(spark, sf_dir):
    """The line items' numbers written as CSV, read back by the numeric reader and profiled."""
    path = scratch_path(spark, "numeric-csv")
    write_csv(context(spark, sf_dir).table("lineitem").select(*PROFILE_COLUMNS), path)
    return _profile(read_numeric_csv(spark, path), PROFILE_COLUMNS)


def qrels_file(spark, sf_dir):
    """The derived judgements written in the judgement file layout and read back."""
    path = scratch_path(spark, "qrels")
    q = context(spark, sf_dir).qrels
    write_text(q, path, "%d %d %d %d", ["query_id", "iter", "doc_id", "rel"])
    return read_qrels(spark, path)


def compare_result_files(spark, sf_dir):
    """Two runs' metric files, with their Mean rows, written, read back and compared by a t test."""
    sides = []
    for name, m in (("x", _eval_metrics(spark, sf_dir)), ("y", _tfidf_ap(spark, sf_dir))):
        path = scratch_path(spark, f"metrics-{name}")
        mean = m.agg(F.lit("Mean").alias("queryID"), F.avg("ap").alias("AP"))
        write_csv(m.select(F.col("query_id").cast("string").alias("queryID"), F.col("ap").alias("AP")).unionByName(mean), path)
        sides.append(read_metric_csv(spark, path).select("query_id", F.col("AP").alias("value")))
    t = sg.paired_t_test(sg.paired_differences(*sides))
    return t.select(F.col("n").cast("bigint").alias("n"), _r("mean").alias("mean"), _r("sd").alias("sd"),
                    _r("t").alias("t"), F.col("df").cast("bigint").alias("df"), _r("p").alias("p"))


def wilcoxon_lineitem(spark, sf_dir):
    """Signed ranks of discount against tax amount over every line item: n, w_plus, w_minus."""
    li = context(spark, sf_dir).table("lineitem").select(
        F.round(F.col("l_extendedprice") * (F.col("l_discount") - F.col("l_tax")), sg.DIFF_DECIMALS).alias("d"))
    w = sg.signed_rank_sums(li)
    return w.select("n", _r("w_plus").alias("w_plus"), _r("w_minus").alias("w_minus"))


QUERIES: dict[str, Query] = {
    "tokenize_docs": tokenize_docs,
    "term_vectors": term_vectors,
    "postings_positions": postings_positions,
    "token_offsets": token_offsets,
    "index_summary": index_summary,
    "vocabulary": vocabulary,
    "field_stats": field_stats,
    "field_stats_all": field_stats_all,
    "coll_terms_df": coll_terms_df,
    "coll_terms_idf": coll_terms_idf,
    "doc_terms_tf": _doc_terms("tf"),
    "doc_terms_df": _doc_terms("df"),
    "doc_terms_idf": _doc_terms("idf"),
    "doc_terms_tfxidf": _doc_terms("tfxidf"),
    "stored_fields_dump": stored_fields_dump,
    "scan_ext_filter": scan_ext_filter,
    "scan_depth_limit": scan_depth_limit,
    "lines_top_bottom": lines_top_bottom,
    "smart_parse_docs": smart_parse_docs,
    "smart_parse_topics": smart_parse_topics,
    "smart_separator_lines": smart_separator_lines,
    "timestamp_formats": timestamp_formats,
    "index_upsert": index_upsert,
    "index_append": index_append,
    "partial_merge_df": partial_merge_df,
    "tf_l1_vectors": tf_l1_vectors,
    "similar_tf": _similar("tf"),
    "similar_tfxidf": _similar("tfxidf"),
    "similar_bin_overlap": _similar("bin"),
    "similar_bin_cosine": _similar("bin_cosine"),
    "euclidean_to_target": euclidean_to_target,
    "numeric_profile": numeric_profile,
    "numeric_drop_profile": numeric_drop_profile,
    "kmeans_seed_distances": kmeans_seed_distances,
    "kmeans_assign": kmeans_assign,
    "kmeans_centroids": kmeans_centroids,
    "kmeans_sse": kmeans_sse,
    "kmeans_converged": kmeans_converged,
    "kmeanspp_seeds": kmeanspp_seeds,
    "cluster_similar_docs": cluster_similar_docs,
    "search_stats": search_stats,
    "search_jm_01": _search("jm", lam=0.1),
    "search_jm_05": _search("jm", lam=0.5),
    "search_jm_bounded": search_jm_bounded,
    "similar_docs_report": similar_docs_report,
    "search_hits_text": search_hits_text,
    "file_tree_documents": file_tree_documents,
    "search_tfidf_p1": _search("tfidf", power=1.0),
    "search_tfidf_p2": _search("tfidf", power=2.0),
    "search_hits_report": search_hits_report,
    "topics_subset": topics_subset,
    "qrels_by_query": qrels_by_query,
    "qrels_pool": qrels_pool,
    "run_relevance_flags": run_relevance_flags,
    "run_cumulative_relevance": run_cumulative_relevance,
    "eval_precision": _metric("p"),
    "eval_recall": _metric("r"),
    "eval_ap": _metric("ap"),
    "eval_means": eval_means,
    "eval_metrics_with_mean": eval_metrics_with_mean,
    "lambda_sweep_means": lambda_sweep_means,
    "lambda_sweep_means_p": _sweep_means("P"),
    "lambda_sweep_means_r": _sweep_means("R"),
    "lambda_best": lambda_best,
    "lambda_matrix": lambda_matrix,
    "tune_train_test": tune_train_test,
    "eval_tfidf_test": eval_tfidf_test,
    "paired_metric_diff": paired_metric_diff,
    "paired_t_test": paired_t_test,
    "wilcoxon_test": wilcoxon_test,
    "wilcoxon_lineitem": wilcoxon_lineitem,
    "numeric_csv_profile": numeric_csv_profile,
    "qrels_file": qrels_file,
    "compare_result_files": compare_result_files,
}
