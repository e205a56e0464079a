"""Hand goldens on the 4-document corpus (every number worked out by hand)."""

import pytest
from pyspark.sql import functions as F

from lexiframe.operators import search as se
from lexiframe.operators import similarity as sim
from lexiframe.operators import terms as tm


def _map(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_document_frequency(tiny_index):
    assert _map(tm.doc_freqs(tiny_index), "term", "df") == {"a": 2, "b": 2, "c": 2, "d": 1, "e": 1}


def test_idf_rounded(tiny_index):
    idf = _map(tm.best_terms_collection(tiny_index, "idf", top=None), "term", "idf")
    assert idf == {"a": 0.30, "b": 0.30, "c": 0.30, "d": 0.60, "e": 0.60}


def test_field_statistics(tiny_index):
    r = tm.field_stats(tiny_index, "text").collect()[0]
    assert (r.doc_count, r.max_doc, r.sum_doc_freq, r.sum_total_term_freq) == (4, 4, 8, 10)


def test_field_statistics_keyword_fields(tiny_index):
    rows = {r.field: r for r in tm.field_stats(tiny_index).collect()}
    assert set(rows) == {"text", "lang", "source"}
    assert (rows["lang"].doc_count, rows["lang"].sum_doc_freq, rows["lang"].sum_total_term_freq) == (4, 4, 4)


def test_unknown_field_gives_empty_statistics(tiny_index):  # Q29
    assert tm.field_stats(tiny_index, "nope").count() == 0


@pytest.mark.parametrize("rep,expected", [
    ("tf", {2: 0.866, 3: 0.365, 4: 0.0}),
    ("tfxidf", {2: 0.866, 3: 0.289, 4: 0.0}),
    ("bin", {2: 0.816, 3: 0.577, 4: 0.0}),
    ("bin_cosine", {2: 0.816, 3: 0.408, 4: 0.0}),
])
def test_similarity(tiny_index, rep, expected):
    got = sim.similar_docs(tiny_index, 1, rep, top=10)
    assert _map(got, "doc_id", "sim") == expected
    assert [r.doc_id for r in got.orderBy("rank").collect()] == sorted(expected, key=lambda d: -expected[d])


def test_similarity_rep_is_case_insensitive(tiny_index):
    assert _map(sim.similar_docs(tiny_index, 1, "TF", top=3), "doc_id", "sim")[2] == 0.866


def test_bin_is_coverage_not_cosine(tiny_index):  # Q13: both kept, they differ
    cov = _map(sim.similar_docs(tiny_index, 1, "bin"), "doc_id", "sim")
    cos = _map(sim.similar_docs(tiny_index, 1, "bin_cosine"), "doc_id", "sim")
    assert cov[3] != cos[3]


def test_tf_l1_vectors_sum_to_one(tiny_index):
    s = sim.tf_l1_vectors(tiny_index).groupBy("doc_id").agg(F.sum("w").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in s)


def _topics(spark, text="a c"):
    return spark.createDataFrame([(1, text)], "query_id bigint, text string")


def test_jm_scores(spark, tiny_index):
    hits = se.search(tiny_index, _topics(spark), "jm", n=10, lam=0.5)
    got = {r.doc_id: round(r.score, 4) for r in hits.collect()}
    assert got == {1: 1.3882, 3: 1.0415, 2: 0.8650}
    assert [r.doc_id for r in hits.orderBy("rank").collect()] == [1, 3, 2]


@pytest.mark.parametrize("p,expected", [(1.0, {1: 1.8237, 3: 1.2336, 2: 1.0683}),
                                        (2.0, {1: 2.7553, 3: 1.8637, 2: 1.6140})])
def test_tfidf_scores(spark, tiny_index, p, expected):
    hits = se.search(tiny_index, _topics(spark), "tfidf", n=10, power=p)
    assert {r.doc_id: round(r.score, 4) for r in hits.collect()} == expected


def test_repeated_query_words_add_up(spark, tiny_index):
    once = {r.doc_id: r.score for r in se.search(tiny_index, _topics(spark, "d"), "jm", lam=0.5).collect()}
    twice = {r.doc_id: r.score for r in se.search(tiny_index, _topics(spark, "d d"), "jm", lam=0.5).collect()}
    assert twice[3] == pytest.approx(2 * once[3], abs=1e-6)


def test_lambda_grid_matches_single_lambda(spark, tiny_index):
    qt = se.query_terms(_topics(spark))
    grid = se.score_jm_grid(tiny_index, qt).where(F.col("lambda") == 0.5)
    single = se.score_jm(tiny_index, qt, 0.5)
    assert _map(grid, "doc_id", "score") == _map(single, "doc_id", "score")


def test_doc_terms_orders(tiny_index):  # Q02, Q03
    tf = tm.best_terms_document(tiny_index, 1, "TF")
    assert [r.term for r in tf.orderBy("rank").collect()] == ["a", "b", "c"]
    idf = tm.best_terms_document(tiny_index, 3, "idf")   # ascending: common first
    assert [r.term for r in idf.orderBy("rank").collect()] == ["c", "d"]
    tx = tm.best_terms_document(tiny_index, 3, "tfxidf", ascending=False)  # c: 2*0.3=0.6, d: 1*0.6
    rows = tx.orderBy("rank").collect()
    assert [(r.term, r.tfxidf) for r in rows] == [("c", 0.6), ("d", 0.6)]
    with pytest.raises(ValueError):
        tm.best_terms_document(tiny_index, 1, "bm25")


def test_whole_table_rank_is_dense_and_ordered(tiny_index):
    ranked = tm.best_terms_collection(tiny_index, "df", top=None).orderBy("rank").collect()
    assert [r.rank for r in ranked] == [1, 2, 3, 4, 5]
    assert [r.term for r in ranked] == ["a", "b", "c", "d", "e"]


def test_tfxidf_salted_join_matches_broadcast(tiny_index):
    # force the shuffle path (no dictionary broadcast): hot terms are salted, results unchanged
    a = {(r.doc_id, r.term): r.w for r in sim.tfxidf_weights(tiny_index).collect()}
    b = {(r.doc_id, r.term): r.w for r in sim.tfxidf_weights(tiny_index, broadcast_rows=0).collect()}
    assert a == b and len(a) == 8
    s = _map(sim.similarity_scores(tiny_index, 1, "tfxidf", dictionary_broadcast_rows=0), "doc_id", "sim")
    assert s == {2: 0.866, 3: 0.289, 4: 0.0}


def test_cosine_unchanged_by_l1_normalisation(tiny_index):
    import math

    v = {}
    for r in sim.tf_l1_vectors(tiny_index).collect():
        v.setdefault(r.doc_id, {})[r.term] = r.w

    def cos(a, b):
        dot = sum(a[t] * b.get(t, 0.0) for t in a)
        return dot / (math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values())))

    got = _map(sim.similarity_scores(tiny_index, 1, "tf"), "doc_id", "sim")
    assert all(round(cos(v[1], v[d]), 3) == got[d] for d in (2, 3, 4))


def test_query_text_is_a_bag_of_words(spark, tiny_index):  # Q08: no field syntax, punctuation vanishes
    plain = se.search(tiny_index, _topics(spark, "a c"), "jm", lam=0.5)
    syntax = se.search(tiny_index, _topics(spark, "a:  (c)"), "jm", lam=0.5)
    assert _map(plain, "doc_id", "score") == _map(syntax, "doc_id", "score")
