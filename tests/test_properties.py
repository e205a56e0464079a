"""Invariants on small random corpora (hypothesis, few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiframe.operators import evaluation as ev
from lexiframe.operators import similarity as sim
from lexiframe.operators import terms as tm
from lexiframe.operators.index import build_index, merge_indexes

WORDS = st.sampled_from(["a", "b", "c", "d", "e", "f"])
DOCS = st.lists(st.lists(WORDS, min_size=0, max_size=8).map(" ".join), min_size=2, max_size=6)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _index(spark, texts):
    rows = [(i + 1, t, "en", "s1" if i % 2 else "s2") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return docs, build_index(docs)


@SETTINGS
@given(DOCS)
def test_cosine_bounds_and_symmetry(spark, texts):
    _, idx = _index(spark, texts)
    for rep in ("tf", "tfxidf", "bin", "bin_cosine"):
        sims = {r.doc_id: r.sim for r in sim.similarity_scores(idx, 1, rep).collect()}
        assert all(0.0 <= v <= 1.0 for v in sims.values())
        assert len(sims) == len(texts) - 1
    a = {r.doc_id: r.sim for r in sim.similarity_scores(idx, 1, "tf").collect()}
    b = {r.doc_id: r.sim for r in sim.similarity_scores(idx, 2, "tf").collect()}
    assert a[2] == b[1]


@SETTINGS
@given(DOCS)
def test_df_bounded_and_merge_equals_full(spark, texts):
    docs, idx = _index(spark, texts)
    n = len(texts)
    full = {r.term: r.df for r in tm.doc_freqs(idx).collect()}
    assert all(1 <= v <= n for v in full.values())
    parts = [build_index(docs.where(F.col("source") == s)) for s in ("s1", "s2")]
    assert {r.term: r.df for r in tm.doc_freqs(merge_indexes(parts)).collect()} == full


@SETTINGS
@given(st.lists(st.booleans(), min_size=1, max_size=10), st.integers(min_value=1, max_value=12))
def test_metrics_in_unit_interval(spark, flags, extra_relevant):
    run = spark.createDataFrame([(1, i + 1, 1.0 / (i + 1), i + 1) for i in range(len(flags))],
                                "query_id bigint, doc_id bigint, score double, rank bigint")
    rel = [i + 1 for i, f in enumerate(flags) if f] + [100 + j for j in range(extra_relevant)]
    q = spark.createDataFrame([(1, 0, d, 1) for d in rel], "query_id bigint, iter int, doc_id bigint, rel int")
    m = ev.per_query_metrics(run, q, cut=len(flags)).collect()[0]
    assert 0.0 <= m.p <= 1.0 and 0.0 <= m.r <= 1.0 and 0.0 <= m.ap <= 1.0
    if all(flags) and extra_relevant == 0:
        assert m.ap == 1.0
