"""k-means until the SSE stops falling (no SQL oracle): checked against a brute-force numpy Lloyd."""

import os

import numpy as np
import pytest

from lexiframe.operators import kmeans as km

SF = "/root/testdata/sf0.001/embeddings.parquet"


def _numpy_lloyd(ids, x, k):
    order = np.argsort(ids)
    c = x[order[:k]].copy()
    prev, sses, assign = np.inf, [], None
    while True:
        d2 = np.round(((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2), 9)
        assign = d2.argmin(axis=1)  # first (smallest) cluster on ties
        new = c.copy()
        for j in range(k):
            if (assign == j).any():
                new[j] = x[assign == j].mean(axis=0)
        sse = np.round(((x - new[assign]) ** 2).sum(axis=1), 9).sum()
        sses.append(sse)
        c = new
        if prev - sse <= 0:
            break
        prev = sse
    return assign, sses


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_converged_kmeans_matches_numpy(spark):
    df = spark.read.parquet(SF).select("vec_id", "embedding")
    rows = df.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([np.array(r.embedding, dtype=np.float32).astype(np.float64) for r in rows])
    assign, sses = _numpy_lloyd(ids, x, 5)
    res = km.kmeans(df, 5, iterations=None)
    got_sse = [r.sse for r in res.sse.orderBy("iteration").collect()]
    assert len(got_sse) == len(sses)
    assert np.allclose(got_sse, sses, atol=1e-5)
    got = {r.vec_id: r.cluster for r in res.assignments.collect()}
    assert all(got[i] == a for i, a in zip(ids, assign))
