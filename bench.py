"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

The index is built once (``index_build``: tokenize, count terms in-row, persist postings and
lengths), then every query runs against it — the build-once / query-many model of the
reference. Each query is forced completely with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexiframe.plans.context import context  # noqa: E402
from lexiframe.plans.queries import QUERIES  # noqa: E402
from lexiframe.session import local_session  # noqa: E402

HEADLINE = [
    "field_stats_all",
    "coll_terms_idf",
    "doc_terms_tfxidf",
    "postings_positions",
    "similar_tf",
    "similar_tfxidf",
    "similar_bin_cosine",
    "search_stats",
    "search_jm_05",
    "search_tfidf_p1",
    "qrels_by_query",
    "eval_means",
    "lambda_sweep_means",
    "tune_train_test",
    "paired_t_test",
    "wilcoxon_test",
    "kmeans_assign",
    "cluster_similar_docs",
    "index_upsert",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else None, app="lexiframe-bench")
    times: dict[str, float] = {}

    t0 = time.time()
    ctx = context(spark, sf_dir)
    idx = ctx.index
    idx.postings.count()
    idx.doc_fields.count()
    idx.terms.count()
    times["index_build"] = round(time.time() - t0, 3)
    t0 = time.time()
    ctx.qrels.count()
    times["judgements_build"] = round(time.time() - t0, 3)

    for name in names:
        t = time.time()
        _force(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t, 3)

    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in sf_dir else sf_dir
    print(json.dumps({"metric": "total_seconds_index_build_plus_headline_queries", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
