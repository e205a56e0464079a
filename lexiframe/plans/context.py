"""Shared, lazily-built inputs of the registered queries for one ``sf_dir``.

The index of the ``documents`` table is saved once per session and data folder below the shared
checkpoint folder, and read back as parquet: look-ups prune it, and nothing is lost with an executor.
With ``spark.lexiframe.indexDir`` set, it is saved to that folder, where later sessions find it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.operators.evaluation import derive_qrels
from lexiframe.operators.index import CorpusIndex, build_index, index_exists
from lexiframe.operators.search import query_terms, score_jm, score_tfidf, top_hits
from lexiframe.operators.sizing import scratch_path, spread
from lexiframe.operators.terms import doc_freqs
from lexiframe.sources.tables import read_table

# Query constants of the registry.
TARGET_DOC = 1          # target document of the per-document reports and similarity
TARGET_VEC = 0          # target vector of the distance report
TOP_TERMS = 50          # collection term reports
TOP_DOC_TERMS = 20      # per-document term reports
TOP_SIMILAR = 20        # similar documents
CUT = 10                # hits per topic
SHINGLE = 2             # tokens per shared passage in the derived judgements
TRAIN = (0, 19)         # training topics (inclusive)
TEST = (20, 1 << 62)    # test topics (inclusive)
SUBSET = (5, 15)        # topic subset report
KMEANS_K = 5
KMEANS_ITER = 3
KMEANS_SEED = 42
DOC_CLUSTERS = 3

# Optional session setting: a shared folder for saved indexes, kept between sessions.
INDEX_DIR_CONF = "spark.lexiframe.indexDir"

_CACHE: dict = {}


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str
    memo: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @property
    def documents_spread(self) -> DataFrame:
        """Documents spread over every core when the input has fewer splits than cores."""
        return spread(self.documents, self.spark.sparkContext.defaultParallelism)

    @property
    def index(self) -> CorpusIndex:
        if "index" not in self.memo:
            cols = ["doc_id", "text", "lang", "source", "n_chars"]
            index_dir = self.spark.conf.get(INDEX_DIR_CONF, None)
            # without a folder of its own, an index of this session below the shared checkpoint folder
            path = f"{index_dir.rstrip('/')}/{quote(self.sf_dir, safe='')}" if index_dir else scratch_path(self.spark, "index")
            if not index_exists(self.spark, path):
                build_index(self.documents.select(*cols), "doc_id").save(path)  # dealt by key when written
            self.memo["index"] = CorpusIndex.load(self.spark, path)
        return self.memo["index"]

    @property
    def term_stats(self) -> DataFrame:
        """``term, df, cf`` of the text field — the term dictionary, aggregated once."""
        return doc_freqs(self.index, "text")

    def persisted(self, name: str, build) -> DataFrame:
        """Small derived tables shared by several queries (metric tables), computed once."""
        if name not in self.memo:
            self.memo[name] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self.memo[name]

    def release(self) -> None:
        """Unpersist every cached table of this data folder."""
        for v in self.memo.values():
            for df in ([v.postings, v.doc_fields, v.terms] if isinstance(v, CorpusIndex) else [v]):
                if isinstance(df, DataFrame):
                    df.unpersist()
        self.memo.clear()

    @property
    def topics(self) -> DataFrame:
        """Benchmark items as topics: ``query_id, text``."""
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), "text")

    @property
    def qrels(self) -> DataFrame:
        if "qrels" not in self.memo:
            q = derive_qrels(self.documents_spread, self.table("benchmark"), SHINGLE)
            self.memo["qrels"] = q.persist(StorageLevel.MEMORY_AND_DISK)
        return self.memo["qrels"]

    def eval_terms(self) -> DataFrame:
        return query_terms(self.topics, "query_id", "text")

    def eval_run_jm(self, lam: float = 0.5) -> DataFrame:
        """The JM run of every topic (shared by the search report and the evaluation)."""
        return self.persisted(f"run_jm_{lam}", lambda: top_hits(
            score_jm(self.index, self.eval_terms(), lam), CUT).select("query_id", "doc_id", "score", "rank"))

    def eval_run_tfidf(self, power: float = 1.0) -> DataFrame:
        return self.persisted(f"run_tfidf_{power}", lambda: top_hits(
            score_tfidf(self.index, self.eval_terms(), power), CUT).select("query_id", "doc_id", "score", "rank"))


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (id(spark), sf_dir.rstrip("/"))
    ctx = _CACHE.get(key)
    if ctx is None or ctx.spark is not spark:
        ctx = Context(spark, sf_dir.rstrip("/"))
        _CACHE[key] = ctx
    return ctx
