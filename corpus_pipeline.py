"""A training-data pipeline of five operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's docs. All but the last
return the columns of ``documents``:

1. toxicity: documents that score 0.5 or more are dropped; the model learns from ``labels``.
2. simhash_dedup: of each group linked by at most 3 differing fingerprint bits over 3-word
   shingles, the document with the smallest id stays.
3. decontamination: documents that hold a 10-word window of a ``benchmark`` item are dropped.
4. secret_scan: every document stays; secrets in its text become [SECRET], n_chars follows.
5. sentencepiece: two distinct segmentations per document as packed piece ids, decoded again as a
   check.

Null texts count as empty ones throughout; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.llm import secret_scan, simhash_golay, spsample, toxicity as tox, winnow
from lexiframe.llm.common import held_out, read_table
from lexiframe.operators.sizing import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = tox.train(docs, read_table(spark, sf_dir, "labels"), train_rows=~held_out("doc_id", 5, 0))
    return tox.drop_toxic(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_golay.keep_one_per_group(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = spsample.encode(docs, k=2, key="doc_id", name="samples")
    return out.select("doc_id", "lang", "source", "n_chars", F.transform("samples", lambda s: s["ids"]).alias("ids"),
                      F.transform("samples", lambda s: s["n"]).alias("n_pieces"),
                      F.transform("samples", lambda s: s["inclusion"]).alias("inclusion"),
                      F.forall("samples", lambda s: s["round_trip"]).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None  # a learned model, connected components and seeded sampling are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
