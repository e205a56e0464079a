"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lexiframe.llm import (
    bpe_segtree,
    cotrain,
    dualtree,
    htmlmain,
    langid,
    merkle,
    pii_weak,
    secret_scan,
    simhash_golay,
    spsample,
    toxicity,
    whitening,
    winnow,
)
from lexiframe.llm.common import held_out, read_docs, read_table
from lexiframe.llm.spans import count_kind, listing


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
dp AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS s FROM d),
dl AS (SELECT r, s, list(x) OVER (PARTITION BY r ORDER BY s ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM dp),
dw AS (SELECT r, m, s, array_to_string(l[1:m], ' ') AS g FROM dl, (SELECT DISTINCT m FROM iw) WHERE len(l) >= m),
hit AS (SELECT dw.r, dw.m, dw.s, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.m = iw.m),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, n.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct segmentations per document; digests of their ids, and whether they decode to the text."""
    out = spsample.encode(read_docs(spark, sf_dir).select("doc_id", "text"), k=2, key="doc_id", name="s")
    return out.select("doc_id", F.size("s").alias("n_samples"), F.transform("s", lambda x: x["n"]).alias("n_pieces"),
                      F.transform("s", lambda x: F.sha2(x["ids"], 256)).alias("ids_sha256"),
                      F.transform("s", lambda x: x["log_prob"]).alias("log_prob"),
                      F.transform("s", lambda x: x["perturbed"]).alias("perturbed"),
                      F.transform("s", lambda x: x["inclusion"]).alias("inclusion"),
                      F.forall("s", lambda x: x["round_trip"]).alias("round_trip"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read_docs(spark, sf_dir), held_out("doc_id", 4, 2)
    model = langid.train(docs, rows=~out)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay.near_duplicates(read_docs(spark, sf_dir), shingle=3, max_bits=3)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.contamination(read_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read_docs(spark, sf_dir), held_out("doc_id", 5, 0)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), train_rows=~out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_docs(spark, sf_dir, "pages")
    out = htmlmain.extract(pages, htmlmain.train(pages), name="text")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_weak.find_pii(read_docs(spark, sf_dir), name="pii")
    base = F.filter("pii", lambda s: s["base"])
    count = [count_kind(base, k).alias(f"n_{k}") for k in pii_weak.BASE_KINDS]
    return out.select("doc_id", *count, F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("pii")).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir).select("doc_id", "text")
    out = secret_scan.find_secrets(docs, name="secrets", index=secret_scan.build_index(docs))
    base = secret_scan.base_spans(F.col("secrets"))
    count = [count_kind(base, r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE]
    return out.select("doc_id", *count, F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("secrets")).alias("spans"))


def _op8_sql() -> str:
    """The same rules by plain scans of every text."""
    base = [("assign", "(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", "length(regexp_extract(m, pat, 1)) >= 8"),
            ("access", "AKIA[A-Z0-9]+", "length(m) >= 16"), ("hex", "[0-9a-f]+", "length(m) >= 32")]
    rules = base + [(r.kind, r.pattern.replace("(?:live|test)", "(live|test)"), "true") for r in secret_scan.EXTRA]
    ok = " ".join(f"WHEN {i} THEN {c}" for i, (_, _, c) in enumerate(rules))
    hits = " UNION ALL ".join(
        f"SELECT r, {i} AS o, '{k}' AS kind, '{p}' AS pat, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS ms FROM d WHERE regexp_matches(t, '{p}')"
        for i, (k, p, _) in enumerate(rules))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
h AS ({hits}),
u AS (SELECT r, o, kind, pat, unnest(ms) AS m, generate_subscripts(ms, 1) AS i, gaps, ms FROM h),
s AS (SELECT r, o, kind, pat, m, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM u),
f AS (SELECT r, o, kind, a, a + length(m) AS b FROM s WHERE CASE o {ok} END),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n1, count(*) FILTER (kind = 'access') AS n2, count(*) FILTER (kind = 'hex') AS n3,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o) FILTER (o < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o) AS spans FROM f GROUP BY r)
SELECT d.doc_id, coalesce(n1, 0) AS n_assign, coalesce(n2, 0) AS n_access, coalesce(n3, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = read_docs(spark, sf_dir), held_out("doc_id", 5, 0)
    model = cotrain.train(docs, read_table(spark, sf_dir, "labels"), train_rows=~out)
    scored = cotrain.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_docs(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    out = whitening.whiten(vectors, model, components=32)
    rows = out.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    if model is None:
        return rows.select("vec_id", F.col("at").alias("component"), F.lit(0).cast("bigint").alias("n"), "deviation", "whitened",
                           F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    error = whitening.identity_error(out, model.n)
    share = F.array(*[F.lit(x) for x in model.explained[:32]])
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against rows of which half have lost their newlines."""
    docs = read_docs(spark, sf_dir)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = merkle.leaf_hash(*fields, F.replace("text", F.lit("\n"), F.lit("")))
    leaves = docs.select("source", "doc_id", merkle.leaf_hash(*fields, F.col("text")).alias("leaf"),
                         F.when(held_out("doc_id", 2, 0), tampered).alias("tampered"))
    out = merkle.manifest(leaves, "source", "doc_id", "leaf", carry=("tampered",))
    folded = out.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _op12_sql() -> str:
    """Level by level over all nodes; a group with one node left is done."""
    text = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    head = " || ".join(text(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda v, x: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""
    parts = [f"""d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, sha256({head} || {text('text')}) AS leaf,
        CASE WHEN {crc} % 2 = 0 THEN sha256({head} || {text("replace(text, chr(10), '')")}) END AS tampered FROM documents)""",
             """p0 AS MATERIALIZED (SELECT rid, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        leaf AS h, coalesce(tampered, leaf) AS f, '' AS s FROM d)"""]

    def climb(a: int, b: int) -> None:
        for k in range(a, b):
            parts.append(f"""a{k} AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n,
        coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM (SELECT DISTINCT g, i, h FROM p{k}))""")
            parts.append(f"""p{k + 1} AS MATERIALIZED (SELECT rid, p.g, p.i // 3 AS i, CASE WHEN n = 1 THEN p.h ELSE sha256(l || p.h || r) END AS h,
        CASE WHEN n = 1 THEN f ELSE sha256(l || f || r) END AS f, s || l || r AS s FROM p{k} p JOIN a{k} a ON p.g IS NOT DISTINCT FROM a.g AND p.i = a.i)""")

    rows, groups = 16, 10  # levels: trees of up to 3^16 rows and 3^10 sources
    climb(0, rows)
    parts.append(f"u AS MATERIALIZED (SELECT rid, h AS subroot FROM p{rows})")
    parts.append(f"p{rows + 1} AS MATERIALIZED (SELECT rid, 0 AS g, dense_rank() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, f, s FROM p{rows})")
    climb(rows + 1, rows + 1 + groups)
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(s) AS proof_sha256, f AS folded_root, f = h AS verified
FROM p{rows + 1 + groups} JOIN d USING (rid) JOIN u USING (rid)"""


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe_segtree.encode(read_docs(spark, sf_dir).select("doc_id", "text"), name="bpe", with_text=True)
    return out.select("doc_id", F.col("bpe.n").alias("n_tokens"), F.sha2("bpe.ids", 256).alias("ids_sha256"),
                      F.sha2("bpe.text", 256).alias("decoded_sha256"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_langid": op2_langid,
    "op3_simhash": op3_simhash,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_html": op6_html,
    "op7_pii": op7_pii,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_topk": op10_topk,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_bpe": op13_bpe,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": OP4_SQL,
    "op8_secrets": _op8_sql(),
    "op10_topk": OP10_SQL,
    "op12_merkle": _op12_sql(),
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
