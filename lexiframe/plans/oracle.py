"""DuckDB SQL oracles: for each registered query, the same result written as plain SQL over the
driver tables (views ``documents``, ``benchmark``, ``embeddings`` …).

They are written independently of the Spark code: relational GROUP BY / JOIN / window SQL,
no shared helpers beyond a few text snippets below. The token pattern is written here a second time,
from the word-break rules, for the other regular expression engine.
"""

from __future__ import annotations

from lexiframe.plans import context as C
from lexiframe.operators.search import LAMBDA_GRID

_AL = r"(?:[^\P{L}\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}\p{Thai}\p{Lao}\p{Myanmar}\p{Khmer}]|\p{Nl})"
_X = r"[\p{M}\p{Cf}]*"
_KA = r"[\p{Katakana}\x{30FC}]"
_SA = r"[\p{Thai}\p{Lao}\p{Myanmar}\p{Khmer}]"
_LETTERS = rf"{_AL}{_X}(?:{_AL}{_X})*"
_DIGITS = rf"\p{{Nd}}{_X}(?:\p{{Nd}}{_X})*"
_WORD = rf"{_LETTERS}(?:[:.'\x{{B7}}\x{{387}}\x{{55F}}\x{{5F4}}\x{{2027}}\x{{FE13}}\x{{FE55}}\x{{FF1A}}\x{{2018}}\x{{2019}}\x{{2024}}\x{{FE52}}\x{{FF07}}\x{{FF0E}}]{_X}{_LETTERS})*"
_NUMBER = (rf"{_DIGITS}(?:[,;.'\x{{37E}}\x{{589}}\x{{60C}}\x{{60D}}\x{{66C}}\x{{7F8}}\x{{2044}}\x{{FE10}}\x{{FE14}}\x{{FE50}}\x{{FE54}}\x{{FF0C}}\x{{FF1B}}"
           rf"\x{{2018}}\x{{2019}}\x{{2024}}\x{{FE52}}\x{{FF07}}\x{{FF0E}}]{_X}{_DIGITS})*")
_PIECE = rf"(?:(?:{_WORD}|{_NUMBER})+|{_KA}{_X}(?:{_KA}{_X})*)"
_PC = rf"(?:\p{{Pc}}{_X})"
PAT = rf"{_PC}*{_PIECE}(?:{_PC}+{_PIECE})*{_PC}*|[\p{{Han}}\p{{Hiragana}}]{_X}|{_SA}{_X}(?:{_SA}{_X})*".replace("'", "''")


def _tok(col: str) -> str:
    return (f"flatten(list_transform(regexp_extract_all(lower({col}), '{PAT}', 0), lambda w: CASE WHEN length(w) > 255 "
            f"THEN list_transform(range(0, (length(w) - 1) // 255 + 1), lambda j: substr(w, CAST(j * 255 + 1 AS BIGINT), 255)) ELSE [w] END))")


# documents → token lists → (doc, term, tf) and document lengths
TV = f"""
tok AS (SELECT doc_id, {_tok('text')} AS toks FROM documents),
tv AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(toks) AS term FROM tok) GROUP BY doc_id, term),
dl AS (SELECT doc_id, CAST(len(toks) AS BIGINT) AS dl FROM tok),
nd AS (SELECT count(*) AS n FROM documents)"""

# term dictionary of the texts in allv
_DICTIONARY = f"""tf AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest({_tok('text')}) AS term FROM allv) GROUP BY doc_id, term)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term"""

# derived judgements: shared passages of C.SHINGLE tokens between a benchmark item and a document
QRELS = f"""
btok AS (SELECT item_id AS query_id, {_tok('text')} AS toks FROM benchmark),
tsh AS (SELECT DISTINCT query_id, sh FROM (
          SELECT query_id, unnest(list_transform(range(1, len(toks) - {C.SHINGLE - 2}),
                 lambda i: array_to_string(toks[i:i + {C.SHINGLE - 1}], ' '))) AS sh FROM btok)),
dsh AS (SELECT doc_id, unnest(list_transform(range(1, len(toks) - {C.SHINGLE - 2}),
                 lambda i: array_to_string(toks[i:i + {C.SHINGLE - 1}], ' '))) AS sh FROM tok),
qrels AS (SELECT DISTINCT t.query_id, d.doc_id FROM dsh d JOIN tsh t ON d.sh = t.sh),
nrel AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id)"""


def _qterms(where: str = "") -> str:
    toks = _tok("text")
    return f"""
qt AS (SELECT query_id, term, count(*) AS qtf FROM (
         SELECT item_id AS query_id, unnest({toks}) AS term FROM benchmark {where})
       GROUP BY query_id, term),
ts AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tv WHERE term IN (SELECT term FROM qt) GROUP BY term),
tot AS (SELECT sum(dl) AS T FROM dl),
m AS (SELECT qt.query_id, tv.doc_id, qt.qtf, tv.tf, dl.dl, ts.df, ts.cf, tot.T, nd.n
      FROM qt JOIN tv ON qt.term = tv.term JOIN ts ON ts.term = qt.term JOIN dl ON dl.doc_id = tv.doc_id,
           tot, nd)"""


def _jm(lam: str) -> str:
    return (f"qtf * ln(1.0 + ((1.0 - {lam}) * tf / dl) / ({lam} * (cf + 1.0) / (T + 1.0)))")


def _tfidf(p: float) -> str:
    return f"qtf * sqrt(tf) * pow(1.0 + ln((n + 1.0) / (df + 1.0)), {p!r}) / sqrt(dl)"


def _run(score_expr: str, cut: int = C.CUT) -> str:
    return f"""
sc AS (SELECT query_id, doc_id, round(sum({score_expr}), 9) AS score FROM m GROUP BY query_id, doc_id),
run AS (SELECT * FROM (SELECT query_id, doc_id, score,
          row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc)
        WHERE rank <= {cut})"""


def _lam(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _search(score_expr: str) -> str:
    return f"WITH {TV}, {_qterms()}, {_run(score_expr)} SELECT query_id, doc_id, round(score, 6) AS score, rank FROM run"


# per-topic P/R/AP of a run against the derived judgements (judged topics only)
METRICS = f"""
flags AS (SELECT r.query_id, r.doc_id, r.rank, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS is_rel
          FROM run r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id),
cum AS (SELECT *, sum(is_rel) OVER (PARTITION BY query_id ORDER BY rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel FROM flags),
agg AS (SELECT query_id, count(*) AS returned, sum(is_rel) AS rel_ret, sum(is_rel * cum_rel / rank) AS ap_num
        FROM cum GROUP BY query_id),
met AS (SELECT n.query_id, coalesce(a.rel_ret / a.returned, 0.0) AS p,
               coalesce(a.rel_ret / n.n_rel, 0.0) AS r, coalesce(a.ap_num / n.n_rel, 0.0) AS ap
        FROM nrel n LEFT JOIN agg a ON a.query_id = n.query_id)"""


def _eval_jm(lam: float = 0.5) -> str:
    return f"{TV}, {QRELS}, {_qterms()}, {_run(_jm(_lam(lam)))}, {METRICS}"


def _eval_tfidf() -> str:
    return f"{TV}, {QRELS}, {_qterms()}, {_run(_tfidf(1.0))}, {METRICS}"


GRID = "[" + ", ".join(_lam(x) for x in LAMBDA_GRID) + "]"


def _sweep(first: int, last: int) -> str:
    """AP per judged topic in [first, last] and λ of the grid."""
    where = f"WHERE item_id BETWEEN {first} AND {last}"
    return f"""{TV}, {QRELS}, {_qterms(where)},
g AS (SELECT unnest({GRID}) AS "lambda"),
sc AS (SELECT query_id, doc_id, "lambda", round(sum({_jm('"lambda"')}), 9) AS score FROM m, g
       GROUP BY query_id, doc_id, "lambda"),
run AS (SELECT * FROM (SELECT query_id, doc_id, "lambda", score,
          row_number() OVER (PARTITION BY query_id, "lambda" ORDER BY score DESC, doc_id) AS rank FROM sc)
        WHERE rank <= {C.CUT}),
flags AS (SELECT r.query_id, r."lambda", r.rank, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS is_rel
          FROM run r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id),
cum AS (SELECT *, sum(is_rel) OVER (PARTITION BY query_id, "lambda" ORDER BY rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel FROM flags),
agg AS (SELECT query_id, "lambda", sum(is_rel * cum_rel / rank) AS ap_num, count(*) AS returned,
               sum(is_rel) AS rel_ret FROM cum GROUP BY query_id, "lambda"),
sw AS (SELECT n.query_id, g."lambda", coalesce(a.ap_num / n.n_rel, 0.0) AS ap,
              coalesce(a.rel_ret / a.returned, 0.0) AS p, coalesce(a.rel_ret / n.n_rel, 0.0) AS r
       FROM nrel n CROSS JOIN g LEFT JOIN agg a ON a.query_id = n.query_id AND a."lambda" = g."lambda"
       WHERE n.query_id BETWEEN {first} AND {last}),
means AS (SELECT "lambda", avg(ap) AS mean FROM sw GROUP BY "lambda"),
means_p AS (SELECT "lambda", avg(p) AS mean FROM sw GROUP BY "lambda"),
means_r AS (SELECT "lambda", avg(r) AS mean FROM sw GROUP BY "lambda"),
best AS (SELECT "lambda", mean FROM means ORDER BY round(mean, 9) DESC, "lambda" LIMIT 1)"""


# Student-t two-sided p for integer df (closed-form series terms via lgamma)
def _t_p(t: str, nu: str) -> str:
    th = f"atan(abs({t}) / sqrt({nu}))"
    odd = (f"(2 / pi()) * ({th} + sin({th}) * coalesce(list_sum(list_transform(range(0, CAST(({nu} - 1) / 2 AS BIGINT)),"
           f" lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * pow(cos({th}), 2 * j + 1))), 0))")
    even = (f"sin({th}) * list_sum(list_transform(range(0, CAST({nu} / 2 AS BIGINT)),"
            f" lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * pow(cos({th}), 2 * j)))")
    a = f"CASE WHEN {nu} = 1 THEN 2 * {th} / pi() WHEN {nu} % 2 = 1 THEN {odd} ELSE {even} END"
    return f"greatest(0.0, least(1.0, 1 - ({a})))"


# standard normal CDF at -a (a >= 0): 1/2 - phi(a) * sum_k a^(2k+1) / (2k+1)!!
def _phi_neg(a: str) -> str:
    s = (f"list_sum(list_transform(range(0, 100), lambda k: exp((2 * k + 1) * ln({a}) - ((k + 1) * ln(2.0)"
         f" + lgamma(k + 1.5) - 0.5 * ln(pi())))))")
    return (f"CASE WHEN {a} IS NULL THEN NULL WHEN {a} >= 8 THEN 0.0 WHEN {a} = 0 THEN 0.5 "
            f"ELSE greatest(0.0, least(1.0, 0.5 - exp(-{a} * {a} / 2) / sqrt(2 * pi()) * {s})) END")


def _paths() -> str:
    return """paths AS (SELECT doc_id,
    (CASE WHEN source = 'src0' THEN '' ELSE source || '/' END)
    || (CASE WHEN n_chars > 1000 THEN lang || '/' ELSE '' END)
    || 'doc' || CAST(doc_id AS VARCHAR)
    || (CASE lang WHEN 'en' THEN '.txt' WHEN 'de' THEN '.java' WHEN 'es' THEN '.c' ELSE '' END) AS path
  FROM documents),
pp AS (SELECT doc_id, path, len(string_split(path, '/')) - 1 AS level,
              regexp_extract(string_split(path, '/')[-1], '(\\.[^.]*)$', 1) AS ext FROM paths)"""


EXTS = "('.java', '.c', '.txt', '.odt', '.doc', '.pdf')"


def _doc_terms(order: str) -> str:
    key = {"tf": "tf DESC", "df": "df DESC", "idf": "idf ASC", "tfxidf": "tfxidf ASC"}[order]
    return f"""WITH {TV},
t AS (SELECT term, tf FROM tv WHERE doc_id = {C.TARGET_DOC}),
d AS (SELECT term, count(*) AS df FROM tv WHERE term IN (SELECT term FROM t) GROUP BY term),
x AS (SELECT t.term, t.tf, d.df, round(log10(nd.n / d.df), 2) AS idf FROM t JOIN d USING (term), nd)
SELECT term, tf, df, idf, round(tf * idf, 6) AS tfxidf,
       row_number() OVER (ORDER BY {key}, term) AS rank
FROM x ORDER BY {key}, term LIMIT {C.TOP_DOC_TERMS}"""


def _similar(rep: str) -> str:
    t = C.TARGET_DOC
    if rep in ("tf", "tfxidf"):
        w = "CAST(tf AS DOUBLE)" if rep == "tf" else "tf * idf"
        body = f"""
idf AS (SELECT term, round(log10(nd.n / count(*)), 2) AS idf FROM tv, nd GROUP BY term, nd.n),
w AS (SELECT doc_id, term, {w} AS w FROM tv JOIN idf USING (term)),
tw AS (SELECT term, w AS wt FROM w WHERE doc_id = {t}),
tn AS (SELECT sqrt(sum(wt * wt)) AS tn FROM tw),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS dn FROM w GROUP BY doc_id),
dot AS (SELECT w.doc_id, sum(w.w * tw.wt) AS dot FROM w JOIN tw USING (term) GROUP BY w.doc_id),
s AS (SELECT d.doc_id, CASE WHEN dn.dn * tn.tn <> 0 THEN coalesce(dot.dot, 0) / (dn.dn * tn.tn) END AS sim
      FROM documents d LEFT JOIN dn USING (doc_id) LEFT JOIN dot USING (doc_id), tn
      WHERE d.doc_id <> {t})"""
    else:
        num = ("sqrt(coalesce(sh.n, 0) / tt.n)" if rep == "bin"
               else "coalesce(sh.n, 0) / sqrt(dt.n * tt.n)")
        body = f"""
tt AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tv WHERE doc_id = {t}),
dt AS (SELECT doc_id, count(*) AS n FROM tv GROUP BY doc_id),
sh AS (SELECT a.doc_id, count(*) AS n FROM tv a JOIN tv b ON a.term = b.term AND b.doc_id = {t}
       GROUP BY a.doc_id),
s AS (SELECT d.doc_id, CASE WHEN tt.n > 0 AND coalesce(dt.n, 0) > 0 THEN {num} END AS sim
      FROM documents d LEFT JOIN dt USING (doc_id) LEFT JOIN sh USING (doc_id), tt
      WHERE d.doc_id <> {t})"""
    return f"""WITH {TV}, {body.strip()},
r AS (SELECT doc_id, coalesce(round(sim, 3), 0.0) AS sim FROM s)
SELECT doc_id, sim, row_number() OVER (ORDER BY sim DESC, doc_id) AS rank
FROM r ORDER BY sim DESC, doc_id LIMIT {C.TOP_SIMILAR}"""


def _sqdist(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def _kmeans_sql(k: int, iters: int) -> str:
    """Unrolled Lloyd iterations: a{i} assignment, c{i} centroids, s{i} SSE."""
    parts = [
        "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v AS center "
        f"FROM (SELECT * FROM e ORDER BY vec_id LIMIT {k}))",
    ]
    for i in range(1, iters + 1):
        p = i - 1
        parts.append(
            f"a{i} AS (SELECT vec_id, v, cluster, d FROM (SELECT e.vec_id, e.v, c.cluster, "
            f"{_sqdist('e.v', 'c.center')} AS d, row_number() OVER (PARTITION BY e.vec_id "
            f"ORDER BY {_sqdist('e.v', 'c.center')}, c.cluster) AS rn FROM e, c{p} c) WHERE rn = 1)")
        parts.append(
            f"m{i} AS (SELECT cluster, pos, avg(x) AS x FROM (SELECT cluster, unnest(v) AS x, "
            f"unnest(range(1, len(v) + 1)) AS pos FROM a{i}) GROUP BY cluster, pos)")
        parts.append(
            f"c{i} AS (SELECT cluster, list(x ORDER BY pos) AS center FROM m{i} GROUP BY cluster "
            f"UNION ALL SELECT cluster, center FROM c{p} WHERE cluster NOT IN (SELECT cluster FROM m{i}))")
        parts.append(
            f"s{i} AS (SELECT {i} AS iteration, sum({_sqdist('a.v', 'c.center')}) AS sse "
            f"FROM a{i} a JOIN c{i} c ON a.cluster = c.cluster)")
    return ",\n".join(parts)


def _kmeans_until_sql(k: int, rounds: int) -> str:
    """Rounds up to the first one in which the SSE does not fall, out of ``rounds`` unrolled ones."""
    steps = _kmeans_sql(k, rounds).replace(" AS (SELECT", " AS MATERIALIZED (SELECT")
    sses = " UNION ALL ".join(f"SELECT iteration, sse FROM s{i}" for i in range(1, rounds + 1))
    return f"""WITH {steps},
sses AS MATERIALIZED ({sses}),
last AS (SELECT min(iteration) AS n FROM (SELECT iteration, sse, lag(sse) OVER (ORDER BY iteration) AS prev FROM sses)
         WHERE prev - sse <= 1e-10 * sse)
SELECT CAST(iteration AS BIGINT) AS iteration, round(sse, 6) AS sse FROM sses, last WHERE iteration <= n"""


def _seeds_sql(k: int, seed: int) -> str:
    u = lambda i: f"((CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':{seed + i}'), 1, 13) AS BIGINT) + 0.5) / pow(2, 52))"
    parts = ["d0 AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, 'inf'::DOUBLE AS d FROM embeddings)",
             f"c0 AS MATERIALIZED (SELECT v AS c FROM d0 ORDER BY {u(0)}, vec_id LIMIT 1)"]
    for i in range(1, k):
        parts.append(f"d{i} AS MATERIALIZED (SELECT vec_id, v, least(d, {_sqdist('v', 'c')}) AS d FROM d{i - 1}, c{i - 1})")
        parts.append(f"c{i} AS MATERIALIZED (SELECT v AS c FROM d{i} WHERE d > 0 ORDER BY -ln({u(i)}) / d, vec_id LIMIT 1)")
    rows = " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS cluster, c FROM c{i}" for i in range(k))
    return "WITH " + ", ".join(parts) + f"""
SELECT cluster, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value
FROM (SELECT cluster, unnest(range(0, len(c))) AS dim, unnest(c) AS value FROM ({rows}))"""


def _sparse_kmeans_sql(k: int, iters: int) -> str:
    """Top similar documents (tf cosine) clustered on L1-normalised tf vectors."""
    sim_top = _similar("tf").split("WITH", 1)[1]
    # reuse the similarity CTEs, keep the top list as `top`
    head, _, _ = sim_top.rpartition("SELECT doc_id, sim, row_number()")
    parts = [head.strip().rstrip(","),
             f"top AS (SELECT doc_id FROM r ORDER BY sim DESC, doc_id LIMIT {C.TOP_SIMILAR})",
             "vec AS (SELECT tv.doc_id, tv.term, tv.tf / dl.dl AS w FROM tv JOIN dl USING (doc_id) "
             "WHERE tv.doc_id IN (SELECT doc_id FROM top))",
             "vn AS (SELECT doc_id, sum(w * w) AS dn FROM vec GROUP BY doc_id)",
             f"seeds AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS INTEGER) AS cluster "
             f"FROM (SELECT doc_id FROM top ORDER BY doc_id LIMIT {k}))",
             "k0 AS (SELECT s.cluster, v.term, v.w FROM vec v JOIN seeds s USING (doc_id))"]
    for i in range(1, iters + 1):
        p = i - 1
        parts.append(f"kn{p} AS (SELECT cluster, sum(w * w) AS cn FROM k{p} GROUP BY cluster)")
        parts.append(f"kd{i} AS (SELECT v.doc_id, k.cluster, sum(v.w * k.w) AS dot FROM vec v "
                     f"JOIN k{p} k ON v.term = k.term GROUP BY v.doc_id, k.cluster)")
        parts.append(f"x{i} AS (SELECT doc_id, cluster FROM (SELECT vn.doc_id, kn.cluster, row_number() OVER "
                     f"(PARTITION BY vn.doc_id ORDER BY vn.dn + kn.cn - 2.0 * coalesce(kd.dot, 0.0), "
                     f"kn.cluster) AS rn FROM vn CROSS JOIN kn{p} kn LEFT JOIN kd{i} kd "
                     f"ON kd.doc_id = vn.doc_id AND kd.cluster = kn.cluster) WHERE rn = 1)")
        parts.append(f"sz{i} AS (SELECT cluster, count(*) AS size FROM x{i} GROUP BY cluster)")
        parts.append(f"k{i} AS (SELECT x.cluster, v.term, sum(v.w) / any_value(sz.size) AS w FROM vec v "
                     f"JOIN x{i} x USING (doc_id) JOIN sz{i} sz ON sz.cluster = x.cluster GROUP BY x.cluster, v.term "
                     f"UNION ALL SELECT cluster, term, w FROM k{p} WHERE cluster NOT IN (SELECT cluster FROM sz{i}))")
    return ",\n".join(parts)


def _profile(cols) -> str:
    sel = " UNION ALL ".join(
        f"SELECT '{c}' AS attr, round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
        f"round(avg({c}), 6) AS mean FROM lineitem" for c in cols)
    return sel


ORACLE_SQL: dict[str, str] = {
    "tokenize_docs": f"""WITH {TV}
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(list_distinct(toks)) AS BIGINT) AS n_terms FROM tok""",
    "term_vectors": f"WITH {TV} SELECT doc_id, term, tf FROM tv",
    "postings_positions": f"""WITH tok AS (SELECT doc_id, {_tok('text')} AS toks FROM documents),
p AS (SELECT doc_id, unnest(toks) AS term, unnest(range(0, len(toks))) AS pos FROM tok)
SELECT doc_id, term, count(*) AS tf, min(pos) AS first_pos, max(pos) AS last_pos FROM p GROUP BY doc_id, term""",
    "token_offsets": f"""WITH s0 AS (SELECT doc_id, regexp_extract_all(lower(text), '{PAT}', 0) AS raw,
                     regexp_split_to_array(lower(text), '{PAT}') AS gaps FROM documents),
s AS (SELECT doc_id, {_tok('text')} AS t, flatten(list_transform(raw, lambda w, k: list_concat([gaps[k]],
             list_transform(range(0, (length(w) - 1) // 255), lambda j: '')))) AS g FROM s0 JOIN documents USING (doc_id)),
r AS (SELECT doc_id, unnest(range(0, len(t))) AS pos, unnest(t) AS term, g FROM s),
x AS (SELECT doc_id, pos, term, length(g[pos + 1]) + length(term) AS step, length(term) AS ln FROM r)
SELECT doc_id, pos, term,
       CAST(sum(step) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ln
            AS BIGINT) AS start_offset,
       CAST(sum(step) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS end_offset
FROM x""",
    "index_summary": f"""WITH {TV}
SELECT (SELECT n FROM nd) AS n_docs, (SELECT count(DISTINCT doc_id) FROM tv) AS n_docs_with_text,
       (SELECT count(*) FROM tv) AS n_postings, (SELECT count(DISTINCT term) FROM tv) AS n_terms,
       (SELECT CAST(sum(dl) AS BIGINT) FROM dl) AS n_tokens""",
    "vocabulary": f"WITH {TV} SELECT DISTINCT term FROM tv",
    "field_stats": f"""WITH {TV}
SELECT 'text' AS field, (SELECT count(DISTINCT doc_id) FROM tv) AS doc_count, (SELECT n FROM nd) AS max_doc,
       (SELECT count(*) FROM tv) AS sum_doc_freq, (SELECT CAST(sum(tf) AS BIGINT) FROM tv) AS sum_total_term_freq""",
    "field_stats_all": f"""WITH {TV}
SELECT 'text' AS field, (SELECT count(DISTINCT doc_id) FROM tv) AS doc_count, (SELECT n FROM nd) AS max_doc,
       (SELECT count(*) FROM tv) AS sum_doc_freq, (SELECT CAST(sum(tf) AS BIGINT) FROM tv) AS sum_total_term_freq
UNION ALL SELECT 'lang', count(lang), (SELECT n FROM nd), count(lang), count(lang) FROM documents
UNION ALL SELECT 'source', count(source), (SELECT n FROM nd), count(source), count(source) FROM documents""",
    "coll_terms_df": f"""WITH {TV}, d AS (SELECT term, count(*) AS df FROM tv GROUP BY term)
SELECT term, df, row_number() OVER (ORDER BY df DESC, term) AS rank FROM d
ORDER BY df DESC, term LIMIT {C.TOP_TERMS}""",
    "coll_terms_idf": f"""WITH {TV}, d AS (SELECT term, round(log10(nd.n / count(*)), 2) AS idf FROM tv, nd
                                   GROUP BY term, nd.n)
SELECT term, idf, row_number() OVER (ORDER BY idf ASC, term) AS rank FROM d
ORDER BY idf ASC, term LIMIT {C.TOP_TERMS}""",
    "doc_terms_tf": _doc_terms("tf"),
    "doc_terms_df": _doc_terms("df"),
    "doc_terms_idf": _doc_terms("idf"),
    "doc_terms_tfxidf": _doc_terms("tfxidf"),
    "stored_fields_dump": """
SELECT doc_id, 'text' AS field, text AS value FROM documents
UNION ALL SELECT doc_id, 'lang', lang FROM documents
UNION ALL SELECT doc_id, 'source', source FROM documents
UNION ALL SELECT doc_id, 'n_chars', CAST(n_chars AS VARCHAR) FROM documents""",
    "scan_ext_filter": f"WITH {_paths()} SELECT doc_id, path FROM pp WHERE level >= 1 AND ext IN {EXTS}",
    "scan_depth_limit": f"WITH {_paths()} SELECT doc_id, path FROM pp WHERE level >= 1 AND level <= 1 AND ext IN {EXTS}",
    "lines_top_bottom": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, array_to_string(list_concat(ls[1:least(2, len(ls))],
       ls[greatest(2, len(ls) - 2) + 1:len(ls)]), chr(10)) AS body FROM l""",
    "smart_parse_docs": "SELECT doc_id AS id, regexp_replace(text, '\\n+$', '') AS body FROM documents",
    "smart_parse_topics": "SELECT item_id AS id, regexp_replace(text, '\\n+$', '') AS body FROM benchmark",
    "timestamp_formats": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS local_fmt,
       strftime(ts, '%Y%m%d%H%M%S%g') AS ms_fmt FROM events""",
    "index_upsert": f"""WITH upd AS (SELECT d.doc_id, d.text || chr(10) || 'quality=' || CAST(l.quality AS VARCHAR)
                          || ' toxic=' || CAST(l.toxic AS VARCHAR) AS text
                    FROM documents d JOIN labels l USING (doc_id)),
allv AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM upd)
         UNION ALL SELECT doc_id, text FROM upd),
{_DICTIONARY}""",
    "index_append": f"""WITH allv AS (SELECT doc_id, text FROM documents
         UNION ALL SELECT page_id + (SELECT max(doc_id) + 1 FROM documents), html FROM pages),
{_DICTIONARY}""",
    "partial_merge_df": f"WITH {TV} SELECT term, count(*) AS df FROM tv GROUP BY term",
    "tf_l1_vectors": f"WITH {TV} SELECT doc_id, term, round(tf / dl, 6) AS w FROM tv JOIN dl USING (doc_id)",
    "similar_tf": _similar("tf"),
    "similar_tfxidf": _similar("tfxidf"),
    "similar_bin_overlap": _similar("bin"),
    "similar_bin_cosine": _similar("bin_cosine"),
    "euclidean_to_target": f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
t AS (SELECT v AS tv FROM e WHERE vec_id = {C.TARGET_VEC})
SELECT vec_id, round(CASE WHEN len(v) <> len(tv) THEN 'inf'::DOUBLE ELSE sqrt({_sqdist('v', 'tv')}) END, 6) AS dist
FROM e, t""",
    "numeric_profile": _profile(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "numeric_drop_profile": _profile(["l_quantity", "l_extendedprice", "l_discount"]),
    "kmeans_seed_distances": f"""WITH {_kmeans_sql(C.KMEANS_K, 0)}
SELECT e.vec_id, round(min(round({_sqdist('e.v', 'c.center')}, 9)), 9) AS min_dist2 FROM e, c0 c GROUP BY e.vec_id""",
    "kmeans_assign": f"""WITH {_kmeans_sql(C.KMEANS_K, C.KMEANS_ITER)}
SELECT vec_id, CAST(cluster AS BIGINT) AS cluster FROM a{C.KMEANS_ITER}""",
    "kmeans_centroids": f"""WITH {_kmeans_sql(C.KMEANS_K, C.KMEANS_ITER)}
SELECT CAST(cluster AS BIGINT) AS cluster, CAST(pos - 1 AS BIGINT) AS dim, round(x, 6) AS value
FROM (SELECT cluster, unnest(center) AS x, unnest(range(1, len(center) + 1)) AS pos FROM c{C.KMEANS_ITER})""",
    "kmeans_sse": f"""WITH {_kmeans_sql(C.KMEANS_K, C.KMEANS_ITER)}
""" + " UNION ALL ".join(f"SELECT CAST(iteration AS BIGINT) AS iteration, round(sse, 6) AS sse FROM s{i}"
                         for i in range(1, C.KMEANS_ITER + 1)),
    "cluster_similar_docs": f"""WITH {_sparse_kmeans_sql(C.DOC_CLUSTERS, C.KMEANS_ITER)}
SELECT doc_id, CAST(cluster AS BIGINT) AS cluster FROM x{C.KMEANS_ITER}""",
    "search_stats": f"WITH {TV} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tv GROUP BY term",
    "search_jm_01": _search(_jm(_lam(0.1))),
    "search_jm_05": _search(_jm(_lam(0.5))),
    "search_tfidf_p1": _search(_tfidf(1.0)),
    "search_tfidf_p2": _search(_tfidf(2.0)),
    "search_hits_report": f"""WITH {_eval_jm(0.5)}
SELECT f.query_id, f.rank, f.doc_id, round(r.score, 6) AS score, d.lang, d.source,
       CASE WHEN f.is_rel = 1 THEN 'relevant' ELSE 'not relevant' END AS relevance
FROM flags f JOIN run r ON r.query_id = f.query_id AND r.doc_id = f.doc_id JOIN documents d ON d.doc_id = f.doc_id""",
    "topics_subset": f"""SELECT item_id AS query_id, text FROM benchmark
WHERE item_id BETWEEN {C.SUBSET[0]} AND {C.SUBSET[1]}""",
    "qrels_by_query": f"WITH {TV}, {QRELS} SELECT query_id, n_rel FROM nrel",
    "qrels_pool": f"""WITH {TV}, {QRELS}
SELECT doc_id, count(*) AS n FROM qrels WHERE query_id BETWEEN {C.TRAIN[0]} AND {C.TRAIN[1]} GROUP BY doc_id""",
    "run_relevance_flags": f"WITH {_eval_jm(0.5)} SELECT query_id, rank, doc_id, CAST(is_rel AS BIGINT) AS is_rel FROM flags",
    "run_cumulative_relevance": f"""WITH {_eval_jm(0.5)}
SELECT query_id, rank, doc_id, CAST(is_rel AS BIGINT) AS is_rel, CAST(cum_rel AS BIGINT) AS cum_rel FROM cum""",
    "eval_precision": f"WITH {_eval_jm(0.5)} SELECT query_id, round(p, 6) AS value FROM met",
    "eval_recall": f"WITH {_eval_jm(0.5)} SELECT query_id, round(r, 6) AS value FROM met",
    "eval_ap": f"WITH {_eval_jm(0.5)} SELECT query_id, round(ap, 6) AS value FROM met",
    "eval_means": f"""WITH {_eval_jm(0.5)}
SELECT 'P' AS metric, round(avg(p), 6) AS value FROM met
UNION ALL SELECT 'R', round(avg(r), 6) FROM met UNION ALL SELECT 'MAP', round(avg(ap), 6) FROM met""",
    "eval_metrics_with_mean": f"""WITH {_eval_jm(0.5)}
SELECT CAST(query_id AS VARCHAR) AS query_id, round(p, 6) AS p, round(r, 6) AS r, round(ap, 6) AS ap FROM met
UNION ALL SELECT 'Mean', round(avg(p), 6), round(avg(r), 6), round(avg(ap), 6) FROM met""",
    "lambda_sweep_means": f'WITH {_sweep(*C.TRAIN)} SELECT "lambda", round(mean, 6) AS mean FROM means',
    "lambda_best": f'WITH {_sweep(*C.TRAIN)} SELECT "lambda", round(mean, 6) AS mean FROM best',
    "lambda_sweep_means_p": f'WITH {_sweep(*C.TRAIN)} SELECT "lambda", round(mean, 6) AS mean FROM means_p',
    "lambda_sweep_means_r": f'WITH {_sweep(*C.TRAIN)} SELECT "lambda", round(mean, 6) AS mean FROM means_r',
    "lambda_matrix": f"""WITH {_sweep(*C.TRAIN)},
wide AS (SELECT CAST(query_id AS VARCHAR) AS query_id, {", ".join(
        f"max(CASE WHEN \"lambda\" = {_lam(x)} THEN ap END) AS l{int(round(x * 10)):02d}" for x in LAMBDA_GRID)}
         FROM sw GROUP BY query_id)
SELECT query_id, {", ".join(f"round(l{int(round(x * 10)):02d}, 6) AS l{int(round(x * 10)):02d}" for x in LAMBDA_GRID)} FROM wide
UNION ALL SELECT 'Mean', {", ".join(f"round(avg(l{int(round(x * 10)):02d}), 6)" for x in LAMBDA_GRID)} FROM wide""",
    "tune_train_test": f"""WITH {_sweep(*C.TRAIN)}
SELECT 1 AS _dummy""",  # replaced below
    "eval_tfidf_test": f"""WITH {_eval_tfidf()}
SELECT query_id, round(ap, 6) AS value FROM met WHERE query_id >= {C.TEST[0]}""",
    "paired_metric_diff": "",  # filled below
    "paired_t_test": "",
    "wilcoxon_test": "",
}


def _tune_train_test() -> str:
    train = _sweep(*C.TRAIN)
    # the tuned λ comes from the training means (`best`); the test topics are scored with it
    first, last = C.TEST
    return f"""WITH {train},
tq AS (SELECT query_id, term, count(*) AS qtf FROM (
         SELECT item_id AS query_id, unnest({_tok('text')}) AS term FROM benchmark
         WHERE item_id BETWEEN {first} AND {last}) GROUP BY query_id, term),
tts AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tv WHERE term IN (SELECT term FROM tq) GROUP BY term),
tm AS (SELECT tq.query_id, tv.doc_id, tq.qtf, tv.tf, dl.dl, tts.cf, tot.T
       FROM tq JOIN tv ON tq.term = tv.term JOIN tts ON tts.term = tq.term JOIN dl ON dl.doc_id = tv.doc_id, tot),
tsc AS (SELECT query_id, doc_id, round(sum({_jm('best."lambda"')}), 9) AS score FROM tm, best GROUP BY query_id, doc_id),
trun AS (SELECT * FROM (SELECT query_id, doc_id, score,
          row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM tsc)
         WHERE rank <= {C.CUT}),
tflags AS (SELECT r.query_id, r.rank, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS is_rel
           FROM trun r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id),
tcum AS (SELECT *, sum(is_rel) OVER (PARTITION BY query_id ORDER BY rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel FROM tflags),
tagg AS (SELECT query_id, sum(is_rel * cum_rel / rank) AS ap_num FROM tcum GROUP BY query_id)
SELECT n.query_id, best."lambda", round(coalesce(a.ap_num / n.n_rel, 0.0), 6) AS value
FROM nrel n CROSS JOIN best LEFT JOIN tagg a ON a.query_id = n.query_id
WHERE n.query_id BETWEEN {first} AND {last}"""


def _paired_base() -> str:
    """AP of JM λ=0.5 (x) and TF-IDF p=1 (y) per judged topic."""
    jm = _eval_jm(0.5)
    tf_run = _run(_tfidf(1.0)).replace("sc AS", "sc2 AS").replace("FROM sc)", "FROM sc2)").replace(
        "run AS", "run2 AS")
    tf_metrics = METRICS.replace("FROM run r", "FROM run2 r").replace("flags AS", "flags2 AS").replace(
        "FROM flags)", "FROM flags2)").replace("cum AS", "cum2 AS").replace("FROM cum GROUP", "FROM cum2 GROUP") \
        .replace("agg AS", "agg2 AS").replace("LEFT JOIN agg a", "LEFT JOIN agg2 a").replace("met AS", "met2 AS")
    return f"""{jm}, {tf_run.strip()}, {tf_metrics.strip()},
pd AS (SELECT a.query_id, a.ap AS x, b.ap AS y, round(a.ap - b.ap, 9) AS d FROM met a JOIN met2 b USING (query_id))"""


def _paired_t() -> str:
    return f"""WITH {_paired_base()},
s AS (SELECT count(*) AS n, avg(d) AS mean, stddev_samp(d) AS sd FROM pd),
t AS (SELECT n, mean, sd, CASE WHEN sd > 0 THEN mean / (sd / sqrt(n)) END AS t, n - 1 AS df FROM s)
SELECT CAST(n AS BIGINT) AS n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(t, 6) AS t,
       CAST(df AS BIGINT) AS df, round({_t_p('t', 'df')}, 6) AS p FROM t"""


def _wilcoxon() -> str:
    return f"""WITH RECURSIVE {_paired_base()},
nz AS (SELECT abs(d) AS a, d > 0 AS pos FROM pd WHERE d <> 0),
rk AS (SELECT a, pos, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS rk,
              row_number() OVER (ORDER BY a) AS i FROM nz),
ti AS (SELECT coalesce(sum(t * t * t - t), 0.0) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM nz GROUP BY a)),
w AS (SELECT count(*) AS n, coalesce(sum(CASE WHEN pos THEN rk ELSE 0 END), 0.0) AS w_plus,
             coalesce(sum(CASE WHEN pos THEN 0 ELSE rk END), 0.0) AS w_minus FROM rk),
z AS (SELECT n, w_plus, w_minus, least(w_plus, w_minus) AS w,
             CASE WHEN n > 0 THEN (least(w_plus, w_minus) - n * (n + 1) / 4.0)
                  / sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - ties / 48.0) END AS z FROM w, ti),
-- sign choices of the first i differences by their rank sum, for up to 50 differences
dist AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS s, CAST(1 AS DOUBLE) AS c
         UNION ALL
         SELECT i, s, sum(c) AS c FROM (
           SELECT dist.i + 1 AS i, dist.s + g * rk.rk AS s, dist.c
           FROM dist JOIN rk ON rk.i = dist.i + 1 CROSS JOIN (VALUES (0), (1)) AS sign(g), w WHERE w.n <= 50) GROUP BY i, s)
SELECT CAST(n AS BIGINT) AS n, round(w_plus, 6) AS w_plus, round(w_minus, 6) AS w_minus, round(w, 6) AS w,
       round(z, 6) AS z, round(CASE WHEN n = 0 THEN NULL
         WHEN n <= 50 THEN least(1.0, 2 * (SELECT sum(c) FROM dist WHERE dist.i = z.n AND dist.s <= z.w) / pow(2, n))
         ELSE 2 * ({_phi_neg('abs(z)')}) END, 6) AS p FROM z"""


ORACLE_SQL["tune_train_test"] = _tune_train_test()
ORACLE_SQL["paired_metric_diff"] = f"""WITH {_paired_base()}
SELECT query_id, round(x, 6) AS x, round(y, 6) AS y, round(d, 6) AS d FROM pd"""
ORACLE_SQL["paired_t_test"] = _paired_t()
ORACLE_SQL["kmeans_converged"] = _kmeans_until_sql(C.KMEANS_K, 40)
ORACLE_SQL["kmeanspp_seeds"] = _seeds_sql(C.KMEANS_K, C.KMEANS_SEED)
ORACLE_SQL["smart_separator_lines"] = r"""SELECT doc_id AS id, regexp_replace(replace(text, ', ', chr(10) || '.I '), '\n+$', '') AS body FROM documents"""
ORACLE_SQL["search_hits_text"] = f"""WITH {_eval_jm(0.5)}
SELECT f.query_id, f.rank, f.doc_id, d.text, f.is_rel = 1 AS relevant, round(m.p, 6) AS p, round(m.r, 6) AS r, round(m.ap, 6) AS ap
FROM flags f JOIN met m ON m.query_id = f.query_id JOIN documents d ON d.doc_id = f.doc_id"""
ORACLE_SQL["file_tree_documents"] = r"""SELECT doc_id, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS text,
       CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS n_bytes, 'isRegularFile' AS type, CAST(2 AS BIGINT) AS level FROM documents"""
ORACLE_SQL["search_jm_bounded"] = ORACLE_SQL["search_jm_05"]
ORACLE_SQL["similar_docs_report"] = f"""SELECT s.*, d.source, d.lang FROM ({ORACLE_SQL["similar_tf"]}) s JOIN documents d USING (doc_id)"""
ORACLE_SQL["wilcoxon_test"] = _wilcoxon()
ORACLE_SQL["wilcoxon_lineitem"] = """WITH x AS (SELECT round(l_extendedprice * (l_discount - l_tax), 9) AS d FROM lineitem),
rk AS (SELECT d > 0 AS pos, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS rk FROM x WHERE d <> 0)
SELECT CAST(count(*) AS BIGINT) AS n, round(coalesce(sum(CASE WHEN pos THEN rk END), 0.0), 6) AS w_plus,
       round(coalesce(sum(CASE WHEN NOT pos THEN rk END), 0.0), 6) AS w_minus FROM rk"""
ORACLE_SQL["numeric_csv_profile"] = ORACLE_SQL["numeric_profile"]
ORACLE_SQL["qrels_file"] = f"""WITH {TV}, {QRELS}
SELECT query_id, CAST(0 AS INTEGER) AS iter, doc_id, CAST(1 AS INTEGER) AS rel FROM qrels"""
# result files hold three decimals
ORACLE_SQL["compare_result_files"] = ORACLE_SQL["paired_t_test"].replace(
    "a.ap AS x, b.ap AS y, round(a.ap - b.ap, 9) AS d", "round(a.ap, 3) AS x, round(b.ap, 3) AS y, round(round(a.ap, 3) - round(b.ap, 3), 9) AS d")
