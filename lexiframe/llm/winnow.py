"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``span`` consecutive words. Every window keeps the smallest hash of its k-grams
(``span - k + 1`` of them); neighbouring windows mostly keep the same one, so that a text's
distinct fingerprints number about 2 in ``span - k + 2`` words. A shared span of ``span`` words
has the same k-grams on both sides and hence the same fingerprint: none is missed. Fingerprints
of texts and benchmark items are joined; in documents with hits, every window that keeps a hit
fingerprint is compared word by word with the benchmark's windows, which extends hits to whole
shared spans and drops hash accidents.

Items of 1 to ``span - 1`` words are one window each. Winnowing gives them no guarantee, so
documents also get plain hashes of all their grams of those lengths, and only of those.

Rows are told apart by (id, hash of the text). Texts move only if the hit table is too large to
broadcast by its written size, and then once.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import save_small

SPAN = 10
K = 5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z became lower case


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; none for null."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(low, NOT_WORD), ""), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")), F.lit(0))


def _grams(ws: str, m: int, salt: int) -> Column:
    """Hash of the m words from every start (none in shorter texts). Words are taken one by one:
    ``slice`` would copy the whole array for every start."""
    n = F.size(ws)
    return F.when(n >= m, F.transform(F.sequence(F.lit(0), n - m), lambda i: F.xxhash64(F.lit(salt), *(F.get(ws, i + j) for j in range(m))))
                  ).otherwise(F.array().cast("array<bigint>"))


def with_windows(df: DataFrame, span: int, k: int, short: list[int]) -> DataFrame:
    """Adds ``_f<m>`` for m = span and every length in ``short``: the fingerprints of all windows of
    m words, by their start. Needs ``_w``, the words."""
    per = span - k + 1
    df = df.withColumn("_k", _grams("_w", k, 0))
    mins = F.when(F.size("_k") >= per, F.transform(F.sequence(F.lit(0), F.size("_k") - per),
                                                  lambda j: _least([F.get("_k", j + x) for x in range(per)]))
                  ).otherwise(F.array().cast("array<bigint>"))
    return df.withColumns({f"_f{span}": mins} | {f"_f{m}": _grams("_w", m, m) for m in short}).drop("_k")


def _least(cols: list[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def _windows(df: DataFrame, pick: Column | None, lengths: list[int], *keep: str) -> DataFrame:
    """One row per window (all, or those whose fingerprint is in the array ``pick``): s, m, h and
    its words g."""
    def of(m: int) -> Column:
        at = F.transform(f"_f{m}", lambda h, i: F.struct(i.alias("s"), h.alias("h")))
        at = at if pick is None else F.filter(at, lambda x: F.array_contains(pick, x["h"]))
        return F.transform(at, lambda x: F.struct((x["s"] + 1).alias("s"), F.lit(m).alias("m"), x["h"].alias("h"),
                                                  F.concat_ws(" ", *(F.get("_w", x["s"] + j) for j in range(m))).alias("g")))

    flat = df.select(*keep, F.concat(*(of(m) for m in lengths)).alias("_o"))
    # explode_outer: for explode, Catalyst infers size(...) > 0 and pushes the whole expression below the projects
    flat = flat.select(*keep, F.explode_outer("_o").alias("_o"))
    return flat.select(*keep, "_o.s", "_o.m", "_o.h", "_o.g").where("s is not null")


def contaminated_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", span: int = SPAN,
                       k: int = K) -> tuple[DataFrame, DataFrame]:
    """(id, t, s, m, w): every occurrence of a benchmark window ``w`` of m words from word s of the
    row with that id and text hash; and (w, item): the items that hold it."""
    if not 0 < k <= span:
        raise ValueError("k-grams must fit the span")
    it = items.select(F.col(item_id_col).alias("item"), words(F.col(item_text_col).cast("string")).alias("_w")).where(F.size("_w") > 0)
    short = sorted(r[0] for r in it.where(F.size("_w") < span).select(F.size("_w")).distinct().collect())  # at most span - 1 rows
    it = with_windows(it, span, k, short)
    lengths = [span, *short]
    own = _windows(it.withColumn("_n", F.size("_w")), None, lengths, "item", "_n").where(F.col("m") == F.least("_n", F.lit(span)))
    held = save_small(own.select("item", "m", "h", "g", F.sha2(F.concat_ws(":", "m", "g"), 256).alias("w")).distinct(), "bench-windows")
    prints = save_small(held.select("h").distinct(), "bench-prints")

    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))
    text = text.withColumn("t", F.xxhash64("_text"))
    ready = with_windows(text.withColumn("_w", words(F.col("_text"))).drop("_text"), span, k, short)
    every = F.array_distinct(F.concat(*(F.col(f"_f{m}") for m in lengths)))
    hits = (ready.select("id", "t", F.explode_outer(every).alias("h")).join(prints, "h")
            .groupBy("id", "t").agg(F.collect_set("h").alias("hs")))
    hits = save_small(hits, "winnow-hits")

    found = text.join(hits.withColumnsRenamed({"id": "_i", "t": "_t"}), F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_t")))
    found = with_windows(found.withColumn("_w", words(F.col("_text"))).drop("_text"), span, k, short)
    found = _windows(found, F.col("hs"), lengths, "id", "t")
    exact = held.select("m", "g", "w").distinct()
    return found.join(exact, ["m", "g"]).select("id", "t", "s", "m", "w"), held.select("w", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, k: int = K) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items (array of strings, sorted), contaminated.

    Rows that repeat an id and a text get a row each; a null or wordless text has zeros; a null
    id is kept. Wordless items match nothing; items of a null id make words hit but are not
    listed. With an empty benchmark nothing is hit; an empty table gives an empty result.
    """
    found, held = contaminated_spans(docs, items, id_col, text_col, item_id_col, item_text_col, span, k)
    found = found.distinct()
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(F.array_sort("at"), zero, lambda a, x: F.struct(
        F.greatest(a["upto"], x["s"] + x["m"]).alias("upto"),
        (a["n"] + F.greatest(F.lit(0), x["s"] + x["m"] - F.greatest(a["upto"], x["s"]))).alias("n")), lambda a: a["n"])
    hit = found.groupBy("id", "t").agg(F.collect_set(F.struct("s", "m")).alias("at")).select("id", "t", covered.alias("n_hit"))
    listed = (found.select("id", "t", "w").distinct().join(held.where("item is not null"), "w")
              .groupBy("id", "t").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    out = hit.withColumnsRenamed({"id": "_i", "t": "_t"})
    lst = listed.withColumnsRenamed({"id": "_i2", "t": "_t2"})
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("t"),
                       n_words(F.col(text_col).cast("string")).cast("bigint").alias("n_words"))
    both = out.join(lst, F.col("_i").eqNullSafe(F.col("_i2")) & (F.col("_t") == F.col("_t2")), "left")
    rows = rows.join(both, F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_t")), "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                       F.size(items_).cast("bigint").alias("n_items"), items_.alias("items"),
                       (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns."""
    found, _ = contaminated_spans(docs, items, id_col, text_col)
    gone = found.select(F.col("id").alias("_lx_i"), F.col("t").alias("_lx_t")).distinct()
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("_lx_i")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_lx_t")), "left_anti")
