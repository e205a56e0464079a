"""Language of words, spans and documents.

A word's score in a language is the log-likelihood of its character n-grams (1 to 4, with word
ends; hashed into buckets), normalised over the languages. Its script narrows the candidates: a
language that training never saw written in that script is out. Viterbi with a penalty for
switching then labels the word sequence, and runs of one label are the spans. A document's
language is that of the most letters.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3, 4)
SAMPLE_PER_LANG = 1500  # training documents per language, by the hash of their id
DEALT = 256  # hash buckets that the training ids of a language are dealt into
SWITCH = 10.0  # log-score that a change of language costs
FLOOR = -6.0  # least log-score of a word in a candidate language
CHUNK = 1500  # documents labelled together
RUN = re.compile(r"[^\W\d_]+")  # also takes numbers that are no decimal digits (superscripts, fractions, circled and Roman ones)
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
WORD = re.compile(rf"[^\W\d_{_NUMBERS}]+")  # letters only; slower
# fixed values: first code points of script blocks, in order; a letter's script is the block it falls in
SCRIPTS = np.array([0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0E00, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000,
                    0x3040, 0x3100, 0x3400, 0xAC00, 0xD800, 0xF900])


def words_of(t: str) -> list[str]:
    """The words of letters: those of ``WORD``."""
    words = RUN.findall(t)
    return words if all(map(str.isalpha, words)) else WORD.findall(t)


def script_of(words: list[str]) -> np.ndarray:
    return np.searchsorted(SCRIPTS, np.fromiter((ord(w[0]) for w in words), np.int64, len(words)), side="right") - 1


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every n-gram of every word."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = codes == 32
    word = np.cumsum(space) - 1
    at, bucket = [], []
    for n in NGRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        ok = ~space[:m] if n == 1 else np.ones(m, bool)
        for j in range(1, n - 1):
            ok &= ~space[j : j + m]
        if n == 2:
            ok &= ~(space[:m] & space[1 : 1 + m])
        i = np.flatnonzero(ok)
        h = np.full(len(i), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + codes[i + j]
        at.append(word[i])
        bucket.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64))
    return np.concatenate(at), np.concatenate(bucket)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages) log-probabilities
    scripts: np.ndarray  # (scripts, languages) whether training saw them together
    prior: int
    place: dict[str, int] = field(default_factory=dict)  # words seen by this worker, for speed only
    rows: list[np.ndarray] = field(default_factory=list)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"place": {}, "rows": []}

    def word_scores(self, words: list[str]) -> np.ndarray:
        at, bucket = grams(words)
        s = np.stack([np.bincount(at, self.table[bucket, j], len(words)) for j in range(len(self.langs))], axis=1) / 2
        allowed = self.scripts[script_of(words)]
        s = np.where(allowed, s, -np.inf)
        top = s.max(axis=1, keepdims=True)
        known = np.isfinite(top)
        s = np.where(known, s - np.where(known, top, 0), 0.0)  # a script of no language says nothing
        s = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        return np.where(allowed | ~known, np.maximum(s, FLOOR), 4 * FLOOR)

    def label(self, docs: list[list[str]]) -> list[np.ndarray]:
        """A language index for every word of every document."""
        if len(self.place) > 400_000:
            self.place.clear()
            self.rows.clear()
        place = self.place
        new = list({w for d in docs for w in d if w not in place})
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            place.update(zip(part, range(len(place), len(place) + len(part)), strict=True))
            self.rows.append(self.word_scores(part).astype(np.float32))
        if len(self.rows) > 1:
            self.rows[:] = [np.concatenate(self.rows)]
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        size = np.array([len(docs[i]) for i in order])
        off = np.concatenate([[0], np.cumsum(size)])
        total, n_lang = int(off[-1]), len(self.langs)
        if not total:
            return [np.zeros(0, np.int64) for _ in docs]
        ids = np.fromiter((place[w] for i in order for w in docs[i]), np.int64, total)
        score = self.rows[0][ids]
        stay = np.zeros((total, n_lang), bool)
        come = np.zeros(total, np.int16)
        live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")  # documents longer than t
        best = score[off[: live[0]]].astype(np.float64)
        last = np.zeros(len(docs), np.int64)
        ended = live[0]
        for t in range(1, int(size[0])):
            k = int(live[t])
            if k < ended:
                last[k:ended] = best[k:ended].argmax(axis=1)
                ended = k
                best = best[:k]
            at = off[:k] + t
            switch = best.max(axis=1) - SWITCH
            come[at] = best.argmax(axis=1)
            s = best >= switch[:, None]
            stay[at] = s
            best = np.where(s, best, switch[:, None]) + score[at]
        last[:ended] = best.argmax(axis=1)
        out = np.zeros(total, np.int64)
        now = last.copy()
        for t in range(int(size[0]) - 1, -1, -1):
            k = int(live[t])
            at = off[:k] + t
            out[at] = now[:k]
            if t:
                now[:k] = np.where(stay[at, now[:k]], now[:k], come[at])
        got: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
        for j, i in enumerate(order):
            got[i] = out[off[j] : off[j + 1]]
        return got


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: Column | None = None,
          per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learns from at most ``per_lang`` texts of each language, chosen by the hash of their id among
    the given rows with a text and a language: the smallest hashes of ``DEALT`` hash buckets, four
    times as many as an even share, and of these the smallest of all, so that no task ranks all ids of
    a language. What reaches the driver is bounded by ``BUCKETS`` counts a language. Without any such
    row the model knows no language, and every text is `und`."""
    on_workers(docs.sparkSession)
    ids = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    ids = ids if rows is None else ids.where(rows)
    ids = ids.select(F.col(id_col).alias("_lx_id"), F.col(lang_col).alias("_lx_lang")).withColumn("_lx_h", F.xxhash64("_lx_id"))
    ids = ids.withColumn("_lx_b", F.pmod(F.xxhash64("_lx_id", F.lit(1)), F.lit(DEALT)))
    for by, most in ((["_lx_lang", "_lx_b"], max(1, 4 * per_lang // DEALT)), (["_lx_lang"], per_lang)):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("_lx_h", "_lx_id"))
        ids = ids.withColumn("_lx_n", rank).where(F.col("_lx_n") <= most)
    ids = ids.select("_lx_id").distinct()
    some = docs.where(F.col(lang_col).isNotNull()).join(F.broadcast(ids), F.col(id_col) == F.col("_lx_id"))  # per_lang ids a language

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for t, lang in zip(b["text"], b["lang"], strict=True):
                c = total.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                if words := words_of((t or "").lower()):
                    c[:BUCKETS] += np.bincount(grams(words)[1], minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(script_of(words), minlength=len(SCRIPTS))
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": c[at]})

    got = (some.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
           .mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    if not len(got):
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool), 0)
    langs = sorted(got["lang"].unique())
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    counts[got["bucket"], got["lang"].map({x: i for i, x in enumerate(langs)})] = got["n"]
    table = np.log((counts[:BUCKETS] + 0.5) / (counts[:BUCKETS].sum(axis=0) + 0.5 * BUCKETS))
    script = counts[BUCKETS:]
    return Model(langs, table.astype(np.float32), script > 1e-4 * script.sum(axis=0), int(script.sum(axis=0).argmax()))


SPANS = "array<struct<start:bigint,end:bigint,lang:string>>"


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, lang_score and lang_spans (code points, end exclusive).

    ``lang_score`` is the share of the letters in spans of the predicted language; ties go to the
    first language in order. A text that is null or has no letter gets `und`, 0 and no span. Rows
    keep their other columns and are not moved; repeated rows get the same each, and an empty table
    gives an empty one.
    """
    on_workers(docs.sparkSession)

    @F.pandas_udf(f"struct<lang:string,score:double,spans:{SPANS}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [_identify(list(texts.iloc[at : at + CHUNK]), model) for at in range(0, len(texts), CHUNK)]
            rows = [r for p in parts for r in p]
            yield pd.DataFrame({"lang": pd.Series([r[0] for r in rows], dtype="object"), "score": pd.Series([r[1] for r in rows], dtype="float64"),
                                "spans": pd.Series([r[2] for r in rows], dtype="object")})

    out = docs.withColumn("_lx_lang", run(F.col(text_col).cast("string")))
    return out.select(*docs.columns, F.col("_lx_lang.lang").alias("lang_pred"), F.col("_lx_lang.score").alias("lang_score"),
                      F.col("_lx_lang.spans").alias("lang_spans"))


def _identify(texts: list, model: Model) -> list[tuple]:
    if not model.langs:
        return [("und", 0.0, [])] * len(texts)
    docs = [words_of(t.lower()) if t else [] for t in texts]
    out = []
    for t, words, labels in zip(texts, docs, model.label(docs), strict=True):
        if not len(words):
            out.append(("und", 0.0, []))
            continue
        length = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.bincount(labels, length, len(model.langs))
        lang = int(letters.argmax())
        cuts = np.flatnonzero(np.diff(labels)) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(words)]]) - 1
        if len(words) and len(t) == len(t.lower()):
            word = RUN if len(cuts) and all(map(str.isalpha, RUN.findall(t))) else WORD
            at = [m.span() for m in word.finditer(t.lower())] if len(cuts) else None
            ends = [(at[a][0], at[b][1]) for a, b in zip(first, last, strict=True)] if at else [_outer(t)]
        else:  # lower-casing changed the length: positions from the text itself
            at = [m.span() for m in WORD.finditer(t)]
            ends = [(at[min(a, len(at) - 1)][0], at[min(b, len(at) - 1)][1]) for a, b in zip(first, last, strict=True)]
        spans = [{"start": a, "end": b, "lang": model.langs[labels[i]]} for (a, b), i in zip(ends, first, strict=True)]
        out.append((model.langs[lang], float(letters[lang] / letters.sum()), spans))
    return out


def _outer(t: str) -> tuple[int, int]:
    a = WORD.search(t).start()
    b = len(t)
    while b > a and not t[b - 1].isalpha():
        b -= 1
    return a, b
