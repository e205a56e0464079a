"""Secret scans by a trigram inverted index, with DataFrame functions only.

Every rule is a regular expression. ``trigram_query`` derives from its parse the Boolean query of
trigrams that each match must hold. ``trigram_postings`` is the inverted index of a table: one row per
trigram that the rules' queries name and document whose lower-cased text holds it. ``candidates``
intersects the postings: a conjunction holds where a document has as many of its trigrams as it names.
Candidates are verified with the regular expression. A rule without mandatory trigrams (a run of hex
digits) scans every text.

A document is known in the index by the 64-bit hash of its text, so that copies share their postings; a
collision can only add a candidate that verification turns down.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import save_small
from lexiframe.llm.spans import find_all, none

# a query is True, ("and", trigrams, queries) or ("or", queries)
MOST = 32  # exact strings followed per part of a pattern before they are turned into trigrams


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # shortest accepted text ...
    group: int = 0  # ... of this group


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("stripe", r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("privatekey", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)


def _all(parts: list) -> object:
    grams, rest = set(), []
    for p in parts:
        if p is True:
            continue
        if p[0] == "and":
            grams |= p[1]
            rest += p[2]
        else:
            rest.append(p)
    return ("and", frozenset(grams), tuple(rest)) if grams or rest else True


def _strings(words: set[str]) -> object:
    """Query that holds wherever one of the strings does."""
    each = [_all([("and", frozenset(w[i : i + 3] for i in range(len(w) - 2)), ())] if len(w) > 2 else []) for w in words]
    if True in each:
        return True
    each = [e for e in set(each) if not any(o[1] < e[1] for o in each)]  # "a or (a and b)" is a
    return each[0] if len(each) == 1 else ("or", tuple(sorted(each, key=str)))


def _analyse(node) -> tuple[set[str] | None, object]:
    """(the few exact strings that a part can match, or None; the query that its matches fulfil)."""
    run, queries = {""}, []
    exact = True

    def flush() -> None:
        nonlocal run, exact
        queries.append(_strings(run))
        run, exact = {""}, False

    for op, av in node:
        some, query = None, True
        if op is sre.LITERAL:
            some = {chr(av).lower()}
        elif op is sre.IN:
            chars = [x for k, x in av if k is sre.LITERAL]
            for k, x in av:
                if k is sre.RANGE:
                    chars += range(x[0], min(x[1], x[0] + MOST) + 1)
            if all(k in (sre.LITERAL, sre.RANGE) for k, _ in av) and len({chr(c).lower() for c in chars}) <= 8:
                some = {chr(c).lower() for c in chars}
        elif op is sre.SUBPATTERN:
            some, query = _analyse(av[3])
        elif op is sre.BRANCH:
            subs = [_analyse(x) for x in av[1]]
            if all(s is not None for s, _ in subs):
                some = set().union(*(s for s, _ in subs))
            else:
                alts = [_strings(s) if s is not None else q for s, q in subs]
                query = True if True in alts else ("or", tuple(alts))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, sub = av
            inner, q = _analyse(sub)
            if low == 0 and high == 1 and inner is not None:
                some = inner | {""}
            elif low >= 1:
                query = _strings(inner) if inner is not None else q
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue
        if some is not None and len(run) * len(some) <= MOST:
            run = {a + b for a, b in product(run, some)}
        else:
            flush()
            if some is not None:
                run = some
            else:
                queries.append(query)
    if exact:
        return run, True
    flush()
    return None, _all(queries)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query, over lower case, that every text with a match fulfils."""
    exact, query = _analyse(parser.parse(pattern))
    return _strings(exact) if exact is not None else query


def trigrams_of(query: object) -> set[str]:
    if query is True:
        return set()
    if query[0] == "and":
        return set(query[1]).union(*(trigrams_of(q) for q in query[2]))
    return set().union(*(trigrams_of(q) for q in query[1]))


def _one_of(grams: list[str]) -> str:
    """A pattern for any of the sorted strings that tells first letters apart by halves."""
    if len(grams) == 1 or not all(grams):
        return "|".join(re.escape(g) for g in grams)
    heads = sorted({g[0] for g in grams})
    if len(heads) == 1:
        return re.escape(heads[0]) + "(?:" + _one_of([g[1:] for g in grams]) + ")"
    low = heads[: len(heads) // 2]
    left, right = [g for g in grams if g[0] in low], [g for g in grams if g[0] not in low]
    if len(heads) > 3:
        return "(?=[" + "".join(re.escape(h) for h in low) + "])(?:" + _one_of(left) + ")|" + _one_of(right)
    return _one_of(left) + "|" + _one_of(right)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def row_trigrams(text: Column, rules: tuple[Rule, ...] = BASE + EXTRA) -> Column:
    """The distinct trigrams of the rules' queries that the lower-cased text holds, in one scan."""
    vocabulary = sorted(set().union(*(trigrams_of(trigram_query(r.pattern)) for r in rules)))
    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?=(" + _one_of(vocabulary) + "))"), F.lit(1)))


def trigram_postings(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """(gram, doc): the documents, by the hash of their text, that hold each trigram of the rules'
    queries. Copies are put together before the shuffle; every part is sorted by trigram."""
    rows = docs.select(F.xxhash64(_text(text_col)).alias("doc"), row_trigrams(_text(text_col), rules).alias("grams"))
    return rows.select(F.explode("grams").alias("gram"), "doc").distinct().sortWithinPartitions("gram", "doc")


def _intersected(query: object) -> Column:
    """An aggregate over the postings of one document: whether they fulfil the query."""
    parts = [F.count_if(F.col("gram").isin(*sorted(query[1]))) == len(query[1])] if query[0] == "and" and query[1] else []
    parts += [_intersected(q) for q in (query[2] if query[0] == "and" else query[1])]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if query[0] == "and" else (out | p)
    return out


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """(doc, rules): the documents whose postings fulfil the query of at least one rule, with the
    places of those rules. Rules without a query are not listed: every text is their candidate."""
    fits = [F.when(_intersected(q), F.lit(i)) for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not True]
    if not fits:
        return postings.select("doc", F.array().cast("array<int>").alias("rules")).limit(0)
    return postings.groupBy("doc").agg(F.array_compact(F.array(*fits)).alias("rules")).where(F.size("rules") > 0)


def build_index(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """Writes the postings to the shared folder, intersects them once for all rules and writes the
    candidates: Spark then knows their size, and broadcasts them to the texts only below its threshold.
    Beyond it texts meet them by a shuffle, where adaptive execution splits the part of a hot text."""
    return save_small(candidates(save_small(trigram_postings(docs, text_col, rules), "trigrams"), rules), "candidates")


def _accepted(rule: Rule, text: Column) -> Column:
    got = find_all(text, rule.pattern)
    if not rule.least:
        return got
    long = (lambda s: F.length(s["text"]) >= rule.least) if not rule.group else (
        lambda s: F.length(F.regexp_extract(s["text"], rule.pattern, rule.group)) >= rule.least)
    return F.filter(got, long)


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE + EXTRA,
                 name: str = "secrets", index: DataFrame | None = None) -> DataFrame:
    """Adds array<struct<kind, start, end, text>> sorted by start, then in the order of ``rules``.

    Spans are in code points, end exclusive; matches of one rule do not overlap, those of
    different rules may. A null or empty text has none; repeated rows stay and get the same spans; an
    empty table gives an empty result. ``index`` holds the candidates of ``build_index`` over a table
    with these texts and the same rules; without one (a stream, a few rows) every rule scans every row,
    and rows are neither joined nor shuffled.
    """
    df, text = docs, _text(text_col)
    if index is not None:
        found = index.select(F.col("doc").alias("_lx_doc"), F.col("rules").alias("_lx_rules"))
        df = docs.join(found, F.xxhash64(text) == F.col("_lx_doc"), "left")
    per = {}
    for i, r in enumerate(rules):
        scans = index is None or trigram_query(r.pattern) is True
        wanted = F.rlike(text, F.lit(r.pattern)) if scans else F.array_contains("_lx_rules", i)
        per[f"_lx_s{i}"] = F.when(wanted, _accepted(r, text)).otherwise(none())
    df = df.withColumns(per).drop("_lx_doc", "_lx_rules")

    def ranked(i: int) -> Column:
        return F.transform(f"_lx_s{i}", lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("o"), s["end"].alias("end"), s["text"].alias("text")))

    kinds = F.array(*(F.lit(r.kind) for r in rules))
    out = F.transform(F.array_sort(F.concat(*(ranked(i) for i in range(len(rules))))), lambda s: F.struct(
        F.get(kinds, s["o"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))
    return df.withColumn(name, out).drop(*per)


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
           rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """Every row, with the matched spans replaced by [SECRET]; overlapping spans become one. Texts
    without secrets, null ones too, stay as they are; ``chars_col``, if it is a column, follows
    the changed texts. Candidates come from the index of ``docs``."""
    df = find_secrets(docs, text_col, rules, "_lx_found", build_index(docs, text_col, rules))
    text = F.col(text_col).cast("string")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(gap, F.lit("[SECRET]"))).alias("out")))

    clean = F.aggregate("_lx_found", zero, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    changed = F.size("_lx_found") > 0
    df = df.withColumn("_lx_text", F.when(changed, clean).otherwise(text))
    if chars_col in docs.columns:
        df = df.withColumn(chars_col, F.when(changed, F.length("_lx_text").cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)))
    return df.withColumn(text_col, F.col("_lx_text")).select(*docs.columns)


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*(r.kind for r in BASE)))


__all__ = ["BASE", "EXTRA", "Rule", "base_spans", "build_index", "candidates", "find_secrets", "redact", "row_trigrams", "trigram_postings", "trigram_query",
           "trigrams_of"]
