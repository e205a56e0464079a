"""PII and secret spans against Python's re, trigram queries, and redaction."""

import random
import re

from pyspark.sql import functions as F

from lexiframe.llm import pii_weak as p, secret_scan as s
from lexiframe.llm.spans import listing

PARTS = ["mail a.b+c@ex-1.co.uk end", "x@y", "a@b.c_d@e.f", "@a.b c@d.e@f.g", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.255", "9.9.9",
         "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "2353820953013749 4550997810720808", "+1 (017) 555-7713 x", "+12", "+49 30.",
         "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "PassWord:short", "passwd=longenough1", "API_KEY = 'abcdefgh'",
         "apikey:12345678", "AKIAABCDEFGHIJKL12", "AKIA1", "deadbeef" * 4, "deadbeef" * 8 + "g", "secret secret=aaaaaaaaa", "日本 é😀 ", "\n", "ghp_" + "a1" * 18, "plain words"]


def texts(n=150):
    r = random.Random(4)
    return [" ".join(r.sample(PARTS, r.randrange(1, 7))) if r.random() < 0.7 else "".join(r.sample(PARTS, r.randrange(1, 5))) for _ in range(n)]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base_secrets(t):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def join(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_pii_matches_re(rows_of):
    ts = texts()
    df = p.find_pii(rows_of(list(enumerate(ts))), name="pii")
    got = {x["doc_id"]: x for x in df.select("doc_id", listing(F.filter("pii", lambda s: s["base"])).alias("b"), listing(F.col("pii")).alias("a")).collect()}
    for i, t in enumerate(ts):
        assert got[i]["b"] == join(base_pii(t)), t
        assert set(got[i]["b"].split(",")) <= set(got[i]["a"].split(","))


def test_classifier_adds_spans_and_keeps_numbers_out(rows_of):
    rows = [(i, f"Call my phone 212-555-{1000 + i} or write joe{i} [at] mail [dot] com. My ssn: 123-45-{6789 - i}.") for i in range(30)]
    rows += [(100 + i, f"release version 1.2.{i} of section {i}") for i in range(30)]
    df = p.find_pii(rows_of(rows), name="pii").select("doc_id", F.transform("pii", lambda s: s["kind"]).alias("k")).collect()
    got = {x["doc_id"]: set(x["k"]) for x in df}
    assert all(got[i] == {"phone", "email", "ssn"} for i in range(30)) and all(not got[100 + i] for i in range(30))


def test_em_prefers_the_reliable_labelers():
    def code(k, votes, bits=(0, 0, 0)):
        for v in votes:
            k = k * 3 + v + 1
        for b in bits:
            k = k * 2 + b
        return k
    m = p.fit({code(1, (1, 1, 1)): 500, code(1, (1, 1, 0)): 400, code(1, (-1, -1, 0)): 300, code(1, (-1, -1, -1)): 50, code(1, (1, -1, 0)): 3})
    assert m[code(1, (1, 1, 0))] > 0.9 > 0.1 > m[code(1, (-1, -1, 0))]
    assert p.fit({}) == {}


def test_base_secrets_match_re(rows_of):
    ts = texts()
    df = s.find_secrets(rows_of(list(enumerate(ts))), name="secrets")
    got = {x["doc_id"]: x["b"] for x in df.select("doc_id", listing(s.base_spans(F.col("secrets"))).alias("b")).collect()}
    for i, t in enumerate(ts):
        assert got[i] == join(base_secrets(t)), t


def test_trigram_queries_hold_for_every_match():
    def holds(q, low):
        if q is True:
            return True
        if q[0] == "and":
            return all(g in low for g in q[1]) and all(holds(x, low) for x in q[2])
        return any(holds(x, low) for x in q[1])
    for rule in s.BASE + s.EXTRA:
        q = s.trigram_query(rule.pattern)
        for t in [*texts(), "-----BEGIN RSA PRIVATE KEY-----", "sk_live_" + "a" * 20, "xoxb-1234567890", "eyJabcdefgh1.eyJabcdefgh1.abcdefgh1"]:
            if re.search(rule.pattern, t):
                assert holds(q, t.lower()), (rule.kind, t)
    assert s.trigram_query(s.BASE[2].pattern) is True  # no mandatory trigram: scanned fully
    assert s.trigram_query("abcd(?:ef|gh)*") == ("and", frozenset({"abc", "bcd"}), ())


def test_redaction(rows_of):
    df = rows_of([(1, 'x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" é AKIAABCDEFGHIJKL12'), (2, None), (3, "clean"), (4, "deadbeef" * 4)])
    out = s.redact(df)
    assert out.columns == df.columns
    got = {x["doc_id"]: (x["text"], x["n_chars"]) for x in out.collect()}
    assert got == {1: ('x [SECRET]" é [SECRET]', 22), 2: (None, 0), 3: ("clean", 5), 4: ("[SECRET]", 8)}


def test_odd_rows_and_empty_table(odd, empty):
    for f in (lambda d: p.find_pii(d, name="out"), lambda d: s.find_secrets(d, name="out")):
        got = f(odd).collect()
        assert len(got) == 9 and all(x["out"] == [] for x in got)
        assert f(odd).columns == [*odd.columns, "out"]
        assert f(empty).count() == 0
        plan = f(odd)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan
    assert s.redact(empty).count() == 0 and s.redact(odd).count() == 9


def test_long_runs_do_not_overflow(rows_of):
    df = rows_of([(1, "1 " * 60000), (2, "a." * 50000 + "@" + "b." * 50000 + "c"), (3, "f" * 100000), (4, "+1" + " 2" * 50000)])
    a = {x["doc_id"]: x["n"] for x in p.find_pii(df, name="o").select("doc_id", F.size("o").alias("n")).collect()}
    assert a == {1: 0, 2: 1, 3: 0, 4: 0}
    b = {x["doc_id"]: x["n"] for x in s.find_secrets(df, name="o").select("doc_id", F.size("o").alias("n")).collect()}
    assert b == {1: 0, 2: 0, 3: 1, 4: 0}


def test_index_gives_the_rows_of_full_scans(rows_of, odd, empty):
    more = ["-----BEGIN RSA PRIVATE KEY-----", "sk_live_" + "a" * 20, "xoxb-1234567890", "ghp_" + "A" * 36,
            "eyJabcdefgh1.eyJabcdefgh1.abcdefgh1", "secretly not one", "API-KEY", "toKen: abcdefgh1"]
    every = [*texts(), *more, *more]  # repeated texts share their postings
    df = rows_of(list(enumerate(every)))
    index = s.build_index(df)
    spans = {x["doc_id"]: x["o"] for x in s.find_secrets(df, name="o").collect()}
    got = s.find_secrets(df, name="o", index=index)
    assert got.columns == [*df.columns, "o"]
    rows = got.collect()
    assert len(rows) == len(every) and all(x["o"] == spans[x["doc_id"]] for x in rows)
    vocabulary = set().union(*(s.trigrams_of(s.trigram_query(r.pattern)) for r in s.BASE + s.EXTRA))
    posted = {(x["gram"], x["doc"]) for x in s.trigram_postings(df).collect()}
    hashes = dict(df.select("text", F.xxhash64("text")).collect())
    assert posted == {(g, hashes[t]) for t in every for g in vocabulary if g in t.lower()}
    fit = {x["doc"]: set(x["rules"]) for x in index.collect()}
    assert len(fit) < len(set(every)) and all(2 not in v for v in fit.values())  # a rule without trigrams is not indexed
    for d in (odd, empty):
        out = s.find_secrets(d, name="out", index=s.build_index(d))
        assert out.count() == d.count() and out.columns == [*d.columns, "out"]
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_rules_that_share_no_trigram(rows_of):
    rules = (s.Rule("digits", "[0-9]{4}"),)
    df = rows_of([(1, "a 1234"), (2, "b"), (3, None)])
    index = s.build_index(df, rules=rules)
    assert index.count() == 0
    assert {x["doc_id"]: len(x["o"]) for x in s.find_secrets(df, rules=rules, name="o", index=index).collect()} == {1: 1, 2: 0, 3: 0}
