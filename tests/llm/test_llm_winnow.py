"""Decontamination against a plain search for every window."""

import random
import re

from lexiframe.llm import winnow as w


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items):
    out = []
    for i, t in docs:
        ws, hit, found = words(t), set(), set()
        for item, x in items:
            xs = words(x)
            m = min(10, len(xs))
            if not m:
                continue
            wins = {tuple(xs[a : a + m]) for a in range(len(xs) - m + 1)}
            for a in range(len(ws) - m + 1):
                if tuple(ws[a : a + m]) in wins:
                    hit |= set(range(a, a + m))
                    found.add(item)
        out.append((i, len(ws), len(hit), sorted(str(f) for f in found if f is not None), bool(hit)))
    return sorted(out, key=str)


def check(spark, docs_df, pairs, items):
    it = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(x["doc_id"], x["n_words"], x["n_hit"], x["items"], x["contaminated"]) for x in w.contamination(docs_df, it).collect()]
    assert sorted(got, key=str) == plain(pairs, items)


def test_matches_brute_force(spark, rows_of):
    r = random.Random(2)
    voc = [f"v{i}" for i in range(300)] + ["É1", "é1", "x-y"]
    item = [" ".join(r.choices(voc, k=n)) for n in (9, 10, 11, 14, 40, 3, 1, 25)] + ["a a a a a a a a a a a a", None, "...", "A a"]
    items = [(90 + i, t) for i, t in enumerate(item)] + [(90, item[4]), (None, item[3])]
    docs = []
    for i in range(40):
        t = r.choices(voc, k=r.randrange(0, 60))
        src = (r.choice(item[:9]) or "").split()
        a = r.randrange(len(src))
        t[len(t) // 2 : len(t) // 2] = src[a : a + r.randrange(1, 30)]
        docs.append((i, " ".join(t).replace("v1", "V1")))
    docs += [(50, "a " * 40), (51, "a"), (52, None), (53, ""), (50, "a " * 40), (None, " ".join(item[4].split()))]
    check(spark, rows_of(docs), docs, items)


def test_odd_rows_and_empty_sides(spark, odd, empty):
    some = spark.createDataFrame([(1, "word " * 12), (2, "a b c")], "item_id bigint, text string")
    got = {(x["doc_id"], x["n_hit"]) for x in w.contamination(odd, some).collect()}
    assert {(7, 30000), (5, 3), (1, 0), (2, 0), (None, 0)} <= got
    kept = w.drop_contaminated(odd, some)
    assert kept.columns == odd.columns and sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 2, 3, 4, 8]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {x["contaminated"] for x in w.contamination(odd, none).collect()} == {False}
    assert w.contamination(empty, some).count() == 0
    assert w.drop_contaminated(empty, some).count() == 0


def test_no_python_on_the_main_path(spark, odd):
    some = spark.createDataFrame([(1, "word " * 12)], "item_id bigint, text string")
    plan = w.contamination(odd, some)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
