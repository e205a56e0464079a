"""Language, toxicity, HTML and co-training on small data and on held-out rows."""

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiframe.llm import cotrain, htmlmain, langid, toxicity
from lexiframe.llm.common import held_out

SF = "/root/testdata/sf0.01"
EN = "the cat sat on the mat with a hat and then it went to the house of the king where the rain never stopped".split()
DE = "der hund ging in das haus und sprach mit dem könig über die straße während es nicht aufhörte zu regnen".split()
RU = "кот сидел на окне и смотрел как идёт дождь над старым городом".split()


def lang_docs(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(w, k=30)), lang) for lang, w, at in (("en", EN, 0), ("de", DE, 100), ("ru", RU, 200)) for i in range(at, at + 20)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def lang_model(spark):
    return langid.train(lang_docs(spark))


def test_language_spans_of_mixed_text(spark, lang_model, odd, empty):
    mixed = " ".join(EN) + ". " + " ".join(DE) + "! " + " ".join(RU)
    df = spark.createDataFrame([(1, mixed), (2, "123 ... 456"), (3, None), (4, "кот"), (5, "日本語")], "doc_id bigint, text string")
    got = {x["doc_id"]: x for x in langid.identify(df, lang_model).collect()}
    spans = [(mixed[s["start"] : s["end"]], s["lang"]) for s in got[1]["lang_spans"]]
    assert spans == [(" ".join(EN), "en"), (" ".join(DE), "de"), (" ".join(RU), "ru")]
    assert (got[2]["lang_pred"], got[3]["lang_pred"], got[4]["lang_pred"]) == ("und", "und", "ru")
    assert got[2]["lang_score"] == 0 and got[2]["lang_spans"] == [] and got[5]["lang_pred"] in ("en", "de", "ru")
    out = langid.identify(odd, lang_model)
    assert out.columns == [*odd.columns, "lang_pred", "lang_score", "lang_spans"] and out.count() == 9
    assert langid.identify(empty, lang_model).count() == 0
    none = langid.identify(odd, langid.train(empty)).collect()
    assert len(none) == 9 and {(r["lang_pred"], r["lang_score"]) for r in none} == {("und", 0.0)}


def test_viterbi_equals_plain_recursion(lang_model):
    r = random.Random(2)
    docs = [r.choices(EN + DE + RU, k=n) for n in (0, 1, 5, 40, 3)]
    for words, got in zip(docs, lang_model.label(docs)):
        if not words:
            continue
        s = lang_model.word_scores(words)
        best, back = s[0].copy(), []
        for row in s[1:]:
            move = best.max() - langid.SWITCH
            back.append([i if best[i] >= move else int(best.argmax()) for i in range(len(row))])
            best = np.maximum(best, move) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(b[path[-1]])
        total = lambda p: sum(s[i][x] for i, x in enumerate(p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
        assert total(list(got)) == pytest.approx(total(path[::-1]), abs=1e-3)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = held_out("doc_id", 4, 2)
    found = langid.identify(docs, langid.train(docs, rows=~out)).where(out & F.col("lang").isNotNull())
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97


def test_grammar_reads_clauses():
    lex = toxicity.Lexicon({"idiot": 2.0, "kill": 2.0}, {"schwach": 1.5})
    def labels(t):
        x = toxicity.features(t, lex)
        return {n for n, v in zip(toxicity.LABELS, x) if v > 0}
    assert labels("you are an idiot") == {"it"}
    assert labels("he was no idiot") == {"itn"}
    assert labels("a critic called it an idiot thing") == {"ir"}
    assert labels("I will kill you") == {"ht"}
    assert labels("never. idiot") == {"i"}  # a negation does not leave its clause
    assert labels("schwachkopf") == {"i"} and labels("nothing here") == set() and labels(None) == set()
    assert toxicity.features("idiot, idiot", lex)[-1] > toxicity.features("idiot. idiot", lex)[-1]


def test_composed_table_equals_running_the_parts():
    r = random.Random(3)
    a, b = toxicity._reach(toxicity.NEGATED, "n", 3), toxicity._flag(toxicity.SAID, "r")
    both = toxicity.compose(a, b)
    for _ in range(50):
        x = y = z = 0
        for c in r.choices(range(6), k=12):
            x, y, z = a.step[x][c], b.step[y][c], both.step[z][c]
            assert both.mark[z] == a.mark[x] + b.mark[y]


def test_toxicity_held_out(spark, odd, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = held_out("doc_id", 5, 0)
    model = toxicity.train(docs, labels, train_rows=~out)
    got = toxicity.score(docs.where(out).join(labels, "doc_id"), model).select("toxic", "score").toPandas()
    pred = got["score"] >= 0.5
    assert pred[got["toxic"] == 1].mean() > 0.8 and pred[got["toxic"] == 0].mean() < 0.02
    scored = toxicity.score(odd, model)
    assert scored.columns == [*odd.columns, "score"] and scored.where("score between 0 and 1").count() == 9
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == 9
    assert toxicity.drop_toxic(empty, model).count() == 0


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(odd, none)
    assert model.score("you idiot moron scum") > 0.5 > model.score("a fine day") and model.score(None) < 0.5


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/x>y'>Home page link</a></li></ul></nav><div class=\"ad banner\">Buy cheap things now</div>{main}"
        "<aside>More links here</aside><div id='comments'><p>First! great reader comment here</p></div><footer>&copy; site</footer></body></html>")


def page(main):
    return PAGE.replace("{main}", main)


def test_article_without_boilerplate():
    weights = {}
    body = "".join(f"<p>Paragraph {i} holds   several <b>plain</b> words &amp; more\ntext.</p>" for i in range(5))
    want = "\n".join(["Head line", *(f"Paragraph {i} holds several plain words & more text." for i in range(5))])
    assert htmlmain.main_text(page(f"<article><h1>Head line</h1>{body}</article>"), weights) == want
    inner = "<form><p>Sign up here</p></form><script>if (a<b) x()</script><!-- note --><div class='share'>Share this</div>"
    assert htmlmain.main_text(page(f"<article><h1>Head line</h1>{inner}{body}</article>"), weights) == want
    assert htmlmain.main_text(page(f"<div><h1>Head line</h1>{body}</div>"), weights) == want
    assert htmlmain.main_text(f"<article><h1>Head line</h1>{body[:-4]}", weights) == want  # cut off
    for t in (None, "", "<", "<p", "<<>>", "</p></p>", "<script>", "&amp;", "<!--"):
        assert isinstance(htmlmain.main_text(t, weights), str)
    assert htmlmain.main_text("just plain text", weights) == "just plain text"


def test_best_region_equals_all_regions():
    r = random.Random(1)
    for _ in range(200):
        x = [r.randrange(-5, 6) for _ in range(r.randrange(0, 12))]
        a, b = htmlmain.best_region(x)
        assert sum(x[a:b]) == max([0] + [sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)])


def test_pages_of_the_sample_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = htmlmain.extract(pages, htmlmain.train(pages)).collect()
    for x in out:
        inner = re.search(r"<article>(.*?)(</article>|$)", x["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"<(?!/?b>)[^>]*>", inner))
        assert x["main_text"] == "\n".join(b for b in blocks if b)
    none = spark.createDataFrame([(1, None, "x"), (None, "", "y")], "page_id bigint, html string, text string")
    got = htmlmain.extract(none, htmlmain.train(none), name="text2").collect()
    assert [r["text2"] for r in got] == ["", ""] and htmlmain.extract(none.limit(0), {}).count() == 0


def test_quality_held_out(spark, odd, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = held_out("doc_id", 5, 0)
    model = cotrain.train(docs, labels, train_rows=~out)
    got = cotrain.score(docs.where(out).join(labels, "doc_id"), model).select("quality", "score").toPandas()
    assert ((got["score"] >= 0.5) == (got["quality"] == 1)).mean() > 0.97
    scored = cotrain.score(odd, model)
    assert scored.columns == [*odd.columns, "score"] and scored.where("score between 0 and 1").count() == 9
    assert cotrain.score(empty, model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert cotrain.train(odd, none) is None and {x["score"] for x in cotrain.score(odd, None).collect()} == {0.5}


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    def view(y):
        return np.stack([y * 2 - 1 + rng.normal(0, 0.6, len(y)), rng.normal(size=len(y))], axis=1)
    y, pool_y = rng.integers(0, 2, 60).astype(float), rng.integers(0, 2, 2000).astype(float)
    xs, pool = [view(y), view(y)], [view(pool_y), view(pool_y)]
    model = cotrain.co_train(xs, y, pool, np.arange(60) % 4 == 0, 0.5)
    assert ((model.score(pool) >= 0.5) == (pool_y == 1)).mean() > 0.95
    one = cotrain.co_train([x[:5] for x in xs], np.ones(5), [p[:0] for p in pool], np.zeros(5, bool), 1.0)
    assert np.isfinite(one.score(pool)).all()


def test_classes_and_ids_that_only_look_like_boilerplate():
    body = "".join(f"<p>Paragraph {i} holds several plain words of text.</p>" for i in range(4))
    plain = [f"Paragraph {i} holds several plain words of text." for i in range(4)]
    for around in ('<article class="post has-sidebar">{}</article>', '<div class="content no-sidebar">{}</div>', '<div class="content no-sidebar"><article>{}</article></div>',
                   '<div class="sidebar"><main>{}</main></div>', '<div id="social"><article class="related">{}</article></div>',
                   '<section id="social-impact">{}</section>', '<div class="comments-on-the-method">{}</div>'):
        assert htmlmain.main_text(page(around.format(body)), {}).split("\n") == plain, around
    inner = f'{body}<h2 id="related-work" class="related">Other work</h2><section id="related">{body}</section><p class="notice">Last words of it.</p>'
    assert htmlmain.main_text(page(f"<article>{inner}</article>"), {}).split("\n") == [*plain, "Other work", *plain, "Last words of it."]
    teaser = "<div class='related-posts'><article><p>Read this teaser too</p></article></div>"
    assert htmlmain.main_text(page(f"<main><article>{body}</article>{teaser}</main>"), {}).split("\n") == plain
    formula = "<p>Energy is <math><mi>E</mi><mspace/><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> and <object>a drawing</object> here.</p>"
    assert htmlmain.main_text(page(f"<article>{body}{formula}</article>"), {}).split("\n") == [*plain, "Energy is E=m and a drawing here."]


def test_forms_and_ends_of_articles(spark):
    body = "".join(f"<p>Paragraph {i} holds several plain words of text.</p>" for i in range(4))
    plain = [f"Paragraph {i} holds several plain words of text." for i in range(4)]
    learned = htmlmain.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    ends = {"<pre>some code of it</pre>": ["some code of it"], "<blockquote>words of another</blockquote>": ["words of another"],
            "<dl><dt>Term</dt><dd>what the term means</dd></dl>": ["Term", "what the term means"], "<h5>Small head</h5>": ["Small head"],
            "<figure><img src=x><figcaption>What it shows</figcaption></figure>": ["What it shows"],
            "<details><summary>More</summary>of the same</details>": ["More", "of the same"],
            "<ul><li><a href=1>First link</a></li><li><a href=2>Second</a></li></ul>": ["First link", "Second"],
            "<table><tr><th>Name</th><td>1</td></tr></table>": ["Name", "1"]}
    for weights in ({}, learned):
        for around in ("<form><div><article>{}</article></div></form>", "<form><div>{}</div></form>", "<form method=post><main>{}</main></form>"):
            for end, lines in ends.items():
                if "article" in around or "main" in around or "<ul>" not in end and "<table>" not in end:
                    assert htmlmain.main_text(page(around.format(body + end)), weights).split("\n") == [*plain, *lines], (around, end)
            assert htmlmain.main_text(page(around.format("<nav>Go there</nav>" + body + "<form>Your name</form>")), weights).split("\n") == plain
        long = "".join(f"<p>Line {i} of a very long page.</p>" for i in range(20_000))
        assert htmlmain.main_text(page(f"<article>{long}</article>"), weights).count("\n") == 19_999


def test_numbers_that_are_no_letters(spark, lang_model):
    texts = ["½", "3² = 9", "① Ⅷ", "x² кот½", "½ кот ²"]
    got = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), lang_model).orderBy("doc_id").collect()
    assert [(r["lang_pred"], r["lang_score"], r["lang_spans"]) for r in got[:3]] == [("und", 0.0, [])] * 3
    assert got[3]["lang_pred"] == "ru"
    assert [(texts[4][s["start"] : s["end"]], s["lang"]) for s in got[4]["lang_spans"]] == [("кот", "ru")]
    assert all(langid.WORD.fullmatch(c) is not None for c in "aßжقक漢") and langid.WORD.findall("a¼b٣c_dⅧ") == ["a", "b", "c", "d"]


def test_threat_sequences_and_reports_behind(spark):
    lex = toxicity.Lexicon({"idiot": 2.0, "kill": 2.0, "zorfel": 2.0}, {}, frozenset({"zorfel"}))
    def labels(t):
        return {n for n, v in zip(toxicity.LABELS, toxicity.features(t, lex)) if v > 0}
    assert labels("I will end you") == labels("I'm sure we'll crush them") == labels("ich werde dich vernichten") == {"ht"}
    assert labels("I will never end you") == {"htn"} and labels("te voy a destruir") == {"ht"}
    assert labels("I will end the meeting soon") == labels("the end of you") == labels("a piece of cake") == set()
    assert labels("you piece of garbage") == {"it"} and labels("they zorfel") == {"ht"}
    assert labels('"you idiot", he said') == labels('"You idiot! Get out!" he said.') == {"itr"}
    assert labels('"You idiot!" It was late. He said so.') == {"it"} and labels("you idiot. He said no.") == {"it"}
    mean = [(i, f"i will zorfel you n{i} m{i} k{i}") for i in range(30)] + [(i, f"what a grumbit n{i} m{i} k{i} day") for i in range(30, 60)]
    kind = [(i, f"a fine day n{i} m{i} k{i} with you and will i what") for i in range(60, 160)]
    docs = spark.createDataFrame(mean + kind, "doc_id bigint, text string")
    model = toxicity.train(docs, docs.selectExpr("doc_id", "int(doc_id < 60) AS toxic"))
    assert model.score("what a grumbit") > model.score("i will crush you") > model.score("a day")
    assert model.lexicon.read("zorfel")[0] == toxicity.THREAT and model.lexicon.read("grumbit")[0] == toxicity.INSULT


def test_every_arc_with_evidence_is_learned(spark):
    # 21,000 words in 25 toxic texts come before the one in 20
    many = [(" ".join(f"x{chr(97 + i // 676 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 17576)}" for i in range(21_000)), 1, i) for i in range(25)]
    df = spark.createDataFrame(many + [("zzgrumbit", 1, 90 + i) for i in range(20)] + [("fine", 0, 200 + i) for i in range(45)], "text string, y int, h long")
    assert "zzgrumbit" in toxicity._arcs(df, set(), (0,), 0.85, 20.0)


def test_pool_where_every_document_has_a_label(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = docs.select("doc_id", (F.length("text") % 2).cast("int").alias("quality"))
    seen = {}

    def spy(xs, y, pool, aside, share):
        seen.update(labelled=len(y), pool=len(pool[0]))

    monkeypatch.setattr(cotrain, "co_train", spy)
    n = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().count()
    cotrain.train(docs, labels, labelled=40, pool=30)
    assert seen == {"labelled": 40, "pool": 30} and n > 70
    cotrain.train(docs.unionByName(docs.withColumn("text", F.lit("another text"))), labels, labelled=40, pool=30)
    assert seen == {"labelled": 40, "pool": 30}  # one row per sampled id
