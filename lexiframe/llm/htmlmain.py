"""Main text of HTML pages as a maximum-scoring subsequence.

A page is a sequence of tags and words. Every tag scores the weight of its name (with whether it
opens or closes), every word that of the element it stands in; one linear scan finds the
contiguous region with the highest total. Weights are log-odds of lying in the main content,
counted on labelled pages, with priors for elements that the sample lacks: words positive, tags
negative. Pages that mark their main content with one ``article`` or ``main`` element serve as
labelled ones. Inside the region, elements that are no article text (navigation, asides, forms,
adverts, notices, comments of readers) are left out. A class names such an element only as a
whole, and never a heading, a paragraph, the main element or what it stands in; an id only gives
its words a weight of their own, which is learned like any other. A form, or another element by
name, is none where it holds at least half of a page's words or of its main element.

A page's longest main element, or else its longest article, is where the scan starts from: nothing
in it that is no boilerplate costs anything, so that the region may go beyond its ends but not stop
within. Null and empty pages give the empty text, repeated rows the same text each, an empty table
an empty one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers

SAMPLE = 400  # labelled pages that the weights are counted on
# fixed values: elements of HTML
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select", "canvas", "annotation", "annotation-xml")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr acronym object".split())
MATHML = set("math mi mn mo ms mtext mrow msub msup msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mlabeledtr mstyle mspace mpadded "
             "mphantom menclose merror mfenced mmultiscripts mprescripts none semantics".split())
INLINE |= MATHML
BOILER = set("nav footer aside form menu button dialog fieldset head".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 br b strong i em blockquote pre article main dl dt dd figure figcaption details summary caption".split())
# elements whose words have a weight of their own
PLACES = set("a p li td th h1 h2 h3 h4 h5 h6 div body section blockquote pre dl dt dd figcaption details summary caption".split())
MAIN = ("article", "main")
NO_CLASS = set("p h1 h2 h3 h4 h5 h6 article main html body".split())  # what a class or id never marks
_NAMED = (r"(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:s|ed)?|promos?|promotions?|promoted|cookies?|consent|notices?|popup|modal|sidebar|menu|"
          r"nav|navbar|navigation|breadcrumbs?|footer|masthead|share|sharing|social|related|newsletter|subscribe|comments?|disqus|replies|responses)")
# a whole class or id: such words only, or with one that says what holds them
NAMED = re.compile(rf"(?i){_NAMED}(?:[_-]{_NAMED})*(?:[_-](?:area|articles|bar|box|buttons|icons|links|list|posts|widget))?")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
ATTR = re.compile(r"(?i)(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
END_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


def _boiler(name: str, attrs: str, inside: bool) -> str:
    """What an element starts: `always` or, by its class, `class` for no article text; `id` for what
    its id alone makes doubtful; else nothing. ``inside``: in the main element, where a header
    belongs to the article."""
    if name in BOILER or name == "header" and not inside:
        return "always"
    found = ""
    for key, a, b, c in ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), a or b or c
        if key == "role":
            if value.lower() in ROLES:
                return "always"
        elif name not in NO_CLASS and any(map(NAMED.fullmatch, value.split())):
            found = "class" if "class" in (key, found) else "id"
    return found


def tokens(page: str) -> list[tuple[str, str, str, bool, int, bool, bool]]:
    """(kind, feature, text, boilerplate, words, main, span): kind is `t` for a text run, `b` for a block
    boundary and `i` for other tags; ``main`` is any article or main element, ``span`` the one that the
    scan starts from. Raw elements, comments and declarations give no text."""
    out: list[tuple[str, str, str, int, int]] = []  # (kind, tag, text, element, words)
    # elements, after their parents: what stands for the page itself comes first
    names, parent, marks, mains, words = [""], [0], [""], [False], [0]
    stack: list[int] = []
    at, n = 0, len(page)

    def here() -> int:
        return stack[-1] if stack else 0

    def text(a: int, b: int) -> None:
        run = page[a:b]
        if run:
            run = entities.unescape(run)
            k = len(run.split())
            words[here()] += k
            out.append(("t", "", run, here(), k))

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in VOID or name in MATHML and not m[1] and m[3].endswith("/"):
            out.append(("i" if name in INLINE else "b", "<" + name, "", here(), 0))
            continue
        if m[1]:
            if any(names[e] == name for e in stack):
                while names[stack.pop()] != name:
                    pass
            out.append(("i" if name in INLINE else "b", "</" + name, "", here(), 0))
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            out.append(("i", "<" + name, "", here(), 0))
            continue
        if name in END_P:  # an open paragraph ends here, with the inline elements left open in it
            for j in range(len(stack) - 1, -1, -1):
                if names[stack[j]] == "p":
                    del stack[j:]
                    break
                if names[stack[j]] not in INLINE:
                    break
        if name == "li":
            for j in range(len(stack) - 1, -1, -1):
                if names[stack[j]] == "li":
                    del stack[j:]
                    break
                if names[stack[j]] in ("ul", "ol", "menu"):
                    break
        if name in MAIN:  # a main element is not part of boilerplate left open before it
            while stack and names[stack[-1]] not in ("html", "body", "div", "section", "main", "article"):
                stack.pop()
        up, e = here(), len(names)
        names.append(name)
        parent.append(up)
        mains.append(mains[up] or name in MAIN)
        marks.append(_boiler(name, m[3] or "", mains[e]))
        words.append(0)
        stack.append(e)
        out.append(("i" if name in INLINE else "b", "<" + name, "", e, 0))

    for e in range(len(names) - 1, 0, -1):
        words[parent[e]] += words[e]
    # the classes around a main element, and around the longest article, do not mark it
    held = [e for e, x in enumerate(names) if x == "main"]
    held += sorted((e for e, x in enumerate(names) if x == "article"), key=lambda e: -words[e])[:1]
    for e in held:
        most = 2 * words[e] >= words[0]
        while e:
            e = parent[e]
            marks[e] = "" if most or marks[e] in ("class", "id") else marks[e]
    for e, x in enumerate(names):  # a form around the page, as some servers write it
        if x == "form" and 2 * words[e] >= words[0]:
            marks[e] = ""
    longest = max(held, key=lambda e: (names[e] == "main", words[e]), default=0)
    boil, doubt, span = [False], [False], [False]
    for e in range(1, len(names)):
        boil.append(boil[parent[e]] or marks[e] in ("always", "class"))
        doubt.append(doubt[parent[e]] or marks[e] == "id")
        span.append(span[parent[e]] or e == longest)

    def feature(kind: str, tag: str, e: int) -> str:
        if kind == "t":
            return "w:" + ("boiler/" if boil[e] else "doubt/" if doubt[e] else "") + _place(names[e])
        return "<boiler:" + tag[1:] if boil[e] and not tag.startswith("</") and tag[1:] == names[e] else tag

    return [(kind, feature(kind, tag, e), run, boil[e], k, mains[e], span[e]) for kind, tag, run, e, k in out]


def _place(name: str) -> str:
    return "inline" if name in INLINE - {"a"} else name if name in PLACES else "other"


def prior(feature: str) -> tuple[float, float]:
    """Counts (in the main content, outside) that stand for no observation."""
    if "boiler" in feature:
        return 0.5, 10.0
    if "doubt/" in feature:
        return 1.0, 3.0
    if feature.startswith("w:"):
        return (1.0, 2.0) if feature in ("w:a", "w:body", "w:section", "w:other") else (3.0, 1.0)
    return (1.0, 1.0) if feature.lstrip("</") in PROSE | MATHML else (1.0, 2.0)


def weight(feature: str, seen: dict[str, tuple[int, int]], totals: tuple[int, int]) -> float:
    a, b = seen.get(feature, (0, 0))
    pa, pb = prior(feature)
    w = math.log((a + pa) / (b + pb))
    # words are many; tags keep their weight negative unless they stand in the content only
    return max(-6.0, min(6.0, w if feature.startswith("w:") else min(w, 1.0) - 0.2))


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights per feature from at most ``sample`` pages with exactly one article or main element,
    chosen by the hash of their id. Without such pages the priors remain."""
    on_workers(pages.sparkSession)
    own = F.lower(F.col(html_col).cast("string"))
    marks = sum((F.size(F.split(own, f"<{x}[\\s>]")) - 1 for x in MAIN[1:]), F.size(F.split(own, f"<{MAIN[0]}[\\s>]")) - 1)
    ids = pages.where(marks == 1).select(F.col(id_col).alias("_lx_id")).where("_lx_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("_lx_id"), "_lx_id").limit(sample)
    rows = pages.join(F.broadcast(ids), F.col(id_col) == F.col("_lx_id")).select(F.col(html_col).cast("string").alias("html"))  # sample ids

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inside, outside = Counter(), Counter()
        for b in batches:
            for h in b["html"]:
                for kind, feature, _t, _boil, n, main, _span in tokens(h or ""):
                    (inside if main else outside)[feature] += n if kind == "t" else 1
        if keys := sorted(inside.keys() | outside.keys()):
            yield pd.DataFrame({"f": keys, "a": [inside[k] for k in keys], "b": [outside[k] for k in keys]})

    got = rows.mapInPandas(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()  # one row per element name
    seen = {r["f"]: (r["a"], r["b"]) for r in got}
    totals = (sum(a for a, _ in seen.values()), sum(b for _, b in seen.values()))
    return {f: weight(f, seen, totals) for f in seen}


def best_region(scores: list[float]) -> tuple[int, int]:
    """The first contiguous region with the highest total, as [start, end); empty if none is above 0."""
    best, total, start, out = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, out = total, (start, i + 1)
    return out


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best region, one a line."""
    toks = tokens(page or "")
    scores = []
    was = False
    for kind, feature, _t, boil, n, main, span in toks:
        w = weights.get(feature)
        if w is None:
            w = weight(feature, {}, (0, 0))
        if main and "doubt/" in feature:  # an id takes no more than half from a word of the main element
            own = feature.replace("doubt/", "")
            w = max(w, weights.get(own, weight(own, {}, (0, 0))) / 2)
        if kind != "t" and main:  # an element amid the main one breaks nothing off
            w = max(w, -0.2)
        if span and not boil:
            w = max(w, 0.05 if kind == "t" else 0.0)
        if boil and (was or kind == "t"):  # left out in any case; only its first tag scores
            w = 0.0
        was = boil
        scores.append(w * n if kind == "t" else w)
    a, b = best_region(scores)
    while a > 0 and toks[a - 1][0] != "b":  # whole blocks
        a -= 1
    while b < len(toks) and toks[b][0] != "b":
        b += 1
    blocks, now = [], []
    for kind, _f, run, boil, _n, _main, _span in toks[a:b]:
        if kind == "b":
            blocks.append("".join(now))
            now = []
        elif kind == "t" and not boil:
            now.append(run)
    blocks.append("".join(now))
    return "\n".join(t for t in (" ".join(x.split()) for x in blocks) if t)


def extract(pages: DataFrame, weights: dict[str, float], html_col: str = "html", name: str = "main_text") -> DataFrame:
    """Adds the main text; the empty string for null and empty pages and pages without content.
    All columns and rows stay where they are."""
    on_workers(pages.sparkSession)

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, weights) for h in col], dtype="object")

    return pages.withColumn(name, run(F.col(html_col).cast("string")))
