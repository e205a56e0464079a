"""Personal data by weak supervision, with DataFrame functions only.

Candidates come from broad patterns. Three labelers vote on each, with 1, -1 or 0 (abstain): a
strict regular expression, a gazetteer (top-level domains, calling codes, issuer prefixes,
reserved networks) and the words before the span. Over all documents, votes and shape features are
counted per pattern of votes; that table has at most ``kinds * 3^3 * 2^3`` rows whatever the
corpus. Expectation-maximisation on it estimates, per kind, the prior and each labeler's
reliability. The expected labels train the final classifier, naive Bayes over votes and shape
features, again per pattern; candidates of a pattern with probability 0.5 or more are spans.
Spans of the four base patterns that pass their checks stay in any case.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.spans import find_all, none

# fixed values: gazetteers
TLDS = "com org net edu gov mil int io info biz co de fr es uk eu it nl be ch at pt us ca au jp cn in br ru pl se no dk fi ie cz gr mx ar example".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
RESERVED = r"^(?:0|127|22[4-9]|2[3-5][0-9])\."
IBAN_LANDS = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM".split()
CUES = {
    "email": r"(?i)e-?mail|contact|write|address|correo|courriel|kontakt",
    "ip": r"(?i)\bip\b|host|server|addr|client|login",
    "card": r"(?i)card|visa|master|credit|pay|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|mobil|fax|contact|whatsapp",
    "ssn": r"(?i)ssn|social|security",
    "iban": r"(?i)iban|bank|account|konto|compte|cuenta",
}
AGAINST = r"(?i)version|isbn|order|invoice|section|figure|build|release|ticket"


@dataclass(frozen=True)
class Kind:
    """A candidate pattern; ``gate`` is a cheap test that every text with a match passes."""
    kind: str
    pattern: str
    gate: str
    base: bool
    strict: str


# The base patterns are those of the contract. Repeats are possessive where what follows cannot
# match what they took; \G and the look-behind skip starts inside a run that already failed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True,
         r"^(?!.*\.\.)[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]*\.[A-Za-z]{2,24}$"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]+\.[0-9]", True,
         r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}", True,
         r"^(?:[0-9]{16,19}|[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4}){2}[0-9]{0,3})$"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True,
         r"^\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\))?(?:[\x20.-]?[0-9]{2,12}){1,6}$"),
    Kind("email", r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Z0-9-]{1,63}(?:\x20?[\[(]dot[\])]\x20?[A-Z0-9-]{1,63}){1,4}",
         r"(?i)[\[(]dot[\])]", False, r"(?i)[\[(]dot[\])]\x20?[A-Z]{2,24}$"),
    Kind("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])", r"[0-9]{3}[.-][0-9]{4}", False,
         r"^(?:\([2-9][0-9]{2}\)\x20|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}$"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", False,
         r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", False,
         r"^[A-Z]{2}[0-9]{2}(?:\x20?[0-9]{4}){3,7}(?:\x20?[0-9]{1,3})?$"),
)
BASE_KINDS = ("email", "ip", "card", "phone")
LABELERS = 3
FEATURES = 3


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda x, i: (
        F.when(i % 2 == 0, x.cast("int")).otherwise(x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(k: Kind, s: Column) -> Column:
    """The contract's checks of a base match."""
    if k.kind == "ip":
        parts = F.transform(F.split(s, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
        return F.forall(parts, lambda x: F.when(F.length(x) <= 3, x.cast("int") <= 255).otherwise(False))
    if k.kind == "card":
        return F.when(F.length(_digits(s)).between(16, 19), luhn(_digits(s))).otherwise(False)
    if k.kind == "phone":
        return F.length(_digits(s)).between(8, 15)
    return F.lit(True)


def _gazetteer(k: Kind, s: Column) -> Column:
    """1 or -1 by the kind's list; 0 where the kind has none."""
    if k.kind == "email":
        ok = F.lower(F.regexp_extract(s, "([A-Za-z]+)$", 1)).isin(*TLDS)
    elif k.kind == "phone" and k.base:
        d = _digits(s)
        ok = F.substring(d, 1, 1).isin(*CALLING) | F.substring(d, 1, 2).isin(*CALLING)
    elif k.kind == "card":
        ok = F.rlike(s, F.lit(ISSUERS))
    elif k.kind == "ip":
        ok = ~F.rlike(s, F.lit(RESERVED))
    elif k.kind == "iban":
        ok = F.substring(s, 1, 2).isin(*IBAN_LANDS)
    else:
        return F.lit(0)
    return F.when(ok, 1).otherwise(-1)


def _context(k: Kind, before: Column) -> Column:
    return F.when(F.rlike(before, F.lit(CUES[k.kind])), 1).when(F.rlike(before, F.lit(AGAINST)), -1).otherwise(0)


def candidates(text: Column) -> Column:
    """array<struct<k, base, start, end, code>>: k is the place in ``KINDS``, code the pattern of
    votes and features."""
    def of(i: int, k: Kind) -> Column:
        def one(s: Column) -> Column:
            got = s["text"]
            before = F.substring(text, F.greatest(s["start"] - 39, F.lit(1)).cast("int"), F.least(s["start"], F.lit(40)).cast("int"))
            votes = [F.when(F.rlike(got, F.lit(k.strict)), 1).otherwise(-1), _gazetteer(k, got), _context(k, before)]
            shape = [F.rlike(got, F.lit(r"[\x20().-]")), F.length(got) > 16, F.rlike(before, F.lit(r"(?:^|[\s\"'(<:,;=])$"))]
            code = F.lit(i)
            for v in votes:
                code = code * 3 + v + 1
            for b in shape:
                code = code * 2 + b.cast("int")
            base = _passes(k, got) if k.base else F.lit(False)
            return F.struct(F.lit(i).alias("k"), base.alias("base"), s["start"].alias("start"), s["end"].alias("end"), code.alias("code"))

        gate = F.contains(text, F.lit(k.gate)) if k.gate == "@" else F.rlike(text, F.lit(k.gate))
        return F.when(gate, F.transform(find_all(text, k.pattern), one)).otherwise(F.transform(none(), one))

    return F.concat(*(of(i, k) for i, k in enumerate(KINDS)))


def _decode(code: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    code, bits = divmod(code, 2**FEATURES)
    k, votes = divmod(code, 3**LABELERS)
    return k, tuple(votes // 3**j % 3 - 1 for j in reversed(range(LABELERS))), tuple(bits >> j & 1 for j in reversed(range(FEATURES)))


def fit(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Probability per pattern, from the number of candidates of each: expectation-maximisation for
    the labelers, then naive Bayes on its expected labels. Nothing is drawn at random."""
    out: dict[int, float] = {}
    per: dict[int, dict[int, int]] = defaultdict(dict)
    for code, n in counts.items():
        per[_decode(code)[0]][code] = n
    for of in per.values():
        prior, right = 0.7, [0.8] * LABELERS
        post: dict[int, float] = {}
        for _ in range(rounds):
            for code in of:
                odds = math.log(prior / (1 - prior))
                for v, r in zip(_decode(code)[1], right, strict=True):
                    odds += v * math.log(r / (1 - r))
                post[code] = 1 / (1 + math.exp(-odds))
            total = sum(of.values())
            prior = min(0.99, max(0.01, (sum(of[c] * post[c] for c in of) + 1.4) / (total + 2)))
            for j in range(LABELERS):
                cast = {c: _decode(c)[1][j] for c in of}
                good = sum(of[c] * (post[c] if cast[c] > 0 else 1 - post[c]) for c in of if cast[c])
                right[j] = min(0.98, max(0.55, (good + 8) / (sum(of[c] for c in of if cast[c]) + 10)))
        weight = {True: 1.0, False: 1.0}
        seen: dict = defaultdict(lambda: 0.5)
        for c in of:
            for y, p in ((True, post[c]), (False, 1 - post[c])):
                weight[y] += of[c] * p
                for j, x in enumerate(_decode(c)[1] + _decode(c)[2]):
                    seen[y, j, x] += of[c] * p
        for c in of:
            odds = math.log(weight[True] / weight[False])
            for j, x in enumerate(_decode(c)[1] + _decode(c)[2]):
                odds += math.log(seen[True, j, x] / (weight[True] + 1)) - math.log(seen[False, j, x] / (weight[False] + 1))
            out[c] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return out


def find_pii(docs: DataFrame, text_col: str = "text", name: str = "pii") -> DataFrame:
    """Adds array<struct<kind, base, start, end>>: base spans by kind as listed, then start, and the
    spans that the classifier adds, those of a listed kind behind its base ones.

    Positions are code points, end exclusive. An added span that overlaps a base span is left out.
    A null or empty text has none. Two passes over the table; nothing but the counts of vote
    patterns leaves the tasks, and rows are neither joined nor shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ready = docs.withColumn("_lx_c", candidates(text))
    counted = (ready.select(F.explode(F.transform("_lx_c", lambda c: c["code"])).alias("code"))
               .groupBy("code").count().collect())  # at most len(KINDS) * 27 * 8 rows
    model = fit({r["code"]: r["count"] for r in counted})
    good = F.array(*(F.lit(c) for c in sorted(c for c, p in model.items() if p >= 0.5))).cast("array<int>")
    kinds = F.array(*(F.lit(k.kind) for k in KINDS))
    own = F.filter("_lx_c", lambda c: c["base"])
    added = F.filter("_lx_c", lambda c: ~c["base"] & F.array_contains(good, c["code"])
                     & ~F.exists(F.filter("_lx_c", lambda b: b["base"]), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.filter(added, lambda c: ~F.get(F.array(*(F.lit(k.base) for k in KINDS)), c["k"]))  # failed base matches are not retried
    order = {k: i for i, k in enumerate(dict.fromkeys(k.kind for k in KINDS))}
    ranked = F.transform(F.concat(own, added), lambda c: F.struct(
        F.get(F.array(*(F.lit(order[k.kind]) for k in KINDS)), c["k"]).alias("o"), (~c["base"]).alias("new"),
        c["start"].alias("start"), c["end"].alias("end"), F.get(kinds, c["k"]).alias("kind")))
    out = F.transform(F.array_sort(ranked), lambda c: F.struct(c["kind"].alias("kind"), (~c["new"]).alias("base"),
                                                               c["start"].alias("start"), c["end"].alias("end")))
    return ready.withColumn(name, out).drop("_lx_c")
