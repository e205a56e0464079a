"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five small transducers read the classes of a clause's words: *insult* and *threat* (word types
that they accept at once, with weights learned from labels for whole words and word beginnings on
top of a short seed list, and sequences of classes: `piece of garbage`, `I will end you`),
*target*, *negation* and *reported speech*. ``compose`` builds the product of all five as one
table over (state, class). A path through it is accepted where an insult or threat is read; its
label says whether the clause also holds a target, whether it stands under a negation (the next
words of the clause) and whether the clause is reported, before or behind. A document's score
comes from the weights of its accepted paths by label, not from isolated words: a logistic model,
fitted on the same bounded sample, weighs the labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import cut, on_workers
from lexiframe.llm.fit import logistic, sigmoid

# fixed values: closed classes and seeds, English, German, French and Spanish
TARGET = "you your yours yourself u ya du dich dir dein deine euch ihr tu te toi ton ta vous votre usted tú ti ustedes they them he she him her".split()
NEGATION = "not never no nobody don't doesn't isn't aren't nicht nie kein keine ne pas jamais aucun nunca jamás ningún".split()
REPORTED = "said says wrote writes called quoted claimed alleged reported according sagte schrieb nannte dit disait écrit dijo escribió llamó".split()
INSULT_SEEDS = "idiot moron stupid scum loser trash pathetic worthless disgusting clown dumb imbecile arschloch trottel idiota imbécile connard estúpido".split()
THREAT_SEEDS = "kill murder hurt destroy strangle stab shoot töten umbringen tuer matar".split()
SPEAKER = "i we ich wir nous yo nosotros".split()
INTENT = "will shall going".split()  # with a speaker before it
VOW = "i'll we'll gonna werde werden vais allons voy vamos".split()  # says the speaker too
HARM = "end finish bury crush ruin burn beat break hunt smash erledigen fertigmachen vernichten zerstören détruire écraser brûler destruir aplastar quemar acabar".split()
MEASURE = "piece waste sack pile stück tas pedazo montón".split()
FILTH = "garbage rubbish filth dirt crap space air dreck abfall merde ordure basura mierda".split()

OTHER, TARGETED, NEGATED, SAID, INSULT, THREAT, SPEAKS, INTENDS, VOWS, HARMS, MEASURES, FOUL = range(12)
N_CLASSES = 12
TOKENS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n\"“”„«»]")
ENDS = set(".!?;\n")
QUOTES = set("\"“”„«»")
ATTRIBUTION = 4  # words behind a quotation among which its speaker is named
GAP = 1  # other words between two steps of a sequence
REACH = 3  # words that a negation governs
SAMPLE_PER_CLASS = 2500  # labelled documents of each class that the model is fitted on
STEMS = range(3, 9)  # lengths of word beginnings that may become lexicon arcs


@dataclass(frozen=True)
class Transducer:
    """``step[state][class]`` is the next state; ``mark[state]`` what the state adds to a label."""
    step: tuple[tuple[int, ...], ...]
    mark: tuple[str, ...]


def _flag(on: int, mark: str) -> Transducer:
    return Transducer((tuple(int(c == on) for c in range(N_CLASSES)), (1,) * N_CLASSES), ("", mark))


def _reach(on: int, mark: str, n: int) -> Transducer:
    rows = [tuple(n if c == on else max(s - 1, 0) for c in range(N_CLASSES)) for s in range(n + 1)]
    return Transducer(tuple(rows), ("",) + (mark,) * n)


def _accept(mark: str, *sequences: tuple[int, ...], gap: int = GAP) -> Transducer:
    """Marks the state behind the last word of any of the sequences of classes, in which at most
    ``gap`` other words stand between two steps. A state is the set of sequences under way."""
    def read(state: tuple[frozenset, bool], c: int) -> tuple[frozenset, bool]:
        now, done = set(), False
        for q, at, left in [*state[0], *((q, 0, 0) for q in range(len(sequences)))]:
            if sequences[q][at] == c:
                if at + 1 == len(sequences[q]):
                    done = True
                else:
                    now.add((q, at + 1, gap))
            if at and left:
                now.add((q, at, left - 1))
        return frozenset(now), done

    states = [(frozenset(), False)]
    number, step = {states[0]: 0}, []
    for s in states:  # grows
        row = []
        for c in range(N_CLASSES):
            t = read(s, c)
            if t not in number:
                number[t] = len(states)
                states.append(t)
            row.append(number[t])
        step.append(tuple(row))
    return Transducer(tuple(step), tuple(mark if done else "" for _, done in states))


def compose(*parts: Transducer) -> Transducer:
    """The product transducer; marks are joined."""
    number, states, step = {(0,) * len(parts): 0}, [(0,) * len(parts)], []
    for s in states:  # grows; states that cannot be reached are left out
        row = []
        for c in range(N_CLASSES):
            t = tuple(p.step[x][c] for p, x in zip(parts, s, strict=True))
            if t not in number:
                number[t] = len(states)
                states.append(t)
            row.append(number[t])
        step.append(tuple(row))
    return Transducer(tuple(step), tuple("".join(p.mark[x] for p, x in zip(parts, s, strict=True)) for s in states))


INSULTS = _accept("i", (INSULT,), (MEASURES, FOUL))
THREATS = ((SPEAKS, INTENDS, HARMS, TARGETED), (VOWS, HARMS, TARGETED), (VOWS, TARGETED, HARMS), (TARGETED, VOWS, HARMS))
GRAMMAR = compose(INSULTS, _accept("h", (THREAT,), *THREATS), _flag(TARGETED, "t"), _reach(NEGATED, "n", REACH + 1), _flag(SAID, "r"))
FRAMES = _accept("h", *THREATS)
LABELS = [k + t + m for k in ("i", "h") for t in ("", "t") for m in ("", "n", "r", "nr")]
PLACE = {x: i for i, x in enumerate(LABELS)}


@dataclass
class Lexicon:
    """Weights of whole words and of word beginnings; classes of the closed lists."""
    words: dict[str, float]
    stems: dict[str, float]
    threats: frozenset[str] = frozenset()  # which of them are threats, besides the seeds
    cache: dict[str, tuple[int, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.closed = {w: c for c, ws in (
            (FOUL, FILTH), (MEASURES, MEASURE), (HARMS, HARM), (VOWS, VOW), (INTENDS, INTENT), (SPEAKS, SPEAKER),
            (TARGETED, TARGET), (NEGATED, NEGATION), (SAID, REPORTED)) for w in ws}
        self.threat = {*THREAT_SEEDS, *self.threats}

    def arc(self, w: str) -> tuple[str, float]:
        """The heaviest lexicon entry that accepts a lower-case word, and its weight (0 for none)."""
        best, weight = w, self.words.get(w, 0.0)
        for n in STEMS:
            if len(w) >= n and self.stems.get(w[:n], 0.0) > weight:
                best, weight = w[:n], self.stems[w[:n]]
        return best, weight

    def read(self, w: str) -> tuple[int, float]:
        """(class, weight) of a lower-case word."""
        got = self.cache.get(w)
        if got is None:
            arc, weight = self.arc(w)
            got = ((THREAT if w in self.threat or arc in self.threat else INSULT), weight) if weight > 0 else (self.closed.get(w, OTHER), 0.0)
            if len(self.cache) >= 100_000:  # memory only: a word's reading does not change
                self.cache.clear()
            self.cache[w] = got
        return got


def clauses(tokens: list[str], classes: list[tuple[int, float]]) -> Iterator[tuple[int, int]]:
    """The clauses that hold a word which can be part of an accepted path, as [start, end)."""
    upto = -1
    for i, (c, w) in enumerate(classes):
        if i < upto or not (w > 0 or c in (HARMS, FOUL)):
            continue
        a, upto = i, i
        while a and tokens[a - 1] not in ENDS:
            a -= 1
        while upto < len(tokens) and tokens[upto] not in ENDS:
            upto += 1
        yield a, upto


def attributed(tokens: list[str], classes: list[tuple[int, float]]) -> bytearray:
    """1 for the words of a quotation on one line whose sentence goes on behind it with a word of
    saying: `"You idiot! Get out!" he said`."""
    out = bytearray(len(tokens))
    if QUOTES.isdisjoint(tokens):
        return out
    opened = -1
    for i, t in enumerate(tokens):
        if t == "\n":
            opened = -1
        elif t in QUOTES and opened < 0:
            opened = i
        elif t in QUOTES:
            for j in range(i + 1, min(i + 1 + ATTRIBUTION, len(tokens))):
                if tokens[j] in ENDS or tokens[j] in QUOTES:
                    break
                if classes[j][0] == SAID:
                    out[opened:i] = b"\1" * (i - opened)
                    break
            opened = -1
    return out


def features(text: str | None, lex: Lexicon) -> np.ndarray:
    """Per label the summed weight of its accepted paths (log scale), and the heaviest clause. A
    sequence weighs as much as a seed."""
    out = np.zeros(len(LABELS) + 1)
    if not text:
        return out
    tokens = TOKENS.findall(text.lower())
    read = lex.read
    classes = [read(w) for w in tokens]
    step, mark = GRAMMAR.step, GRAMMAR.mark
    reported = attributed(tokens, classes)
    for a, b in clauses(tokens, classes):
        s, paths, total = 0, [], 0.0
        for i in range(a, b):
            if tokens[i] in QUOTES:
                continue
            c, w = classes[i]
            s = step[s][c]
            if mark[s] and mark[s][0] in "ih":
                paths.append((mark[s][0], "n" in mark[s], reported[i], w or 1.0))
        t = "t" if "t" in mark[s] else ""
        for kind, negated, said, w in paths:
            out[PLACE[kind + t + ("n" if negated else "") + ("r" if said or "r" in mark[s] else "")]] += w
            total += w
        out[-1] = max(out[-1], total)
    return np.log1p(out)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        return float(sigmoid(features(text, self.lexicon) @ self.weights[:-1] + self.weights[-1]))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column | None, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled documents of each class, by the hash of their id."""
    ids = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if train is not None:
        ids = ids.where(train)
    ids = ids.groupBy(F.col(id_col).alias("_lx_id")).agg(F.max(label_col).alias("_lx_y"))
    picked = [ids.where(F.col("_lx_y") == y).orderBy(F.xxhash64("_lx_id"), "_lx_id").limit(per_class) for y in (0, 1)]
    some = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_class ids
    rows = docs.join(some, F.col(id_col) == F.col("_lx_id")).select(
        F.col(text_col).cast("string").alias("text"), F.col("_lx_y").cast("int").alias("y"))
    # the smallest hash of a text's 3-word shingles is the same for most near copies, which would
    # lend their words false support
    rows = rows.withColumn("_w", F.split(F.coalesce("text", F.lit("")), r"\s+"))
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - 3, F.lit(0))),
                        lambda i: F.xxhash64(*(F.get("_w", i + j) for j in range(3))))
    return rows.withColumn("h", F.array_min(grams)).drop("_w").dropDuplicates(["h"])


def _evidence(n_tox: int, n_clean: int) -> tuple[Column, Column]:
    """(smoothed toxic share in a balanced sample, G² of ``tox`` toxic texts among ``tox + clean``)."""
    t, c = F.col("tox"), F.col("clean")
    a, b = (t + 0.2) / (n_tox + 1), (c + 0.2) / (n_clean + 1)
    p = n_tox / max(1, n_tox + n_clean)
    if not 0 < p < 1:
        return a / (a + b), F.lit(0.0)
    g = sum((F.when(x > 0, x * F.log(x / ((t + c) * q))).otherwise(0.0) for x, q in ((t, p), (c, 1 - p))), F.lit(0.0))
    return a / (a + b), 2 * g


def _arcs(rows: DataFrame, known: set[str], lengths: tuple[int, ...], share: float, evidence: float) -> dict[str, float]:
    """Weights of the word beginnings of the given lengths (0: whole words) that mark toxic texts,
    among the sample's texts without a known word. Texts are counted, not occurrences."""
    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, n = (Counter(), Counter()), [0, 0]
        for b in batches:
            for t, y in zip(b["text"], b["y"], strict=True):
                words = {w for w in TOKENS.findall((t or "").lower()) if len(w) > 1}  # no marks
                if not words & known:
                    count[y].update({w[: k or None] for w in words for k in lengths if len(w) >= k})
                    n[y] += 1
        keys = list(count[0].keys() | count[1].keys())
        yield pd.DataFrame({"f": [*keys, ""], "tox": [*(count[1][k] for k in keys), n[1]], "clean": [*(count[0][k] for k in keys), n[0]]})

    counts = rows.mapInPandas(parts, "f string, tox long, clean long").groupBy("f").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    counts = cut(counts)  # parts of the sample's words
    total = counts.where("f = ''").first()
    p, g = _evidence(total["tox"], total["clean"]) if total else _evidence(0, 0)
    passed = counts.where("f <> '' and tox >= 4 and tox > clean").select("f", p.alias("p"), g.alias("g")).where((F.col("p") >= share) & (F.col("g") >= evidence))
    return {r["f"]: math.log(r["p"] / (1 - r["p"])) for r in passed.orderBy("f").collect()}  # at least 4 texts of the sample hold each


def _threats(rows: DataFrame, lex: Lexicon) -> frozenset[str]:
    """The arcs that are threats: at least half of their texts among the sample's toxic ones, and
    four, hold them as the verb of a threat's sequence."""
    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, verb = Counter(), Counter()
        for b in batches:
            for t, y in zip(b["text"], b["y"], strict=True):
                if not y:
                    continue
                tokens = [w for w in TOKENS.findall((t or "").lower()) if w not in QUOTES]
                arcs = [lex.arc(w) for w in tokens]
                as_verb = [(HARMS if w > 0 else lex.closed.get(x, OTHER), w) for x, (_, w) in zip(tokens, arcs, strict=True)]
                seen.update({x for x, w in arcs if w > 0})
                found = set()
                for a, end in clauses(tokens, as_verb):
                    s = 0
                    for i in range(a, end):
                        s = FRAMES.step[s][as_verb[i][0]]
                        if FRAMES.mark[s]:  # the verb is the last one read, before or at the target
                            found.update(arcs[j][0] for j in range(i, max(a, i - GAP - 1) - 1, -1) if arcs[j][1] > 0)
                verb.update(found)
        if keys := sorted(seen):
            yield pd.DataFrame({"f": keys, "n": [seen[k] for k in keys], "verb": [verb[k] for k in keys]})

    got = rows.mapInPandas(parts, "f string, n long, verb long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("verb").alias("verb"))
    return frozenset(r["f"] for r in got.where("verb >= 4 and 2 * verb >= n").collect())  # arcs of the lexicon


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: Column | None = None, per_class: int = SAMPLE_PER_CLASS, share: float = 0.85, evidence: float = 30.0) -> Model:
    """Fits lexicon and weights on at most ``2 * per_class`` labelled texts (near copies count once).

    A whole word becomes an arc if its toxic share, smoothed and in a balanced sample, is at least
    ``share`` and the G² of its counts at least ``evidence``. Word beginnings are then held to the
    same on the texts that no such word explains. Without labels only the seeds are left.
    """
    on_workers(docs.sparkSession)
    rows = cut(_sample(docs, labels, id_col, text_col, label_col, train_rows, per_class))  # read four times
    words = _arcs(rows, set(), (0,), share, evidence)
    stems = _arcs(rows, {*words, *INSULT_SEEDS}, tuple(STEMS), share, evidence)
    stems = {x: v for x, v in stems.items() if not any(x[:k] in stems for k in STEMS if k < len(x))}
    lexicon = dict.fromkeys([*INSULT_SEEDS, *THREAT_SEEDS], 1.0) | words
    lex = Lexicon(lexicon, stems, _threats(rows, Lexicon(lexicon, stems)) - {*INSULT_SEEDS})

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([features(t, lex) for t in b["text"]]).reshape(len(b), -1)
            yield pd.DataFrame({"x": list(x), "y": b["y"], "h": b["h"]})

    sample = rows.mapInPandas(scored, "x array<double>, y int, h long").toPandas().sort_values("h")  # bounded as the sample is
    if not len(sample):
        w = np.full(len(LABELS) + 2, 1.0)
        w[-1] = -1.0
        return Model(lex, w)
    x, y = np.array(sample["x"].tolist()), sample["y"].to_numpy(float)
    # the sample's classes weigh as much as they do among all labels
    share = labels.where(F.col(label_col).isin(0, 1) & (F.lit(True) if train_rows is None else train_rows)).agg(F.avg(label_col)).first()[0]
    weight = np.where(y > 0, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    w = logistic(x, y, weight, ridge=1e-4)
    for label, j in PLACE.items():  # threats that the sample lacks weigh like insults
        if label[0] == "h" and not x[:, j].any():
            w[j] = w[PLACE["i" + label[1:]]]
    return Model(lex, w)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Adds the probability of a toxic text. Null and empty texts get that of a text without a
    matched clause. All columns stay; rows are neither dropped nor moved."""
    on_workers(docs.sparkSession)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:  # one Python string at a time
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn(name, run(F.col(text_col).cast("string")))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with their columns."""
    return score(docs, model, text_col, "_lx_score").where(F.col("_lx_score") < threshold).drop("_lx_score")
