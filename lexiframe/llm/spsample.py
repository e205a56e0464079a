"""SentencePiece encoding by sampling without replacement, and decoding.

A text's lattice has an edge for every piece that stands somewhere in it. Pieces never hold white
space behind other characters, so the lattice is a chain of independent unit lattices (a run of
spaces with the word behind it, or a run of line feeds). A forward pass gives every node the
probability of each edge that ends there; walking back from a unit's end, one edge after the other,
draws a segmentation with its exact probability.

Gumbel top-k: if every segmentation's log-probability gets an independent Gumbel noise, the k
highest are a sample without replacement. The search is best-first over sets of segmentations. The
set of all has a Gumbel(0) maximum; its argument is an ordinary draw x. What is left falls into one
set per edge i of x: those that agree with x before edge i and differ there. A set's mass is known
from the edge probabilities, and its maximum is a Gumbel of that location, truncated at the parent
set's maximum. The set with the highest maximum is opened next: its argument is drawn, and the rest
of it is divided in the same way. No set is opened that does not yield a sample. The (k+1)-th
maximum is the threshold of the inclusion probabilities 1 - exp(-exp(log p - threshold)).

Every random number is a hash of the row's key and a counter: results do not depend on
partitioning, batches or repeats of a task.

The installed public model is a BPE one, whose scores are merge ranks; its pieces get the
log-weight -log(2 + rank) (Zipf's law). Scores of a unigram model are used as they are. A
character that the vocabulary lacks, and a literal U+2581, becomes its UTF-8 byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import on_workers

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNITS = re.compile(r" +[^ \n]*|[^ \n]+|\n+")
CHUNK_CHARS = 300_000  # characters whose lattices are walked together
CACHE_EDGES = 1_500_000  # lattice edges that a worker keeps (32 bytes each), for speed only
SEEN_BITS = 20  # log2 of the marks that tell units seen before
NEAR_ONE = 0.999  # above this the mass beside an edge is summed, not taken from 1
BYTE_WEIGHT = -10.5  # log-weight of a byte piece
GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, stream: int, a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    """Numbers in (0, 1) from a key, a stream number and two counters."""
    with np.errstate(over="ignore"):
        x = key + GOLD * (np.uint64(stream) + (np.asarray(a).astype(np.uint64) << np.uint64(8)) + (np.asarray(b).astype(np.uint64) << np.uint64(44)) + np.uint64(1))
        x = _mix(_mix(x) + GOLD)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Vocabulary:
    """Pieces of a SentencePiece model, with a dense trie over the characters of longer pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        score = np.array([sp.get_score(i) for i in range(n)])
        ranks = bool((score[plain] == np.round(score[plain])).all())
        self.weight = (-np.log(2.0 - np.minimum(score, 0)) if ranks else score).astype(np.float64)
        self.weight[list(self.byte.values())] = BYTE_WEIGHT
        self.single = {self.pieces[i].replace("▁", " "): i for i in plain if len(self.pieces[i]) == 1}
        longer = {self.pieces[i].replace("▁", " "): i for i in plain if len(self.pieces[i]) > 1}
        letters = sorted({c for p in longer for c in p})
        self.column = {c: j for j, c in enumerate(letters)}
        kids: list[dict[int, int]] = [{}]
        ends = [-1]
        for p, i in longer.items():
            s = 0
            for c in p:
                j = self.column[c]
                if j not in kids[s]:
                    kids[s][j] = len(kids)
                    kids.append({})
                    ends.append(-1)
                s = kids[s][j]
            ends[s] = i
        self.width = len(letters) + 1
        self.trie = np.zeros((len(kids), self.width), np.uint16 if len(kids) < 2**16 else np.uint32)  # 0: no such piece
        for s, k in enumerate(kids):
            for j, t in k.items():
                self.trie[s, j] = t
        self.trie = self.trie.ravel()
        self.ends = np.array(ends, np.int32)
        self.code_of = np.full(0x110000, -1, np.int32)  # code point: its number in the two lists below
        self.col: list[int] = []
        self.lone: list[int] = []  # its single piece, or -2 - (its number) for byte pieces
        self.texts = [p.replace("▁", " ").encode() for p in self.pieces]
        for b, i in self.byte.items():
            self.texts[i] = bytes([b])
        self.flat = np.frombuffer(b"".join(self.texts), np.uint8)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.spelled: list[list[int]] = []  # byte pieces of characters beyond ASCII, by number
        if len(self.byte) < 256:
            raise ValueError("the model needs byte pieces for exact round trips")

    def numbers(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code_of[points]
        if (new := np.unique(points[codes < 0])).size:
            for point in new.tolist():
                c = chr(point)
                i = self.single.get(c, -1) if c != "▁" else -1
                if i < 0 and point < 128:
                    i = self.byte[point]
                elif i < 0:
                    i = -2 - len(self.spelled)
                    self.spelled.append([self.byte[x] for x in c.encode("utf-8", "surrogatepass")])
                self.code_of[point] = len(self.col)
                self.col.append(self.column.get(c, self.width - 1) if c != "▁" else self.width - 1)
                self.lone.append(i)
            codes = self.code_of[points]
        return codes

    def edges(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece, log-weight) of all edges of the units laid end to end in ``text``;
        ``ends`` is for every character the end of its unit."""
        codes = self.numbers(text)
        col, lone = np.array(self.col, np.int32)[codes], np.array(self.lone, np.int32)[codes]
        spelled = np.array([len(x) for x in self.spelled] or [0])
        w = np.where(lone >= 0, self.weight[np.maximum(lone, 0)], 0.0)
        w = np.where(lone < 0, BYTE_WEIGHT * spelled[np.minimum(np.maximum(-2 - lone, 0), len(spelled) - 1)], w)
        at = np.arange(len(text))
        got = [(at, at + 1, lone, w)]
        state = self.trie[col].astype(np.int64)
        at = np.flatnonzero(state)
        state, d = state[at], 1
        while len(at):
            ok = at + d < ends[at]
            at, state = at[ok], state[ok]
            state = self.trie[state * self.width + col[at + d]].astype(np.int64)
            ok = state > 0
            at, state = at[ok], state[ok]
            d += 1
            hit = self.ends[state]
            e = hit >= 0
            got.append((at[e], at[e] + d, hit[e], self.weight[hit[e]]))
        return tuple(np.concatenate(x) for x in zip(*got[::-1], strict=True))  # the longest, likely ones first


EDGE_KINDS = {"src": np.int32, "piece": np.int32, "p": np.float64, "beside": np.float64, "cum": np.float64}
UNIT_KINDS = {"first": np.int64, "last": np.int64}


@dataclass
class Lattices:
    """Edges of the units seen so far, grouped by end node. Arrays have room to grow into; the first
    ``edges``, ``nodes`` + 1 (``ptr``) and ``units`` entries count.

    Of edge i, ``src`` is how many nodes back it starts and ``beside`` the probability of the other
    edges into its end, exact also where it is tiny; the edges of node i are ptr[i]:ptr[i + 1];
    ``first`` and ``last`` are a unit's first and last node.

    Units that come up in a second chunk are kept until there are ``CACHE_EDGES`` edges, and those
    start anew once they serve less than half of a chunk; other units make room for the next chunk's.
    """
    vocab: Vocabulary
    place: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ptr = np.zeros(1, np.int64)
        for name, kind in (EDGE_KINDS | UNIT_KINDS).items():
            setattr(self, name, np.zeros(0, kind))
        self.clear()

    def clear(self) -> None:
        self.place.clear()
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.edges = self.nodes = self.units = 0
        self.kept = (0, 0, 0)
        self.passing: list[str] = []

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        """Writes ``values`` from entry ``at`` on; a full array is copied to one of twice the size."""
        have, need = getattr(self, name), at + len(values)
        if need > len(have):
            more = np.zeros(max(need, 2 * len(have)), have.dtype)
            more[:at] = have[:at]
            setattr(self, name, more)
            have = more
        have[at:need] = values

    def add(self, units: list[str]) -> None:
        """Forward pass over the lattices of new units, all of them at once by position."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        stop = np.cumsum(size)
        begin = stop - size
        unit = np.repeat(np.arange(len(units)), size)
        start, end, piece, w = self.vocab.edges("".join(units), stop[unit])
        by = np.argsort(end.astype(np.int32), kind="stable")
        start, end, piece, w = start[by], end[by], piece[by], w[by]
        of = unit[start]
        node_s, node_e = start + of, end + of  # one more node than characters in every unit
        depth = end - begin[of]
        total = int(stop[-1]) + len(units)
        count = np.bincount(node_e, minlength=total)
        ptr = np.concatenate([[0], np.cumsum(count)])
        alpha = np.full(total, -np.inf)
        alpha[begin + np.arange(len(units))] = 0.0
        longest = int(size.max())
        by = np.argsort(depth.astype(np.int16 if longest < 2**15 else np.int32), kind="stable")
        cuts = np.searchsorted(depth[by], np.arange(1, longest + 2))
        by_s, by_e, by_w = node_s[by], node_e[by], w[by]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x = alpha[by_s[a:b]] + by_w[a:b]
            to = by_e[a:b]
            heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            to = to[heads]
            top = np.maximum.reduceat(x, heads)
            alpha[to] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, count[to])), heads))
        p = np.exp(alpha[node_s] + w - alpha[node_e])
        run = np.cumsum(p)
        before = np.where(ptr[:-1] > 0, run[np.maximum(ptr[:-1] - 1, 0)], 0.0)
        beside = 1.0 - p
        near = np.flatnonzero(p > NEAR_ONE)
        if len(near):
            a, b = ptr[node_e[near]], ptr[node_e[near] + 1]
            rest = np.zeros(len(near))
            for j in range(int((b - a).max())):
                rest += np.where((a + j < b) & (a + j != near), p[np.minimum(a + j, b - 1)], 0.0)
            beside[near] = rest
        node, at, n = self.nodes, self.edges, self.units
        self.place.update(zip(units, range(n, n + len(units)), strict=True))
        self._put("first", n, node + begin + np.arange(len(units)))
        self._put("last", n, node + stop + np.arange(len(units)))
        self._put("ptr", node + 1, at + ptr[1:])
        self._put("src", at, node_e - node_s)
        self._put("piece", at, piece)
        self._put("p", at, p)
        self._put("beside", at, beside)
        self._put("cum", at, run - np.repeat(before, count))
        self.edges, self.nodes, self.units = at + len(p), node + total, n + len(units)

    def numbers(self, docs: list[list[str]]) -> np.ndarray:
        for u in self.passing:
            del self.place[u]
        self.edges, self.nodes, self.units = self.kept
        self.passing = []
        flat = list(chain.from_iterable(docs))
        got = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(got < 0)
        if len(new):
            if self.edges > CACHE_EDGES and 2 * len(new) > len(got):  # other texts than those it was filled with
                self.clear()
                new = np.arange(len(got))
            lacking = [flat[i] for i in new.tolist()]
            units = list(dict.fromkeys(lacking))
            mark = np.fromiter(map(hash, units), np.int64, len(units)) & ((1 << SEEN_BITS) - 1)
            again = self.seen[mark] & (self.edges <= CACHE_EDGES)
            self.seen[mark] = True
            if again.any():
                self.add([units[i] for i in np.flatnonzero(again)])
            self.kept = self.edges, self.nodes, self.units
            if not again.all():
                self.passing = [units[i] for i in np.flatnonzero(~again)]
                self.add(self.passing)
            got[new] = np.fromiter(map(self.place.__getitem__, lacking), np.int64, len(lacking))
        return got

    def ends(self, edge: np.ndarray) -> np.ndarray:
        """The node that an edge ends at."""
        return np.searchsorted(self.ptr[: self.nodes + 1], edge, side="right") - 1

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge into each node at quantile u."""
        e = self.ptr[node]
        end = self.ptr[node + 1] - 1
        todo = np.flatnonzero((self.cum[e] < u) & (e < end))
        while len(todo):
            e[todo] += 1
            todo = todo[(self.cum[e[todo]] < u[todo]) & (e[todo] < end[todo])]
        return e


def _draw(lat: Lattices, unit: np.ndarray, node: np.ndarray, first: np.ndarray, key: np.ndarray, stream: int,
          where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Walks back from ``node`` to ``first`` in every unit: (unit, edge) in walking order."""
    units, edges = [], []
    live = np.flatnonzero(node > first)
    node, t = node.copy(), 0
    while len(live):
        e = lat.pick(node[live], uniform(key[live], stream, where[live], t))
        units.append(unit[live])
        edges.append(e)
        node[live] -= lat.src[e]
        live = live[node[live] > first[live]]
        t += 1
    return (np.concatenate(units), np.concatenate(edges)) if units else (np.zeros(0, np.int64),) * 2


def _truncated(g: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A Gumbel held below ``most``. It rises with ``g``, so that the highest one stays the highest."""
    return -np.logaddexp(-most, -g)


def _free(lat: Lattices, edge: np.ndarray, barred: np.ndarray) -> np.ndarray:
    """Probabilities of all edges into the end of each edge, with 0 for the barred ones."""
    node = lat.ends(edge)
    a, b = lat.ptr[node][:, None], lat.ptr[node + 1][:, None]
    e = a + np.arange(int((b - a).max()))[None, :]
    p = np.where(e < b, lat.p[np.minimum(e, b - 1)], 0.0)
    for j in range(barred.shape[1]):
        p = np.where(e == barred[:, j][:, None], 0.0, p)
    return p


def sample(docs: list[list[str]], keys: np.ndarray, k: int, lat: Lattices) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per document up to k (edges of the whole text in reading order, log-probability, perturbed
    log-probability, inclusion probability), by falling perturbed log-probability."""
    n = len(docs)
    unit_id = lat.numbers(docs)
    sizes = np.fromiter(map(len, docs), np.int64, n)
    doc = np.repeat(np.arange(n), sizes)
    off = np.cumsum(sizes) - sizes
    within = np.arange(len(unit_id)) - off[doc]
    first, last = lat.first[unit_id], lat.last[unit_id]
    keys = keys.view(np.uint64)
    every = np.arange(len(unit_id))
    unit, edge = _draw(lat, every, last, first, keys[doc], 1, within)
    by = np.argsort(unit, kind="stable")
    unit, edge = unit[by], edge[by]
    top = -np.log(-np.log(uniform(keys, 0, np.zeros(n))))
    diverge = np.zeros(n, np.int64)
    barred = np.full((n, k + 1), -1, np.int64)  # edges barred at the diverging place besides the one taken
    open_: list[dict] = []  # per sample: its edges and the maxima of its sets
    alive = np.ones(n, bool)
    out: list[list] = [[] for _ in range(n)]
    kth = np.full(n, -np.inf)
    for r in range(k):
        d = doc[unit]
        count = np.bincount(d, minlength=n)
        begin = np.cumsum(count) - count
        at = np.arange(len(edge)) - begin[d]
        p = lat.p[edge]
        lp = np.log(p)
        total = np.cumsum(lp)
        before = total - lp
        before -= np.repeat(np.where(count > 0, before[np.minimum(begin, max(len(before) - 1, 0))], 0.0), count) if len(lp) else 0
        rest = lat.beside[edge]
        has = np.flatnonzero(alive & (count > 0) & (barred >= 0).any(axis=1))
        if len(has):  # where the set diverges, what is neither taken nor barred
            here = begin[has] + diverge[has]
            rest[here] = _free(lat, edge[here], np.column_stack([barred[has], edge[here]])).sum(axis=1)
        with np.errstate(divide="ignore"):
            g = before + np.log(rest / -np.log(uniform(keys[d], 2 + 4 * r, at)))
        g[at < diverge[d]] = -np.inf
        log_p = np.bincount(d, lp, n)
        for i in np.flatnonzero(alive):
            out[i].append([None, float(log_p[i]), float(top[i]), 1.0])
        open_.append({"unit": unit, "edge": edge, "g": g, "begin": begin, "count": count, "diverge": diverge, "barred": barred, "alive": alive, "top": top})
        # the set with the highest maximum over all samples of a document
        best, which, place = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for s, o in enumerate(open_):
            full = np.flatnonzero(o["count"] > 0)
            if not len(full):
                continue
            high = np.full(n, -np.inf)
            high[full] = _truncated(np.maximum.reduceat(o["g"], o["begin"][full]), o["top"][full])
            better = np.flatnonzero(o["alive"] & (high > best))
            best[better], which[better] = high[better], s
            for i in better:  # position of the maximum
                a = o["begin"][i]
                place[i] = int(o["g"][a : a + o["count"][i]].argmax())
        kth = best
        alive = np.isfinite(best)
        if r == k - 1 or not alive.any():
            break
        new_unit, new_edge, bars, div = [], [], np.full((n, k + 1), -1, np.int64), np.zeros(n, np.int64)
        node = np.zeros(n, np.int64)
        cut_unit = np.zeros(n, np.int64)
        for s, o in enumerate(open_):
            mine = np.flatnonzero(alive & (which == s))
            if not len(mine):
                continue
            pos = o["begin"][mine] + place[mine]
            o["g"][pos] = -np.inf
            x = o["edge"][pos]
            again = place[mine] == o["diverge"][mine]
            bars[mine] = np.where(again[:, None], o["barred"][mine], -1)
            bars[mine, r] = x
            node[mine] = lat.ends(x)
            cut_unit[mine] = o["unit"][pos]
            div[mine] = place[mine]
            keep = np.zeros(n, np.int64)
            keep[mine] = place[mine]
            dd = doc[o["unit"]]
            pre = (np.arange(len(dd)) - o["begin"][dd]) < keep[dd]
            new_unit.append(o["unit"][pre])
            new_edge.append(o["edge"][pre])
        mine = np.flatnonzero(alive)
        # an edge that is not barred, at the node where the set diverges
        pr = _free(lat, lat.ptr[node[mine]], bars[mine])
        cum = np.cumsum(pr, axis=1)
        u = uniform(keys[mine], 3 + 4 * r, div[mine]) * cum[:, -1]
        last_free = pr.shape[1] - 1 - (pr[:, ::-1] > 0).argmax(axis=1)
        took = lat.ptr[node[mine]] + np.minimum((cum < u[:, None]).sum(axis=1), last_free)
        new_unit.append(cut_unit[mine])
        new_edge.append(took)
        cut_node = np.full(n, -1, np.int64)
        cut_node[mine] = node[mine] - lat.src[took]
        # the rest of that unit, and all units behind it, are free
        behind = alive[doc] & (every > cut_unit[doc])
        rest = np.concatenate([cut_unit[mine], every[behind]])
        start = np.concatenate([cut_node[mine], last[behind]])
        u2, e2 = _draw(lat, rest, start, first[rest], keys[doc[rest]], 4 + 4 * r, within[rest])
        unit, edge = np.concatenate([*new_unit, u2]), np.concatenate([*new_edge, e2])
        by = np.argsort(unit, kind="stable")
        unit, edge = unit[by], edge[by]
        top, diverge, barred = best, div, bars
    for r, o in enumerate(open_):
        # within a unit edges were walked from its end; turn them round
        key = o["unit"]
        heads = np.flatnonzero(np.r_[True, np.diff(key) != 0]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[heads, len(key)])
        turned = np.repeat(heads + size - 1, size) - (np.arange(len(key)) - np.repeat(heads, size))
        pieces = lat.piece[o["edge"][turned]] if len(key) else np.zeros(0, np.int32)
        for i in np.flatnonzero(o["alive"]):
            a = o["begin"][i]
            out[i][r][0] = pieces[a : a + o["count"][i]]
    for i in range(n):
        if np.isfinite(kth[i]) and len(out[i]) == k:
            for s in out[i]:
                s[3] = float(-np.expm1(-np.exp(s[1] - kth[i])))
    return [[tuple(s) for s in x] for x in out]


def _ids(pieces: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Piece ids, with byte pieces spelled out."""
    bad = np.flatnonzero(pieces < 0)
    if not len(bad):
        return pieces
    spelled = [vocab.spelled[-2 - int(x)] for x in pieces[bad]]
    size = np.ones(len(pieces), np.int64)
    size[bad] = [len(s) for s in spelled]
    out = np.repeat(pieces, size)
    out[np.repeat(pieces < 0, size)] = [x for s in spelled for x in s]
    return out


def decode_bytes(ids, vocab: Vocabulary) -> bytes:
    ids = np.asarray(ids, np.int64)
    n = vocab.length[ids]
    total = np.cumsum(n)
    return vocab.flat[np.repeat(vocab.start[ids] - total + n, n) + np.arange(total[-1] if len(n) else 0)].tobytes()


def decode_ids(ids, vocab: Vocabulary) -> str:
    """The text of a list of piece ids; the leading space that encoding adds goes."""
    return decode_bytes(ids, vocab)[1:].decode("utf-8", "surrogatepass")


_LOADED: dict[str, Lattices] = {}


def _lattices(path: str) -> Lattices:
    if path not in _LOADED:
        _LOADED[path] = Lattices(Vocabulary(path))
    return _LOADED[path]


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for b, n in enumerate(sizes):
        if b > a and size + n > CHUNK_CHARS:
            yield a, b
            a, size = b, 0
        size += n
    if len(sizes) > a:
        yield a, len(sizes)


SAMPLES = "array<struct<ids:binary,n:int,log_prob:double,perturbed:double,inclusion:double,round_trip:boolean>>"


def encode(docs: DataFrame, k: int = 2, key: Column | str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH,
           name: str = "samples") -> DataFrame:
    """Adds up to k distinct segmentations per row, drawn without replacement (fewer if the text has
    no more), by falling perturbed log-probability.

    ``ids`` holds piece ids as little-endian int32 (see ``unpack``); ``round_trip`` says whether
    decoding them gives the text again. A null text counts as empty: one segmentation, the lone
    leading space. ``key`` seeds the noise: rows of one key and text get the same samples; a null
    key is a key of its own. Other columns and rows stay as they are.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    on_workers(docs.sparkSession)

    kind = pa.list_(pa.struct([("ids", pa.binary()), ("n", pa.int32()), ("log_prob", pa.float64()), ("perturbed", pa.float64()),
                               ("inclusion", pa.float64()), ("round_trip", pa.bool_())]))

    @F.arrow_udf(SAMPLES)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lat = _lattices(model_path)
        vocab = lat.vocab
        for seeds, texts in batches:
            for a, b in _chunks(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):  # a chunk's texts and samples at a time
                rows = [t or "" for t in texts[a:b].to_pylist()]
                keys = seeds[a:b].to_numpy(zero_copy_only=False).astype(np.int64)
                got = []
                for t, found in zip(rows, sample([UNITS.findall(" " + t) for t in rows], keys, k, lat), strict=True):
                    one, raw = [], (" " + t).encode("utf-8", "surrogatepass")
                    for pieces, lp, g, inc in found:
                        ids = _ids(pieces, vocab)
                        one.append({"ids": ids.astype("<i4").tobytes(), "n": len(ids), "log_prob": lp, "perturbed": g, "inclusion": inc,
                                    "round_trip": decode_bytes(ids, vocab) == raw})
                    got.append(one)
                yield pa.array(got, kind)

    key = F.col(key) if isinstance(key, str) else key
    return docs.withColumn(name, run(F.xxhash64(key, F.col(text_col).cast("string")), F.col(text_col).cast("string")))


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<i4").tolist()


def decode(rows: DataFrame, ids_col: str, model_path: str = MODEL_PATH, name: str = "decoded") -> DataFrame:
    """Adds the text of a column of packed ids; null for null."""
    on_workers(rows.sparkSession)

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        vocab = _lattices(model_path).vocab
        return pd.Series([None if x is None else decode_ids(unpack(x), vocab) for x in col], dtype="object")

    return rows.withColumn(name, run(F.col(ids_col)))
