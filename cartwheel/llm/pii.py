r"""Personal data: base patterns and a skip-chain conditional random field.

The base patterns find emails, IP addresses, payment cards and phone numbers,
leftmost and non-overlapping per kind; a match that fails its check is dropped
and not tried again, so two cards side by side, or a phone followed by an
address, are lost to them.  The field adds such spans; base spans stay.

The nodes of the field are the tokens that hold a digit or ``@``; labels are
outside, or begin / inside of a kind.  Each node has a potential of its shape
and the shapes of its neighbours, tokens side by side share a transition
potential (the chain), and every token shares a potential with the last token
before it, however far away, that has the same digits or text or whose number
ends in the same TAIL digits (the skip edges), so that one document labels an
entity alike: ``(826) 555-4081`` and ``8265554081`` are phones if
``+1 826 555 4081`` is one.  A number here is a run of neighbouring tokens of
digits and signs.  Sum-product messages go round the loops, damped, until they
settle or ROUNDS are over; the labels of tokens in base spans are given.

Training is piecewise and without hand labels: base spans of all documents
label the tokens.  A token that the base patterns leave out, but that repeats
one they label, counts as unknown, not as outside, so that skip edges learn from
entities alone what repeats mean.  Counts of (shape, neighbours, label), of adjacent labels and
of labels at the ends of skip edges are the only statistics; shapes and labels
are fixed lists, so these tables have a bounded number of rows however many
documents there are.  A weighted softmax regression on them gives the node
potentials, and log ratios of the counts give the edge potentials.

Scale: two passes over the texts without a shuffle of texts.  Skip edges tie
an occurrence to the next one only, so edges grow with the tokens.

Cases: a null or empty text has no spans; an empty table gives an empty result
(and a model that adds nothing); repeated rows get equal results; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_LABELS = len(LABELS)
ROUNDS, DAMPING, SETTLED = 20, 0.5, 1e-4
TAIL = 8                # last digits by which two numbers are the same
CLIP = 2.0              # bound of a chain potential
SKIP_CLIP = 6.0         # bound of a skip potential
GIVEN = 10.0            # node potential of a given label
ADD_AT = 0.5            # marginal probability from which the field adds a token to a span
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match cannot begin inside a run of digits: it would have begun, or failed, at the run's start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_TOKEN_END = re.compile(r"\s|$")
_EDGE = re.compile(r"^[^0-9A-Za-z+(%_]+|[^0-9A-Za-z)]+$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str, dropped: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start.

    ``dropped`` gets the start and end of matches with a space inside that fail their check."""
    if not _SIGN.search(text):
        return []
    out = []

    def fails(m: re.Match) -> None:
        if dropped is not None and " " in m[0]:
            dropped.append(m.span())

    at, done = text.find("@"), 0
    while at >= 0:
        # the local part is the run of its characters before the sign, after the last match
        lo = at
        while lo > done and (c := text[lo - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            lo -= 1
        end = at + 1
        if lo < at and (m := _DOMAIN.match(text, at)):
            out.append((0, lo, m.end()))
            done = end = m.end()
        at = text.find("@", end)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
        else:
            fails(m)
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
        else:
            fails(m)
    return out


# ---- tokens and their shapes

# The shapes of a token; the first one stands for "no such token next to it".
SHAPES = ("none", "email", "at", "ip", "ip_over", "plus_short", "plus_mid", "plus_phone", "plus_long", "paren", "mixed",
          "hyphen_short", "hyphen_mid", "hyphen_phone", "hyphen_card", "hyphen_long", "dotted",
          "digits_1_3", "digits_4", "digits_5_7", "digits_8_12", "digits_13_15", "card_ok", "card_bad", "digits_20")
SHAPE_ID = {s: i for i, s in enumerate(SHAPES)}
_NO_NUMBER = frozenset(SHAPE_ID[s] for s in ("none", "email", "at", "ip", "ip_over", "mixed"))
KIND_OF = np.array([0] + [k + 1 for k in range(len(KINDS)) for _ in "BI"])  # of a label; 0 is outside


def shape(core: str) -> str:
    if "@" in core:
        m = _LOCAL.match(core.split("@")[0])
        return "email" if m and _DOMAIN.fullmatch(core, core.index("@")) else "at"
    d = _digits(core)
    n = len(d)
    if len(d) == len(core):
        if 16 <= n <= 19:
            return "card_ok" if luhn(d) else "card_bad"
        return ("digits_1_3" if n < 4 else "digits_4" if n == 4 else "digits_5_7" if n < 8 else
                "digits_8_12" if n < 13 else "digits_13_15" if n < 16 else "digits_20")
    if any(c not in "0123456789.()-+" for c in core):
        return "mixed"
    if _IP.fullmatch(core):
        return "ip" if all(int(p) <= 255 for p in core.split(".") if len(p) < 9) and max(map(len, core.split("."))) < 9 else "ip_over"
    if core[0] == "+":
        return "plus_short" if n < 4 else "plus_mid" if n < 8 else "plus_phone" if n < 16 else "plus_long"
    if "(" in core or ")" in core:
        return "paren"
    if "-" in core:
        return ("hyphen_short" if n < 4 else "hyphen_mid" if n < 8 else "hyphen_phone" if n < 16 else
                "hyphen_card" if n < 20 else "hyphen_long")
    return "dotted"


def tokens(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, directly follows the one before) of the tokens with a digit or ``@``.

    Signs around a token are no part of it; a token of signs only is none."""
    out: list[tuple[int, int, bool]] = []
    m, last = _SIGN.search(text), -1
    while m:
        lo = m.start()
        while lo > 0 and not text[lo - 1].isspace():
            lo -= 1
        hi = _TOKEN_END.search(text, m.end()).start()
        core = text[lo:hi]
        a = _EDGE.match(core)
        left = a.end() if a and a.start() == 0 else 0
        right = len(core)
        while right > left and not (core[right - 1] == ")" or (core[right - 1] < "\x80" and core[right - 1].isalnum())):
            right -= 1
        if right > left and _SIGN.search(core, left, right):
            out.append((lo + left, lo + right, last >= 0 and text[last:lo].isspace()))
            last = hi
        m = _SIGN.search(text, hi)
    return out


class Graph:
    """Nodes, chain edges and skip edges of the documents of a batch."""

    def __init__(self, texts: list[str | None]):
        self.base, self.dropped, self.first = [], [], [0]
        self.span: list[tuple[int, int]] = []
        shapes, self.chain, self.skip, self.same = [], [], [], []
        skips = 0
        for text in texts:
            text = text or ""
            self.dropped.append([])
            self.base.append(base_spans(text, self.dropped[-1]))
            seen: dict[tuple[str, str], int] = {}
            same: dict[tuple[str, str], list[int]] = {}
            runs: list[list[int]] = []
            for lo, hi, follows in tokens(text) if _SIGN.search(text) else ():
                i, core = len(self.span), text[lo:hi]
                self.span.append((lo, hi))
                shapes.append(SHAPE_ID[shape(core)])
                if follows:
                    self.chain.append((i - 1, i))
                d = _digits(core)
                key = ("token", d if len(d) >= 7 and "@" not in core else core.lower())
                if key in seen:
                    self.skip.append((seen[key], i))
                seen[key] = i
                same.setdefault(key, []).append(i)
                if shapes[i] not in _NO_NUMBER:
                    if follows and runs and runs[-1][-1] == i - 1:
                        runs[-1].append(i)
                    else:
                        runs.append([i])
            linked = set(self.skip[skips:])
            for run in runs:
                number = _digits("".join(text[slice(*self.span[i])] for i in run))
                if len(number) >= TAIL:
                    key = ("number", number[-TAIL:])
                    if key in seen:
                        self.skip.extend((seen[key], i) for i in run if (seen[key], i) not in linked)
                    seen[key] = run[-1]
                    same.setdefault(key, []).extend(run)
            skips = len(self.skip)
            self.same.extend(g for g in same.values() if len(g) > 1)
            self.first.append(len(self.span))
        self.shape = np.array(shapes, np.int64)
        self.before, self.after = np.zeros_like(self.shape), np.zeros_like(self.shape)
        for i, j in self.chain:
            self.before[j], self.after[i] = self.shape[i], self.shape[j]

    def base_labels(self) -> np.ndarray:
        """Label of every node by the base spans: the first in a span begins it.

        -1, unknown, inside a dropped match with a space, where the base
        patterns may have taken several entities for one, and where a token is
        outside that repeats one inside."""
        out = np.zeros(len(self.span), np.int64)
        for d, spans in enumerate(self.base):
            nodes = range(self.first[d], self.first[d + 1])
            starts = [self.span[i][0] for i in nodes]

            def within(lo: int, hi: int):
                for i in range(int(np.searchsorted(starts, lo)), int(np.searchsorted(starts, hi))):
                    if self.span[self.first[d] + i][1] <= hi:
                        yield self.first[d] + i

            for lo, hi in self.dropped[d]:
                for node in within(lo, hi):
                    out[node] = -1
            for kind, lo, hi in spans:
                for k, node in enumerate(within(lo, hi)):
                    out[node] = 1 + 2 * kind + (k > 0)
        for group in self.same:
            y = out[group]
            if (y > 0).any():
                out[np.array(group)[y == 0]] = -1
        return out


# ---- training

def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts of one slice: part 0 nodes, 1 chain edges, 2 skip edges."""
    g = Graph(batch.column("text").to_pylist())
    y = g.base_labels()
    rows = [np.stack([np.zeros_like(y), g.shape, g.before, g.after, y], axis=1)[y >= 0]] if len(y) else []
    for part, edges in ((1, g.chain), (2, g.skip)):
        if edges:
            e = np.array(edges)
            e = e[(y[e] >= 0).all(axis=1)]
            zero = np.zeros(len(e), np.int64)
            rows.append(np.stack([zero + part, y[e[:, 0]], y[e[:, 1]], zero, zero], axis=1))
    found, n = (np.unique(np.concatenate(rows), axis=0, return_counts=True) if rows
                else (np.empty((0, 5), np.int64), np.empty(0, np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, c]), pa.int64()) for c in range(5)] + [pa.array(n, pa.int64())],
                                      names=["part", "a", "b", "c", "y", "n"])


class Model:
    """Node potentials by shape and neighbour shapes; chain and skip potentials."""

    def __init__(self, counts: np.ndarray):
        s = len(SHAPES)
        nodes = counts[counts[:, 0] == 0]
        self.own, self.prev, self.next = np.zeros((s, N_LABELS)), np.zeros((s, s, N_LABELS)), np.zeros((s, s, N_LABELS))
        self.own[:, 0] = 1.0  # without evidence a token is outside
        self._regress(nodes)
        self.chain = self._ratios(counts[counts[:, 0] == 1], N_LABELS, 1.0, CLIP)
        # the ends of a skip edge agree in kind, whether they begin an entity or not
        skip = counts[counts[:, 0] == 2].copy()
        skip[:, 1:3] = KIND_OF[skip[:, 1:3]]
        self.skip = self._ratios(skip, len(KINDS) + 1, 0.25, SKIP_CLIP)[np.ix_(KIND_OF, KIND_OF)]

    def _regress(self, nodes: np.ndarray, rounds: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> None:
        """Softmax regression on the counted rows, by gradient steps scaled per weight."""
        if not len(nodes):
            return
        a, b, c, y = (nodes[:, k] for k in range(1, 5))
        w = np.sqrt(nodes[:, 5].astype(float))  # frequent shapes count more, but do not drown the others
        w /= w.sum()
        truth = np.eye(N_LABELS)[y]
        parts = ((self.own, (a,)), (self.prev, (a, b)), (self.next, (a, c)))
        scale = [np.full_like(p, 1e-8) for p, _ in parts]
        for _ in range(rounds):
            step = (_softmax(self.node(a, b, c)) - truth) * w[:, None]
            for (p, at), q in zip(parts, scale):
                grad = ridge * p
                np.add.at(grad, at, step)
                q += grad * grad
                p -= rate * grad / np.sqrt(q)

    @staticmethod
    def _ratios(edges: np.ndarray, labels: int, smooth: float, clip: float) -> np.ndarray:
        """log P(y, y') / P(y) P(y') of the labels at the two ends, at most ``clip`` either way.

        Base labels can never show some neighbours, such as two cards, so on the
        chain a count of zero is weak evidence however large the corpus is."""
        joint = np.full((labels, labels), smooth)
        np.add.at(joint, (edges[:, 1], edges[:, 2]), edges[:, 5])
        joint /= joint.sum()
        return np.clip(np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True))), -clip, clip)

    def node(self, a, b, c) -> np.ndarray:
        return self.own[a] + self.prev[a, b] + self.next[a, c]

    def marginals(self, g: Graph, skips: bool = True) -> np.ndarray:
        """Label probabilities of every node by damped sum-product messages, without skip edges if asked.

        Tokens in base spans are evidence: their labels are given."""
        unary = self.node(g.shape, g.before, g.after)
        given = g.base_labels()
        unary[given > 0] = -GIVEN
        unary[given > 0, given[given > 0]] = GIVEN
        skip = g.skip if skips else []
        edges = np.array(g.chain + skip, np.int64).reshape(-1, 2)
        if not len(edges):
            return _softmax(unary)
        pair = np.concatenate([np.broadcast_to(p, (len(e), N_LABELS, N_LABELS)) for p, e in ((self.chain, g.chain), (self.skip, skip))])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), N_LABELS))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + pair
            top = out.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
            new -= new.max(axis=1, keepdims=True)
            new = DAMPING * message + (1 - DAMPING) * new
            moved = np.abs(new - message).max()
            message = new
            if moved < SETTLED:
                break
        belief = unary.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame) -> Model:
    """A model from the base spans of all documents."""
    counted = map_arrow(docs.select("text"), _count, "part long, a long, b long, c long, y long, n long")
    rows = counted.groupBy("part", "a", "b", "c", "y").agg(F.sum("n").alias("n")).collect()  # bounded by the fixed lists
    return Model(np.array(sorted(tuple(r) for r in rows), np.int64).reshape(-1, 6))


# ---- finding

def find(texts: list[str | None], model: Model, skips: bool = True) -> list[tuple[list, list]]:
    """Per text: the base spans, and the spans that the field adds."""
    g = Graph(texts)
    p = model.marginals(g, skips) if len(g.span) else np.empty((0, N_LABELS))
    inside = np.stack([p[:, 1 + 2 * k] + p[:, 2 + 2 * k] for k in range(len(KINDS))], axis=1)
    kind = inside.argmax(axis=1) if len(p) else np.empty(0, np.int64)
    sure = inside[np.arange(len(p)), kind] >= ADD_AT
    follows = np.zeros(len(p), bool)
    for _, j in g.chain:
        follows[j] = True
    out = []
    for d, base in enumerate(g.base):
        spans: list[list[int]] = []
        grows = False
        for i in range(g.first[d], g.first[d + 1]):
            if not sure[i]:
                grows = False
                continue
            k = int(kind[i])
            if grows and follows[i] and spans[-1][0] == k and p[i, 2 + 2 * k] > p[i, 1 + 2 * k]:
                spans[-1][2] = g.span[i][1]
            else:
                spans.append([k, *g.span[i]])
            grows = True
        out.append((base, [tuple(s) for s in _clear_of(spans, base)]))
    return out


def _clear_of(spans: list[list[int]], base: list[tuple[int, int, int]]) -> list[list[int]]:
    """The spans that touch no base span."""
    taken = sorted((lo, hi) for _, lo, hi in base)
    out, b, reach = [], 0, -1
    for s in sorted(spans, key=lambda x: x[1]):
        while b < len(taken) and taken[b][0] < s[2]:
            reach = max(reach, taken[b][1])
            b += 1
        if reach <= s[1]:
            out.append(s)
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for k, lo, hi in sorted(spans))


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    model = train(docs)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find(batch.column("text").to_pylist(), model)
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *counts,
             pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string()),
             pa.array([listed(base + more) for base, more in found], pa.string()),
             pa.array([len(more) for _, more in found], pa.int64())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return map_arrow(docs.select("doc_id", "text"), step,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                     + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string, n_added long")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; spans may overlap."""
    out, done = [], 0
    for lo, hi, k in sorted((lo, hi, k) for k, lo, hi in spans):
        if lo >= done:
            out += [text[done:lo], f"[{KINDS[k].upper()}]"]
        done = max(done, hi)
    return "".join(out) + text[done:]


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; personal data in ``text`` is replaced, ``n_chars`` follows."""
    model = train(docs)
    schema = docs.schema

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        new = [t if t is None else redact(t, base + more) for t, (base, more) in zip(texts, find(texts, model))]
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns["text"] = pa.array(new, batch.schema.field("text").type)
        if "n_chars" in columns:
            columns["n_chars"] = pa.array([old if t == u else len(u) for t, u, old in zip(texts, new, columns["n_chars"].to_pylist())],
                                          batch.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], names=batch.schema.names)

    return map_arrow(docs, step, schema)
