"""A first-order semi-Markov conditional random field over token segments.

A region of text is a sequence of tokens. A segmentation labels every token ``O`` by itself or joins up to
``LONGEST`` tokens to an entity; its score is the sum over segments of ``w[label] . f(whole segment)``
plus a transition weight from the label before. ``Field.best`` finds the best segmentation, boundaries and
types together, by dynamic programming over (end, label) with entity length bounded; training maximises the
conditional likelihood with the forward-backward sums of the same recursion.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
#: Tokens and characters of an entity at most.
LONGEST, WIDEST = 26, 80
#: The label of tokens outside entities; the first one.
OUT = 0
KINDS = re.compile(r"([0-9])|([^\W\d_])|(\s)")


def same_token(a: str, b: str) -> bool:
    """Two characters side by side are in one token."""
    x, y = KINDS.match(a), KINDS.match(b)
    return x is not None and y is not None and x.lastindex == y.lastindex


@dataclass
class Lattice:
    """Segments of a region: start and end token, and features; the first ones are the single tokens."""

    tokens: list[tuple[int, int]]
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    by_end: list[list[int]] = field(default_factory=list)


Featurise = Callable[[str, int, int], list[str] | None]


class Field:
    def __init__(self, labels: list[str], of_entity: Featurise, of_token: Featurise):
        self.labels, self.of_entity, self.of_token = labels, of_entity, of_token
        self.index: dict[str, int] = {}
        self.w = np.zeros((0, len(labels)))
        self.t = np.zeros((len(labels), len(labels)))

    def ids(self, names: list[str], learn: bool) -> list[int]:
        return [self.index.setdefault(n, len(self.index)) if learn else self.index[n] for n in names if learn or n in self.index]

    def lattice(self, text: str, a: int = 0, b: int | None = None, learn: bool = False) -> Lattice:
        b = len(text) if b is None else b
        tokens = [m.span() for m in TOKEN.finditer(text, a, b)]
        x = Lattice(tokens, by_end=[[] for _ in range(len(tokens) + 1)])

        def add(i: int, j: int, names: list[str]) -> None:
            x.by_end[j].append(len(x.start))
            x.start.append(i)
            x.end.append(j)
            x.features.append(self.ids(names, learn))

        for i, (s, e) in enumerate(tokens):
            add(i, i + 1, self.of_token(text, s, e) or [])
        for i, (s, _) in enumerate(tokens):
            for j in range(i, min(len(tokens), i + LONGEST)):
                if tokens[j][1] - s > WIDEST:
                    break
                if (names := self.of_entity(text, s, tokens[j][1])) is not None:
                    add(i, j + 1, names)
        return x

    def scores(self, x: Lattice) -> np.ndarray:
        """Score of each segment with each label; a single token is O, another segment is not."""
        n = len(x.tokens)
        out = np.array([self.w[f].sum(axis=0) if f else np.zeros(len(self.labels)) for f in x.features])
        out[:n, 1:] = -np.inf
        out[n:, OUT] = -np.inf
        return out

    def best(self, text: str, a: int = 0, b: int | None = None) -> list[tuple[int, int, str]]:
        """Entities (start, end, label) of the best segmentation. Segments are scored as the search comes to their end, and not held."""
        b = len(text) if b is None else b
        size = len(self.labels)
        starts, ends = array("q"), array("q")
        top = [np.full(size, -np.inf)]  # of the last LONGEST + 1 ends
        top[0][OUT] = 0
        way_start, way_label = array("i"), array("b")  # of each end and label: first token of the last segment, label before it
        some = False
        for m in TOKEN.finditer(text, a, b):
            starts.append(m.start())
            ends.append(m.end())
            j, e = len(starts), m.end()
            best = np.full(size, -np.inf)
            start, label = [0] * size, [OUT] * size
            for k in range(min(j, LONGEST)):  # segments of k + 1 tokens
                i = j - k - 1
                if e - starts[i] > WIDEST and k:
                    break
                before = top[-1 - k]
                ways = [(self.of_token(text, starts[i], e) or [], slice(OUT, OUT + 1))] if not k else []
                if e - starts[i] <= WIDEST and (names := self.of_entity(text, starts[i], e)) is not None:
                    ways.append((names, slice(OUT + 1, size)))
                for names, kinds in ways:
                    ids = self.ids(names, False)
                    way = before[:, None] + self.t[:, kinds]
                    value = way.max(axis=0) + (self.w[ids, kinds].sum(axis=0) if ids else 0)
                    for y in np.flatnonzero(value > best[kinds]).tolist():
                        best[kinds.start + y], start[kinds.start + y], label[kinds.start + y] = value[y], i, int(way[:, y].argmax())
                        some |= kinds.start > OUT
            top = [*top[-LONGEST:], best]
            way_start.extend(start)
            way_label.extend(label)
        out, j = [], len(starts)
        y = int(top[-1].argmax()) if some else OUT
        while j and some:
            i, before = way_start[(j - 1) * size + y], way_label[(j - 1) * size + y]
            if y != OUT:
                out.append((starts[i], ends[j - 1], self.labels[y]))
            j, y = i, before
        return out[::-1]

    def train(self, examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int, rate: float, decay: float) -> None:
        """AdaGrad on the negative log-likelihood with an L2 term."""
        xs = [(self.lattice(text, learn=True), gold) for text, gold in examples]
        size = len(self.labels)
        self.w = np.zeros((len(self.index), size))
        gw, gt = np.full_like(self.w, 1e-6), np.full_like(self.t, 1e-6)
        for _ in range(epochs):
            for x, gold in xs:
                dw, dt = self.gradient(x, gold)
                rows = sorted({f for fs in x.features for f in fs})
                d = dw[rows] + decay * self.w[rows]
                gw[rows] += d * d
                self.w[rows] -= rate * d / np.sqrt(gw[rows])
                gt += dt * dt
                self.t -= rate * dt / np.sqrt(gt)

    def gradient(self, x: Lattice, gold: list[tuple[int, int, str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of -log p(gold): expected less observed counts."""
        n, size = len(x.tokens), len(self.labels)
        s = self.scores(x)
        fore, aft = np.full((n + 1, size), -np.inf), np.full((n + 1, size), -np.inf)
        fore[0, OUT], aft[n] = 0, 0
        with np.errstate(divide="ignore"):
            log = lambda v: np.logaddexp.reduce(v, axis=0)
            for j in range(1, n + 1):
                fore[j] = log(np.array([log(fore[x.start[k]][:, None] + self.t) + s[k] for k in x.by_end[j]]))
            for j in range(n, 0, -1):
                for k in x.by_end[j]:
                    i = x.start[k]
                    aft[i] = np.logaddexp(aft[i], log((self.t + (s[k] + aft[j])[None, :]).T))
        z = log(fore[n])
        dw, dt = np.zeros_like(self.w), np.zeros_like(self.t)
        place = {(x.tokens[i][0], x.tokens[j - 1][1]): k for k, (i, j) in enumerate(zip(x.start, x.end, strict=True)) if k >= n}
        entity = {place[a, b]: self.labels.index(label) for a, b, label in gold}
        inside = {i for k in entity for i in range(x.start[k], x.end[k])}
        told = entity | {i: OUT for i in range(n) if i not in inside}
        for k in range(len(x.start)):
            p = np.exp(fore[x.start[k]][:, None] + self.t + (s[k] + aft[x.end[k]])[None, :] - z)
            dt += p
            q = p.sum(axis=0)
            if k in told:
                q[told[k]] -= 1
            for f in x.features[k]:
                dw[f] += q
        before = OUT
        for k in sorted(told, key=lambda k: x.start[k]):
            dt[before, told[k]] -= 1
            before = told[k]
        return dw, dt
