"""DartMinHash: sparse weighted MinHash signatures from hashed darts.

Every element carries a Poisson process of darts over (weight, rank), one dart on average per unit of area, the same wherever the
element occurs. A dart hits a set if its weight coordinate lies within the element's weight there; each dart also names one of ``k``
coordinates, and a signature keeps for every coordinate the hitting dart of lowest rank. Two sets agree on a coordinate with a
probability equal to their weighted Jaccard similarity. Ranks are cut into intervals (one of 1/256, doublings up to 1, then units), and
darts are thrown interval by interval until all coordinates are held: about k ln k darts, however large the set.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from .text import mixed

GOLD = 0x9E3779B97F4A7C15
FINE = 8
#: Unit cells times intervals handled at a time.
BATCH = 400_000
SCALE = 2.0**-53


@lru_cache(64)
def thresholds(length: float) -> list[int]:
    """A 64-bit value has more than i darts if it is at least the i-th threshold: Poisson counts with this mean."""
    p, total, out = math.exp(-length), 0.0, []
    for i in range(24):
        total += p
        out.append(min(int(total * 2.0**64), 2**64 - 1))
        p *= length / (i + 1)
    return out


def interval(a: int) -> tuple[float, float]:
    """(start, length) of the a-th interval of ranks."""
    if a == 0:
        return 0.0, 2.0**-FINE
    if a <= FINE:
        return 2.0 ** (a - 1 - FINE), 2.0 ** (a - 1 - FINE)
    return float(a - FINE), 1.0


def throw(cells: np.ndarray, part: np.ndarray | None, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell number, identity, rank) of the darts of unit cells in intervals first to last - 1; part: the share of a cell that is weight."""
    some = range(first, last)
    seed = mixed(np.array([(a + 1) * GOLD & (1 << 64) - 1 for a in some], np.uint64))
    start, length = np.array([interval(a) for a in some]).T
    limit = np.array([thresholds(interval(a)[1]) for a in some], np.uint64)
    u = mixed(cells[None, :] + seed[:, None])
    row, cell = np.nonzero(u >= limit[:, :1])
    u = u[row, cell]
    who, ids, ranks, d = [], [], [], 0
    while len(u):
        dart = mixed(u ^ np.uint64((d + 1) * GOLD & (1 << 64) - 1))
        place = mixed(dart ^ seed[row])
        rank = start[row] + length[row] * ((place >> np.uint64(11)).astype(np.float64) * SCALE)
        if part is None:
            inside = slice(None)
        else:
            inside = (mixed(place) >> np.uint64(11)).astype(np.float64) * SCALE < part[cell]
        who.append(cell[inside])
        ids.append(dart[inside])
        ranks.append(rank[inside])
        d += 1
        more = u >= limit[row, d]
        row, cell, u = row[more], cell[more], u[more]
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return np.concatenate(who), np.concatenate(ids), np.concatenate(ranks)


def unit_cells(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A weight of 2.3 is two full unit cells and 0.3 of a third."""
    whole = np.ceil(weights).astype(np.int64)
    unit = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    return mixed(np.repeat(mixed(elements), whole) + unit.astype(np.uint64) * np.uint64(GOLD)), np.minimum(np.repeat(weights, whole) - unit, 1.0)


def signatures(sets: list[np.ndarray], k: int, weights: list[np.ndarray] | None = None) -> np.ndarray:
    """A row for each non-empty set of distinct 64-bit elements: identities of the earliest darts, by coordinate."""
    out, have = np.zeros((len(sets), k), np.uint64), np.zeros((len(sets), k), bool)
    if weights is None:
        cells, parts = [mixed(s) for s in sets], None
        mass = np.array([len(s) for s in sets], np.float64)
    else:
        cells, parts = map(list, zip(*map(unit_cells, sets, weights), strict=True)) if sets else ([], [])
        mass = np.array([p.sum() for p in parts])
    want = k * (math.log(k) + 1.5) / np.maximum(mass, 1e-9)
    done = np.zeros(len(sets), np.int64)
    until = np.where(want <= 1, np.ceil(np.log2(np.maximum(want, 1e-9))) + FINE + 1, np.ceil(want) + FINE).astype(np.int64)
    until = np.maximum(until, 1)
    todo = np.arange(len(sets))
    while len(todo):
        order = todo[np.lexsort((until[todo], done[todo]))]
        at = 0
        while at < len(order):
            first, last = done[order[at]], until[order[at]]
            last = min(last, first + max(1, BATCH // max(1, len(cells[order[at]]))))
            take, held = [], 0
            while at < len(order) and done[order[at]] == first and min(until[order[at]], first + max(1, BATCH // max(1, len(cells[order[at]])))) == last and (not take or held < BATCH):
                take.append(order[at])
                held += len(cells[order[at]]) * (last - first)
                at += 1
            owner = np.repeat(np.array(take), [len(cells[i]) for i in take])
            cell, dart, rank = throw(np.concatenate([cells[i] for i in take]), None if parts is None else np.concatenate([parts[i] for i in take]), int(first), int(last))
            low_last = np.argsort(-rank, kind="stable")
            cell, dart = cell[low_last], dart[low_last]
            spot = owner[cell] * k + ((mixed(dart) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            new = ~have.ravel()[spot]
            out.ravel()[spot[new]] = dart[new]  # of darts for one coordinate the last, of lowest rank, stays
            have.ravel()[spot] = True
            done[take] = last
        todo = todo[~have[todo].all(axis=1)]
        more = np.maximum(1, (until - done)[todo])
        until[todo] = done[todo] + np.where(done[todo] <= FINE, more, np.maximum(more, (done[todo] - FINE) // 4 + 1))
    return out


def signature(elements: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    return signatures([elements], k, None if weights is None else [weights])[0]
