"""Routes along road lines, and the ways to cut a feature before it is routed (H5, H6). Lines are arrays of (lon, lat) in their direction of travel."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

from . import kernels

#: Waypoints tried, most and least; most relative difference of lengths; most dissimilarity; chunk and least last chunk in kilometres.
WAYPOINTS, LENGTH_ERROR, DISSIMILARITY, CHUNK_KM, LAST_KM = (10, 4), 0.05, 0.008, 2.5, 1.0
ROUTE, MATCH = "ROUTE", "MATCH"
DISTANCE, BEARING = "DISTANCE_SLICE_METHOD", "BEARING_SLICE_METHOD"
#: Roads that a point is snapped to: the nearest for a route, and so many within this distance for a match.
CANDIDATES, SNAP_KM = 4, 0.05


@dataclass
class Place:
    road: int
    km: float
    off: float


@dataclass
class Roads:
    """A directed graph: roads meet where one's last coordinate is another's first."""

    lines: list[np.ndarray]
    near: list[kernels.Near] = field(init=False)
    km: list[float] = field(init=False)
    ends: list[tuple] = field(init=False)
    leaving: dict[tuple, list[int]] = field(init=False)

    def __post_init__(self):
        self.near = [kernels.Near(x) for x in self.lines]
        self.km = [float(x.km[-1]) for x in self.near]
        self.ends = [tuple(x[-1].round(6)) for x in self.lines]
        self.leaving = {}
        for i, x in enumerate(self.lines):
            self.leaving.setdefault(tuple(x[0].round(6)), []).append(i)

    def places(self, point: np.ndarray, method: str) -> list[Place]:
        """Where a point may be on the roads, nearest first."""
        return self.places_of(point[None], method)[0]

    def places_of(self, points: np.ndarray, method: str) -> list[list[Place]]:
        """For each point where it may be on the roads, nearest first."""
        each = [x.places(points)[:2] for x in self.near]
        km, off = (np.stack([x[k] for x in each], axis=1) for k in (0, 1))
        most = 1 if method == ROUTE else CANDIDATES
        out = []
        for own, at, order in zip(off.tolist(), km.tolist(), np.argsort(off, axis=1, kind="stable")[:, :most].tolist(), strict=True):
            found = [Place(i, at[i], own[i]) for i in order]
            out.append(found[:1] if method == ROUTE else [p for p in found if p.off <= SNAP_KM] or found[:1])
        return out

    def part(self, road: int, start: float, stop: float) -> np.ndarray:
        return kernels.slice_along(self.lines[road], start, stop, self.near[road].km)

    def routes(self, lines: list[np.ndarray], method: str) -> Iterator[np.ndarray | None]:
        """``route`` through the points of each line; their places are looked for together."""
        if not lines:
            return
        places, at = self.places_of(np.concatenate(lines), method), 0
        for x in lines:
            yield self.route(x, method, places[at : at + len(x)])
            at += len(x)

    def reach(self, road: int, most: float) -> dict[int, tuple[float, int]]:
        """Roads that can be entered after the whole of one: kilometres up to their start, and the road before; no further than ``most``."""
        out: dict[int, tuple[float, int]] = {}
        heap = [(0.0, road, road)]
        while heap:
            km, at, _ = heapq.heappop(heap)
            for n in self.leaving.get(self.ends[at], ()):
                if n not in out or km < out[n][0]:
                    out[n] = (km, at)
                    if km + self.km[n] <= most:
                        heapq.heappush(heap, (km + self.km[n], n, at))
        return out

    def leg(self, a: Place, b: Place, reach: dict[int, tuple[float, int]]) -> tuple[float, list[int]] | None:
        """Kilometres from one place to another, and the roads; reach: of a's road."""
        if a.road == b.road and b.km >= a.km:
            return b.km - a.km, [a.road]
        if b.road not in reach:
            return None
        roads, at = [b.road], reach[b.road][1]
        while at != a.road:
            roads.append(at)
            at = reach[at][1]
        return self.km[a.road] - a.km + reach[b.road][0] + b.km, [a.road, *roads[::-1]]

    def route(self, points: np.ndarray, method: str = ROUTE, places: list[list[Place]] | None = None) -> np.ndarray | None:
        """The line along roads through all points in order. ROUTE: each point is at its nearest road, legs are shortest. MATCH: places are
        chosen along the whole way, with the least sum of squared distances from the points and of detours. places: of the points, if they are known."""
        places = self.places_of(points, method) if places is None else places
        straight = kernels.haversine(points[:-1], points[1:])
        best: list[list[tuple[float, int, list[int]] | None]] = [[(p.off**2, -1, []) for p in places[0]]]
        for k in range(1, len(places)):
            most = 2 * float(straight[k - 1]) + 1.0
            reach = {r: self.reach(r, most) for r in {p.road for p in places[k - 1]}}
            row: list[tuple[float, int, list[int]] | None] = []
            for b in places[k]:
                ways = []
                for i, a in enumerate(places[k - 1]):
                    if best[-1][i] is not None and (leg := self.leg(a, b, reach[a.road])) is not None:
                        ways.append((best[-1][i][0] + b.off**2 + abs(leg[0] - float(straight[k - 1])), i, leg[1]))
                row.append(min(ways, key=lambda w: w[:2], default=None))
            best.append(row)
        ends = [(w[0], i) for i, w in enumerate(best[-1]) if w]
        if not ends:
            return None
        i, parts = min(ends)[1], []
        for k in range(len(places) - 1, 0, -1):
            _, before, roads = best[k][i]
            a, b = places[k - 1][before], places[k][i]
            if len(roads) == 1:
                parts.append(self.part(roads[0], a.km, b.km))
            else:
                whole = [self.part(roads[0], a.km, self.km[roads[0]]), *(self.lines[r] for r in roads[1:-1]), self.part(roads[-1], 0.0, b.km)]
                parts.append(np.concatenate(whole))
            i = before
        line = kernels.without_repeats(np.concatenate(parts[::-1]).round(9))
        return line if len(line) > 1 else None


def waypoints(line: np.ndarray, n: int) -> np.ndarray:
    """H5: n points at equal distances along the line, from its start, and its last."""
    total, km = kernels.length(line), kernels.along(line)
    at = total * np.arange(n) / n
    return np.concatenate([np.stack([np.interp(at, km, line[:, d]) for d in (0, 1)], axis=1), line[-1:]])


def length_error(line: np.ndarray, other: np.ndarray | None) -> float:
    return abs(kernels.length(line) - (kernels.length(other) if other is not None else 0.0)) / max(kernels.length(line), 1e-12)


def by_distance(line: np.ndarray, roads: Roads, method: str) -> list[np.ndarray]:
    """H5: routes through ten to four waypoints whose length differs by five hundredths at most, the nearest in length first."""
    found = []
    for way in roads.routes([waypoints(line, n) for n in range(WAYPOINTS[0], WAYPOINTS[1] - 1, -1)], method):
        if way is None:
            return []
        if (error := length_error(line, way)) <= LENGTH_ERROR:
            found.append((error, len(found), way))
    return [way for _, _, way in sorted(found, key=lambda x: x[:2])]


def slices(line: np.ndarray) -> list[np.ndarray]:
    """H6: the smooth parts of a line, neighbouring parts together, and chunks of those that are long; a short last chunk also at full length."""
    parts = kernels.smooth_parts(line)
    parts += [np.concatenate([a, b]) for a, b in zip(parts[:-1], parts[1:], strict=True)]
    out = list(parts)
    for part in parts:
        cut = kernels.chunks(part, CHUNK_KM)
        if len(cut) > 1:
            out += cut
            if kernels.length(cut[-1]) < LAST_KM:
                total = kernels.length(part)
                out.append(kernels.slice_along(part, total - CHUNK_KM, total))
    return out


def by_bearing(line: np.ndarray, roads: Roads, method: str, compat: bool = False) -> list[np.ndarray]:
    """H6: the route along each slice if its length and form are near the slice's, else the slice itself; each line once.

    compat: every route that was found, near or not, as the choice between route and slice isn't kept.
    """
    out: list[np.ndarray] = []
    parts = [kernels.without_repeats(part) for part in slices(line)]
    ways = roads.routes([part for part in parts if len(part) > 1], method)
    for part in parts:
        way = next(ways) if len(part) > 1 else None
        near = way is not None and length_error(part, way) <= LENGTH_ERROR and kernels.dissimilarity(part, way) <= DISSIMILARITY
        pick = way if near or compat else part
        if pick is not None and len(pick) > 1 and not any(np.array_equal(pick, x) for x in out):
            out.append(pick)
    return out


def graph(lines: list[np.ndarray]) -> Roads | None:
    """The roads that a route can go along; None if there are none."""
    lines = [x for x in lines if len(x) > 1 and math.isfinite(float(x.sum()))]
    return Roads(lines) if lines else None


def led(line: np.ndarray, roads: Roads | None, method: str, slicing: str, compat: bool = False) -> list[np.ndarray]:
    """Lines along roads that stand in for a feature."""
    if roads is None or len(line) < 2:
        return []
    return by_distance(line, roads, method) if slicing == DISTANCE else by_bearing(line, roads, method, compat)


def assisted(line: np.ndarray, lines: list[np.ndarray], method: str, slicing: str, compat: bool = False) -> list[np.ndarray]:
    """``led`` along roads that are used once."""
    return led(line, graph(lines), method, slicing, compat)
