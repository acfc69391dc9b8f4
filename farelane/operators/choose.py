"""Choosing consistent chains of matches for a shape's segments (G5-G12, U7), one shape to a group.

A shape's matches are a handful for each segment, so a shape is solved in one grouped call; shapes are independent.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import prepare
from ..functions import kernels
from .network import as_line

#: (first, last) values of the thresholds that are loosened by the square root of two: least length, most relative length error, most gap.
LENGTH_KM, LENGTH_ERROR, GAP_KM = (0.1, 0.01), (0.005, 0.05), (0.0005, 0.002)
OVERLAP_KM = MERGE_KM = 0.002
PATHS = "shape_id string, shape_index int, path_index int, path_edge_index int, shst_match_id long, shst_reference string, shst_ref_start double, shst_ref_end double"


@dataclass
class Path:
    ids: tuple[int, ...]
    line: np.ndarray

    @property
    def km(self) -> float:
        return kernels.length(self.line)


def graph(segment: np.ndarray, matches: dict[int, np.ndarray]) -> dict[tuple, list[tuple[tuple, float, int]]]:
    """From each match's first coordinate to its last; weight: length times root mean square deviation. Of parallel edges the lighter stays."""
    edges: dict[tuple, dict[tuple, tuple[float, int]]] = {}
    for i, line in sorted(matches.items()):
        line = kernels.without_repeats(line)
        if len(line) < 2:
            continue
        a, b = tuple(line[0]), tuple(line[-1])
        w = kernels.length(line) * kernels.rms_deviation_m(segment, line)
        to = edges.setdefault(a, {})
        if b not in to or w < to[b][0]:
            to[b] = (w, i)
        edges.setdefault(b, {})
    return {a: [(b, w, i) for b, (w, i) in to.items()] for a, to in edges.items()}


def components(g: dict) -> list[set]:
    near: dict = {a: set() for a in g}
    for a, out in g.items():
        for b, _, _ in out:
            near[a].add(b)
            near[b].add(a)
    seen, out = set(), []
    for a in sorted(g):
        if a not in seen:
            part, todo = set(), [a]
            while todo:
                x = todo.pop()
                if x not in part:
                    part.add(x)
                    todo += near[x] - part
            seen |= part
            out.append(part)
    return out


def shortest(g: dict, source: tuple) -> dict[tuple, list[int]]:
    """Match ids on the lightest way from a node to every node it reaches."""
    best, done, heap = {source: (0.0, [])}, set(), [(0.0, 0, source)]
    n = 0
    while heap:
        w, _, a = heapq.heappop(heap)
        if a in done:
            continue
        done.add(a)
        for b, more, i in g[a]:
            if b not in best or w + more < best[b][0]:
                best[b] = (w + more, [*best[a][1], i])
                n += 1
                heapq.heappush(heap, (w + more, n, b))
    return {b: ids for b, (_, ids) in best.items()}


def source_sink_paths(segment: np.ndarray, matches: dict[int, np.ndarray]) -> list[Path]:
    """In each component the lightest path from every source to every sink; a component that is one cycle has none."""
    g = graph(segment, matches)
    entered = {b for out in g.values() for b, _, _ in out}
    paths = []
    for part in components(g):
        for source in sorted(a for a in part if a not in entered):
            ways = shortest(g, source)
            paths += [as_path(ways[sink], matches) for sink in sorted(a for a in part if not g[a]) if ways.get(sink)]
    return paths


def as_path(ids: list[int], matches: dict[int, np.ndarray]) -> Path:
    line = np.concatenate([matches[i] for i in ids])
    return Path(tuple(ids), kernels.without_repeats(line))


def merged(paths: list[Path], matches: dict[int, np.ndarray]) -> list[Path]:
    """Unions paths until nothing changes, then drops those whose matches another one holds.

    Two paths become one if one ends within two metres of the other's start, or if the matches at one's end are those at the other's
    start; never if another match would occur twice.
    """
    held = {p.ids: p for p in paths}
    made = set(held)
    fresh = sorted(held)
    while fresh:  # each pair is looked at once, when the later of the two comes up
        new = []
        for p in fresh:
            for q in sorted(held):
                for ids in (union_of(held[p], held[q]), union_of(held[q], held[p])) if p in held else ():
                    if ids and ids not in made:
                        made.add(ids)
                        held[ids] = as_path(list(ids), matches)
                        new.append(ids)
        drop_subsets(held)
        fresh = sorted(x for x in new if x in held)
    return [held[ids] for ids in sorted(held)]


def union_of(p: Path, q: Path) -> tuple[int, ...] | None:
    if p.ids == q.ids:
        return None
    shared = set(p.ids) & set(q.ids)
    if not shared:
        meets = float(kernels.haversine(p.line[-1], q.line[0])) <= MERGE_KM
        closes = float(kernels.haversine(q.line[-1], p.line[0])) <= MERGE_KM
        return p.ids + q.ids if meets and not closes else None
    n = len(shared)
    return p.ids + q.ids[n:] if p.ids[-n:] == q.ids[:n] and n < len(q.ids) and n < len(p.ids) else None


def drop_subsets(held: dict[tuple, Path]) -> None:
    sets = {ids: set(ids) for ids in held}
    for ids in sorted(held, key=lambda x: (len(x), x)):
        if any(sets[ids] <= sets[o] for o in held if o != ids):
            del held[ids]


def gap(a: Path, b: Path) -> float:
    return float(kernels.haversine(a.line[-1], b.line[0]))


def axiomatic(chosen: list, candidates: list[list[Path]], lengths: list[float], least: float, error: float, most_gap: float) -> bool:
    """Gives a path to each open segment for which exactly one passes; neighbours are those chosen before this pass."""
    before = list(chosen)
    progress = False
    for i, paths in enumerate(candidates):
        if before[i] is not None or not paths:
            continue
        left = before[i - 1] if i else None
        right = before[i + 1] if i + 1 < len(before) else None
        fit = [
            p
            for p in paths
            if p.km >= least and abs(lengths[i] - p.km) / max(lengths[i], 1e-12) <= error and not (left and gap(left[-1], p) > most_gap) and not (right and gap(p, right[0]) > most_gap)
        ]
        if len(fit) == 1:
            chosen[i], progress = fit, True
    return progress


def conflict(p: Path, q: Path) -> bool:
    found = kernels.cospatiality(p.line, q.line)
    return max(sum(x["s_end"] - x["s_start"] for x in found), sum(x["t_end"] - x["t_start"] for x in found)) > OVERLAP_KM if found else False


def longest_compatible(paths: list[Path]) -> list[Path]:
    """Paths without conflicts of the greatest total length; the first found wins ties.

    Paths that no chain of conflicts joins are decided apart, so the search is exponential only in the largest such group.
    """
    n = len(paths)
    against: list[set[int]] = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i + 1, n):
            if conflict(paths[i], paths[j]):
                against[i].add(j)
                against[j].add(i)
    km, left, out = [p.km for p in paths], set(range(n)), []
    while left:
        group, todo = set(), [min(left)]
        while todo:
            if (i := todo.pop()) not in group:
                group.add(i)
                todo += against[i] - group
        left -= group
        out += heaviest(sorted(group), km, against)
    return [paths[i] for i in sorted(out)]


def heaviest(group: list[int], km: list[float], against: list[set[int]]) -> list[int]:
    """Of a group of paths those without conflicts of the greatest total length: branch and bound with a stack."""
    rest = np.append(np.cumsum([km[i] for i in group][::-1])[::-1], 0.0)
    best: tuple[float, list[int]] = (-math.inf, [])
    stack: list[tuple[int, float, tuple, frozenset]] = [(0, 0.0, (), frozenset())]  # next place, total, taken, barred
    while stack:
        at, total, taken, barred = stack.pop()
        if total + rest[at] <= best[0]:
            continue
        if at == len(group):
            best = (total, unwound(taken))
            continue
        i = group[at]
        stack.append((at + 1, total, taken, barred))
        if i not in barred:
            stack.append((at + 1, total + km[i], (i, taken), barred | against[i]))  # looked at first
    return best[1]


def unwound(taken: tuple) -> list[int]:
    out = []
    while taken:
        i, taken = taken
        out.append(i)
    return out[::-1]


def choose(segments: list[np.ndarray], matches: list[dict[int, np.ndarray]]) -> list[list[Path]]:
    """The chosen paths of each segment, in order."""
    candidates = [merged(source_sink_paths(s, m), m) if m else [] for s, m in zip(segments, matches, strict=True)]
    lengths = [kernels.length(s) for s in segments]
    chosen: list = [None] * len(segments)
    least, error, most_gap = LENGTH_KM[0], LENGTH_ERROR[0], GAP_KM[0]
    while any(c is None for c in chosen):
        if axiomatic(chosen, candidates, lengths, least, error, most_gap):
            continue
        if (least, error, most_gap) == (LENGTH_KM[1], LENGTH_ERROR[1], GAP_KM[1]):
            break
        least, error, most_gap = max(least / math.sqrt(2), LENGTH_KM[1]), min(error * math.sqrt(2), LENGTH_ERROR[1]), min(most_gap * math.sqrt(2), GAP_KM[1])
    for i, c in enumerate(chosen):
        if c is None:
            chosen[i] = candidates[i] if len(candidates[i]) < 2 else longest_compatible(candidates[i])
    return chosen


def chosen_paths(segments: DataFrame, matches: DataFrame) -> DataFrame:
    """A row for each match of each chosen path, from segments (shape_id, shape_index, coords) and matches (… id, coords, section_start, section_end)."""
    seg = segments.select(F.col("shape_id").cast("string").alias("shape_id"), "shape_index", F.col("coords").alias("line"))
    entry = F.struct("id", "shst_reference", "section_start", "section_end", "coords")
    of = matches.select(F.col("shape_id").cast("string").alias("shape_id"), "shape_index", entry.alias("m")).groupBy("shape_id", "shape_index").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    rows = seg.join(of, ["shape_id", "shape_index"], "left")

    prepare(rows.sparkSession)

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shape_index")
        about = [{int(m["id"]): m for m in (ms if ms is not None else [])} for ms in pdf["ms"]]
        lines = [{i: as_line(m["coords"]) for i, m in a.items()} for a in about]
        out = []
        for index, a, paths in zip(pdf["shape_index"], about, choose([as_line(c) for c in pdf["line"]], lines), strict=True):
            for p, path in enumerate(paths):
                out += [(key[0], int(index), p, e, i, str(a[i]["shst_reference"]), a[i]["section_start"], a[i]["section_end"]) for e, i in enumerate(path.ids)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in PATHS.split(", ")])

    return rows.groupBy("shape_id").applyInPandas(solve, PATHS)


def scores(segments: DataFrame, matches: DataFrame, paths: DataFrame, compat: bool = False) -> DataFrame:
    """Similarity of each segment with its chosen matches joined (compat: with all of its matches, the unchosen last)."""
    used = paths.select("shape_id", "shape_index", F.col("shst_match_id").alias("id"), "path_index", "path_edge_index")
    own = matches.select(F.col("shape_id").cast("string").alias("shape_id"), "shape_index", "id", "coords")
    rows = own.join(used, ["shape_id", "shape_index", "id"], "left" if compat else "inner")
    far = F.lit(2**31 - 1)
    entry = F.struct(F.coalesce("path_index", far).alias("p"), F.coalesce("path_edge_index", far).alias("e"), "id", "coords")
    lines = rows.groupBy("shape_id", "shape_index").agg(F.sort_array(F.collect_list(entry)).alias("ms"))
    both = segments.select(F.col("shape_id").cast("string").alias("shape_id"), "shape_index", F.col("coords").alias("line")).join(lines, ["shape_id", "shape_index"])

    prepare(both.sparkSession)

    def score(batches):
        for b in batches:
            values = []
            for line, ms in zip(b["line"], b["ms"], strict=True):
                whole = kernels.without_repeats(np.concatenate([as_line(m["coords"]) for m in ms]))
                values.append(kernels.shape_similarity(as_line(line), whole) if len(whole) > 1 else 0.0)
            yield b[["shape_id", "shape_index"]].assign(score=values)

    return both.mapInPandas(score, "shape_id string, shape_index int, score double")
