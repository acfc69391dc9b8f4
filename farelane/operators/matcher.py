"""A geometric matcher (H1, H2, H4-H6): road pieces that run along a network segment, and routed stand-ins for segments it can't match.

Matches made by another matcher can be given instead (see pipeline.gtfs_osm_network). This deterministic one makes them from the road map
itself: roads that share a grid cell with a segment are cut to the parts within ``TUBE_M`` of it that run in its direction. Segments
that stay unmatched are led along the roads near them (functions/routes) and matched again, pass by pass.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import prepare
from ..functions import geo, kernels, routes
from . import matches
from .network import flat, line_of, zipped

TUBE_M, LEAST_KM, MOST_DEGREES = 20.0, 0.01, 60.0
#: Roads this near a segment are there for routes in its stead.
AROUND_KM = 0.3
#: Segments that go with a road, or with the roads around them, at once.
AT_A_ROAD, AT_ROADS = 1000, 250
KEY = ["shape_id", "shape_index"]
MATCHES = "shape_id string, shape_index int, shst_reference string, section_start double, section_end double, feature_len_km double, x array<double>, y array<double>"


def heading(line: np.ndarray) -> np.ndarray:
    d = kernels.flat(line[-1], line[0])
    return d / max(math.hypot(*d), 1e-12)


def pieces(segment: np.ndarray, road: np.ndarray | kernels.Located, tube_m: float = TUBE_M) -> list[tuple[float, float, np.ndarray]]:
    """(start km, end km, line) of the road's parts along the segment."""
    out = []
    road = road if isinstance(road, kernels.Located) else kernels.Located(road)
    for a, b in kernels.covered(road, segment, tube_m / 1000 / kernels.DEGREE_KM):
        part = kernels.slice_along(road.line, a, b, road.km)
        if b - a < LEAST_KM or len(part) < 2:
            continue
        at = sorted(kernels.nearest_on_line(segment, p)[1] for p in (part[0], part[-1]))
        beside = kernels.slice_along(segment, *at)
        if at[1] - at[0] > 0 and heading(part) @ heading(beside) >= math.cos(math.radians(MOST_DEGREES)):
            out.append((a, b, part))
    return out


def near(features: DataFrame, roads: DataFrame, pad_km: float) -> DataFrame:
    """Pairs of rows (number n of features, road of roads) that share a grid cell."""
    a = features.select("n", F.explode(geo.cells(F.col("coords"), pad_km)).alias("cell"))
    b = roads.select("road", F.explode(geo.cells(F.col("coords"), 0.0)).alias("cell"))
    return a.join(b, "cell").select("n", "road").distinct()


def numbered_roads(roads: DataFrame) -> DataFrame:
    """A reference may have several map segments; each is a road of its own."""
    return roads.select(F.xxhash64("shst_reference", "coords").alias("road"), F.col("shst_reference").cast("string").alias("shst_reference"), "coords").dropDuplicates(["road"])


def preprocessed(segments: DataFrame, compat: bool = False) -> DataFrame:
    """H2: segments beyond two kilometres in equal parts that meet; parts of few points get midpoints. compat: the whole segment once for each part (Q16)."""
    prepare(segments.sparkSession)

    def cut(batches):
        for b in batches:
            rows = []
            for i, k, x, y in zip(b["shape_id"], b["shape_index"], b["c_x"], b["c_y"], strict=True):
                line = line_of(x, y)
                for part in parts_of(line, compat):
                    rows.append((i, k, part[:, 0], part[:, 1]))
            yield pd.DataFrame(rows, columns=[*KEY, "x", "y"])

    out = segments.select(F.col("shape_id").cast("string").alias("shape_id"), F.col("shape_index").cast("int").alias("shape_index"), *flat("c")).mapInPandas(cut, "shape_id string, shape_index int, x array<double>, y array<double>")
    return out.select(*KEY, zipped("x", "y").alias("coords"))


def parts_of(line: np.ndarray, compat: bool = False) -> list[np.ndarray]:
    total = kernels.length(line)
    n = math.ceil(total / matches.PRESPLIT_KM)
    if n < 2:
        return [line]
    out: list[np.ndarray] = []
    for i in range(n):
        part = kernels.slice_along(line, total * i / n, total * (i + 1) / n)
        if out and not compat:
            part[0] = out[-1][-1]
        whole = line if compat else part
        out.append(kernels.denser(whole) if len(part) < matches.FEW_POINTS else whole)
    return out


def spread_out(rows: DataFrame) -> DataFrame:
    """Few rows with much work each, over as many tasks as a shuffle has."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def match(segments: DataFrame, roads: DataFrame) -> DataFrame:
    """Matches of segments (shape_id, shape_index, coords; several lines for one segment are matched each) and roads (shst_reference, coords); ids follow the key's hash."""
    prepare(segments.sparkSession)
    lines = segments.select(F.col("shape_id").cast("string").alias("shape_id"), F.col("shape_index").cast("int").alias("shape_index"), "coords", F.xxhash64("shape_id", "shape_index", "coords").alias("n")).dropDuplicates(["n"])
    roads = numbered_roads(roads)
    pairs = near(lines, roads, TUBE_M / 1000)
    # a long road is near many segments: it goes to Python once with many of them, not once with each
    parts = pairs.groupBy("road").agg(F.ceil(F.count("*") / AT_A_ROAD).alias("parts"))
    rows = pairs.join(lines.select("n", *KEY, *flat("s")), "n").join(parts, "road")
    rows = rows.groupBy("road", F.pmod(F.xxhash64("n"), F.col("parts")).alias("part")).agg(F.collect_list(F.struct(*KEY, "s_x", "s_y")).alias("beside"))
    rows = rows.join(roads.select("road", "shst_reference", *flat("r")), "road")

    def cut(batches):
        for b in batches:
            for ref, rx, ry, beside in zip(b["shst_reference"], b["r_x"], b["r_y"], b["beside"], strict=True):
                road = kernels.Located(line_of(rx, ry))
                out = [
                    (s["shape_id"], s["shape_index"], ref, p * 1000, q * 1000, q - p, part[:, 0], part[:, 1])
                    for s in beside
                    for p, q, part in pieces(line_of(s["s_x"], s["s_y"]), road)
                ]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in MATCHES.split(", ")])

    found = spread_out(rows.select("shst_reference", "r_x", "r_y", "beside")).mapInPandas(cut, MATCHES).withColumn("coords", zipped("x", "y")).drop("x", "y")
    found = found.dropDuplicates([*KEY, "shst_reference", "section_start", "section_end"])
    number = F.xxhash64(*KEY, "shst_reference", "section_start", "section_end").bitwiseAND(2**53 - 1)
    return found.select(number.alias("id"), "*", F.lit(False).alias("osrm_assisted"))


def led_along_roads(segments: DataFrame, roads: DataFrame, method: str, slicing: str, compat: bool = False) -> DataFrame:
    """H5, H6: shape_id, shape_index, coords: lines along the roads near each segment that stand in for it."""
    prepare(segments.sparkSession)
    lines = segments.select(F.col("shape_id").cast("string").alias("shape_id"), F.col("shape_index").cast("int").alias("shape_index"), "coords", F.xxhash64("shape_id", "shape_index").alias("n"))
    roads = numbered_roads(roads)
    # segments with the same roads around them go to Python together, with these roads once
    around = near(lines, roads, AROUND_KM).groupBy("n").agg(F.sort_array(F.collect_list("road")).alias("roads"))
    rows = lines.join(around.withColumn("set", F.xxhash64("roads")), "n").checkpoint()
    sets = rows.groupBy("set").agg(F.first("roads").alias("roads"), F.ceil(F.count("*") / AT_ROADS).alias("parts"))
    lying = sets.select("set", F.explode("roads").alias("road")).join(roads.select("road", *flat("r")), "road")
    lying = lying.groupBy("set").agg(F.sort_array(F.collect_list(F.struct("road", "r_x", "r_y"))).alias("lying"))
    rows = rows.join(sets.select("set", "parts"), "set").groupBy("set", F.pmod(F.xxhash64("n"), F.col("parts")).alias("part")).agg(F.collect_list(F.struct(*KEY, *flat("c"))).alias("beside"))
    rows = spread_out(rows.join(lying, "set").select("beside", F.transform("lying", lambda r: r["r_x"]).alias("r_x"), F.transform("lying", lambda r: r["r_y"]).alias("r_y")))

    def lead(batches):
        for b in batches:
            for beside, rx, ry in zip(b["beside"], b["r_x"], b["r_y"], strict=True):
                along = routes.graph([line_of(p, q) for p, q in zip(rx, ry, strict=True)])
                out = [(s["shape_id"], s["shape_index"], way[:, 0], way[:, 1]) for s in beside for way in routes.led(line_of(s["c_x"], s["c_y"]), along, method, slicing, compat)]
                yield pd.DataFrame(out, columns=[*KEY, "x", "y"])

    return rows.mapInPandas(lead, "shape_id string, shape_index int, x array<double>, y array<double>").select(*KEY, zipped("x", "y").alias("coords"))


def assisted(segments: DataFrame, roads: DataFrame, method: str, slicing: str, compat: bool = False) -> DataFrame:
    """Matches of the lines that stand in for segments, tagged with how they came about."""
    lines = preprocessed(led_along_roads(segments, roads, method, slicing, compat), compat).checkpoint()  # routes are made once for all that match does with them
    found = match(lines, roads)
    return found.withColumn("osrm_assisted", F.lit(True)).withColumn("osrm_method", F.lit(method)).withColumn("line_slice_method", F.lit(slicing))


def passes(roads: DataFrame, compat: bool = False) -> list:
    """H4: the plain matcher, then the four kinds of assistance (compat, Q16: two of them, each twice)."""
    kinds = [(m, s) for m in (routes.ROUTE, routes.MATCH) for s in (routes.DISTANCE, routes.BEARING)]
    if compat:
        kinds = [(routes.ROUTE, routes.DISTANCE)] * 2 + [(routes.MATCH, routes.BEARING)] * 2
    none = F.lit(None).cast("string")

    def plain(left: DataFrame) -> DataFrame:
        return match(preprocessed(left, compat), roads).withColumn("osrm_method", none).withColumn("line_slice_method", none)

    return [("plain", plain), *((f"{m} {s}", partial(assisted, roads=roads, method=m, slicing=s, compat=compat)) for m, s in kinds)]


def matched(segments: DataFrame, roads: DataFrame, compat: bool = False) -> DataFrame:
    """H1-H6: all matches of segments (shape_id, shape_index, coords, len_km)."""
    found = matches.ladder(matches.matchable(segments), passes(roads, compat), [*KEY, "shst_reference", "section_start", "section_end"])
    return matches.without_redundant(found.withColumn("vertices", F.col("coords"))).drop("vertices")
