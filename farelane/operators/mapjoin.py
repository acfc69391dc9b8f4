"""Matches and the road map: overlap of candidate pairs and order along the shape."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import prepare
from ..functions import geo, kernels
from .matches import candidates, shape_map_path
from .network import COORDS, as_coords, as_line, flat, line_of, zipped

LEAST_KM = 0.001
COSPATIAL = "conflation_map_id long, gtfs_matches_id long, intersection_len double, conf_map_seg_len double, conf_map_pre_len double, conf_map_post_len double, gtfs_map_seg_len double, gtfs_map_pre_len double, gtfs_map_post_len double"


def cospatiality(conflation_map: DataFrame, matches: DataFrame, paths: DataFrame) -> DataFrame:
    """Overlaps beyond a metre of map segments and chosen matches that share a reference.

    Pairs are made distinct before the kernel (Q23) and spread evenly, so a reference with many matches doesn't stay in one task.
    """
    pairs = candidates(paths, matches, conflation_map).select("conflation_map_id", "gtfs_matches_id")
    rows = pairs.join(conflation_map.select(F.col("id").alias("conflation_map_id"), *flat("s")), "conflation_map_id")
    rows = rows.join(matches.select(F.col("id").alias("gtfs_matches_id"), *flat("t")), "gtfs_matches_id")

    prepare(rows.sparkSession)

    def overlap(batches):
        for b in batches:
            out = []
            for i, j, sx, sy, tx, ty in zip(b["conflation_map_id"], b["gtfs_matches_id"], b["s_x"], b["s_y"], b["t_x"], b["t_y"], strict=True):
                x = kernels.overlap_offsets(line_of(sx, sy), line_of(tx, ty))
                if x and x[0] > LEAST_KM:
                    out.append((i, j, *x))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in COSPATIAL.split(", ")])

    return rows.select("conflation_map_id", "gtfs_matches_id", "s_x", "s_y", "t_x", "t_y").hint("rebalance").mapInPandas(overlap, COSPATIAL)


def conflation_join(conflation_map: DataFrame, matches: DataFrame, paths: DataFrame) -> DataFrame:
    """shape_id, shape_index, conflation_map_id, conf_map_pre_len, conf_map_post_len, along_idx."""
    return shape_map_path(paths, cospatiality(conflation_map, matches, paths))


def sliced(join: DataFrame, conflation_map: DataFrame) -> DataFrame:
    """Each joined map segment without its overhangs, if they pass five metres: adds coords."""
    rows = join.join(conflation_map.select(F.col("id").alias("conflation_map_id"), "coords"), "conflation_map_id")
    names = rows.columns

    prepare(rows.sparkSession)

    def cut(batches):
        for b in batches:
            new = []
            for pre, post, coords in zip(b["conf_map_pre_len"], b["conf_map_post_len"], b["coords"], strict=True):
                line = as_line(coords)
                new.append(as_coords(kernels.slice_along(line, pre, kernels.length(line) - post) if pre > 0.005 or post > 0.005 else line))
            yield b.assign(coords=new)[names]

    return rows.mapInPandas(cut, rows.schema)


def slices(lines: DataFrame, key: str, start: float, stop: float) -> DataFrame:
    """Of each line the part between two shares of its length: key, coords."""
    prepare(lines.sparkSession)

    def cut(batches):
        for b in batches:
            rows = []
            for k, x, y in zip(b["key"], b["c_x"], b["c_y"], strict=True):
                line = line_of(x, y)
                part = kernels.slice_along(line, kernels.length(line) * start, kernels.length(line) * stop)
                rows.append((k, part[:, 0], part[:, 1]))
            yield pd.DataFrame(rows, columns=["key", "x", "y"])

    kind = lines.schema[key].dataType.simpleString()
    out = lines.select(F.col(key).alias("key"), *flat("c")).mapInPandas(cut, f"key {kind}, x array<double>, y array<double>")
    return out.select(F.col("key").alias(key), zipped("x", "y").alias("coords"))


def within(conflation_map: DataFrame, areas: DataFrame, pad_km: float = 0.005) -> DataFrame:
    """Ids of map segments that come within pad_km of an area: equi-join on grid cells, then the exact distance.

    An area whose first and last coordinates are equal is a polygon, and what lies within it is near it; another one is a line.
    """
    areas = areas.select(F.xxhash64("coords").alias("area"), "coords").dropDuplicates(["area"])
    a = conflation_map.select("id", F.explode(geo.cells(F.col("coords"), 0.0)).alias("cell"))
    b = areas.select("area", F.explode(geo.cells(F.col("coords"), pad_km)).alias("cell"))
    rows = a.join(b, "cell").select("id", "area").distinct()
    rows = rows.join(conflation_map.select("id", *flat("s")), "id").join(areas.select("area", *flat("t")), "area")

    prepare(rows.sparkSession)

    def near(batches):
        for x in batches:
            keep = []
            for sx, sy, tx, ty in zip(x["s_x"], x["s_y"], x["t_x"], x["t_y"], strict=True):
                line, area = line_of(sx, sy), line_of(tx, ty)
                ring = len(area) > 3 and (area[0] == area[-1]).all()
                keep.append(bool(ring and kernels.inside(area, line[:1])[0]) or kernels.gap_km(line, area) <= pad_km)
            yield x.loc[keep, ["id"]]

    return rows.mapInPandas(near, "id long").distinct()


__all__ = ["COORDS", "conflation_join", "cospatiality", "sliced", "within"]
