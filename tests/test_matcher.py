import time

import numpy as np
from pyspark.sql import functions as F

from farelane.functions import kernels, routes
from farelane.operators import mapjoin, matcher, matches
from farelane.operators.network import as_coords, as_line

ROAD = np.array([(0, 0), (0.01, 0), (0.02, 0)])


def frame(spark, rows, names):
    return spark.createDataFrame(rows, f"{names}, coords array<struct<lon:double,lat:double>>")


def test_pieces():
    along = np.array([(0.005, 0.0001), (0.015, 0.0001)])
    ((a, b, part),) = matcher.pieces(along, ROAD)
    assert abs(a - kernels.length(ROAD) / 4) < 0.03 and abs(b - a - kernels.length(along)) < 0.05
    assert matcher.pieces(along[::-1], ROAD) == []  # the other direction
    assert matcher.pieces(along + [0, 0.001], ROAD) == []  # a hundred metres off
    assert matcher.pieces(np.array([(0.01, -0.01), (0.01, 0.01)]), ROAD) == []  # a crossing


def test_match(spark):
    seg = frame(spark, [("s", 0, as_coords(np.array([(0.001, 0.00005), (0.012, 0.00005)])))], "shape_id string, shape_index int")
    roads = frame(spark, [("r1", as_coords(ROAD[:2])), ("r2", as_coords(ROAD[1:])), ("far", as_coords(ROAD + 1))], "shst_reference string")
    got = matcher.match(seg, roads).orderBy("shst_reference").collect()
    assert [r["shst_reference"] for r in got] == ["r1", "r2"] and len({r["id"] for r in got}) == 2
    assert all(abs(kernels.length(as_line(r["coords"])) - r["feature_len_km"]) < 1e-6 for r in got)


def test_within(spark):
    area = frame(spark, [("a", as_coords(np.array([(0.005, -0.01), (0.005, 0.01)])))], "name string")
    roads = frame(spark, [(1, as_coords(ROAD)), (2, as_coords(ROAD + [0, 0.5])), (3, as_coords(ROAD + [0.0052, 0])), (4, as_coords(ROAD + [0.00503, 0]))], "id long")
    assert {r["id"] for r in mapjoin.within(roads, area).collect()} == {1, 4}


def test_sliced(spark):
    join = spark.createDataFrame([("s", 0, 1, 0.3, 0.2, 0), ("s", 0, 1, 0.004, 0.0, 1)], "shape_id string, shape_index int, conflation_map_id long, conf_map_pre_len double, conf_map_post_len double, along_idx int")
    road = frame(spark, [(1, as_coords(ROAD))], "id long")
    got = {r["along_idx"]: kernels.length(as_line(r["coords"])) for r in mapjoin.sliced(join, road).collect()}
    assert abs(got[0] - kernels.length(ROAD) + 0.5) < 1e-4 and abs(got[1] - kernels.length(ROAD)) < 1e-9


def test_presplit(spark):
    long = np.array([(0, 0), (0.05, 0)])
    rows = matches.presplit(frame(spark, [("s", as_coords(long)), ("t", as_coords(long / 10))], "shape_id string")).collect()
    parts = [r for r in rows if r["shape_id"] == "s"]
    assert len(parts) == 3 and abs(max(r["stop_km"] for r in parts) - kernels.length(long)) < 1e-6 and len(rows) == 4 and all(r["make_dense"] for r in rows)


def test_parts_meet_and_get_midpoints():
    line = np.array([(0, 0), (0.03, 0), (0.05, 0)])
    parts = matcher.parts_of(line)
    assert len(parts) == 3 and all((a[-1] == b[0]).all() for a, b in zip(parts[:-1], parts[1:], strict=True)) and all(len(p) in (3, 5) for p in parts)
    assert matcher.parts_of(line / 10)[0] is not None and len(matcher.parts_of(line / 10)) == 1
    assert [len(p) for p in matcher.parts_of(line, compat=True)] == [5, 5, 5]  # Q16


def test_matchable(spark):
    rows = [("s", 0, as_coords(ROAD)), ("s", 1, [])]
    assert matches.matchable(frame(spark, rows, "shape_id string, shape_index int")).count() == 1
    import pytest

    with pytest.raises(Exception, match="no id"):
        matches.matchable(frame(spark, [*rows, (None, 2, as_coords(ROAD))], "shape_id string, shape_index int")).collect()


def test_polygons(spark):
    ring = np.array([(0, 0), (0.02, 0), (0.02, 0.02), (0, 0.02), (0, 0)])
    areas = frame(spark, [("a", as_coords(ring))], "name string")
    roads = frame(spark, [(1, as_coords(np.array([(0.009, 0.009), (0.0091, 0.0092)]))), (2, as_coords(np.array([(0.03, 0.03), (0.04, 0.03)]))), (3, as_coords(np.array([(-0.01, 0.01), (0.03, 0.01)])))], "id long")
    assert {r["id"] for r in mapjoin.within(roads, areas).collect()} == {1, 3}


def test_matches_of_a_segment_off_the_roads_come_from_routes(spark):
    """A street 30 m beside the segment is out of the plain matcher's reach; the route along it is matched in the segment's stead."""
    near, far = ROAD + [0, 0.0001], ROAD + [0, 0.00027]
    seg = frame(spark, [("s", 0, as_coords(near[:2])), ("s", 1, as_coords(far[:2] + [0, 0.2]))], "shape_id string, shape_index int").withColumn("len_km", F.lit(kernels.length(near[:2])))
    roads = frame(spark, [("r0", as_coords(ROAD[:2])), ("r1", as_coords(ROAD[:2] + [0, 0.2]))], "shst_reference string")
    got = {r["shape_index"]: r for r in matcher.matched(seg, roads).collect()}
    assert not got[0]["osrm_assisted"] and got[0]["matcher"] == "plain" and got[0]["shst_reference"] == "r0"
    assert got[1]["osrm_assisted"] and got[1]["osrm_method"] == "ROUTE" and got[1]["line_slice_method"] == "DISTANCE_SLICE_METHOD" and got[1]["shst_reference"] == "r1"


def test_a_long_road_beside_many_segments(spark):
    """Before, each segment's row held the road, and the road's cells took the square of its points."""
    line = np.array([(-73.9 + i * 2e-3, 42.6 + i % 5 * 3e-4) for i in range(20_000)])
    s = frame(spark, [("a", i, as_coords(line[3 * i : 3 * i + 4])) for i in range(6000)], "shape_id string, shape_index int")
    began = time.time()
    got = {(r["shape_index"], round(r["section_start"]), round(r["section_end"])) for r in matcher.match(s, frame(spark, [("r", as_coords(line))], "shst_reference string")).collect()}
    assert time.time() - began < 100
    want = {(i, round(p * 1000), round(q * 1000)) for i in range(0, 6000, 600) for p, q, _ in matcher.pieces(line[3 * i : 3 * i + 4], line)}
    assert {x for x in got if x[0] % 600 == 0} == want and len({x[0] for x in got}) == 6000


def test_pieces_of_a_located_road():
    road = np.array([(-73.9 + i * 1e-3, 42.6 + i % 3 * 1e-3) for i in range(500)])
    for i in (0, 100, 400):
        a, b = (matcher.pieces(road[i : i + 4] + [1e-5, 5e-5], r) for r in (road, kernels.Located(road)))
        assert len(a) == len(b) > 0 and all(x[:2] == y[:2] and (x[2] == y[2]).all() for x, y in zip(a, b, strict=True))


def test_many_segments_beside_long_roads_are_led_along_them(spark):
    """Before, each segment's row held all of the roads near it, and each point was held against all of their points."""
    line = np.array([(-73.9 + i * 2e-3, 42.6 + i % 5 * 3e-4) for i in range(20_000)])
    s = frame(spark, [("a", i, as_coords(line[6 * i : 6 * i + 4] + [6e-4, 0])) for i in range(3000)], "shape_id string, shape_index int")
    roads = frame(spark, [("r", as_coords(line)), ("q", as_coords(line[::-1] + [0, 2e-3]))], "shst_reference string")
    began = time.time()
    got = matcher.led_along_roads(s, roads, routes.MATCH, routes.DISTANCE).filter("shape_index % 300 = 7").collect()
    assert time.time() - began < 60
    lines = [as_line(r["coords"]) for r in matcher.numbered_roads(roads).orderBy("road").collect()]
    for i in range(7, 3000, 300):
        want = routes.assisted(line[6 * i : 6 * i + 4] + [6e-4, 0], lines, routes.MATCH, routes.DISTANCE)
        assert want and sorted(as_line(r["coords"]).tolist() for r in got if r["shape_index"] == i) == sorted(x.tolist() for x in want)
