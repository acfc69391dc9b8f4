"""Every registered query against its SQL at the smallest size; those without SQL against plain loops over all rows."""

import itertools
import math
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.functions import geo, kernels
from farelane.operators import choose, mapjoin, matcher, matches, network, schedule
from farelane.operators.network import as_line
from farelane.plans import queries_map, registry
from farelane.plans.fixtures import relation
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLE_SQL:
        same(df, registry.ORACLE_SQL[name], SF)
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def tables(spark):
    return lambda name: relation(spark, SF, name)


def test_segments_against_a_plain_search(spark):
    """Each shape's segments cover its line, and the cuts at its stops are the cheapest that never go back."""
    got = defaultdict(list)
    for r in registry.QUERIES["shape_segments"](spark, SF).orderBy("shape_id", "shape_index").collect():
        got[r["shape_id"]].append(r)
    shapes = queries_map.shaped(tables(spark)).collect()
    assert {str(s["shape_id"]) for s in shapes} == set(got)
    for s in shapes:
        line, stops, mine = as_line(s["coords"]), as_line(s["stops"]), got[str(s["shape_id"])]
        assert all(np.allclose(as_line(a["coords"])[-1], as_line(b["coords"])[0]) for a, b in itertools.pairwise(mine))
        assert math.isclose(sum(r["len_km"] for r in mine), kernels.length(line), abs_tol=1e-3)
        at = {stop: r["start_dist"] for r in mine for stop in r["from_stop_ids"] if stop} | {stop: r["stop_dist"] for r in mine for stop in r["to_stop_ids"] if stop}
        dist, dev, _ = kernels.projections(line, stops)
        cost = [list(dev[0] ** 2)]  # over all pairs of segments of neighbouring stops
        for k in range(1, len(stops)):
            cost.append([min((cost[-1][i] for i in range(len(dist[0])) if dist[k - 1, i] <= dist[k, j]), default=math.inf) + dev[k, j] ** 2 for j in range(len(dist[0]))])
        chosen = [at[x["stop_id"]] for x in s["stops"]]
        assert all(a <= b for a, b in itertools.pairwise(chosen))
        off = [min(dev[k, j] for j in range(len(dist[0])) if abs(dist[k, j] - chosen[k]) < 1e-5) for k in range(len(stops))]
        assert sum(x * x for x in off) <= min(cost[-1]) + 1e-9


def test_chosen_paths_cover_their_segments(spark):
    s = {(r["shape_id"], r["shape_index"]): r["len_km"] for r in queries_map.network_of(tables(spark)).collect()}
    m = {r["id"]: r for r in queries_map.matched(queries_map.network_of(tables(spark))).collect()}
    paths = defaultdict(list)
    for r in registry.QUERIES["chosen_paths"](spark, SF).orderBy("path_edge_index").collect():
        paths[r["shape_id"], r["shape_index"], r["path_index"]].append(m[r["shst_match_id"]])
    with_matches = {(r["shape_id"], r["shape_index"]) for r in m.values()}
    assert {k[:2] for k in paths} == with_matches
    for key, edges in paths.items():
        lines = [as_line(e["coords"]) for e in edges]
        assert all((e["shape_id"], e["shape_index"]) == key[:2] for e in edges) and all((a[-1] == b[0]).all() for a, b in itertools.pairwise(lines))
        assert abs(sum(map(kernels.length, lines)) - s[key[:2]]) <= 0.005 * s[key[:2]]


def test_scores_against_the_kernel(spark):
    s = queries_map.network_of(tables(spark))
    m = {r["id"]: as_line(r["coords"]) for r in queries_map.matched(s).collect()}
    used = defaultdict(list)
    for r in choose.chosen_paths(s, queries_map.matched(s)).orderBy("path_index", "path_edge_index").collect():
        used[r["shape_id"], r["shape_index"]].append(m[r["shst_match_id"]])
    lines = {(r["shape_id"], r["shape_index"]): as_line(r["coords"]) for r in s.collect()}
    got = {(r["shape_id"], r["shape_index"]): r["score"] for r in registry.QUERIES["path_scores"](spark, SF).collect()}
    assert set(got) == set(used)
    for k, v in used.items():
        assert math.isclose(got[k], kernels.shape_similarity(lines[k], kernels.without_repeats(np.concatenate(v))), abs_tol=1e-9)


def test_map_join_against_all_pairs(spark):
    s = queries_map.network_of(tables(spark))
    m = {r["id"]: r for r in queries_map.matched(s).collect()}
    paths = choose.chosen_paths(s, queries_map.matched(s)).collect()
    roads = s.select(F.xxhash64("shape_id", "shape_index").bitwiseAND(2**53 - 1).alias("id"), F.concat_ws("/", "shape_id", "shape_index").alias("ref"), "coords").collect()
    want = []
    for group in {(p["shape_id"], p["shape_index"]) for p in paths}:
        rows = []
        for p in paths:
            for road in roads:
                if (p["shape_id"], p["shape_index"]) == group and road["ref"] == m[p["shst_match_id"]]["shst_reference"]:
                    x = kernels.overlap_offsets(as_line(road["coords"]), as_line(m[p["shst_match_id"]]["coords"]))
                    if x and x[0] > mapjoin.LEAST_KM:
                        rows.append((p["path_index"], p["path_edge_index"], x[5], road["id"]))
        want += [(*group, r[3], sum(o[:3] < r[:3] for o in rows)) for r in rows]
    got = [(r["shape_id"], r["shape_index"], r["conflation_map_id"], r["along_idx"]) for r in registry.QUERIES["cospatial_join"](spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 50


def test_matcher_against_all_pairs(spark):
    t = tables(spark)
    segments, roads = queries_map.network_of(t).collect(), queries_map.roads_of(t).collect()
    want = {
        (s["shape_id"], s["shape_index"], r["shst_reference"], round(a * 1000, 6), round(b * 1000, 6))
        for s in segments
        for r in roads
        for a, b, _ in matcher.pieces(as_line(s["coords"]), as_line(r["coords"]))
    }
    got = {(r["shape_id"], r["shape_index"], r["shst_reference"], round(r["section_start"], 6), round(r["section_end"], 6)) for r in registry.QUERIES["segment_matches"](spark, SF).collect()}
    assert got == want and want


def test_assisted_matches_lie_on_roads(spark):
    t = tables(spark)
    roads = {r["shst_reference"]: as_line(r["coords"]) for r in queries_map.roads_of(t).collect()}
    rows = registry.QUERIES["assisted_matches"](spark, SF).collect()
    assert any(r["osrm_assisted"] for r in rows)
    for r in rows:
        line, road = as_line(r["coords"]), roads[r["shst_reference"]]
        assert kernels.projections(road, line)[1].min(axis=1).max() < 1e-4 and math.isclose(kernels.length(line) * 1000, r["section_end"] - r["section_start"], abs_tol=0.01)
        assert r["osrm_assisted"] == (r["osrm_method"] is not None) == (r["line_slice_method"] is not None)


def test_network_lines_go_both_ways(spark):
    rows = queries_map.lines_of(tables(spark)).select("id", "coords", *network.flat("c"))
    assert all((network.line_of(r["c_x"], r["c_y"]) == as_line(r["coords"])).all() for r in rows.collect())
    assert rows.filter(network.zipped("c_x", "c_y") != F.col("coords")).isEmpty()


def test_turns_of_a_long_line(spark):
    """Time in proportion to the length, where each step was worked out again for each other one."""
    x = F.sequence(F.lit(0), F.lit(9999))
    line = F.transform(x, lambda i: F.struct((-73.9 + i * 0.002).alias("lon"), (42.6 + F.when(i % 10 < 5, 0.001).otherwise(0.0)).alias("lat")))
    began = time.time()
    (r,) = spark.range(1).select(line.alias("c")).select(geo.split_at_turns(F.col("c"), 20.0).alias("p")).collect()
    assert time.time() - began < 60
    want, part = [], 0
    for i in range(9999):
        before, now = ((i - 1) % 10 in (4, 9)), (i % 10 in (4, 9))  # the steps that go up or down
        part += i > 0 and before != now
        want.append(part)
    assert r["p"] == want


def test_turns_of_short_lines(spark):
    coords = "array<struct<lon:double,lat:double>>"
    rows = spark.createDataFrame([(n, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)][:n]) for n in (1, 2, 3)], f"n int, c {coords}")
    got = {r["n"]: r["p"] for r in rows.select("n", geo.split_at_turns(F.col("c")).alias("p")).collect()}
    assert got == {1: [], 2: [0], 3: [0, 1]}


def test_nearest_segments_are_the_least_of_all_projections(spark):
    """Before, all stops on all segments were rows."""
    t = tables(spark)
    lines = queries_map.lines_of(t).withColumnRenamed("id", "shape_id")
    got = network.nearest_segments(queries_map.shape_points(t), lines)
    least = queries_map.projected(t).groupBy("shape_id", "k").agg(F.min("dev").alias("want"))
    rows = got.join(least, ["shape_id", "k"]).select(F.abs(F.col("dev") - F.col("want")) < 1e-9).collect()
    assert len(rows) == least.count() > 0 and all(r[0] for r in rows)


def test_projections_in_small_parts(spark, monkeypatch):
    """Before, the few bytes of stops and lines came to one task, which made all pairs of a large shape."""
    for name, n in (("AT_A_LINE", 3), ("AT_ONCE", 2), ("PAIRS", 20)):
        monkeypatch.setattr(network, name, n)
    df = registry.QUERIES["stop_projections"](spark, SF)
    same(df, registry.ORACLE_SQL["stop_projections"], SF)
    assert df.select(F.spark_partition_id()).distinct().count() > 10


def test_projections_of_odd_stops(spark):
    coords = "array<struct<lon:double,lat:double>>"
    lines = spark.createDataFrame([("a", [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), ("b", [(0.0, 0.0), (1.0, 0.0)]), ("c", [(0.0, 0.0)]), (None, [(0.0, 0.0), (1.0, 0.0)])], f"shape_id string, coords {coords}")
    stops = spark.createDataFrame([("a", 1, 0.5, 0.0), ("a", 1, 0.5, 0.0), ("a", None, 0.0, 0.0), ("a", 2, None, 0.0), ("c", 1, 0.0, 0.0), ("d", 1, 0.0, 0.0), (None, 1, 0.0, 0.0)], "shape_id string, k int, lon double, lat double")
    got = sorted(((r["shape_id"], r["k"], r["seg"], r["dev"] is None or round(r["dev"], 6) == 0) for r in network.segment_projections(stops, lines).collect()), key=str)
    assert got == sorted([("a", k, seg, seg == 0 or (k == 2)) for k in (1, 1) for seg in range(3)] + [("a", None, seg, seg == 0) for seg in range(3)] + [("a", 2, seg, True) for seg in range(3)], key=str)
    assert network.segment_projections(stops.limit(0), lines).count() == 0


def test_redundant_matches_of_a_large_group(spark):
    """Sets of vertices are compared, not all pairs of a group's matches."""
    i = F.col("id")
    few = [F.array(), F.array(i % 2), F.array(i % 2, i % 2), F.array(i % 2, F.lit(5)), F.array(F.lit(None).cast("long"), i % 2), F.array(i % 2, i % 3, F.lit(5))]
    v = F.element_at(F.array(*[x.cast("array<long>") for x in few]), (i % 6 + 1).cast("int"))
    rows = spark.range(300).select("id", (i % 4).alias("shape_id"), F.lit(0).alias("shape_index"), F.when(i % 7 > 0, i % 3).alias("shst_reference"), (i % 5 % 2).alias("osrm_assisted"), v.alias("vertices"))
    data = rows.collect()
    key = lambda r: (r["shape_id"], r["shst_reference"])
    rank = lambda r: (-len(r["vertices"]), r["osrm_assisted"], r["id"])
    want = {a["id"] for a in data if a["shst_reference"] is not None and any(key(a) == key(b) and set(a["vertices"]) <= set(b["vertices"]) and rank(b) < rank(a) for b in data)}
    assert {r["id"] for r in matches.redundant(rows).collect()} == want and want
    one = spark.range(20_000).select("id", F.lit(1).alias("shape_id"), F.lit(0).alias("shape_index"), F.lit(1).alias("shst_reference"), F.lit(0).alias("osrm_assisted"), F.array(i % 3, i % 5).alias("vertices"))
    out = matches.redundant(one)
    began = time.time()
    assert out.count() == 20_000 - 12 and time.time() - began < 20


def test_pairs_of_a_large_group_come_from_many_tasks(spark):
    rows = spark.range(3000).select(F.lit(1).alias("g"), "id").unionByName(spark.createDataFrame([(2, 1), (2, 2), (None, 1), (None, 2)], "g int, id long"))
    out = matches.pairs(rows, ["g"], "id")
    assert out.count() == 3000 * 2999 // 2 + 1 and out.distinct().count() == 3000 * 2999 // 2 + 1
    assert out.filter("g = 1").select(F.spark_partition_id()).distinct().count() > 1


def test_path_arrays_of_repeated_trips(spark):
    traffic = spark.createDataFrame([(1, 7, 0, 2), (1, 7, 0, 2), (2, 7, 0, 2), (2, 8, 0, 2), (3, 7, 1, 2), (4, 7, 1, 1), (5, 9, 0, 1), (6, None, 0, 1)], "trip_id int, shape_id int, departure_seg_idx int, arrival_seg_idx int")
    shape_map = spark.createDataFrame([(7, 0, 1, 0), (7, 1, 2, 1), (8, 0, 3, 0)], "shape_id int, shape_index int, conflation_map_id int, along_idx int")
    road = spark.createDataFrame([(i, 1, 1.0) for i in (1, 2, 3)], "id int, networklevel int, length_km double")
    got = {r["trip_id"]: [x["conflation_map_id"] for x in r["path"]] for r in schedule.path_arrays(traffic, shape_map, road).collect()}
    assert got == {1: [1, 1, 2, 2], 2: [1, 3, 2], 3: [2]}


def test_path_arrays_are_made_once_for_a_stretch(spark):
    """Before, each traversal was spread over its segments and gathered again, by shuffle."""
    traffic = spark.range(20_000).select(F.col("id").alias("trip_id"), F.lit(7).alias("shape_id"), F.lit(0).alias("departure_seg_idx"), F.lit(1).alias("arrival_seg_idx"))
    shape_map = spark.range(300).select(F.lit(7).alias("shape_id"), F.lit(0).alias("shape_index"), F.col("id").alias("conflation_map_id"), F.col("id").alias("along_idx"))
    road = spark.range(300).select("id", F.lit(1).alias("networklevel"), F.lit(1.0).alias("length_km"))
    out = schedule.path_arrays(traffic, shape_map, road)
    began = time.time()
    got = out.select(F.size("path").alias("n")).distinct().collect()
    assert [r["n"] for r in got] == [300] and out.count() == 20_000 and time.time() - began < 20
