"""Traffic and AADT by blocks of segments against a row for each observation."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators import schedule, spread


def odd_tables(spark, seed: int, days: float = 4.0):
    """Shapes that share segments in other orders or come over them again, overlapping and backward traversals, unknown times and lengths, lengths below overhangs."""
    r = random.Random(seed)
    routes = spark.createDataFrame([(1, "b"), (2, None), (3, "Ä")], "route_id int, route_short_name string")
    trips = spark.createDataFrame([(i, r.randint(1, 3), f"s{r.randint(0, 2)}", i % 5) for i in range(60)], "trip_id int, route_id int, service_id string, shape_id int")
    dates = spark.createDataFrame([(f"s{s}", d) for s in range(2) for d in range(7) for _ in range(r.randint(0, 4))], "service_id string, dow int")
    rows = []
    for i in range(60):
        at, sec = r.randint(0, 2), r.randint(20000, 24000)
        for _ in range(4):
            to, end = at + r.randint(0, 3), sec + r.choice([0, 60, 240, 900, 4000])
            if i % 20 == 19:
                end = None if i == 19 else sec - 50
            rows.append((i, i % 5, at, to, sec, end))
            at, sec = (to if i % 7 else max(to - 1, 0)), (end or sec) + 30
    traffic = spark.createDataFrame(rows, "trip_id int, shape_id int, departure_seg_idx int, arrival_seg_idx int, departure_time_sec int, arrival_time_sec int")
    shared = [(k, list(r.sample(range(100 * k, 100 * k + 12), 12))) for k in range(6)]
    over = []
    for shape in range(5):
        for k, ids in shared:
            own = sorted(ids) if shape % 2 else ids[::-1] if shape == 4 else ids
            over += [(shape, k + shape // 3, c, 0.0, r.choice([0.0, 0.001]), j) for j, c in enumerate(own)]
    over.append((3, 2, 100, 0.0, 0.0, 50))  # shape 3 comes over it again
    shape_map = spark.createDataFrame(over, "shape_id int, shape_index int, conflation_map_id int, conf_map_pre_len double, conf_map_post_len double, along_idx int")
    ids = [c for _, own in shared for c in own]
    road = spark.createDataFrame([(c, r.randint(0, 9), None if c == 305 else 0.0 if c == 401 else 0.0005 if c == 207 else r.randint(5, 50) / 100) for c in ids], "id int, networklevel int, length_km double")
    weeks = spark.createDataFrame([(days / 7,)], "feed_num_weeks double")
    return routes, trips, dates, traffic, shape_map, road, weeks


def plain(rows):
    return sorted((tuple(sorted(r.asDict(recursive=True).items())) for r in rows.collect()), key=str)


@pytest.mark.parametrize("seed,days", [(1, 4.0), (2, 30.0), (3, 0.0)])
def test_aadt_of_odd_tables(spark, seed, days, monkeypatch):
    monkeypatch.setattr(spread, "AT_ONCE", 5)
    t = odd_tables(spark, seed, days)
    want = schedule.aadt_breakdown(schedule.aadt_by_route_and_peak(schedule.weekday_sums(*t)))
    got = spread.aadt_breakdown(*t)
    assert plain(got) == plain(want.select(*got.columns)) and got.count() > 50
    assert plain(spread.aadt_breakdown(*t, nested=False)) == plain(got.drop("aadt_by_route"))


def long_stretch(spark, n_trips: int, n_segments: int):
    i = F.col("id").cast("int")
    routes = spark.range(20).select(i.alias("route_id"), F.col("id").cast("string").alias("route_short_name"))
    trips = spark.range(n_trips).select(i.alias("trip_id"), (i % 20).alias("route_id"), F.lit("s").alias("service_id"), F.lit(7).alias("shape_id"))
    dates = spark.range(30).select(F.lit("s").alias("service_id"), (i % 7).alias("dow"))
    start = 18000 + i * 7 % 50000
    traffic = spark.range(n_trips).select(i.alias("trip_id"), F.lit(7).alias("shape_id"), F.lit(0).alias("departure_seg_idx"), F.lit(1).alias("arrival_seg_idx"), start.alias("departure_time_sec"), (start + 200).alias("arrival_time_sec"))
    shape_map = spark.range(n_segments).select(F.lit(7).alias("shape_id"), F.lit(0).alias("shape_index"), F.col("id").alias("conflation_map_id"), F.lit(0.0).alias("conf_map_pre_len"), F.lit(0.0).alias("conf_map_post_len"), F.col("id").alias("along_idx"))
    road = spark.range(n_segments).select("id", (i % 8).alias("networklevel"), (0.1 + i % 9 / 10).alias("length_km"))
    return routes, trips, dates, traffic, shape_map, road, spark.createDataFrame([(29 / 7,)], "feed_num_weeks double")


def test_aadt_takes_no_row_an_observation(spark):
    """200 million observations; before, all of them were shuffled."""
    out = spread.aadt_breakdown(*long_stretch(spark, 50_000, 4_000))
    began = time.time()
    got = out.agg(F.count("*").alias("n"), F.min("aadt").alias("least")).first()
    assert time.time() - began < 30 and got["n"] == 4_000 and got["least"] > 40_000


@pytest.mark.parametrize("seed,days,cells", [(1, 4.0, 20), (2, 30.0, 30_000), (3, 0.0, 100)])
def test_traffic_of_odd_tables(spark, seed, days, cells, monkeypatch):
    monkeypatch.setattr(spread, "OF_TRAFFIC", 5)
    monkeypatch.setattr(spread, "CELLS", cells)
    t = odd_tables(spark, seed, days)
    want = schedule.traffic_total(schedule.weekday_sums(*t))
    got = spread.traffic_total(*t)
    assert plain(got) == plain(want.select(*got.columns)) and got.count() > 200


def test_traffic_takes_no_row_an_observation(spark):
    """20 million observations; before, all of them were shuffled."""
    out = spread.traffic_total(*long_stretch(spark, 20_000, 1_000))
    began = time.time()
    got = out.agg(F.count("*").alias("n"), F.min("avg_weekly_count").alias("least")).first()
    assert time.time() - began < 30 and got["n"] > 1_000_000 and got["least"] > 0


@pytest.mark.parametrize("seed,days,cells", [(1, 4.0, 20), (2, 30.0, 30_000), (3, 0.0, 100)])
def test_traffic_by_route_of_odd_tables(spark, seed, days, cells, monkeypatch):
    monkeypatch.setattr(spread, "OF_TRAFFIC", 5)
    monkeypatch.setattr(spread, "CELLS", cells)
    monkeypatch.setattr(spread, "OF_TRIPS", 30 * seed)
    t = odd_tables(spark, seed, days)
    t = (t[0], t[1].union(t[1].limit(7)), *t[2:])  # trips that are there twice
    want = schedule.by_route(schedule.weekday_sums(*t))
    want = want.withColumn("avg_travel_time_us", F.round(F.col("avg_travel_time").cast("decimal(30,15)") * 1_000_000).cast("long")).drop("avg_travel_time")
    got = spread.traffic_by_route(*t)
    assert plain(got) == plain(want.select(*got.columns)) and got.count() > 200


def test_traffic_by_route_takes_no_row_an_observation(spark):
    """15 million observations; before, all of them were shuffled with their trips."""
    out = spread.traffic_by_route(*long_stretch(spark, 60_000, 250))
    began = time.time()
    got = out.agg(F.count("*").alias("n"), F.max(F.length("trip_ids")).alias("longest")).first()
    assert time.time() - began < 30 and got["n"] > 1_000_000 and got["longest"] > 50


@pytest.mark.parametrize("seed", [1, 2])
def test_probe_of_odd_tables(spark, seed):
    _, _, _, traffic, shape_map, road, _ = odd_tables(spark, seed)
    want = schedule.met(schedule.observed(schedule.with_overlaps(traffic), schedule.shares(traffic, shape_map, road)))
    got = schedule.synthetic_probe(traffic, shape_map, road)
    assert plain(got) == plain(want.withColumn("travel_time", F.col("ms") / 1000).select(*got.columns)) and got.count() > 500


def test_probe_looks_for_meeting_observations_only_where_some_can_be(spark, monkeypatch):
    """Before, all observations were made twice."""
    _, _, _, traffic, shape_map, road, _ = long_stretch(spark, 5_000, 100)
    spread_over, plain_observed = [], schedule.observed
    monkeypatch.setattr(schedule, "observed", lambda rows, part: spread_over.append(rows.count()) or plain_observed(rows, part))
    assert schedule.synthetic_probe(traffic, shape_map, road).count() >= 500_000 and spread_over == [5_000, 0]


@pytest.mark.parametrize("seed,compat", [(1, False), (2, True)])
def test_probe_in_small_parts(spark, seed, compat, monkeypatch):
    monkeypatch.setattr(schedule, "TRIPS", 4)
    monkeypatch.setattr(schedule, "AT_ONCE", 3)
    monkeypatch.setattr(schedule, "ROWS_A_TASK", 100)
    _, _, _, traffic, shape_map, road, _ = odd_tables(spark, seed)
    traffic = traffic.unionByName(traffic.limit(9)).unionByName(traffic.limit(9).withColumn("trip_id", F.lit(None).cast("int")))
    want = schedule.met(schedule.observed(schedule.with_overlaps(traffic), schedule.shares(traffic, shape_map, road, compat)))
    got = schedule.synthetic_probe(traffic, shape_map, road, compat)
    assert plain(got) == plain(want.withColumn("travel_time", F.col("ms") / 1000).select(*got.columns)) and got.count() > 400
    assert schedule.synthetic_probe(traffic.limit(0), shape_map, road, compat).count() == 0


@pytest.mark.parametrize("compat", [False, True])
def test_probe_is_small_when_written(spark, tmp_path, compat):
    """Before, trips came one after the other, each with its own epochs and travel times."""
    _, _, _, traffic, shape_map, road, _ = long_stretch(spark, 6_000, 300)
    traffic = traffic.withColumn("arrival_time_sec", F.col("departure_time_sec") + 200 - F.col("trip_id") % 60)
    plainly = schedule.observed(schedule.with_overlaps(traffic), schedule.shares(traffic, shape_map, road, compat)).select("conflation_map_id", "trip_id", "epoch", (F.col("ms") / 1000).alias("travel_time"))
    sizes = []
    for k, rows in enumerate((plainly, schedule.synthetic_probe(traffic, shape_map, road, compat))):
        rows.write.parquet(str(tmp_path / str(k)))
        sizes.append((spark.read.parquet(str(tmp_path / str(k))).agg(F.count("*"), F.bit_xor(F.xxhash64(*plainly.columns))).first(), sum(p.stat().st_size for p in (tmp_path / str(k)).glob("*.parquet"))))
    assert sizes[0][0] == sizes[1][0] and sizes[0][0][0] == 1_800_000 and sizes[1][1] < 0.6 * sizes[0][1]


def ids_of(path):
    return [F.size(path).alias("n"), F.array_join(F.transform(path, lambda x: x["conflation_map_id"].cast("string")), ",").alias("ids")]


@pytest.mark.parametrize("seed", [1, 2])
def test_path_arrays_in_small_parts(spark, seed, monkeypatch):
    for name, n in (("TRIPS", 4), ("BYTES_HELD", 500), ("BYTES_A_TASK", 1000)):
        monkeypatch.setattr(schedule, name, n)
    _, _, _, traffic, shape_map, road, _ = odd_tables(spark, seed)
    traffic = traffic.unionByName(traffic.limit(9)).unionByName(traffic.limit(9).withColumn("trip_id", F.lit(None).cast("int")))
    one = ["trip_id", "departure_seg_idx", "arrival_seg_idx"]
    want = schedule.paths_of_traversals(traffic, shape_map, road).groupBy(*one).agg(F.sort_array(F.collect_list(F.struct("shape_index", "along_idx", "conflation_map_id"))).alias("path"))
    got = schedule.path_arrays(traffic, shape_map, road, ids_of)
    assert plain(got) == plain(want.select(*one, *ids_of(F.col("path"))).select(*got.columns)) and got.count() > 100
    assert plain(schedule.path_arrays(traffic, shape_map, road)) == plain(want)
    assert schedule.path_arrays(traffic.limit(0), shape_map, road).count() == 0


def test_path_arrays_hold_a_text_once(spark, tmp_path):
    """Before, each trip had its ids joined anew, and paths came in any order, so that Parquet gave up its dictionary."""
    i = F.col("id").cast("int")
    at = (i / 10_000).cast("int")
    traffic = spark.range(9_000).select(i.alias("trip_id"), (i % 30).alias("shape_id"), at.alias("departure_seg_idx"), (at + 1).alias("arrival_seg_idx"))
    shape_map = spark.range(30 * 3_000).select((i % 30).alias("shape_id"), F.lit(0).alias("shape_index"), F.xxhash64("id").alias("conflation_map_id"), F.col("id").alias("along_idx"))
    road = shape_map.select(F.col("conflation_map_id").alias("id"), F.lit(1).alias("networklevel"), F.lit(1.0).alias("length_km"))
    schedule.path_arrays(traffic, shape_map, road, ids_of).write.parquet(str(tmp_path / "out"))
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 20_000_000  # 540 MB of text, of which 2 MB differ
    got = spark.read.parquet(str(tmp_path / "out")).agg(F.count("*").alias("n"), F.min("n").alias("least"), F.count_distinct(F.xxhash64("ids")).alias("texts")).first()
    assert got.asDict() == {"n": 9_000, "least": 3_000, "texts": 30}


PATH = ["trip_id", "departure_seg_idx", "arrival_seg_idx", "shape_index", "conflation_map_id", "along_idx"]


@pytest.mark.parametrize("seed", [1, 2])
def test_traversal_paths_of_odd_tables(spark, seed, monkeypatch):
    monkeypatch.setattr(schedule, "TRIPS", 4)
    monkeypatch.setattr(schedule, "AT_ONCE", 3)
    monkeypatch.setattr(schedule, "ROWS_A_TASK", 100)
    _, _, _, traffic, shape_map, road, _ = odd_tables(spark, seed)
    traffic = traffic.unionByName(traffic.limit(9)).unionByName(traffic.limit(9).withColumn("trip_id", F.lit(None).cast("int")))
    got = schedule.traversal_paths(traffic, shape_map, road)
    assert plain(got) == plain(schedule.paths_of_traversals(traffic, shape_map, road).select(*PATH)) and got.count() > 500
    assert schedule.traversal_paths(traffic.limit(0), shape_map, road).count() == 0


def test_traversal_paths_are_small_when_written(spark, tmp_path):
    """Before, trips came one after the other, each with numbers of its whole path."""
    _, _, _, traffic, shape_map, road, _ = long_stretch(spark, 6_000, 300)
    for name in ("paths_of_traversals", "traversal_paths"):
        getattr(schedule, name)(traffic, shape_map, road).select(*PATH).write.parquet(str(tmp_path / name))
    rows = [spark.read.parquet(str(tmp_path / name)) for name in ("paths_of_traversals", "traversal_paths")]
    assert rows[0].count() == rows[1].count() >= 1_800_000 and rows[0].agg(F.sum(F.xxhash64(*PATH).cast("decimal(20)"))).first() == rows[1].agg(F.sum(F.xxhash64(*PATH).cast("decimal(20)"))).first()
    before, after = (sum(p.stat().st_size for p in (tmp_path / name).glob("*.parquet")) for name in ("paths_of_traversals", "traversal_paths"))
    assert after < 0.6 * before


def test_names_beyond_a_code():
    names = [f"r{k:03}" for k in range(100)]
    sets = [[0, 47], [0, 47], [48, 99], [50], list(range(100))]
    codes = [pa_codes(sets, k) for k in (0, 48, 96)]
    assert spread.texts_of(codes, names).to_pylist() == [",".join(names[x] for x in s) for s in sets]


def pa_codes(sets, k):
    return np.array([float(sum(2 ** (x - k) for x in s if k <= x < k + 48)) for s in sets])
