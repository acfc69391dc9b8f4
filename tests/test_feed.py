"""A small feed through sources, checks and all nine stages."""

import json
import sqlite3
import struct
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farelane import cli
from farelane.functions import times
from farelane.operators import calendar, features, matches, schedule, tracking
from farelane.pipeline import Pipeline
from farelane.sources import gtfs, roadmap
from farelane.sources.warehouse import Warehouse

FEED = {
    "agency.txt": "agency_id,agency_name\n1,Test\n",
    "stops.txt": "stop_id,stop_name,stop_lat,stop_lon,extra\nA,\"First, \"\"one\"\"\",42.6,-73.90,x\nB,Second,42.6,-73.89,x\nC,Third,42.6,-73.88,x\n",
    "routes.txt": "route_id,agency_id,route_short_name,route_type\nR1,1,,3\n",
    "trips.txt": "route_id,service_id,trip_id,shape_id\nR1,WK,T1,00632\nR1,WK,T2,00632\nR1,WK,T3,\n",
    "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,06:00:00,06:00:00,A,1\nT1,06:05:00,06:05:30,B,2\nT1,06:10:00,06:10:00,C,10\nT2,25:00:00,25:00:00,A,1\nT2,25:10:00,25:10:00,C,3\nT3,07:00:00,07:00:00,A,1\n",
    "shapes.txt": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\n00632,42.6,-73.88,4\n00632,42.6,-73.905,1\n00632,42.6,-73.89,3\n00632,42.6,-73.90,2\n",
    "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nWK,1,1,1,1,1,0,0,20240101,20240114\n",
    "calendar_dates.txt": "service_id,date,exception_type\nWK,20240102,2\nWK,20240106,1\n",
    "folder/stops.txt": "stop_id\nZ\n",
    "readme.txt": "hello\n",
}


def write_feed(path, **changes):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in (FEED | changes).items():
            if text is not None:
                z.writestr(name, text)
    return str(path)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    feed = write_feed(Path(out) / "in.zip")
    run = lambda *a: cli.main(["--output_dir", out, *a], spark)
    run("load_raw_gtfs_into_sqlite", "--agency_name", "TestBus", "--gtfs_zip", feed)
    run("gtfs_as_geojson")
    run("gtfs_network")
    p = Pipeline(spark, out)
    s = p.tables.read("gtfs_network.shape_segments")
    found = s.select(F.col("shape_index").cast("long").alias("id"), "shape_id", "shape_index", F.concat(F.lit("ref"), F.col("shape_index").cast("string")).alias("shst_reference"), F.lit(0.0).alias("section_start"), F.col("len_km").alias("section_end"), F.col("len_km").alias("feature_len_km"), "coords", F.lit(False).alias("osrm_assisted"))
    found.write.parquet(f"{out}/matches")
    run("gtfs_osm_network", "--matches", f"{out}/matches")
    run("scheduled_bus_traffic")
    db = sqlite3.connect(f"{out}/map.sqlite")
    db.execute("CREATE TABLE conflation_map (id INTEGER, feature TEXT)")
    for r in found.collect():
        props = {"shstReferenceId": r["shst_reference"], "networklevel": 2.0, "osm": {"conflationMapMatchedTargetMapId": "w1"}, "ris_2019": {"targetMapId": "q", "other": 1}}
        db.execute("INSERT INTO conflation_map VALUES (?, ?)", (100 + r["id"], json.dumps({"id": 100 + r["id"], "properties": props, "geometry": {"type": "LineString", "coordinates": [[c["lon"], c["lat"]] for c in r["coords"]]}})))
    db.execute("INSERT INTO conflation_map VALUES (1, ?)", (json.dumps({"id": 1, "properties": {"networklevel": 1}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}}),))
    db.commit()
    run("load_conflation_map", "--conflation_map_sqlite_db", f"{out}/map.sqlite")
    run("gtfs_conflation_map_join")
    run("gtfs_conflation_schedule_join")
    return p


def test_files_and_tables(done):
    assert (Path(done.output_dir) / "AGENCY_NAME").read_text() == "testbus" and (Path(done.output_dir) / "gtfs.zip").exists()
    stops = {r["stop_id"]: r for r in done.raw("stops").collect()}
    assert stops["A"]["stop_name"] == 'First, "one"' and stops["A"]["stop_code"] is None and "Z" not in stops


def test_ids_keep_leading_zeros(done):
    """Q4."""
    assert [r["id"] for r in done.tables.read("geojson_gtfs.shapes").collect()] == ["00632"]


def test_network(done):
    rows = done.tables.read("gtfs_network.shape_segments").orderBy("shape_index").collect()
    assert [(r["from_stop_ids"], r["to_stop_ids"]) for r in rows] == [([None], ["A"]), (["A"], ["B"]), (["B"], ["C"])]


def test_traffic_spans_skipped_stops(done):
    rows = done.tables.read("gtfs_scheduled_traffic.scheduled_transit_traffic").orderBy("trip_id", "departure_time_sec").collect()
    assert [(r["trip_id"], r["departure_seg_idx"], r["arrival_seg_idx"], r["departure_time_sec"], r["arrival_time_sec"]) for r in rows] == [
        ("T1", 1, 2, 21600, 21900), ("T1", 2, 3, 21930, 22200), ("T2", 1, 3, 90000, 90600)]


def test_service_dates(done):
    dates = {r["date"]: r["dow"] for r in done.tables.read("gtfs_scheduled_traffic.service_dates").collect()}
    assert "20240102" not in dates and dates["20240106"] == 6 and len(dates) == 10


def test_probe_keeps_time_and_aadt_adds_up(done):
    probe = done.tables.read("gtfs_conflation_schedule_join.gtfs_synthetic_probe_data")
    total = {r["trip_id"]: r["s"] for r in probe.groupBy("trip_id").agg(F.sum("travel_time").alias("s")).collect()}
    assert abs(total["T1"] - 570) < 0.01 and abs(total["T2"] - 600) < 0.01
    assert {r["epoch"] for r in probe.filter("trip_id = 'T2'").collect()} == {300, 301}
    assert probe.groupBy("conflation_map_id", "trip_id", "epoch").count().filter("count > 1").isEmpty()
    for r in done.tables.read("gtfs_conflation_schedule_join.conflation_map_aadt_breakdown").collect():
        assert r["aadt"] == sum(r["aadt_by_peak"].values()) == sum(x for m in r["aadt_by_route"].values() for x in m.values())
        assert set(r["aadt_by_route"]) == {"R1"}  # Q29
        assert "OVN" in r["aadt_by_peak"]  # Q6


def test_scores(done):
    assert all(r["score"] > 0.99 for r in done.tables.read("gtfs_osm_network.gtfs_shape_shst_match_scores").collect())


def test_layers(done, tmp_path):
    out = str(tmp_path / "layers")
    counts = done.output_shapefile(out)
    assert counts == {"geojson_gtfs_stops": 3, "geojson_gtfs_shapes": 1, "gtfs_network_shape_segments": 3, "shst_matches": 3, "chosen_shst_matches": 3, "gtfs_conflation_map_join": 3}
    shp = Path(f"{out}/gtfs_network_shape_segments.shp").read_bytes()
    assert struct.unpack(">i", shp[:4])[0] == 9994 and struct.unpack(">i", shp[24:28])[0] * 2 == len(shp) and struct.unpack("<i", shp[32:36])[0] == 3
    dbf = Path(f"{out}/geojson_gtfs_stops.dbf").read_bytes()
    assert struct.unpack("<I", dbf[4:8])[0] == 3 and b"wchair_bdn" in dbf and b"Second" in dbf and b'"Second"' not in dbf  # Q22
    with pytest.raises(FileExistsError):
        done.output_shapefile(out)


def test_map_dump_and_features(done, spark, tmp_path):
    cli.main(["--output_dir", done.output_dir, "dump_conflation_map", "--output_file", str(tmp_path / "nd")], spark)
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "nd")).collect()]
    assert len(rows) == 3 and rows[0]["properties"].keys() == {"id", "shst", "osm", "nlev"}
    text = roadmap.as_geojson(done.tables.read("conflation_map.conflation_map"), "coords", ["id", "shst_reference"])
    roadmap.write_feature_collection(text, str(tmp_path / "c.json"))
    back = roadmap.read_feature_collection(spark, str(tmp_path / "c.json"), "id:long,shst_reference:string")
    assert back.count() == 3 and len(back.first()["coords"]) >= 2
    assert roadmap.read_feature_collection(spark, str(tmp_path / "none.json"), "id:long") is None


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"stops.txt": "stop_id,stop_lat,stop_lon\nA,1,1\nA,2,2\n"}, "duplicate stop_id"),
        ({"calendar.txt": FEED["calendar.txt"].replace("WK,1,1", "WK,2,1")}, "monday IN"),
        ({"shapes.txt": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\ns,,1,1\n"}, "shape_pt_lat is null"),
        ({"stops.txt": "stop_id,stop_lat,stop_lon\nA,north,1\n"}, "not a number"),
        ({"transfers.txt": "from_stop_id,to_stop_id,transfer_type\nA,B,7\n"}, "transfer_type IN"),
    ],
)
def test_rules(spark, tmp_path, change, rule):
    with pytest.raises(gtfs.FeedError, match=rule.replace("(", r"\(")):
        gtfs.read_feed(spark, write_feed(tmp_path / "f.zip", **change), str(tmp_path / "u"))


def test_entry_names():
    assert gtfs.table_of("Stops.TXT") == "stops" and gtfs.table_of("a/stops.txt") is None and gtfs.table_of("notes.txt") is None


def test_calendar_quirks(spark):
    reg = spark.createDataFrame([("W", 1, 1, 1, 1, 1, 1, 1, "20240101", "20240103")], "service_id string, sunday int, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, start_date string, end_date string")
    spec = spark.createDataFrame([("W", "20240102", "2"), ("W", "20250101", "2")], calendar.CALENDAR_DATES)
    info = spark.createDataFrame([], calendar.FEED_INFO)
    extent = calendar.feed_extent(info, reg, spec)
    assert calendar.checked_extent(extent) == ("20240101", "20240103")
    assert calendar.service_dates(extent, reg, spec).count() == 2
    assert calendar.service_dates(extent, reg, spec, compat=True).count() == 3  # Q1
    assert calendar.feed_extent(spark.createDataFrame([("20230101", None)], calendar.FEED_INFO), reg, spec).first()["feed_start_date"] == "20230101"
    with pytest.raises(ValueError):
        calendar.date_tables(spark, {})
    with pytest.raises(ValueError):  # Q10
        calendar.checked_extent(calendar.feed_extent(info, spark.createDataFrame([], calendar.CALENDAR), spec))


def test_one_day_feed_has_no_weekly_count(spark):
    """Q5."""
    extent = spark.createDataFrame([("20240101", "20240101")], "feed_start_date string, feed_end_date string")
    by = schedule.traffic_by_route(
        spark.createDataFrame([(1, "x")], "route_id int, route_short_name string"), spark.createDataFrame([(1, "W", 5)], "route_id int, service_id string, trip_id int"),
        spark.createDataFrame([("W", "20240101", 1)], "service_id string, date string, dow int"), spark.createDataFrame([(9, 5, 80, 10.0)], "conflation_map_id int, trip_id int, epoch int, travel_time double"), calendar.feed_weeks(extent))
    assert by.first()["avg_weekly_count"] is None


def test_times(spark):
    df = spark.createDataFrame([("25:10:30",), (None,)], "t string").select(times.seconds(F.col("t")).alias("s"))
    assert [r["s"] for r in df.collect()] == [90630, None]
    with pytest.raises(Exception, match="not a time"):
        spark.createDataFrame([("25:1030",)], "t string").select(times.seconds(F.col("t"))).collect()


def test_peaks(spark):
    rows = spark.createDataFrame([(e, d) for e in (71, 72, 119, 120, 191, 192, 239, 240, 300) for d in (0, 1)], "epoch int, dow int")
    got = [r["p"] for r in rows.select(schedule.peak(F.col("epoch"), F.col("dow")).alias("p")).collect()]
    assert got == ["OVN", "OVN", "WE", "AMP", "WE", "AMP", "WE", "MIDD", "WE", "MIDD", "WE", "PMP", "WE", "PMP", "OVN", "OVN", "OVN", "OVN"]


def stops_rows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, shape_id string, stop_sequence int, stop_id string, arrival_sec int, departure_sec int")


def test_tracking(spark):
    ends = tracking.stop_indices(spark.createDataFrame([("s", 0, "a"), ("s", 1, "b"), ("s", 2, "a")], "shape_id string, shape_index int, stop_id string"))
    loop = stops_rows(spark, [("t", "s", 1, "a", 0, 0), ("t", "s", 2, "b", 5, 6), ("t", "s", 3, "a", 9, 9), ("t", "s", 4, "a", 9, 9)])
    assert [(r["departure_seg_idx"], r["arrival_seg_idx"]) for r in tracking.scheduled_traffic(loop, ends).orderBy("departure_time_sec", "arrival_seg_idx").collect()] == [(0, 1), (1, 2), (2, 2)]
    with pytest.raises(Exception, match="no segment left"):
        tracking.scheduled_traffic(stops_rows(spark, [("t", "s", 1, "b", 0, 0), ("t", "s", 2, "a", 1, 1), ("t", "s", 3, "b", 2, 2)]), ends).collect()
    with pytest.raises(Exception, match="backwards"):
        tracking.scheduled_traffic(stops_rows(spark, [("t", "s", 1, "a", 0, 9), ("t", "s", 2, "b", 5, 6)]), ends).collect()


def test_sequences(spark):
    good = stops_rows(spark, [("1", "s", i, x, 0, 0) for i, x in enumerate("abc")] + [("2", "s", i, x, 0, 0) for i, x in enumerate("ac")])
    assert [x["stop_id"] for x in features.stop_sequences(good).first()["stops"]] == ["a", "b", "c"]
    bad = good.union(stops_rows(spark, [("3", "s", i, x, 0, 0) for i, x in enumerate("ca")]))
    with pytest.raises(Exception, match="more than one stop sequence"):
        features.stop_sequences(bad).collect()


def test_probe_order_of_skipped_stops(spark):
    """Q30: indices first, then the position within them."""
    traffic = spark.createDataFrame([("t", "s", 0, 2, 0, 600)], "trip_id string, shape_id string, departure_seg_idx int, arrival_seg_idx int, departure_time_sec int, arrival_time_sec int")
    join = spark.createDataFrame([("s", 0, 1, 0.0, 0.0, 0), ("s", 0, 2, 0.0, 0.0, 1), ("s", 1, 3, 0.0, 0.0, 0)], "shape_id string, shape_index int, conflation_map_id int, conf_map_pre_len double, conf_map_post_len double, along_idx int")
    road = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0), (3, 0.0, 1.0)], "id int, networklevel double, length_km double")
    at = lambda compat: {r["conflation_map_id"]: r["epoch"] for r in schedule.synthetic_probe(traffic, join, road, compat).collect()}
    assert at(False) == {1: 0, 2: 0, 3: 1} and at(True) == {1: 0, 3: 0, 2: 1}


def test_match_operators(spark):
    seg = spark.createDataFrame([("s", 0, 1.0), ("s", 1, 1.0)], "shape_id string, shape_index int, len_km double")
    m = lambda i, k, km: spark.createDataFrame([(i, "s", k, f"r{i}", km)], "id long, shape_id string, shape_index int, shst_reference string, feature_len_km double")
    seen = []

    def second(left):
        seen.extend(r["shape_index"] for r in left.collect())
        return m(2, 1, 1.0)

    got = matches.ladder(seg, [("a", lambda left: m(1, 0, 0.95)), ("b", second)], ["shape_id", "shape_index", "shst_reference"])
    assert seen == [1] and {(r["id"], r["matcher"]) for r in got.collect()} == {(1, "a"), (2, "b")}
    one = spark.range(1)
    arr = lambda *x: F.array(*map(F.lit, x))
    assert one.select(matches.is_substring(arr(2, 3), arr(1, 2, 3)) & ~matches.is_substring(arr(1, 3), arr(1, 2, 3)) & matches.is_subset(arr(3, 1), arr(1, 2, 3)) & features.is_subsequence(arr(1, 3), arr(1, 2, 3))).first()[0]


def test_units(spark):
    rows = spark.createDataFrame([(10.0,), (6.2137,), (10000.0,), (32808.4,)], "d double")
    assert [round(r["k"] * r["d"], 2) for r in rows.select("d", features.kilometres(F.col("d"), F.lit(10.0)).alias("k")).collect()] == [10.0] * 4


def test_warehouse_replaces_whole_tables(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(FileNotFoundError):
        w.read("a.b")
    w.write("a.b", spark.range(3))
    before = w.read("a.b")
    assert w.write("a.b", before.filter("id > 0")).count() == 2 and before.count() == 3  # who reads the old one isn't disturbed
    w.write("a.b", spark.range(7), sort=["id"])
    assert w.versions("a.b") == [2, 3] and [r["id"] for r in w.read("a.b").collect()] == list(range(7))
    w.versions = lambda table: [2]  # another writer's view from before
    with pytest.raises(RuntimeError):
        w.write("a.b", spark.range(1))


def test_a_quoted_line_break(spark, tmp_path):
    for text, n in (('stop_id,stop_name\nA,"one\ntwo"\nB,x\n', True), ('stop_id,stop_name\nA,"one, ""two"""\nB,x\n', False)):
        (tmp_path / "stops.txt").write_text(text)
        path = str(tmp_path / "stops.txt")
        assert gtfs.has_broken_lines(spark, path) == n and [r["stop_id"] for r in gtfs.read_csv(spark, path, "stops").collect()] == ["A", "B"]


def test_stages_without_matches_from_elsewhere(spark, done, tmp_path):
    """The same feed and map, matched by the built-in matcher: feed and map to AADT by the command line alone."""
    run = lambda *a: cli.main(["--output_dir", str(tmp_path), *a], spark)
    run("load_raw_gtfs", "--agency_name", "TestBus", "--gtfs_zip", f"{done.output_dir}/gtfs.zip")
    for stage in ("gtfs_as_geojson", "gtfs_network", "scheduled_bus_traffic"):
        run(stage)
    run("load_conflation_map", "--conflation_map_sqlite_db", f"{done.output_dir}/map.sqlite")
    for stage in ("gtfs_osm_network", "gtfs_conflation_map_join", "gtfs_conflation_schedule_join"):
        run(stage)
    aadt = lambda p: {r["conflation_map_id"]: r["aadt"] for r in p.tables.read("gtfs_conflation_schedule_join.conflation_map_aadt_breakdown").collect()}
    mine = aadt(Pipeline(spark, str(tmp_path)))
    assert mine == aadt(done) and mine


def test_stream(spark, tmp_path):
    from farelane.streaming.epochs import epoch_traffic

    src = str(tmp_path / "src")
    spark.sql("SELECT timestamp'2024-01-01 00:01:00' ts, 1 conflation_map_id, 10.0D travel_time UNION ALL SELECT timestamp'2024-01-01 00:04:00', 1, 20.0D UNION ALL SELECT timestamp'2024-01-01 00:06:00', 1, 5.0D").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = epoch_traffic(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("epochs").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    want = sorted((r["n"], r["avg_travel_time"]) for r in epoch_traffic(spark.read.parquet(src)).collect())
    assert sorted((r["n"], r["avg_travel_time"]) for r in spark.table("epochs").collect()) == want == [(1, 5.0), (2, 15.0)]
