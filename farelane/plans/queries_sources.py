"""Queries that go through files and back: feeds, road maps, feature files, stage tables.

Feeds and SQLite maps are single files that one process writes, so here, as with those who publish them, the driver does.
"""

from __future__ import annotations

import csv
import json
import sqlite3
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import fresh_folder, prepare, put
from ..functions import geo
from ..operators import features
from ..sources import gtfs, roadmap, shapefile
from ..sources.warehouse import Warehouse
from .fixtures import relation
from .queries_map import LINES, sql_km

QUERIES = {}
SQL = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(prepare(spark), lambda t: relation(spark, sf_dir, t))
        SQL[f.__name__] = sql
        return f

    return register


def feed_of(stops: DataFrame, path: str) -> None:
    """A zip with stops.txt (columns in another order, one of them unknown, quoted names, empty values), a file in a folder and one that is no table."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, tempfile.NamedTemporaryFile("w", newline="", encoding="utf-8") as text:
        out = csv.writer(text)
        out.writerow(["stop_lon", "unknown", "stop_name", "stop_id", "stop_lat", "stop_code"])
        for r in stops.toLocalIterator():
            out.writerow([repr(r["stop_lon"]), "x", f'{r["stop_name"]}, "{r["stop_id"] % 7}"', r["stop_id"], repr(r["stop_lat"]), r["stop_id"] if r["stop_id"] % 3 == 0 else ""])
        text.flush()
        z.write(text.name, "Stops.txt")
        z.writestr("folder/stops.txt", "stop_id\n1\n")
        z.writestr("readme.txt", "no table")


@query("""SELECT CAST(stop_id AS VARCHAR) AS stop_id, stop_name || ', "' || CAST(stop_id % 7 AS VARCHAR) || '"' AS stop_name, CASE WHEN stop_id % 3 = 0 THEN CAST(stop_id AS VARCHAR) END AS stop_code,
round(stop_lat, 6) AS lat, round(stop_lon, 6) AS lon, NULL::VARCHAR AS stop_url FROM tx_stops""")
def feed_tables(spark, t):
    """A feed's zip to checked, typed tables."""
    with tempfile.TemporaryDirectory(prefix="farelane-") as folder:
        feed_of(t("tx_stops"), f"{folder}/feed.zip")
        tables, others = gtfs.read_feed(spark, f"{folder}/feed.zip", fresh_folder(spark, "feed"))
    if sorted(tables) != ["stops"] or sorted(others) != ["folder/stops.txt", "readme.txt"]:
        raise ValueError(f"{sorted(tables)} {sorted(others)}")
    return tables["stops"].select("stop_id", "stop_name", "stop_code", F.round("stop_lat", 6).alias("lat"), F.round("stop_lon", 6).alias("lon"), "stop_url")


MAP = "map AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 <> 0 THEN 'r' || CAST(p_partkey % 50 AS VARCHAR) END AS shst, (p_size % 10) * 1.0E0 AS nlev, -73.9E0 - (p_partkey % 40) * 0.001E0 AS lon, 42.6E0 + p_size * 0.001E0 AS lat FROM part)"


def road_map(spark, t) -> DataFrame:
    """A SQLite map of two-point segments, some without a reference, as the rows of a table."""
    p, size = F.col("p_partkey"), F.col("p_size")
    rows = t("part").select(p.alias("id"), (p % 11 != 0).alias("has"), (p % 50).alias("ref"), (size % 10).alias("nlev"), (-73.9 - (p % 40) * 0.001).alias("lon"), (42.6 + size * 0.001).alias("lat"))
    with tempfile.TemporaryDirectory(prefix="farelane-") as folder:
        db = sqlite3.connect(f"{folder}/map.sqlite")
        db.execute("CREATE TABLE conflation_map (id INTEGER, feature TEXT)")
        for r in rows.toLocalIterator():
            target = {"targetMapId": f"m{r['id']}", "other": 1}
            properties = ({"shstReferenceId": f"r{r['ref']}"} if r["has"] else {}) | {"networklevel": float(r["nlev"]), "osm": {"conflationMapMatchedTargetMapId": f"w{r['id']}"}, "ris_2019": target}
            line = {"type": "LineString", "coordinates": [[r["lon"], r["lat"]], [r["lon"] + 0.001, r["lat"] + 0.002]]}
            db.execute("INSERT INTO conflation_map VALUES (?, ?)", (r["id"], json.dumps({"id": r["id"], "properties": properties, "geometry": line})))
        db.commit()
        db.close()
        return roadmap.conflation_map(roadmap.sqlite_to_parquet(spark, f"{folder}/map.sqlite", fresh_folder(spark, "map")))


@query(f"WITH {MAP} SELECT id, shst AS shst_reference, nlev AS networklevel, 'w' || CAST(id AS VARCHAR) AS osm, 'm' || CAST(id AS VARCHAR) AS target, round({sql_km('lon', 'lat', '(lon + 0.001)', '(lat + 0.002)')}, 6) AS length_km FROM map WHERE shst IS NOT NULL")
def map_segments(spark, t):
    """The road map's segments that have a reference."""
    return road_map(spark, t).select("id", "shst_reference", "networklevel", "osm", F.col("ris_2019.targetMapId").alias("target"), F.round("length_km", 6).alias("length_km"))


@query(f"WITH {MAP} SELECT id, shst, nlev, 'w' || CAST(id AS VARCHAR) AS osm, 'LineString' AS kind, round(lon, 6) AS lon, round(lat + 0.002, 6) AS lat FROM map WHERE shst IS NOT NULL")
def map_as_ndgeojson(spark, t):
    """The map as lines of GeoJSON, read again as plain JSON."""
    at = fresh_folder(spark, "ndgeojson")
    roadmap.write_ndgeojson(road_map(spark, t), at)
    f = spark.read.schema("type string, id long, properties struct<id:long,shst:string,osm:string,nlev:double>, geometry struct<type:string,coordinates:array<array<double>>>").json(at)
    end = F.element_at("geometry.coordinates", 1)[0], F.element_at("geometry.coordinates", 2)[1]
    return f.select("id", "properties.shst", "properties.nlev", "properties.osm", F.col("geometry.type").alias("kind"), F.round(end[0], 6).alias("lon"), F.round(end[1], 6).alias("lat"))


@query(f"WITH {LINES} SELECT shape_id AS id, k, lon, lat FROM pts WHERE n > 1")
def feature_collection(spark, t):
    """Lines as one GeoJSON document and back."""
    lines = features.shape_lines(t("tx_shapes"))
    with tempfile.TemporaryDirectory(prefix="farelane-") as folder:
        roadmap.write_feature_collection(roadmap.as_geojson(lines.withColumn("id", F.col("id").cast("long")), "coords", ["id"]), f"{folder}/lines.geojson")
        at = fresh_folder(spark, "collection")
        put(spark, f"{folder}/lines.geojson", f"{at}/lines.geojson")
    back = roadmap.read_feature_collection(spark, f"{at}/lines.geojson", "id:long")
    if back is None or roadmap.read_feature_collection(spark, f"{at}/none.geojson", "id:long") is not None:
        raise ValueError("the file isn't there, or another one is")
    return back.select("id", F.posexplode("coords").alias("k", "c")).select("id", "k", "c.lon", "c.lat")


@query(f"WITH {LINES} SELECT shape_id AS id, n, row_number() OVER (ORDER BY shape_id) - 1 AS place FROM (SELECT shape_id, max(n) AS n FROM pts WHERE n > 1 GROUP BY 1) x")
def stage_table(spark, t):
    """K1, K3, K4: a table that is replaced as a whole; its files are in order, so that reading them one after another gives the rows in order."""
    house = Warehouse(spark, fresh_folder(spark, "warehouse"))
    lines = features.shape_lines(t("tx_shapes")).select("id", F.size("coords").cast("long").alias("n"), geo.length_km(F.col("coords")).alias("km"))
    house.write("a.lines", lines.limit(1))
    table = house.write("a.lines", lines, sort=["id"])
    files = table.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("id").alias("least"), F.count("*").alias("rows"))
    before = files.alias("f").join(files.alias("g"), F.col("g.file") < F.col("f.file"), "left").groupBy("f.file").agg(F.coalesce(F.sum("g.rows"), F.lit(0)).alias("before"))
    inside = table.select("id", "n", F.col("_metadata.file_name").alias("file"), (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("row"))
    first = inside.groupBy("file").agg(F.min("row").alias("first"))
    return inside.join(first, "file").join(before, "file").select("id", "n", (F.col("row") - F.col("first") + F.col("before")).alias("place"))


TWO_POINTS = "-73.9E0 - id % 30 * 0.001E0"


def two_points(i: Column) -> Column:
    """A line that starts at a place of its own."""
    lon = -73.9 - (i % 30) * 0.001
    return F.array(geo.point(lon, F.lit(42.6)), geo.point(lon + 0.0005, F.lit(42.61)))


@query(f"""WITH {LINES}, m AS (SELECT *, {TWO_POINTS} AS lon FROM tx_matches), j AS (SELECT shape_id, shape_index, conflation_map_id AS id, along_idx FROM tx_shape_map_join)
SELECT 'geojson_gtfs_stops' AS layer, CAST(stop_id AS VARCHAR) AS key, stop_name AS text, CAST(1 AS BIGINT) AS parts, CAST(1 AS BIGINT) AS points, round(CAST(stop_lon AS DOUBLE), 6) AS lon FROM tx_stops
UNION ALL SELECT 'geojson_gtfs_shapes', CAST(shape_id AS VARCHAR), NULL, 1, count(*), arg_min(lon, k) FROM pts WHERE n > 1 GROUP BY shape_id
UNION ALL SELECT 'gtfs_network_shape_segments', CAST(shape_id AS VARCHAR) || '/' || CAST(shape_index AS VARCHAR), '["' || CAST(shape_id AS VARCHAR) || '"]', 1, 2, round(-73.9E0 - shape_id % 30 * 0.001E0, 6) FROM (SELECT DISTINCT shape_id, shape_index FROM j) x
UNION ALL SELECT 'shst_matches', CAST(id AS VARCHAR), CAST(shst_reference AS VARCHAR), 1, 2, round(lon, 6) FROM m
UNION ALL SELECT 'chosen_shst_matches', CAST(id AS VARCHAR), CAST(shst_reference AS VARCHAR), 1, 2, round(lon, 6) FROM m WHERE id IN (SELECT shst_match_id FROM tx_match_paths)
UNION ALL SELECT 'gtfs_conflation_map_join', CAST(shape_id AS VARCHAR) || '/' || CAST(shape_index AS VARCHAR), CAST(arg_min(id, (along_idx, id)) AS VARCHAR), count(*), 2 * count(*), round(arg_min({TWO_POINTS}, (along_idx, id)), 6)
FROM j GROUP BY shape_id, shape_index
""")
def shapefile_layers(spark, t):
    """K7, K7a-K7f, C4: the six layers as shapefiles and back (as wide as a field of text, so a layer's list of ids is looked at by its first)."""
    pairs = t("tx_shape_map_join").select("shape_id", "shape_index").distinct()
    ends = F.array(F.col("shape_id").cast("string"))
    segments = pairs.select("shape_id", "shape_index", ends.alias("from_stop_ids"), ends.alias("to_stop_ids"), F.lit(0.0).alias("start_dist"), F.lit(1.0).alias("stop_dist"), two_points(F.col("shape_id")).alias("coords"))
    matches = t("tx_matches").withColumn("coords", two_points(F.col("id")))
    join = t("tx_shape_map_join").withColumn("coords", two_points(F.col("conflation_map_id")))
    named = shapefile.layers(features.stop_features(t("tx_stops")), features.shape_lines(t("tx_shapes")), segments, matches, t("tx_match_paths"), join)
    rows = []
    with tempfile.TemporaryDirectory(prefix="farelane-") as folder:
        written = shapefile.write_all(named, f"{folder}/layers")
        for name in named:
            before = len(rows)
            for v, parts in shapefile.read(f"{folder}/layers/{name}.shp"):
                key = v["stop_id"] if name.endswith("stops") else v["shape_id"] if name.endswith("shapes") else v["id"] if name.endswith("matches") else f"{v['shape_id']}/{v['shape_idx']}"
                text = (v.get("map_ids") or "").lstrip("[").split(",")[0].rstrip("]") or v.get("stop_name") or v.get("from_stops") or v.get("shst_ref")
                rows.append((name, key, text, len(parts), sum(map(len, parts)), round(float(parts[0][0, 0]), 6)))
            if written[name] != len(rows) - before:
                raise ValueError(f"{name}: {written[name]} rows written")
    return spark.createDataFrame(rows, "layer string, key string, text string, parts long, points long, lon double")
