"""Queries on geometry, stop sequences, matches and the road map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, properties
from ..functions.geo import EARTH_KM
from ..functions.kernels import DEGREE_KM
from ..operators import choose, features, mapjoin, matcher, matches, network, schedule
from .fixtures import relation

QUERIES = {}
SQL = {}


def query(sql: str = ""):
    def register(f):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(lambda t: relation(spark, sf_dir, t))
        if sql:
            SQL[name] = sql
        return f

    return register


# --- SQL text of geometry ---


def sql_km(a_lon: str, a_lat: str, b_lon: str, b_lat: str) -> str:
    return f"2 * {EARTH_KM} * asin(sqrt(pow(sin(radians({b_lat} - {a_lat}) / 2), 2) + pow(sin(radians({b_lon} - {a_lon}) / 2), 2) * cos(radians({a_lat})) * cos(radians({b_lat}))))"


def sql_bearing(a_lon: str, a_lat: str, b_lon: str, b_lat: str) -> str:
    return (
        f"degrees(atan2(sin(radians({b_lon} - {a_lon})) * cos(radians({b_lat})), cos(radians({a_lat})) * sin(radians({b_lat})) - sin(radians({a_lat})) * cos(radians({b_lat})) * cos(radians({b_lon} - {a_lon}))))"
    )


LINES = """
pts AS (
  SELECT shape_id, CAST(row_number() OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) - 1 AS INT) AS k, count(*) OVER (PARTITION BY shape_id) AS n,
         round(CAST(shape_pt_lon AS DOUBLE), 6) AS lon, round(CAST(shape_pt_lat AS DOUBLE), 6) AS lat
  FROM tx_shapes
), steps AS (
  SELECT a.shape_id, a.k AS seg, a.lon AS a_lon, a.lat AS a_lat, b.lon AS b_lon, b.lat AS b_lat
  FROM pts a JOIN pts b ON a.shape_id = b.shape_id AND b.k = a.k + 1
)"""
KM = sql_km("a_lon", "a_lat", "b_lon", "b_lat")


def lines_of(t) -> DataFrame:
    return features.shape_lines(t("tx_shapes"))


@query("SELECT stop_id AS id, stop_name, round(CAST(stop_lon AS DOUBLE), 6) AS lon, round(CAST(stop_lat AS DOUBLE), 6) AS lat FROM tx_stops")
def stop_features(t):
    return features.stop_features(t("tx_stops")).select("id", "properties.stop_name", "geometry.lon", "geometry.lat")


@query(f"WITH {LINES} SELECT shape_id AS id, k, lon, lat FROM pts WHERE n > 1")
def shape_lines(t):
    return lines_of(t).select("id", F.posexplode("coords").alias("k", "c")).select("id", "k", "c.lon", "c.lat")


@query(f"WITH {LINES} SELECT shape_id AS id, round(sum({KM}), 6) AS km FROM steps GROUP BY 1")
def line_lengths(t):
    return lines_of(t).select("id", F.round(geo.length_km(F.col("coords")), 6).alias("km"))


@query(f"WITH {LINES} SELECT shape_id AS id, seg, round(coalesce(sum({KM}) OVER (PARTITION BY shape_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS km FROM steps")
def running_lengths(t):
    along = geo.running_km(F.col("coords"))
    return lines_of(t).select("id", F.posexplode(F.slice(along, F.lit(1), F.size("coords") - 1)).alias("seg", "km")).withColumn("km", F.round("km", 6))


@query(f"WITH {LINES} SELECT shape_id AS id, seg, round({sql_bearing('a_lon', 'a_lat', 'b_lon', 'b_lat')}, 5) AS bearing FROM steps")
def bearings(t):
    n = F.size("coords")
    b = F.zip_with(F.slice("coords", F.lit(1), n - 1), F.slice("coords", F.lit(2), n - 1), geo.bearing)
    return lines_of(t).select("id", F.posexplode(b).alias("seg", "bearing")).withColumn("bearing", F.round("bearing", 5))


@query(f"""
WITH {LINES}, km AS (SELECT shape_id, sum({KM}) AS len FROM steps GROUP BY 1), ends AS (
  SELECT shape_id, arg_min(a_lon, seg) AS s_lon, arg_min(a_lat, seg) AS s_lat, arg_max(b_lon, seg) AS e_lon, arg_max(b_lat, seg) AS e_lat,
         arg_max(a_lon, seg) AS l_lon, arg_max(a_lat, seg) AS l_lat, arg_min(b_lon, seg) AS f_lon, arg_min(b_lat, seg) AS f_lat FROM steps GROUP BY 1
)
SELECT a, b, round(ka.len, 6) AS s_len, round(kb.len, 6) AS t_len, round(gap, 6) AS gap_dist,
       round(CASE WHEN next - own < -180 THEN next - own + 360 ELSE next - own END, 4) AS segs_rel_brng, round(CASE WHEN over_gap - own < -180 THEN over_gap - own + 360 ELSE over_gap - own END, 4) AS gap_rel_brng
FROM (
  SELECT a.shape_id AS a, b.shape_id AS b, {sql_km('a.e_lon', 'a.e_lat', 'b.s_lon', 'b.s_lat')} AS gap, {sql_bearing('a.l_lon', 'a.l_lat', 'a.e_lon', 'a.e_lat')} AS own,
         {sql_bearing('b.s_lon', 'b.s_lat', 'b.f_lon', 'b.f_lat')} AS next, {sql_bearing('a.e_lon', 'a.e_lat', 'b.s_lon', 'b.s_lat')} AS over_gap
  FROM ends a JOIN ends b ON b.shape_id = a.shape_id + 1
) x JOIN km ka ON ka.shape_id = a JOIN km kb ON kb.shape_id = b
""")
def sequentiality(t):
    a = lines_of(t).select(F.col("id").alias("a"), F.col("coords").alias("s"))
    b = lines_of(t).select(F.col("id").alias("b"), F.col("coords").alias("t"))
    rows = a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", geo.sequentiality(F.col("s"), F.col("t")).alias("x"))
    return rows.select("a", "b", *[F.round(f"x.{c}", 6).alias(c) for c in ("s_len", "t_len", "gap_dist")], *[F.round(f"x.{c}", 4).alias(c) for c in ("segs_rel_brng", "gap_rel_brng")])


@query("""
WITH p AS (SELECT stop_id AS id, bin(CAST(round(abs(round(CAST(stop_lon AS DOUBLE), 6) * 100000)) AS BIGINT)) AS x, bin(CAST(round(abs(round(CAST(stop_lat AS DOUBLE), 6) * 100000)) AS BIGINT)) AS y FROM tx_stops),
bits AS (SELECT id, i, CAST(substr(x, i, 1) AS BIGINT) * 2 + CASE WHEN i <= length(y) THEN CAST(substr(y, i, 1) AS BIGINT) ELSE 0 END AS pair, length(x) AS n FROM p, unnest(range(1, length(x) + 1)) u(i))
SELECT id, lpad(lower(to_base(CAST(sum(pair * CAST(pow(4, n - i) AS BIGINT)) AS BIGINT), 36)), 11, '0') AS geoprox_key FROM bits GROUP BY id
""")
def geoprox_order(t):
    return features.in_geo_order(features.stop_features(t("tx_stops"))).select("id", "geoprox_key")


@query(f"""
WITH {LINES}, turns AS (
  SELECT shape_id, seg, {sql_bearing('a_lon', 'a_lat', 'b_lon', 'b_lat')} AS b FROM steps
), sharp AS (
  SELECT *, CASE WHEN abs(((b - lag(b) OVER (PARTITION BY shape_id ORDER BY seg) + 540) % 360 + 360) % 360 - 180) > 20 THEN 1 ELSE 0 END AS s FROM turns
)
SELECT shape_id AS id, seg, CAST(sum(s) OVER (PARTITION BY shape_id ORDER BY seg) AS INT) AS part FROM sharp
""")
def smooth_split(t):
    return lines_of(t).select("id", F.posexplode(geo.split_at_turns(F.col("coords"), 20.0)).alias("seg", "part"))


SNAPPED = f"""
{LINES}, stops AS (
  SELECT shape_id, k AS k, lon + 0.0003 AS lon, lat + 0.0001 AS lat FROM pts WHERE k % 3 = 1
), proj AS (
  SELECT s.shape_id, s.k, p.seg, {KM} AS km,
         (s.lon - p.a_lon) * {DEGREE_KM} * cos(radians(o.lat)) AS rx, (s.lat - p.a_lat) * {DEGREE_KM} AS ry,
         (p.b_lon - p.a_lon) * {DEGREE_KM} * cos(radians(o.lat)) AS dx, (p.b_lat - p.a_lat) * {DEGREE_KM} AS dy
  FROM stops s JOIN steps p ON s.shape_id = p.shape_id JOIN pts o ON o.shape_id = s.shape_id AND o.k = 0
), placed AS (
  SELECT *, least(greatest(coalesce((rx * dx + ry * dy) / nullif(dx * dx + dy * dy, 0), 0), 0), 1) AS t FROM proj
), cells AS (
  SELECT shape_id, k, seg, t * km AS inside, sqrt(pow(rx - t * dx, 2) + pow(ry - t * dy, 2)) AS dev FROM placed
)"""


def shape_points(t) -> DataFrame:
    """Every third point of a shape, moved a little, as stops."""
    p = lines_of(t).select(F.col("id").alias("shape_id"), F.posexplode("coords").alias("k", "c")).filter("k % 3 = 1")
    return p.select("shape_id", "k", (F.col("c.lon") + 0.0003).alias("lon"), (F.col("c.lat") + 0.0001).alias("lat"))


def projected(t) -> DataFrame:
    return network.segment_projections(shape_points(t), lines_of(t).withColumnRenamed("id", "shape_id"))


@query(f"WITH {SNAPPED} SELECT shape_id, k, seg, round(inside, 6) AS inside, round(dev, 6) AS dev FROM cells")
def stop_projections(t):
    return projected(t).withColumn("inside", F.round("inside", 6)).withColumn("dev", F.round("dev", 6))


@query(f"WITH {SNAPPED} SELECT shape_id, k, round(min(dev), 6) AS dev FROM cells GROUP BY 1, 2")
def snap_argmin(t):
    return network.nearest_segments(shape_points(t), lines_of(t).withColumnRenamed("id", "shape_id")).select("shape_id", "k", F.round("dev", 6).alias("dev"))


# --- stop sequences ---

VISITS = "visits AS (SELECT t.shape_id, t.trip_id, s.stop_id, s.stop_sequence FROM tx_trips t JOIN tx_stop_times s USING (trip_id) WHERE t.shape_id IS NOT NULL)"
PATTERNS = f"{VISITS}, patterns AS (SELECT DISTINCT shape_id, stops FROM (SELECT shape_id, trip_id, array_to_string(list(stop_id ORDER BY stop_sequence), ',') AS stops FROM visits GROUP BY 1, 2) x)"


def sequences_of(t, check: bool = True) -> DataFrame:
    return features.stop_sequences(schedule.with_shape(schedule.scheduled_stops(t("tx_trips"), t("tx_stop_times"))), check)


@query(f"WITH {PATTERNS} SELECT shape_id, count(*) AS n_patterns, max(length(stops) - length(replace(stops, ',', '')) + 1) AS n_stops, arg_max(stops, lpad(CAST(length(stops) - length(replace(stops, ',', '')) AS VARCHAR), 6, '0') || stops) AS stops, any_value(n_conflicts) AS n_conflicts FROM patterns JOIN (SELECT shape_id, count(*) FILTER (NOT held LIKE part) AS n_conflicts FROM (SELECT shape_id, '<' || replace(first_value(stops) OVER (PARTITION BY shape_id ORDER BY lpad(CAST(length(stops) - length(replace(stops, ',', '')) AS VARCHAR), 6, '0') || stops DESC), ',', '><') || '>' AS held, '%<' || replace(stops, ',', '>%<') || '>%' AS part FROM patterns) x GROUP BY 1) c USING (shape_id) GROUP BY 1")
def stop_sequences(t):
    """A pattern conflicts if its stops don't occur in the longest one in their order."""
    return sequences_of(t, check=False).select("shape_id", "n_patterns", "n_conflicts", F.size("stops").cast("long").alias("n_stops"), F.array_join(F.transform("stops", lambda s: s["stop_id"].cast("string")), ",").alias("stops"))


@query(f"""WITH {PATTERNS}, longest AS (SELECT shape_id, arg_max(stops, lpad(CAST(length(stops) - length(replace(stops, ',', '')) AS VARCHAR), 6, '0') || stops) AS l FROM patterns GROUP BY 1)
SELECT shape_id, CAST(k - 1 AS INT) AS k, CAST(s[k] AS BIGINT) AS stop_id, CAST(CASE WHEN k > 1 THEN s[k - 1] END AS BIGINT) AS previous_stop_id, CAST(s[k + 1] AS BIGINT) AS next_stop_id
FROM (SELECT shape_id, string_split(l, ',') AS s FROM longest) x, unnest(range(1, len(s) + 1)) u(k)""")
def stop_neighbours(t):
    return features.neighbours(sequences_of(t, check=False))


@query("""
WITH snaps AS (SELECT s_suppkey % 10 AS shape_id, CAST(row_number() OVER (PARTITION BY s_suppkey % 10 ORDER BY s_suppkey) - 1 AS INT) AS k, s_nationkey AS stop_id, floor(s_suppkey / 30.0) AS dist FROM supplier),
runs AS (SELECT *, CASE WHEN dist <> lag(dist) OVER (PARTITION BY shape_id ORDER BY k) THEN 1 ELSE 0 END AS fresh FROM snaps),
numbered AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY shape_id ORDER BY k) AS INT) AS run FROM runs),
firsts AS (SELECT shape_id, run, dist, stop_id, min(k) AS k FROM numbered GROUP BY 1, 2, 3, 4)
SELECT shape_id, run, CAST(dist AS DOUBLE) AS dist, array_to_string(list(stop_id ORDER BY k), ',') AS stop_ids FROM firsts GROUP BY 1, 2, 3
""")
def snap_runs(t):
    w = Window.partitionBy("shape_id").orderBy("s_suppkey")
    snaps = t("supplier").withColumn("shape_id", F.col("s_suppkey") % 10)
    snaps = snaps.select("shape_id", (F.row_number().over(w) - 1).alias("k"), F.col("s_nationkey").alias("stop_id"), F.floor(F.col("s_suppkey") / 30.0).cast("double").alias("dist"))
    return matches.same_distance_runs(snaps).withColumn("stop_ids", F.array_join(F.transform("stop_ids", lambda s: s.cast("string")), ","))


# --- matches ---

SEGMENTS = "segments AS (SELECT shape_id, shape_index, sum(length_km) AS len_km FROM tx_shape_map_join j JOIN tx_conflation_map m ON m.id = j.conflation_map_id GROUP BY 1, 2)"


def segments_of(t) -> DataFrame:
    rows = t("tx_shape_map_join").join(t("tx_conflation_map"), F.col("id") == F.col("conflation_map_id"))
    return rows.groupBy("shape_id", "shape_index").agg(F.sum("length_km").alias("len_km"))


def joined(c: str):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query(f"WITH {SEGMENTS} SELECT s.shape_id, s.shape_index, count(m.id) AS n, coalesce(array_to_string(list(m.id ORDER BY m.id) FILTER (m.id IS NOT NULL), ','), '') AS match_ids FROM segments s LEFT JOIN tx_matches m USING (shape_id, shape_index) GROUP BY 1, 2")
def network_left_matches(t):
    rows = matches.matches_of_segments(segments_of(t), t("tx_matches"))
    return rows.select("shape_id", "shape_index", F.size("match_ids").cast("long").alias("n"), joined("match_ids").alias("match_ids"))


@query(f"WITH {SEGMENTS} SELECT m.shape_id, m.shape_index, m.id FROM tx_matches m JOIN segments USING (shape_id, shape_index)")
def flattened_matches(t):
    return matches.flattened(matches.segments_of_shapes(matches.matches_of_segments(segments_of(t), t("tx_matches"))))


@query("SELECT * FROM tx_matches WHERE id IN (SELECT shst_match_id FROM tx_match_paths)")
def chosen_matches_semi(t):
    return matches.chosen_matches(t("tx_matches"), t("tx_match_paths"))


@query(f"WITH {SEGMENTS} SELECT s.shape_id, s.shape_index, s.len_km IS NOT NULL AS has_segment, m.id, p.path_index, p.path_edge_index FROM segments s LEFT JOIN tx_matches m USING (shape_id, shape_index) LEFT JOIN tx_match_paths p ON p.shst_match_id = m.id")
def matches_with_choice(t):
    rows = matches.matches_with_choice(segments_of(t), t("tx_matches"), t("tx_match_paths"))
    return rows.select("shape_id", "shape_index", F.col("len_km").isNotNull().alias("has_segment"), "id", "path_index", "path_edge_index")


@query("SELECT shape_id, shape_index, id, row_number() OVER (PARTITION BY shape_id, shape_index ORDER BY id) - 1 AS pp_match_index FROM tx_matches")
def match_index(t):
    return matches.match_index(t("tx_matches")).select("shape_id", "shape_index", "id", "pp_match_index")


@query("SELECT shape_id, shape_index, shst_reference, min(id) AS id FROM tx_matches GROUP BY 1, 2, 3")
def insert_or_ignore(t):
    return matches.insert_or_ignore(t("tx_matches"), ["shape_id", "shape_index", "shst_reference"], ["id"]).select("shape_id", "shape_index", "shst_reference", "id")


@query("""
WITH old AS (SELECT id, shape_id, shst_reference FROM tx_matches WHERE osrm_assisted = 0), fresh AS (SELECT id, shape_id, shst_reference FROM tx_matches WHERE osrm_assisted = 1)
SELECT shape_id, shst_reference, coalesce(min(id) FILTER (origin = 0), min(id)) AS id FROM (SELECT *, 0 AS origin FROM old UNION ALL SELECT *, 1 FROM fresh) x GROUP BY 1, 2
""")
def union_matches(t):
    m = t("tx_matches").select("id", "shape_id", "shst_reference", "osrm_assisted")
    return matches.union_matches(m.filter("osrm_assisted = 0"), m.filter("osrm_assisted = 1"), ["shape_id", "shst_reference"]).select("shape_id", "shst_reference", "id")


@query("SELECT DISTINCT m.id AS conflation_map_id, x.id AS gtfs_matches_id FROM tx_match_paths p JOIN tx_matches x ON p.shst_match_id = x.id JOIN tx_conflation_map m USING (shst_reference)")
def match_candidates(t):
    return matches.candidates(t("tx_match_paths"), t("tx_matches"), t("tx_conflation_map")).select("conflation_map_id", "gtfs_matches_id")


COSPATIAL = "cospatial AS (SELECT DISTINCT m.id AS conflation_map_id, x.id AS gtfs_matches_id, (m.id % 7) / 1000.0E0 AS conf_map_pre_len, (m.id % 5) / 1000.0E0 AS conf_map_post_len, (x.id % 3) / 1000.0E0 AS gtfs_map_pre_len FROM tx_match_paths p JOIN tx_matches x ON p.shst_match_id = x.id JOIN tx_conflation_map m USING (shst_reference))"


@query(f"""WITH {COSPATIAL} SELECT p.shape_id, p.shape_index, c.conflation_map_id, c.conf_map_pre_len, c.conf_map_post_len,
rank() OVER (PARTITION BY p.shape_id, p.shape_index ORDER BY p.path_index, p.path_edge_index, c.gtfs_map_pre_len) - 1 AS along_idx
FROM tx_match_paths p JOIN cospatial c ON p.shst_match_id = c.gtfs_matches_id""")
def shape_map_path(t):
    c, g = F.col("conflation_map_id"), F.col("gtfs_matches_id")
    pairs = matches.candidates(t("tx_match_paths"), t("tx_matches"), t("tx_conflation_map"))
    pairs = pairs.withColumns({"conf_map_pre_len": (c % 7) / 1000.0, "conf_map_post_len": (c % 5) / 1000.0, "gtfs_map_pre_len": (g % 3) / 1000.0})
    return matches.shape_map_path(t("tx_match_paths"), pairs)


@query("""SELECT shape_id, shape_index, array_to_string(list(conflation_map_id ORDER BY along_idx, conflation_map_id), ',') AS ids,
count(*) FILTER (conf_map_pre_len > 0.005 OR conf_map_post_len > 0.005) AS n_sliced FROM tx_shape_map_join GROUP BY 1, 2""")
def multi_line_groups(t):
    rows = matches.multi_lines(t("tx_shape_map_join"))
    sliced = F.size(F.filter("lines", lambda x: matches.needs_slice(x["conf_map_pre_len"], x["conf_map_post_len"])))
    return rows.select("shape_id", "shape_index", F.array_join(F.transform("lines", lambda x: x["conflation_map_id"].cast("string")), ",").alias("ids"), sliced.cast("long").alias("n_sliced"))


@query(f"""WITH {SEGMENTS}, m AS (SELECT shape_id, shape_index, sum(feature_len_km) AS km FROM tx_matches GROUP BY 1, 2)
SELECT shape_id, shape_index, round((len_km - coalesce(km, 0)) / len_km, 6) AS unmatched_ratio FROM segments LEFT JOIN m USING (shape_id, shape_index) WHERE (len_km - coalesce(km, 0)) / len_km >= 0.1""")
def unmatched_ratio(t):
    return matches.unmatched(segments_of(t), t("tx_matches")).select("shape_id", "shape_index", F.round("unmatched_ratio", 6).alias("unmatched_ratio"))


VERTICES = "v AS (SELECT id, shape_id, CAST(0 AS INT) AS shape_index, shst_reference % 5 AS shst_reference, osrm_assisted, list_distinct([id % 3, id % 4, id % 6]) AS vertices FROM tx_matches)"


@query(f"""WITH {VERTICES} SELECT DISTINCT a.id FROM v a JOIN v b USING (shape_id, shape_index, shst_reference)
WHERE list_has_all(b.vertices, a.vertices) AND (len(b.vertices) > len(a.vertices) OR len(b.vertices) = len(a.vertices) AND (b.osrm_assisted < a.osrm_assisted OR b.osrm_assisted = a.osrm_assisted AND b.id < a.id))""")
def redundant_matches(t):
    i = F.col("id")
    v = t("tx_matches").select("id", "shape_id", F.lit(0).alias("shape_index"), (F.col("shst_reference") % 5).alias("shst_reference"), "osrm_assisted", F.array_distinct(F.array(i % 3, i % 4, i % 6)).alias("vertices"))
    return matches.redundant(v).select("id")


@query("SELECT x.id AS a, y.id AS b, x.shape_id, x.shape_index FROM tx_matches x JOIN tx_matches y ON x.shape_id = y.shape_id AND x.shape_index = y.shape_index AND x.id < y.id")
def route_pairs(t):
    return matches.pairs(t("tx_matches"), ["shape_id", "shape_index"], "id")


PATH_KM = f"{SEGMENTS}, path_km AS (SELECT p.shape_id, p.shape_index, p.path_index, sum(m.feature_len_km) AS path_km FROM tx_match_paths p JOIN tx_matches m ON m.id = p.shst_match_id GROUP BY 1, 2, 3)"


@query(f"WITH {PATH_KM} SELECT shape_id, shape_index, path_index, round(path_km, 6) AS path_km, round(abs(len_km - path_km) / len_km, 6) AS length_error FROM path_km JOIN segments USING (shape_id, shape_index)")
def path_length_error(t):
    rows = matches.path_length_error(t("tx_match_paths"), segments_of(t), t("tx_matches"))
    return rows.select("shape_id", "shape_index", "path_index", F.round("path_km", 6).alias("path_km"), F.round("length_error", 6).alias("length_error"))


@query(f"""WITH {PATH_KM}, chosen AS (SELECT shape_id, shape_index, sum(path_km) AS km FROM path_km GROUP BY 1, 2)
SELECT s.shape_id, round(sum(len_km), 6) AS shape_km, count(*) AS n_segments, count(km) AS n_chosen, round(coalesce(sum(km), 0), 6) AS chosen_km FROM segments s LEFT JOIN chosen USING (shape_id, shape_index) GROUP BY 1""")
def shape_summary(t):
    paths = matches.path_length_error(t("tx_match_paths"), segments_of(t), t("tx_matches"))
    out = matches.shape_summary(segments_of(t), paths)
    return out.withColumn("shape_km", F.round("shape_km", 6)).withColumn("chosen_km", F.round("chosen_km", 6))


@query("SELECT m.id, z AS zoom FROM tx_conflation_map m, unnest(range(0, 17)) u(z) WHERE m.networklevel < 1 OR z >= 14 OR (z >= 3 AND m.networklevel <= 1) OR (z >= 4 AND m.networklevel <= 2) OR (z >= 10 AND m.networklevel <= 3) OR (z >= 13 AND m.networklevel <= 4)")
def tile_visibility(t):
    rows = t("tx_conflation_map").select("id", "networklevel", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(16).cast("long"))).alias("zoom"))
    return rows.filter(matches.tile_visible(F.col("zoom"), F.col("networklevel"))).select("id", "zoom")


@query("""SELECT shst_reference % 10 AS grp, round(avg(feature_len_km), 6) AS mean, round(stddev_pop(feature_len_km), 6) AS std_dev, round(quantile_cont(feature_len_km, 0.5), 6) AS median,
round(quantile_cont(feature_len_km, 0.9), 6) AS q90 FROM tx_matches GROUP BY 1""")
def summary_stats(t):
    out = matches.summary_stats(t("tx_matches").withColumn("grp", F.col("shst_reference") % 10), ["grp"], "feature_len_km")
    return out.select("grp", F.round("mean", 6).alias("mean"), F.round("std_dev", 6).alias("std_dev"), F.round(F.get("quantiles", F.lit(4)), 6).alias("median"), F.round(F.get("quantiles", F.lit(6)), 6).alias("q90"))


@query(f"WITH {LINES} SELECT shape_id AS id, k, dense_rank() OVER (ORDER BY lon, lat) - 1 AS coord_id FROM pts WHERE n > 1")
def coordinate_ids(t):
    return matches.coordinate_ids(lines_of(t).select("id", "coords"))


@query(f"""WITH {LINES}, km AS (SELECT shape_id, sum({KM}) AS len, max(seg) + 2 AS n FROM steps GROUP BY 1), parts AS (SELECT *, CAST(greatest(ceil(len / 2.0), 1) AS INT) AS c FROM km)
SELECT shape_id AS id, CAST(p AS INT) AS part, round(len * p / c, 5) AS start_km, round(len * (p + 1) / c, 5) AS stop_km, n < 10 AS make_dense FROM parts, unnest(range(c)) u(p)""")
def presplit(t):
    rows = matches.presplit(lines_of(t))
    return rows.select("id", "part", F.round("start_km", 5).alias("start_km"), F.round("stop_km", 5).alias("stop_km"), "make_dense")


# --- scalar and array functions ---


@query("""
WITH p AS (SELECT shape_id, shape_pt_sequence AS q, round(CAST(shape_pt_lat AS DOUBLE), 3) AS lat, row_number() OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) AS k FROM tx_shapes),
d AS (SELECT *, lag(lat) OVER (PARTITION BY shape_id ORDER BY k) AS b FROM p)
SELECT shape_id AS id, count(*) FILTER (b IS NULL OR b <> lat) AS n FROM d GROUP BY 1
""")
def repeat_free_lines(t):
    flat = F.transform("coords", lambda c: F.struct(F.lit(0.0).alias("lon"), F.round(c["lat"], 3).alias("lat")))
    return lines_of(t).select("id", flat.alias("coords")).select("id", F.size(geo.without_repeats(F.col("coords"))).cast("long").alias("n"))


@query("""
SELECT p_partkey AS id, CASE WHEN k <= m AND k <= s AND k <= f THEN 1.0 WHEN m <= s AND m <= f THEN 1.609344 WHEN s <= f THEN 0.001 ELSE 0.0003048 END AS factor
FROM (SELECT p_partkey, abs(d - len) AS k, abs(d * 1.609344 - len) AS m, abs(d * 0.001 - len) AS s, abs(d * 0.0003048 - len) AS f FROM (SELECT p_partkey, p_retailprice AS d, p_size * 1.0E0 AS len FROM part) x) y
""")
def distance_units(t):
    rows = t("part")
    return rows.select(F.col("p_partkey").alias("id"), features.kilometres(F.col("p_retailprice"), F.col("p_size").cast("double")).alias("factor"))


@query("""
SELECT id, list_has_all(b, a) AS subset, (array_to_string(b, ',') || ',') LIKE ('%,' || array_to_string(a, ',') || ',%') OR (array_to_string(b, ',') || ',') LIKE (array_to_string(a, ',') || ',%') AS run
FROM (SELECT id, [id % 3, id % 2] AS a, [id % 2, id % 3, id % 2, id % 5] AS b FROM tx_matches) x
""")
def array_tests(t):
    i = F.col("id")
    a, b = F.array(i % 3, i % 2), F.array(i % 2, i % 3, i % 2, i % 5)
    return t("tx_matches").select("id", matches.is_subset(a, b).alias("subset"), matches.is_substring(a, b).alias("run"))


@query(f"""
WITH {LINES}, brng AS (SELECT shape_id, seg, {sql_bearing('a_lon', 'a_lat', 'b_lon', 'b_lat')} AS b FROM steps), d AS (SELECT shape_id, seg, b - lag(b) OVER (PARTITION BY shape_id ORDER BY seg) AS d FROM brng)
SELECT shape_id AS id, seg, round(CASE WHEN d < -180 THEN d + 360 ELSE d END, 5) + 0.0E0 AS turn FROM d WHERE d IS NOT NULL
""")
def relative_bearings(t):
    n = F.size("coords")
    b = F.zip_with(F.slice("coords", F.lit(1), n - 1), F.slice("coords", F.lit(2), n - 1), geo.bearing)
    rows = lines_of(t).select("id", b.alias("b"))
    turns = F.zip_with(F.slice("b", F.lit(1), F.size("b") - 1), F.slice("b", F.lit(2), F.size("b") - 1), geo.relative_bearing)
    return rows.select("id", F.posexplode(turns).alias("seg", "turn")).select("id", (F.col("seg") + 1).alias("seg"), (F.round("turn", 5) + 0.0).alias("turn"))


# --- properties ---


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS kind FROM events")
def feature_properties(t):
    """A property set from a column, one read from the JSON text, one dropped."""
    patch = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("gone"), F.lit(None).cast("string"))
    p = properties.merged(F.map_concat(properties.as_map(F.col("props")), F.create_map(F.lit("gone"), F.lit("x"))), patch)
    rows = t("events").select("event_id", properties.extract(F.col("props"), "k").alias("k"), p.alias("p"))
    return rows.select("event_id", "k", F.when(~F.map_contains_key("p", F.lit("gone")), F.col("p")["kind"]).alias("kind"))


@query("SELECT user_id % 50 AS grp, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def grouped_properties(t):
    counts = t("events").groupBy((F.col("user_id") % 50).alias("grp"), F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    return counts.groupBy("grp").agg(properties.grouped(F.col("kind"), F.col("n")).alias("m")).select("grp", F.explode("m").alias("kind", "n"))


@query(f"WITH {LINES} SELECT shape_id AS id, CAST(2 * k AS INT) AS k, round(lon, 6) AS lon, round(lat, 6) AS lat FROM pts WHERE n > 1 UNION ALL SELECT shape_id, CAST(2 * seg + 1 AS INT), round((a_lon + b_lon) / 2, 6), round((a_lat + b_lat) / 2, 6) FROM steps")
def dense_lines(t):
    """H2."""
    rows = lines_of(t).select("id", F.posexplode(geo.denser(F.col("coords"))).alias("k", "c"))
    return rows.select("id", "k", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"))


@query(f"WITH {LINES} SELECT shape_id, CAST(k AS BIGINT) AS shape_index, n FROM pts WHERE k % 4 <> 1")
def matchable_segments(t):
    """features of which some have no coordinates."""
    rows = lines_of(t).select(F.col("id").alias("shape_id"), F.posexplode("coords").alias("shape_index", "c"), "coords")
    some = F.when(F.col("shape_index") % 4 == 1, F.slice("coords", 1, 0)).otherwise(F.col("coords"))
    return matches.matchable(rows.withColumn("coords", some).withColumn("shape_index", F.col("shape_index").cast("long"))).select("shape_id", F.col("shape_index").cast("long").alias("shape_index"), F.size("coords").cast("long").alias("n"))


@query("SELECT shape_id, shape_pt_sequence, lag(shape_pt_sequence) OVER (PARTITION BY shape_id ORDER BY shape_pt_sequence) AS before FROM tx_shapes")
def checked_sequences(t):
    """W9."""
    w = Window.partitionBy("shape_id").orderBy("shape_pt_sequence")
    return features.checked_sequences(t("tx_shapes")).select("shape_id", "shape_pt_sequence", F.lag("shape_pt_sequence").over(w).alias("before"))


@query(f"WITH {SEGMENTS} SELECT shape_id, shape_index, round(len_km, 6) AS len_km FROM segments WHERE shape_id = 7")
def segments_of_shape(t):
    """S9."""
    return features.segments_of_shape(segments_of(t), 7).withColumn("len_km", F.round("len_km", 6))


@query("SELECT event_id, event_type AS kind FROM events")
def properties_without(t):
    """P4."""
    p = properties.without(F.create_map(F.lit("kind"), F.col("event_type"), F.lit("gis_x"), F.lit("1")), ["gis_x"])
    return t("events").select("event_id", p.alias("p")).select("event_id", F.explode("p").alias("key", "kind")).filter("key = 'kind'").drop("key").select("event_id", "kind")


@query(f"""WITH {LINES} SELECT 'stop' AS kind, CAST(stop_id AS VARCHAR) AS id, CAST(1 AS BIGINT) AS n, round(CAST(stop_lon AS DOUBLE), 6) AS lon FROM tx_stops
UNION ALL SELECT 'shape', CAST(shape_id AS VARCHAR), count(*), arg_min(lon, k) FROM pts WHERE n > 1 GROUP BY shape_id""")
def all_features(t):
    """S13."""
    rows = features.all_features(features.stop_features(t("tx_stops")), lines_of(t))
    return rows.select("kind", "id", F.size("coords").cast("long").alias("n"), F.get("coords", F.lit(0))["lon"].alias("lon"))


@query(f"""WITH {LINES}, km AS (SELECT shape_id, sum({KM}) AS len FROM steps GROUP BY 1), seq AS (
  SELECT DISTINCT s_suppkey % 40 AS shape_id, s_suppkey AS stop_id, s_suppkey / 500.0E0 AS dist FROM supplier
), visits AS (SELECT *, CAST(row_number() OVER (PARTITION BY shape_id ORDER BY stop_id) - 1 AS INT) AS k FROM seq)
SELECT v.shape_id, v.k, v.stop_id, round(CAST(s.stop_lon AS DOUBLE), 6) AS lon, round(CASE WHEN v.dist <> 0 THEN least(v.dist, len) ELSE v.dist END, 6) AS dist
FROM visits v JOIN km USING (shape_id) JOIN tx_stops s ON s.stop_id = v.stop_id""")
def shapes_with_stops(t):
    """J3, J5, A10, P10."""
    visit = F.struct("s_suppkey", F.struct(F.col("s_suppkey").alias("stop_id"), (F.col("s_suppkey") / 500.0).alias("shape_dist_traveled")).alias("s"))
    sequences = t("supplier").groupBy((F.col("s_suppkey") % 40).alias("shape_id")).agg(F.sort_array(F.collect_list(visit)).alias("v")).select("shape_id", F.transform("v", lambda v: v["s"]).alias("stops"))
    rows = features.shapes_with_stops(sequences, lines_of(t), features.stop_features(t("tx_stops"))).select("shape_id", F.explode("stops").alias("s"))
    return rows.select("shape_id", "s.k", "s.stop_id", "s.lon", F.round("s.dist", 6).alias("dist"))


@query(f"WITH {SNAPPED}, nearest AS (SELECT shape_id, k, min(dev) AS dev FROM cells GROUP BY 1, 2) SELECT shape_id, round(sqrt(avg(pow(dev * 1000, 2))), 4) AS rms_m FROM nearest GROUP BY 1")
def deviation_of_stops(t):
    """Root mean square of the stops' distances from their shape, in metres."""
    return network.rms_deviation_m(projected(t)).withColumn("rms_m", F.round("rms_m", 4))


@query(f"""WITH {LINES}, along AS (
  SELECT *, sum({KM}) OVER (PARTITION BY shape_id ORDER BY seg) AS stop, {KM} AS km FROM steps
), whole AS (SELECT shape_id, max(stop) AS len FROM along GROUP BY 1), cut AS (
  SELECT shape_id, e, len * e / 4 AS cut_km FROM whole, (SELECT unnest([1, 3]) AS e) x
)
SELECT c.shape_id AS id, CAST(e AS INT) AS quarter, round(a_lon + (b_lon - a_lon) * (cut_km - (stop - km)) / km, 5) AS lon, round(a_lat + (b_lat - a_lat) * (cut_km - (stop - km)) / km, 5) AS lat
FROM cut c JOIN along a ON a.shape_id = c.shape_id AND a.stop - a.km < c.cut_km AND a.stop >= c.cut_km""")
def line_slices(t):
    """Ends of the middle half of each line."""
    rows = mapjoin.slices(lines_of(t), "id", 0.25, 0.75)
    ends = rows.select("id", F.explode(F.array(F.struct(F.lit(1).alias("quarter"), F.get("coords", F.lit(0)).alias("c")), F.struct(F.lit(3).alias("quarter"), F.element_at("coords", -1).alias("c")))).alias("e"))
    return ends.select("id", "e.quarter", F.round("e.c.lon", 5).alias("lon"), F.round("e.c.lat", 5).alias("lat"))


# --- kernels; tests hold them against brute force ---


def shaped(t) -> DataFrame:
    """Shapes with stops on them: shape_id, coords, stops."""
    stops = shape_points(t).groupBy("shape_id").agg(F.sort_array(F.collect_list(F.struct("k", F.concat(F.col("shape_id").cast("string"), F.lit("-"), F.col("k").cast("string")).alias("stop_id"), "lon", "lat"))).alias("stops"))
    return lines_of(t).select(F.col("id").alias("shape_id"), "coords").join(stops, "shape_id")


def network_of(t) -> DataFrame:
    """The network's segments, made once for all that a query does with them."""
    return network.shape_segments(shaped(t)).checkpoint()


def matched(segments: DataFrame) -> DataFrame:
    """The matches of each network segment: its two halves and, for some, the whole of it again."""
    s = segments.select("shape_id", "shape_index", "coords").filter(F.size("coords") > 2)
    n, half = F.size("coords"), F.ceil(F.size("coords") / 2).cast("int")
    parts = F.array(F.slice("coords", F.lit(1), half), F.slice("coords", half, n), F.col("coords"))
    rows = s.select("shape_id", "shape_index", F.posexplode(parts).alias("part", "coords")).filter("part < 2 OR shape_index % 2 = 0")
    return rows.select((F.xxhash64("shape_id", "shape_index", "part").bitwiseAND(2**53 - 1)).alias("id"), "shape_id", "shape_index", F.concat_ws("/", "shape_id", "shape_index").alias("shst_reference"), F.lit(0.0).alias("section_start"), geo.length_km(F.col("coords")).alias("section_end"), "coords")


@query()
def shape_segments(t):
    return network.shape_segments(shaped(t))


@query()
def chosen_paths(t):
    s = network_of(t)
    return choose.chosen_paths(s, matched(s))


@query()
def path_scores(t):
    s = network_of(t)
    return choose.scores(s, matched(s), choose.chosen_paths(s, matched(s)))


@query()
def cospatial_join(t):
    s = network_of(t)
    road = s.select(F.xxhash64("shape_id", "shape_index").bitwiseAND(2**53 - 1).alias("id"), F.concat_ws("/", "shape_id", "shape_index").alias("shst_reference"), "coords")
    return mapjoin.conflation_join(road, matched(s), choose.chosen_paths(s, matched(s)).checkpoint())


def roads_of(t) -> DataFrame:
    return lines_of(t).select(F.col("id").cast("string").alias("shst_reference"), "coords")


@query()
def segment_matches(t):
    """The built-in matcher between the network and its own lines as roads."""
    return matcher.match(network.shape_segments(shaped(t)), roads_of(t))


@query()
def assisted_matches(t):
    """H1-H6: the ladder of passes over segments moved off the roads by 50 m, so that most of them need a route."""
    s = network_of(t).withColumn("coords", F.transform("coords", lambda c: F.struct((c["lon"] + 0.0006).alias("lon"), c["lat"].alias("lat"))))
    return matcher.matched(s, roads_of(t))


@query(f"""WITH {LINES}, area AS (SELECT stop_id, stop_lon AS c_lon, stop_lat AS c_lat, stop_lon + 0.0007 AS d_lon, stop_lat + 0.0011 AS d_lat FROM tx_stops), flat AS (
  SELECT s.shape_id, {DEGREE_KM} * cos(radians(a.c_lat)) AS fx, {DEGREE_KM} AS fy, (s.a_lon - a.c_lon) AS ax, (s.a_lat - a.c_lat) AS ay, (s.b_lon - a.c_lon) AS bx, (s.b_lat - a.c_lat) AS by_, a.d_lon - a.c_lon AS dx, a.d_lat - a.c_lat AS dy
  FROM steps s JOIN area a ON s.a_lon BETWEEN a.c_lon - 0.05 AND a.c_lon + 0.05 AND s.a_lat BETWEEN a.c_lat - 0.05 AND a.c_lat + 0.05
), km AS (SELECT shape_id, ax * fx AS ax, ay * fy AS ay, bx * fx AS bx, by_ * fy AS by_, dx * fx AS dx, dy * fy AS dy FROM flat), ends AS (
  SELECT *, least(greatest((ax * dx + ay * dy) / (dx * dx + dy * dy), 0), 1) AS ta, least(greatest((bx * dx + by_ * dy) / (dx * dx + dy * dy), 0), 1) AS tb,
         least(greatest((-ax * (bx - ax) - ay * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)), 0), 1) AS tc,
         least(greatest(((dx - ax) * (bx - ax) + (dy - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)), 0), 1) AS td,
         (dx * ay - dy * ax) * (dx * by_ - dy * bx) <= 0 AND ((bx - ax) * (-ay) - (by_ - ay) * (-ax)) * ((bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax)) <= 0 AS meet FROM km
)
SELECT DISTINCT CAST(shape_id AS BIGINT) AS id FROM ends WHERE meet OR least(pow(ax - ta * dx, 2) + pow(ay - ta * dy, 2), pow(bx - tb * dx, 2) + pow(by_ - tb * dy, 2),
  pow(ax + tc * (bx - ax), 2) + pow(ay + tc * (by_ - ay), 2), pow(ax + td * (bx - ax) - dx, 2) + pow(ay + td * (by_ - ay) - dy, 2)) <= 0.3 * 0.3""")
def map_within(t):
    """Shapes within 300 m of any stop's short line."""
    ends = F.array(geo.point(F.col("stop_lon"), F.col("stop_lat")), geo.point(F.col("stop_lon") + 0.0007, F.col("stop_lat") + 0.0011))
    return mapjoin.within(lines_of(t).select(F.col("id").cast("long").alias("id"), "coords"), t("tx_stops").select(ends.alias("coords")), 0.3)
