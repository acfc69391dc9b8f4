"""Queries on schedules: stops, calendars, probes, traffic, AADT."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from ..operators import calendar, schedule, spread, tracking
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


def stops_of(t) -> DataFrame:
    return schedule.scheduled_stops(t("tx_trips"), t("tx_stop_times"))


@query("SELECT trip_id, route_id, service_id, shape_id, stop_sequence, stop_id, arrival_sec, departure_sec FROM tx_trips JOIN tx_stop_times USING (trip_id)")
def scheduled_stops(t):
    return stops_of(t).select("trip_id", "route_id", "service_id", "shape_id", "stop_sequence", "stop_id", "arrival_sec", "departure_sec")


@query("SELECT count(*) AS n_trips, count(*) FILTER (shape_id IS NULL) AS n_shapeless FROM tx_trips")
def shapeless_trip_counts(t):
    return schedule.shapeless_trip_counts(t("tx_trips"))


@query("SELECT count(*) - count(DISTINCT trip_id) AS n_expected FROM tx_trips JOIN tx_stop_times USING (trip_id) WHERE shape_id IS NOT NULL")
def expected_observations(t):
    return schedule.expected_observations(schedule.with_shape(stops_of(t)))


@query("""
SELECT * FROM (
  SELECT trip_id, shape_id, stop_sequence, lag(stop_id) OVER w AS from_stop_id, stop_id AS to_stop_id,
         lag(departure_sec) OVER w AS departure_time_sec, arrival_sec AS arrival_time_sec
  FROM tx_trips JOIN tx_stop_times USING (trip_id) WHERE shape_id IS NOT NULL
  WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence)
) x WHERE from_stop_id IS NOT NULL
""")
def trip_traversals(t):
    return schedule.traversals(schedule.with_shape(stops_of(t)))


@query("""
SELECT trip_id, stop_sequence, clock, CAST(split_part(clock, ':', 1) AS INT) * 3600 + CAST(split_part(clock, ':', 2) AS INT) * 60 + CAST(split_part(clock, ':', 3) AS INT) AS seconds,
       CAST(floor(arrival_sec / 300.0) AS INT) AS epoch
FROM (SELECT trip_id, stop_sequence, arrival_sec,
             lpad(CAST(CAST(floor(arrival_sec / 3600.0) AS INT) AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(floor(arrival_sec / 60.0) AS INT) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(arrival_sec % 60 AS VARCHAR), 2, '0') AS clock
      FROM tx_stop_times) x
""")
def clock_seconds(t):
    sec = F.col("arrival_sec")
    clock = F.format_string("%02d:%02d:%02d", F.floor(sec / 3600).cast("int"), F.floor(sec / 60).cast("int") % 60, (sec % 60).cast("int"))
    rows = t("tx_stop_times").select("trip_id", "stop_sequence", clock.alias("clock"))
    return rows.withColumn("seconds", times.seconds(F.col("clock"))).withColumn("epoch", times.epoch(F.col("seconds")))


# --- alignment of trips with their shapes' stops ---

SHAPE_STOPS = """
shape_stops AS (
  SELECT shape_id, CAST(row_number() OVER (PARTITION BY shape_id ORDER BY lap, stop_id) - 1 AS INT) AS shape_index, stop_id
  FROM (SELECT DISTINCT t.shape_id, s.stop_id FROM tx_trips t JOIN tx_stop_times s USING (trip_id) WHERE t.shape_id IS NOT NULL) a
  CROSS JOIN (SELECT 0 AS lap UNION ALL SELECT 1) l
)"""


def shape_stops(t) -> DataFrame:
    """Each shape visits its stops twice, a loop line."""
    one = schedule.with_shape(stops_of(t)).select("shape_id", "stop_id").distinct()
    two = one.withColumn("lap", F.explode(F.array(F.lit(0), F.lit(1))))
    w = Window.partitionBy("shape_id").orderBy("lap", "stop_id")
    return two.select("shape_id", (F.row_number().over(w) - 1).alias("shape_index"), "stop_id")


@query(f"""
WITH RECURSIVE {SHAPE_STOPS}, visits AS (
  SELECT t.trip_id, t.shape_id, s.stop_id, row_number() OVER (PARTITION BY t.trip_id ORDER BY s.stop_sequence) AS k
  FROM tx_trips t JOIN tx_stop_times s USING (trip_id) WHERE t.shape_id IS NOT NULL
), walk AS (
  SELECT v.trip_id, v.shape_id, v.k, min(p.shape_index) AS idx FROM visits v JOIN shape_stops p USING (shape_id, stop_id) WHERE v.k = 1 GROUP BY 1, 2, 3
  UNION ALL
  SELECT v.trip_id, v.shape_id, v.k, (SELECT min(p.shape_index) FROM shape_stops p WHERE p.shape_id = v.shape_id AND p.stop_id = v.stop_id AND p.shape_index >= w.idx) AS idx
  FROM walk w JOIN visits v ON v.trip_id = w.trip_id AND v.k = w.k + 1
)
SELECT trip_id, CAST(k - 1 AS INT) AS visit, CAST(idx AS INT) AS shape_index FROM walk
""")
def trip_alignment(t):
    return tracking.visits(tracking.align(schedule.with_shape(stops_of(t)), tracking.stop_indices(shape_stops(t))))


@query(f"""
WITH RECURSIVE {SHAPE_STOPS}, visits AS (
  SELECT t.trip_id, t.shape_id, s.stop_id, s.arrival_sec, s.departure_sec, row_number() OVER (PARTITION BY t.trip_id ORDER BY s.stop_sequence) AS k
  FROM tx_trips t JOIN tx_stop_times s USING (trip_id) WHERE t.shape_id IS NOT NULL
), walk AS (
  SELECT v.trip_id, v.shape_id, v.k, v.arrival_sec, v.departure_sec, CAST(NULL AS BIGINT) AS dep_idx, CAST(NULL AS BIGINT) AS dep_sec, min(p.shape_index) AS idx
  FROM visits v JOIN shape_stops p USING (shape_id, stop_id) WHERE v.k = 1 GROUP BY 1, 2, 3, 4, 5
  UNION ALL
  SELECT v.trip_id, v.shape_id, v.k, v.arrival_sec, v.departure_sec, w.idx, w.departure_sec,
         (SELECT min(p.shape_index) FROM shape_stops p WHERE p.shape_id = v.shape_id AND p.stop_id = v.stop_id AND p.shape_index >= w.idx)
  FROM walk w JOIN visits v ON v.trip_id = w.trip_id AND v.k = w.k + 1
)
SELECT shape_id, CAST(dep_idx AS INT) AS departure_seg_idx, CAST(idx AS INT) AS arrival_seg_idx, CAST(dep_sec AS BIGINT) AS departure_time_sec, CAST(arrival_sec AS BIGINT) AS arrival_time_sec, trip_id
FROM walk WHERE k > 1
""")
def scheduled_traffic(t):
    out = tracking.scheduled_traffic(schedule.with_shape(stops_of(t)), tracking.stop_indices(shape_stops(t)))
    return out.withColumn("departure_time_sec", F.col("departure_time_sec").cast("long")).withColumn("arrival_time_sec", F.col("arrival_time_sec").cast("long"))


# --- calendar ---

EXTENT = """
extent AS (
  SELECT least((SELECT min(start_date) FROM tx_calendar), (SELECT min(date) FROM tx_calendar_dates WHERE exception_type = '1')) AS feed_start_date,
         greatest((SELECT max(end_date) FROM tx_calendar), (SELECT max(date) FROM tx_calendar_dates WHERE exception_type = '1')) AS feed_end_date
), spine AS (
  SELECT strftime(d, '%Y%m%d') AS date, CAST(dayofweek(d) AS INT) AS dow
  FROM (SELECT unnest(generate_series(strptime(feed_start_date, '%Y%m%d'), strptime(feed_end_date, '%Y%m%d'), INTERVAL 1 DAY)) AS d FROM extent) s
)"""
INCLUDED = """
included AS (
  SELECT c.service_id, s.date, s.dow FROM spine s JOIN tx_calendar c
    ON s.date BETWEEN c.start_date AND c.end_date
   AND [c.sunday, c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday][s.dow + 1] = 1
  UNION SELECT a.service_id, s.date, s.dow FROM tx_calendar_dates a JOIN spine s USING (date) WHERE a.exception_type = '1'
)"""
REMOVED = "SELECT i.* FROM included i LEFT JOIN tx_calendar_dates r ON r.service_id = i.service_id AND r.date = i.date AND r.exception_type = '2' WHERE r.date IS NULL"


def extent_of(t) -> DataFrame:
    none = t("tx_calendar").sparkSession.createDataFrame([], calendar.FEED_INFO)
    return calendar.feed_extent(none, t("tx_calendar"), t("tx_calendar_dates"))


def dates_of(t, compat: bool = False) -> DataFrame:
    return calendar.service_dates(extent_of(t), t("tx_calendar"), t("tx_calendar_dates"), compat)


@query(f"WITH {EXTENT} SELECT feed_start_date, feed_end_date FROM extent")
def feed_extent(t):
    return extent_of(t)


@query(f"WITH {EXTENT} SELECT date, dow FROM spine")
def date_spine(t):
    return calendar.date_spine(extent_of(t))


@query(f"WITH {EXTENT}, {INCLUDED} {REMOVED}")
def service_dates(t):
    return dates_of(t)


@query(f"WITH {EXTENT}, {INCLUDED} SELECT * FROM included")
def service_dates_compat(t):
    return dates_of(t, compat=True)


@query(f"""
WITH {EXTENT}
SELECT DISTINCT a.service_id, s.date, s.dow FROM tx_calendar_dates a JOIN (
  SELECT strftime(d, '%Y%m%d') AS date, CAST(dayofweek(d) AS INT) AS dow FROM (
    SELECT unnest(generate_series((SELECT min(strptime(date, '%Y%m%d')) FROM tx_calendar_dates WHERE exception_type = '1'), (SELECT max(strptime(date, '%Y%m%d')) FROM tx_calendar_dates WHERE exception_type = '1'), INTERVAL 1 DAY)) AS d) x
) s USING (date) WHERE a.exception_type = '1'
""")
def optional_calendar(t):
    """A feed without calendar and feed_info."""
    spark = t("tx_calendar_dates").sparkSession
    info, regular, special = calendar.date_tables(spark, {"calendar_dates": t("tx_calendar_dates")})
    return calendar.service_dates(calendar.feed_extent(info, regular, special), regular, special)


@query("""
SELECT DISTINCT t.trip_id, d.dow FROM tx_trips t JOIN tx_calendar c USING (service_id)
CROSS JOIN (SELECT unnest(range(7)) AS dow) d
WHERE [c.sunday, c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday][d.dow + 1] = 1
""")
def trip_weekdays(t):
    return calendar.trip_weekdays(t("tx_trips"), t("tx_calendar"))


# --- probes and traffic ---

TRAFFIC = """
traffic AS (
  SELECT * FROM (
    SELECT trip_id, shape_id, lag(stop_sequence) OVER w AS departure_seg_idx, stop_sequence AS arrival_seg_idx,
           lag(departure_sec) OVER w AS departure_time_sec, arrival_sec AS arrival_time_sec
    FROM tx_trips JOIN tx_stop_times USING (trip_id) WHERE shape_id IS NOT NULL
    WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence)
  ) x WHERE departure_seg_idx IS NOT NULL
)"""
SPEED = "CASE " + " ".join(f"WHEN floor(m.networklevel) = {k} THEN {v}" for k, v in schedule.SPEED.items()) + f" ELSE {schedule.OTHER_SPEED} END"
PATHS = f"""
paths AS (
  SELECT a.*, b.shape_index, b.along_idx, b.conflation_map_id,
         (m.length_km - b.conf_map_pre_len - b.conf_map_post_len) / ({SPEED}) AS w
  FROM traffic a JOIN tx_shape_map_join b ON a.shape_id = b.shape_id AND a.departure_seg_idx <= b.shape_index AND a.arrival_seg_idx > b.shape_index
  JOIN tx_conflation_map m ON b.conflation_map_id = m.id
)"""


def probe_cte(order: str) -> str:
    return f"""{PATHS}, shared AS (
  SELECT *, (arrival_time_sec - departure_time_sec) * w / sum(w) OVER (PARTITION BY trip_id, departure_time_sec, arrival_time_sec, departure_seg_idx, arrival_seg_idx) AS tt FROM paths
), started AS (
  SELECT *, departure_time_sec + coalesce(sum(tt) OVER (PARTITION BY trip_id, departure_time_sec, arrival_time_sec, departure_seg_idx, arrival_seg_idx
         ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS starts FROM shared
), probe AS (
  SELECT conflation_map_id, trip_id, CAST(floor(round(starts, 6) / 300.0) AS INT) AS epoch, sum(round(tt, 3)) AS travel_time FROM started GROUP BY 1, 2, 3
)"""


PROBE = probe_cte("shape_index, along_idx, conflation_map_id")


def traffic_of(t) -> DataFrame:
    w = Window.partitionBy("trip_id").orderBy("stop_sequence")
    rows = schedule.with_shape(stops_of(t)).select(
        "trip_id", "shape_id", F.lag("stop_sequence").over(w).alias("departure_seg_idx"), F.col("stop_sequence").alias("arrival_seg_idx"),
        F.lag("departure_sec").over(w).alias("departure_time_sec"), F.col("arrival_sec").alias("arrival_time_sec"),
    )
    return rows.filter("departure_seg_idx IS NOT NULL")


def probe_of(t, compat: bool = False) -> DataFrame:
    return schedule.synthetic_probe(traffic_of(t), t("tx_shape_map_join"), t("tx_conflation_map"), compat)


def spreading(t) -> tuple[DataFrame, ...]:
    return t("tx_routes"), t("tx_trips"), dates_of(t), traffic_of(t), t("tx_shape_map_join"), t("tx_conflation_map"), calendar.feed_weeks(extent_of(t))


@query(f"WITH {TRAFFIC}, {PROBE} SELECT conflation_map_id, trip_id, epoch, round(travel_time, 3) AS travel_time FROM probe")
def synthetic_probe(t):
    return probe_of(t)


@query(f"WITH {TRAFFIC}, {probe_cte('along_idx, conflation_map_id')} SELECT conflation_map_id, trip_id, epoch, round(travel_time, 3) AS travel_time FROM probe")
def synthetic_probe_compat(t):
    return probe_of(t, compat=True)


@query(f"WITH {TRAFFIC}, {PATHS} SELECT trip_id, departure_seg_idx, arrival_seg_idx, shape_index, conflation_map_id, along_idx FROM paths")
def traversal_paths(t):
    rows = schedule.traversal_paths(traffic_of(t), t("tx_shape_map_join"), t("tx_conflation_map"))
    return rows.select("trip_id", "departure_seg_idx", "arrival_seg_idx", "shape_index", "conflation_map_id", "along_idx")


@query(f"""WITH {TRAFFIC}, {PATHS} SELECT trip_id, departure_seg_idx, arrival_seg_idx, count(*) AS n,
       array_to_string(list(conflation_map_id ORDER BY shape_index, along_idx, conflation_map_id), ',') AS ids FROM paths GROUP BY 1, 2, 3""")
def traversal_path_arrays(t):
    ids = lambda path: F.array_join(F.transform(path, lambda x: x["conflation_map_id"].cast("string")), ",")
    return schedule.path_arrays(traffic_of(t), t("tx_shape_map_join"), t("tx_conflation_map"), lambda path: [F.size(path).cast("long").alias("n"), ids(path).alias("ids")])


@query(f"SELECT m.id, m.networklevel, CAST({SPEED} AS DOUBLE) AS speed FROM tx_conflation_map m")
def speed_lookup(t):
    return t("tx_conflation_map").select("id", "networklevel", schedule.speed_limit(F.col("networklevel")).cast("double").alias("speed"))


BY_ROUTE = f"""{EXTENT}, {INCLUDED}, service AS ({REMOVED}), {TRAFFIC}, {PROBE}, by_route AS (
  SELECT p.conflation_map_id, coalesce(r.route_short_name, CAST(r.route_id AS VARCHAR)) AS route_short_name, s.dow, p.epoch, CAST(sum(CAST(round(p.travel_time * 1000) AS BIGINT)) AS BIGINT) AS ms, count(p.travel_time) AS n,
         CAST((140 * count(*) + max(days)) // nullif(2 * max(days), 0) AS DOUBLE) / 10 AS avg_weekly_count,
         array_to_string(list_sort(list(DISTINCT CAST(t.trip_id AS VARCHAR))), ',') AS trip_ids
  FROM tx_routes r JOIN tx_trips t USING (route_id) JOIN service s USING (service_id) JOIN probe p USING (trip_id)
  CROSS JOIN (SELECT datediff('day', strptime(feed_start_date, '%Y%m%d'), strptime(feed_end_date, '%Y%m%d')) AS days FROM extent) e
  GROUP BY 1, 2, 3, 4
)"""
AADT = BY_ROUTE + """, aadt AS (
  SELECT conflation_map_id, route_short_name,
         CASE WHEN epoch BETWEEN 72 AND 239 THEN CASE WHEN dow BETWEEN 1 AND 5 THEN CASE WHEN epoch < 120 THEN 'AMP' WHEN epoch < 192 THEN 'MIDD' ELSE 'PMP' END ELSE 'WE' END ELSE 'OVN' END AS peak,
         CAST(round(sum(CAST(avg_weekly_count AS DECIMAL(18, 1))) / 7.0) AS BIGINT) AS aadt
  FROM by_route GROUP BY 1, 2, 3
)"""


@query(f"""WITH {BY_ROUTE}
SELECT conflation_map_id, route_short_name, dow, epoch, avg_weekly_count, trip_ids, CAST((2000 * ms + n) // (2 * n) AS BIGINT) AS avg_travel_time_us FROM by_route""")
def traffic_by_route(t):
    """The average in whole microseconds, halves up, which both sides work out in whole numbers."""
    return spread.traffic_by_route(*spreading(t)).select("conflation_map_id", "route_short_name", "dow", "epoch", "avg_weekly_count", "trip_ids", "avg_travel_time_us")


@query(f"""WITH {BY_ROUTE}, whole AS (
  SELECT *, (2000000 * CAST(ms AS HUGEINT) + n) // (2 * n) AS nano, CAST(round(avg_weekly_count * 10) AS HUGEINT) AS w FROM by_route
)
SELECT conflation_map_id, dow, epoch, CAST((2 * sum(nano * w) + 1000000 * sum(w)) // nullif(2000000 * sum(w), 0) AS DOUBLE) / 1000 AS avg_tt, CAST(sum(w) AS DOUBLE) / 10 AS avg_weekly_count,
       array_to_string(list_sort(list(DISTINCT route_short_name)), ',') AS routes
FROM whole GROUP BY 1, 2, 3""")
def traffic_total(t):
    return spread.traffic_total(*spreading(t))


def breakdown_of(t, nested: bool = True) -> DataFrame:
    return spread.aadt_breakdown(*spreading(t), nested=nested)


@query(f"WITH {AADT} SELECT conflation_map_id, peak, route_short_name, aadt FROM aadt")
def aadt_peak(t):
    return schedule.parts_of_breakdown(breakdown_of(t)).select("conflation_map_id", "peak", "route_short_name", "aadt")


@query(f"WITH {AADT} SELECT conflation_map_id, CAST(sum(aadt) AS BIGINT) AS aadt FROM aadt GROUP BY 1")
def aadt_total(t):
    return breakdown_of(t, nested=False).select("conflation_map_id", "aadt")


@query(f"WITH {AADT} SELECT conflation_map_id, peak, CAST(sum(aadt) AS BIGINT) AS aadt FROM aadt GROUP BY 1, 2")
def aadt_by_peak(t):
    return breakdown_of(t, nested=False).select("conflation_map_id", F.explode("aadt_by_peak").alias("peak", "aadt"))


@query(f"WITH {AADT} SELECT conflation_map_id, route_short_name, peak, aadt FROM aadt")
def aadt_by_route(t):
    return schedule.parts_of_breakdown(breakdown_of(t))
