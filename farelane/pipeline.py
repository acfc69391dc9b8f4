"""The nine stages, each reading and replacing tables of a warehouse (commands 1-9)."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import times
from .operators import calendar, choose, features, mapjoin, matcher, matches, network, schedule, tracking
from .sources import gtfs, roadmap, shapefile
from .sources.warehouse import Warehouse

log = logging.getLogger(__name__)
DATES = ("feed_info", "calendar", "calendar_dates")


@dataclass
class Pipeline:
    spark: SparkSession
    output_dir: str
    compat: bool = False

    def __post_init__(self):
        self.tables = Warehouse(self.spark, f"{self.output_dir}/tables")

    def raw(self, table: str) -> DataFrame:
        return self.tables.read(f"raw_gtfs.{table}")

    def load_raw_gtfs(self, agency_name: str, gtfs_zip: str) -> None:
        found, others = gtfs.read_feed(self.spark, gtfs_zip, f"{self.output_dir}/unpacked")
        for name in others:
            log.warning("no table created for %s", name)
        for name, df in found.items():
            self.tables.write(f"raw_gtfs.{name}", df)
        counts = schedule.shapeless_trip_counts(self.raw("trips")).first()
        if counts["n_shapeless"]:
            log.warning("%d of %d trips have no shape", counts["n_shapeless"], counts["n_trips"])
        gtfs.keep_origin(self.spark, gtfs_zip, agency_name, self.output_dir)

    def gtfs_as_geojson(self) -> None:
        self.tables.write("geojson_gtfs.stops", features.in_geo_order(features.stop_features(self.raw("stops"))))
        self.tables.write("geojson_gtfs.shapes", features.in_geo_order(features.shape_lines(self.raw("shapes"))))

    def stops_of_trips(self) -> DataFrame:
        times_of = self.raw("stop_times").withColumns({"arrival_sec": times.seconds(F.col("arrival_time")), "departure_sec": times.seconds(F.col("departure_time"))})
        return schedule.with_shape(schedule.scheduled_stops(self.raw("trips"), times_of))

    def gtfs_network(self) -> None:
        sequences = features.stop_sequences(schedule.with_shape(schedule.scheduled_stops(self.raw("trips"), self.raw("stop_times"))))
        whole = features.shapes_with_stops(sequences, self.tables.read("geojson_gtfs.shapes"), self.tables.read("geojson_gtfs.stops"))
        segments = network.shape_segments(whole).withColumn("id", F.xxhash64("shape_id", "shape_index"))
        self.tables.write("gtfs_network.shape_segments", features.in_geo_order(segments))

    def gtfs_osm_network(self, found: DataFrame | None = None) -> None:
        """found: matches of segments made elsewhere: id, shape_id, shape_index, shst_reference, section_start, section_end, feature_len_km, coords, osrm_assisted.
        Without them the road map that has been loaded is matched."""
        segments = self.tables.read("gtfs_network.shape_segments")
        if found is None:
            found = matcher.matched(segments, self.tables.read("conflation_map.conflation_map"), self.compat)
        key = ["shape_id", "shape_index", "shst_reference", "section_start", "section_end"]
        vertices = found.withColumn("vertices", F.col("coords"))
        kept = matches.insert_or_ignore(matches.without_redundant(vertices).drop("vertices"), key, ["id"])
        kept = self.tables.write("gtfs_osm_network.tmp_shst_match_features", kept)
        paths = self.tables.write("gtfs_osm_network.gtfs_shape_shst_match_paths", choose.chosen_paths(segments, kept))
        self.tables.write("gtfs_osm_network.gtfs_shape_shst_match_scores", choose.scores(segments, kept, paths, self.compat))

    def scheduled_bus_traffic(self) -> None:
        stops = self.stops_of_trips()
        if not stops.filter("arrival_sec IS NULL OR departure_sec IS NULL").isEmpty():
            raise ValueError("stop_times without arrival_time or departure_time; fill them in first")
        ends = tracking.stop_indices(tracking.shape_stops_of_segments(self.tables.read("gtfs_network.shape_segments")))
        traffic = self.tables.write("gtfs_scheduled_traffic.scheduled_transit_traffic", tracking.scheduled_traffic(stops, ends))
        expected = schedule.expected_observations(stops).first()["n_expected"]
        if (n := traffic.count()) != expected:
            log.warning("%d traversals; %d were expected", n, expected)
        present = {t: self.raw(t) for t in DATES if self.tables.has(f"raw_gtfs.{t}")}
        info, regular, special = calendar.date_tables(self.spark, present)
        extent = calendar.feed_extent(info, regular, special)
        calendar.checked_extent(extent)
        extent = self.tables.write("gtfs_scheduled_traffic.feed_date_extent", extent)
        self.tables.write("gtfs_scheduled_traffic.service_dates", calendar.service_dates(extent, regular, special, self.compat))

    def load_conflation_map(self, conflation_map_sqlite_db: str) -> None:
        raw = roadmap.sqlite_to_parquet(self.spark, conflation_map_sqlite_db, f"{self.output_dir}/conflation_map_rows")
        self.tables.write("conflation_map.conflation_map", roadmap.conflation_map(raw), sort=["id"])

    def gtfs_conflation_map_join(self) -> None:
        found, paths = self.tables.read("gtfs_osm_network.tmp_shst_match_features"), self.tables.read("gtfs_osm_network.gtfs_shape_shst_match_paths")
        overlap = self.tables.write("gtfs_conflation_map_join.map_segments_cospatiality", mapjoin.cospatiality(self.tables.read("conflation_map.conflation_map"), found, paths))
        self.tables.write("gtfs_conflation_map_join.gtfs_matches_conflation_map_join", matches.shape_map_path(paths, overlap))

    def gtfs_conflation_schedule_join(self) -> None:
        t = self.tables
        probe = schedule.synthetic_probe(t.read("gtfs_scheduled_traffic.scheduled_transit_traffic"), t.read("gtfs_conflation_map_join.gtfs_matches_conflation_map_join"), t.read("conflation_map.conflation_map"), self.compat)
        probe = t.write("gtfs_conflation_schedule_join.gtfs_synthetic_probe_data", probe, sort=["conflation_map_id", "trip_id", "epoch"])
        weeks = calendar.feed_weeks(t.read("gtfs_scheduled_traffic.feed_date_extent"))
        served = schedule.served_days(self.raw("routes"), self.raw("trips"), t.read("gtfs_scheduled_traffic.service_dates"))
        sums = t.write("gtfs_conflation_schedule_join.tmp_weekday_sums", schedule.sums_of_probe(served, probe, weeks))
        t.write("gtfs_conflation_schedule_join.gtfs_scheduled_traffic_by_route", schedule.by_route(sums))
        t.write("gtfs_conflation_schedule_join.gtfs_scheduled_traffic", schedule.traffic_total(sums))
        t.write("gtfs_conflation_schedule_join.conflation_map_aadt_breakdown", schedule.aadt_breakdown(schedule.aadt_by_route_and_peak(sums)))

    def output_shapefile(self, output_file: str) -> dict[str, int]:
        t = self.tables
        join = mapjoin.sliced(t.read("gtfs_conflation_map_join.gtfs_matches_conflation_map_join"), t.read("conflation_map.conflation_map"))
        named = shapefile.layers(
            t.read("geojson_gtfs.stops"), t.read("geojson_gtfs.shapes"), t.read("gtfs_network.shape_segments"),
            t.read("gtfs_osm_network.tmp_shst_match_features"), t.read("gtfs_osm_network.gtfs_shape_shst_match_paths"), join,
        )
        return shapefile.write_all(named, output_file)


def timed(stage, *args) -> None:
    began = time.time()
    stage(*args)
    log.info("%s: %.1f s", stage.__name__, time.time() - began)
