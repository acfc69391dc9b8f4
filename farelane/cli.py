"""Command line: python -m farelane.cli --output_dir DIR COMMAND ..."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from .pipeline import Pipeline, timed


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="farelane", description=__doc__)
    p.add_argument("--output_dir", required=True)
    p.add_argument("--compat", action="store_true", help="reproduce known quirks instead of the intended results")
    sub = p.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load_raw_gtfs_into_sqlite", aliases=["load_raw_gtfs"], help="a feed's zip file into tables")
    load.add_argument("--agency_name", required=True)
    load.add_argument("--gtfs_zip", required=True)
    sub.add_parser("gtfs_as_geojson", help="stops and shapes as features")
    sub.add_parser("gtfs_network", help="shapes cut at their stops")
    osm = sub.add_parser("gtfs_osm_network", help="choose among the matches of each segment")
    osm.add_argument("--matches", help="Parquet of matches made by another map matcher; without it the loaded road map is matched")
    sub.add_parser("scheduled_bus_traffic", help="trips along the network, and service dates")
    road = sub.add_parser("load_conflation_map", help="the road map from a SQLite file")
    road.add_argument("--conflation_map_sqlite_db", required=True)
    sub.add_parser("gtfs_conflation_map_join", help="matches joined to the road map")
    sub.add_parser("gtfs_conflation_schedule_join", help="traffic and AADT on the road map")
    out = sub.add_parser("output_shapefile", help="six layers as shapefiles")
    out.add_argument("--output_file", required=True)
    dump = sub.add_parser("dump_conflation_map", help="the road map as NDGeoJSON")
    dump.add_argument("--output_file", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = spark or SparkSession.builder.appName("farelane").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    p = Pipeline(spark, a.output_dir, a.compat)
    if a.command in ("load_raw_gtfs_into_sqlite", "load_raw_gtfs"):
        timed(p.load_raw_gtfs, a.agency_name, a.gtfs_zip)
    elif a.command == "gtfs_osm_network":
        timed(p.gtfs_osm_network, spark.read.parquet(a.matches) if a.matches else None)
    elif a.command == "load_conflation_map":
        timed(p.load_conflation_map, a.conflation_map_sqlite_db)
    elif a.command == "output_shapefile":
        timed(p.output_shapefile, a.output_file)
    elif a.command == "dump_conflation_map":
        from .sources.roadmap import write_ndgeojson

        write_ndgeojson(p.tables.read("conflation_map.conflation_map"), a.output_file)
    else:
        timed(getattr(p, a.command))


if __name__ == "__main__":
    main()
