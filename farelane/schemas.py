"""Tables of a feed: columns, keys and checks (fixed values of the GTFS format)."""

from __future__ import annotations

TABLES = {
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string, agency_lang string, agency_phone string, agency_fare_url string, agency_email string",
    "stops": "stop_id string, stop_code string, stop_name string, stop_desc string, stop_lat double, stop_lon double, zone_id string, stop_url string, location_type int, stop_timezone string, wheelchair_boarding int",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_desc string, route_type int, route_url string, route_color string, route_text_color string",
    "trips": "route_id string, service_id string, trip_id string, trip_headsign string, direction_id string, shape_id string, wheelchair_accessible int, bikes_allowed int",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, stop_headsign string, pickup_type int, drop_off_type int, shape_dist_traveled double, timepoint int",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type string",
    "fare_attributes": "fare_id string, price double, currency_type string, payment_method int, transfers int, agency_id string, transfer_duration int",
    "fare_rules": "fare_id string, route_id string, origin_id string, destination_id string, contains_id string",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
    "frequencies": "trip_id string, start_time string, end_time string, headway_secs int, exact_times int",
    "transfers": "from_stop_id string, to_stop_id string, transfer_type int, min_transfer_time int",
    "feed_info": "feed_publisher_name string, feed_publisher_url string, feed_lang string, feed_start_date string, feed_end_date string, feed_version string",
}
KEYS = {
    "agency": ["agency_id"],
    "stops": ["stop_id"],
    "routes": ["route_id"],
    "trips": ["route_id", "service_id", "trip_id"],
    "stop_times": ["trip_id", "stop_sequence"],
    "calendar": ["service_id"],
    "calendar_dates": ["service_id", "date"],
    "fare_attributes": ["fare_id"],
    "shapes": ["shape_id", "shape_pt_sequence"],
    "frequencies": ["trip_id"],
    "feed_info": ["feed_publisher_name"],
}
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
NOT_NULL = {
    "calendar": [*WEEKDAYS, "start_date", "end_date"],
    "calendar_dates": ["date", "exception_type"],
    "shapes": ["shape_pt_lat", "shape_pt_lon"],
    "transfers": ["from_stop_id", "to_stop_id", "transfer_type"],
}
CHECKS = {"calendar": [f"{d} IN (0, 1)" for d in WEEKDAYS], "transfers": ["transfer_type IN (0, 1, 2, 3)"]}


def columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in TABLES[table].split(", ")]
