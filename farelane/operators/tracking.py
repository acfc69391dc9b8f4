"""Trip tracking (G1, J24): each trip's stops get indices along its shape.

Trips with the same shape and the same stops share one alignment, so distinct patterns are aligned, not trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stop_indices(shape_stops: DataFrame) -> DataFrame:
    """shape_id, indices: map of stop_id to its ascending indices along the shape, from rows (shape_id, shape_index, stop_id)."""
    each = shape_stops.groupBy("shape_id", "stop_id").agg(F.sort_array(F.collect_set(F.col("shape_index").cast("int"))).alias("at"))
    return each.groupBy("shape_id").agg(F.map_from_entries(F.collect_list(F.struct("stop_id", "at"))).alias("indices"))


def shape_stops_of_segments(segments: DataFrame) -> DataFrame:
    """(shape_id, shape_index, stop_id) from a network's segments: from-stops at a segment's index, the last segment's to-stops after it."""
    last = segments.groupBy("shape_id").agg(F.max_by(F.struct("shape_index", "to_stop_ids"), "shape_index").alias("l"))
    starts = segments.select("shape_id", "shape_index", F.explode("from_stop_ids").alias("stop_id"))
    ends = last.select("shape_id", (F.col("l.shape_index") + 1).alias("shape_index"), F.explode("l.to_stop_ids").alias("stop_id"))
    return starts.unionByName(ends).filter("stop_id IS NOT NULL")


def greedy(stops: Column, indices: Column) -> Column:
    """For each stop the smallest of its indices that isn't below the one before it; -1 from where there is none."""

    def step(acc: Column, stop: Column) -> Column:
        low = F.coalesce(F.element_at(acc, -1), F.lit(0))
        ahead = F.filter(F.try_element_at(indices, stop), lambda i: (low >= 0) & (i >= low))
        return F.concat(acc, F.array(F.coalesce(F.get(ahead, F.lit(0)), F.lit(-1))))

    return F.slice(F.aggregate(stops, F.array(F.lit(0)), step), F.lit(2), F.size(stops) + 1)


def align(stops: DataFrame, indices: DataFrame) -> DataFrame:
    """trip_id, shape_id, visits: array of struct(stop_id, arrival_sec, departure_sec), aligned: array of indices; raises if a stop has none left."""
    trips = stops.groupBy("trip_id", "shape_id").agg(F.sort_array(F.collect_list(F.struct("stop_sequence", "stop_id", "arrival_sec", "departure_sec"))).alias("visits"))
    trips = trips.withColumn("pattern", F.transform("visits", lambda v: v["stop_id"]))
    patterns = trips.select("shape_id", "pattern").distinct().join(indices, "shape_id")
    aligned = patterns.select("shape_id", "pattern", greedy(F.col("pattern"), F.col("indices")).alias("aligned"))
    wrong = F.raise_error(F.concat(F.lit("no segment left for a stop of trip "), F.col("trip_id").cast("string")))
    out = trips.join(aligned, ["shape_id", "pattern"], "left")
    checked = F.when(F.array_contains("aligned", -1) | F.col("aligned").isNull(), wrong.cast("array<int>")).otherwise(F.col("aligned"))
    return out.select("trip_id", "shape_id", "visits", checked.alias("aligned"))


def visits(aligned: DataFrame) -> DataFrame:
    """trip_id, visit, shape_index: a row for each stop of each trip."""
    return aligned.select("trip_id", F.posexplode("aligned").alias("visit", "shape_index"))


def scheduled_traffic(stops: DataFrame, indices: DataFrame) -> DataFrame:
    """shape_id, departure_seg_idx, arrival_seg_idx, departure_time_sec, arrival_time_sec, trip_id; raises where time goes backwards."""
    rows = align(stops, indices)
    n = F.size("visits")
    pairs = F.zip_with(
        F.arrays_zip(F.slice("visits", F.lit(1), n - 1).alias("v"), F.slice("aligned", F.lit(1), n - 1).alias("i")),
        F.arrays_zip(F.slice("visits", F.lit(2), n - 1).alias("v"), F.slice("aligned", F.lit(2), n - 1).alias("i")),
        lambda a, b: F.struct(a["i"].alias("departure_seg_idx"), b["i"].alias("arrival_seg_idx"), a["v"]["departure_sec"].alias("departure_time_sec"), b["v"]["arrival_sec"].alias("arrival_time_sec")),
    )
    out = rows.filter(n > 1).select("shape_id", "trip_id", F.explode(pairs).alias("x")).select("shape_id", "x.*", "trip_id")
    wrong = F.raise_error(F.concat(F.lit("time goes backwards in trip "), F.col("trip_id").cast("string")))
    return out.withColumn("arrival_time_sec", F.when(F.col("arrival_time_sec") < F.col("departure_time_sec"), wrong.cast("long")).otherwise(F.col("arrival_time_sec")))
