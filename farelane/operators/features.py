"""Stop and shape features and stop sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

POINT = "struct<lon:double,lat:double>"


def stop_features(stops: DataFrame) -> DataFrame:
    """id, geometry (rounded point), geoprox_key, and a stop's other columns as properties."""
    where = F.get(geo.rounded(F.array(geo.point(F.col("stop_lon"), F.col("stop_lat")))), F.lit(0))
    others = [c for c in stops.columns if c not in ("stop_lon", "stop_lat")]
    out = stops.filter("stop_lon IS NOT NULL AND stop_lat IS NOT NULL").select(F.col("stop_id").alias("id"), where.alias("geometry"), F.struct(*others).alias("properties"))
    return out.withColumn("geoprox_key", geo.point_key(F.col("geometry")))


def shape_lines(shapes: DataFrame) -> DataFrame:
    """id, coords, geoprox_key: each shape's points in order of their sequence, shapes of one point dropped."""
    shapes = checked_sequences(shapes)
    points = F.sort_array(F.collect_list(F.struct("shape_pt_sequence", F.col("shape_pt_lon").cast("double").alias("lon"), F.col("shape_pt_lat").cast("double").alias("lat"))))
    lines = shapes.groupBy(F.col("shape_id").alias("id")).agg(points.alias("p")).filter(F.size("p") > 1)
    lines = lines.select("id", geo.rounded(F.transform("p", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))).alias("coords"))
    return lines.withColumn("geoprox_key", geo.proximity_key(F.col("coords")))


def checked_sequences(shapes: DataFrame) -> DataFrame:
    """Raises where a shape has points with a sequence number and points without, as their order is then unknown."""
    without = F.max(F.col("shape_pt_sequence").isNull()).over(Window.partitionBy("shape_id"))
    wrong = F.raise_error(F.concat(F.lit("points with and without a sequence number in shape "), F.col("shape_id").cast("string")))
    mixed = without & F.col("shape_pt_sequence").isNotNull()
    return shapes.withColumn("shape_pt_sequence", F.when(mixed, wrong.cast("int")).otherwise(F.col("shape_pt_sequence")))


def segments_of_shape(segments: DataFrame, shape_id) -> DataFrame:
    """One shape's segments in order; the filter reaches the scan of a stored table."""
    return segments.filter(F.col("shape_id") == shape_id).orderBy("shape_index")


def in_geo_order(features: DataFrame) -> DataFrame:
    """Near features are near each other; range partitions keep that at any size."""
    return features.repartitionByRange("geoprox_key").sortWithinPartitions("geoprox_key")


def all_features(stops: DataFrame, lines: DataFrame) -> DataFrame:
    """The whole map: kind, id, coords."""
    points = stops.select(F.lit("stop").alias("kind"), F.col("id").cast("string").alias("id"), F.array("geometry").alias("coords"))
    return points.unionByName(lines.select(F.lit("shape").alias("kind"), F.col("id").cast("string").alias("id"), "coords"))


def stop_patterns(stops: DataFrame) -> DataFrame:
    """Distinct ordered stop sequences of each shape's trips; sequence numbers order them as numbers (O2)."""
    has = "shape_dist_traveled" in stops.columns
    dist = F.col("shape_dist_traveled").cast("double") if has else F.lit(None).cast("double")
    visits = F.sort_array(F.collect_list(F.struct("stop_sequence", "stop_id", dist.alias("shape_dist_traveled"))))
    trips = stops.groupBy("shape_id", "trip_id").agg(visits.alias("v"))
    return trips.select("shape_id", F.transform("v", lambda v: F.struct(v["stop_id"].alias("stop_id"), v["shape_dist_traveled"].alias("shape_dist_traveled"))).alias("stops")).distinct()


def is_subsequence(short: Column, long: Column) -> Column:
    """R3."""
    matched = F.aggregate(long, F.lit(0), lambda i, x: F.when((i < F.size(short)) & F.get(short, i).eqNullSafe(x), i + 1).otherwise(i))
    return matched == F.size(short)


def stop_sequences(stops: DataFrame, check: bool = True) -> DataFrame:
    """shape_id, stops (its longest sequence, O4), n_patterns, n_conflicts; raises where a pattern isn't a subsequence of the longest."""
    patterns = stop_patterns(stops)
    longest = patterns.groupBy("shape_id").agg(F.max_by("stops", F.struct(F.size("stops"), F.to_json("stops"))).alias("longest"))
    out = patterns.join(longest, "shape_id").groupBy("shape_id").agg(
        F.any_value("longest").alias("of"),
        F.count("*").alias("n_patterns"),
        F.count_if(~is_subsequence(F.col("stops"), F.col("longest"))).alias("n_conflicts"),
    )
    out = out.withColumnRenamed("of", "stops")
    if not check:
        return out
    wrong = F.raise_error(F.concat(F.lit("more than one stop sequence for shape "), F.col("shape_id").cast("string")))
    return out.withColumn("n_conflicts", F.when(F.col("n_conflicts") > 0, wrong.cast("long")).otherwise(F.col("n_conflicts")))


def shapes_with_stops(sequences: DataFrame, lines: DataFrame, stops: DataFrame) -> DataFrame:
    """shape_id, coords, stops: ordered array of struct(stop_id, lon, lat, dist); raises if a stop is missing (Q25).

    A distance beyond the shape's length is clipped to it.
    """
    each = sequences.select("shape_id", F.posexplode("stops").alias("k", "s")).join(stops.select(F.col("id").alias("stop_id"), "geometry"), F.col("s.stop_id") == F.col("stop_id"), "left")
    wrong = F.raise_error(F.concat(F.lit("a stop is not in the stops table: "), F.col("s.stop_id").cast("string")))
    each = each.withColumn("geometry", F.when(F.col("geometry").isNull(), wrong.cast(POINT)).otherwise(F.col("geometry")))
    entry = F.struct("k", F.col("s.stop_id").alias("stop_id"), F.col("geometry.lon").alias("lon"), F.col("geometry.lat").alias("lat"), F.col("s.shape_dist_traveled").alias("dist"))
    out = lines.select(F.col("id").alias("shape_id"), "coords").join(each.groupBy("shape_id").agg(F.sort_array(F.collect_list(entry)).alias("stops")), "shape_id")
    n = geo.length_km(F.col("coords"))
    clip = lambda s: F.when(s["dist"] != 0, F.least(s["dist"], F.col("__len"))).otherwise(s["dist"])
    return out.withColumn("__len", n).withColumn("stops", F.transform("stops", lambda s: s.withField("dist", clip(s)))).drop("__len")


def kilometres(dist: Column, shape_len: Column) -> Column:
    """M4, Q2: a trip's last distance tells the unit (km, mi, m or ft) whose length is nearest the shape's; the factor to kilometres."""
    units = F.array(*[F.struct(F.abs(dist * f - shape_len).alias("off"), F.lit(f).alias("factor")) for f in (1.0, 1.609344, 0.001, 0.0003048)])
    return F.array_min(units)["factor"]


def neighbours(sequences: DataFrame) -> DataFrame:
    """Each stop of a sequence with the ones before and after it."""
    each = sequences.select("shape_id", "stops", F.posexplode("stops").alias("k", "s"))
    at = lambda i: F.get(F.col("stops"), i)["stop_id"]
    return each.select("shape_id", "k", F.col("s.stop_id").alias("stop_id"), F.when(F.col("k") > 0, at(F.col("k") - 1)).alias("previous_stop_id"), at(F.col("k") + 1).alias("next_stop_id"))
