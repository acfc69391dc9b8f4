"""Match relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import prepare
from ..functions import geo

UNMATCHED, PRESPLIT_KM, FEW_POINTS = 0.1, 2.0, 10
SPREAD = 8
#: Rows of a group that meet all of the group in one place.
AT_A_PLACE = 512


def insert_or_ignore(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """K2: of rows with one key the first in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def match_index(matches: DataFrame, order: str = "id") -> DataFrame:
    """Running number of a match within its segment."""
    w = Window.partitionBy("shape_id", "shape_index").orderBy(order)
    return matches.withColumn("pp_match_index", F.row_number().over(w) - 1)


def matches_of_segments(segments: DataFrame, matches: DataFrame) -> DataFrame:
    """Every segment with the array of its matches, empty if it has none."""
    grouped = matches.groupBy("shape_id", "shape_index").agg(F.sort_array(F.collect_list("id")).alias("match_ids"))
    out = segments.join(grouped, ["shape_id", "shape_index"], "left")
    return out.withColumn("match_ids", F.coalesce("match_ids", F.array().cast(grouped.schema["match_ids"].dataType)))


def segments_of_shapes(segments: DataFrame) -> DataFrame:
    """A13, second level: a shape's segments in order."""
    return segments.groupBy("shape_id").agg(F.sort_array(F.collect_list(F.struct("shape_index", "match_ids"))).alias("segments"))


def flattened(shapes: DataFrame) -> DataFrame:
    """Back to a row for each match."""
    return shapes.select("shape_id", F.explode("segments").alias("s")).select("shape_id", F.col("s.shape_index").alias("shape_index"), F.explode("s.match_ids").alias("id"))


def chosen_matches(matches: DataFrame, paths: DataFrame) -> DataFrame:
    """Matches that a chosen path uses, each once."""
    return matches.join(paths.select(F.col("shst_match_id").alias("id")), "id", "left_semi")


def matches_with_choice(segments: DataFrame, matches: DataFrame, paths: DataFrame) -> DataFrame:
    """Segments, their matches and where a path uses them; unmatched and unchosen rows stay."""
    used = paths.select(F.col("shst_match_id").alias("id"), "path_index", "path_edge_index")
    return segments.join(matches, ["shape_id", "shape_index"], "left").join(used, "id", "left")


def candidates(paths: DataFrame, matches: DataFrame, conflation_map: DataFrame) -> DataFrame:
    """Distinct pairs of a map segment and a match in a chosen path that share a reference. Both sides are made distinct first.

    A reference that many matches have is spread over ``SPREAD`` tasks: its map segments, which are few, are copied to each.
    """
    chosen = chosen_matches(matches, paths).select(F.col("id").alias("gtfs_matches_id"), "shst_reference").distinct()
    chosen = chosen.withColumn("__part", F.pmod(F.xxhash64("gtfs_matches_id"), F.lit(SPREAD)))
    road = conflation_map.select(F.col("id").alias("conflation_map_id"), "shst_reference").distinct()
    road = road.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return road.join(chosen, ["shst_reference", "__part"]).drop("__part")


def shape_map_path(paths: DataFrame, cospatiality: DataFrame) -> DataFrame:
    """Rank of the map segments along each shape segment; (shape, index, map id, rank) must be unique."""
    w = Window.partitionBy("shape_id", "shape_index").orderBy("path_index", "path_edge_index", "gtfs_map_pre_len")
    rows = paths.join(cospatiality, F.col("shst_match_id") == F.col("gtfs_matches_id"))
    return rows.select("shape_id", "shape_index", "conflation_map_id", "conf_map_pre_len", "conf_map_post_len", (F.rank().over(w) - 1).alias("along_idx"))


def multi_lines(join: DataFrame) -> DataFrame:
    """The map segments of each shape segment in order."""
    entry = F.struct("along_idx", "conflation_map_id", "conf_map_pre_len", "conf_map_post_len")
    return join.groupBy("shape_id", "shape_index").agg(F.sort_array(F.collect_list(entry)).alias("lines"))


def needs_slice(pre: Column, post: Column) -> Column:
    """an overhang beyond five metres."""
    return (pre > 0.005) | (post > 0.005)


def unmatched(segments: DataFrame, matches: DataFrame, length: str = "len_km") -> DataFrame:
    """segments of which a tenth or more of the length is unmatched."""
    matched = matches.groupBy("shape_id", "shape_index").agg(F.sum("feature_len_km").alias("matched_km"))
    rows = segments.join(matched, ["shape_id", "shape_index"], "left").withColumn("matched_km", F.coalesce("matched_km", F.lit(0.0)))
    return rows.withColumn("unmatched_ratio", F.try_divide(F.col(length) - F.col("matched_km"), F.col(length))).filter(F.col("unmatched_ratio") >= UNMATCHED)


def union_matches(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """H3: old matches first; a new one stays if its key is new."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return insert_or_ignore(both, key, ["__new", "id"]).drop("__new")


def matchable(segments: DataFrame) -> DataFrame:
    """segments with coordinates; raises where a key is missing."""
    wrong = F.raise_error(F.lit("a feature to be matched has no id"))
    keyed = segments.withColumn("shape_index", F.when(F.col("shape_id").isNull() | F.col("shape_index").isNull(), wrong.cast("int")).otherwise(F.col("shape_index")))
    return keyed.filter(F.size("coords") > 0)


def ladder(segments: DataFrame, matchers: list, key: list[str]) -> DataFrame:
    """Each matcher (DataFrame of unmatched segments to matches) gets what the ones before it left unmatched.

    A pass's result is checkpointed, so later passes don't repeat it.
    """
    prepare(segments.sparkSession)
    found = None
    left = segments = segments.checkpoint()
    for name, matcher in matchers:
        new = matcher(left).withColumn("matcher", F.lit(name))
        found = (new if found is None else union_matches(found, new, key)).checkpoint()
        left = unmatched(segments, found).select(*segments.columns).checkpoint()
        if left.isEmpty():
            break
    return found


def redundant(matches: DataFrame) -> DataFrame:
    """Matches whose vertices all occur in a longer one of the same segment and reference (unassisted, then smaller id first among equals).

    Inclusion is transitive, so any including match that is itself dropped is included in one that stays. Of the matches with one set of
    vertices only the first counts for others, and a set is held only against those that have its first vertex.
    """
    key = ["shape_id", "shape_index", "shst_reference"]
    m = matches.select(*key, "id", "osrm_assisted", "vertices")
    ranked = m.withColumn("__set", F.sort_array(F.array_distinct("vertices"))).withColumn("__rank", F.struct((-F.size("vertices")).alias("n"), "osrm_assisted", "id"))
    sets = ranked.groupBy(*key, "__set").agg(F.min("__rank").alias("__best"))
    vertex = lambda v: F.xxhash64(v)
    none = F.lit(None).cast(m.schema["vertices"].dataType.elementType)  # by which an empty set finds all
    small = sets.select(*key, "__set", vertex(F.get("__set", F.lit(0))).alias("__v"))
    large = sets.select(*key, F.col("__set").alias("__in"), "__best", F.explode(F.array_distinct(F.transform(F.concat(F.array(none), "__set"), vertex))).alias("__v"))
    best = small.join(large, [*key, "__v"]).filter(F.size(F.array_except("__set", "__in")) == 0).groupBy(*key, "__set").agg(F.min("__best").alias("__best"))
    return ranked.join(best, [*key, "__set"]).filter(F.col("__best") < F.col("__rank")).select(*m.columns)


def without_redundant(matches: DataFrame) -> DataFrame:
    """Matches of a point or none go too."""
    matches = matches.filter(F.size("vertices") > 1)
    return matches.join(redundant(matches).select("id"), "id", "left_anti")


def pairs(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """Ordered pairs of rows of one group.

    A group goes to as many places as it has ``AT_A_PLACE`` rows, all of it to each, and there meets its part; the number of partitions is
    given, as the rows are few for their pairs and would else be put together in few tasks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.groupBy(*key).agg(F.ceil(F.count("*") / AT_A_PLACE).alias("__parts"))
    rows = rows.select(*key, F.col(order).alias("a")).join(parts, key)
    a = rows.select(*key, "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1)).alias("__part"))
    b = rows.select(*key, F.col("a").alias("b"), F.pmod(F.xxhash64("a"), F.col("__parts")).alias("__part"))
    on = [*key, "__part"]
    out = a.repartition(n, *on).join(b.repartition(n, *on).hint("merge"), on)
    return out.filter("a < b").select(*key, "a", "b")


def path_length_error(paths: DataFrame, segments: DataFrame, matches: DataFrame) -> DataFrame:
    """Length of each path and its relative error against its segment."""
    length = paths.join(matches.select(F.col("id").alias("shst_match_id"), "feature_len_km"), "shst_match_id").groupBy("shape_id", "shape_index", "path_index").agg(F.sum("feature_len_km").alias("path_km"))
    rows = length.join(segments, ["shape_id", "shape_index"])
    return rows.withColumn("length_error", F.abs(F.col("len_km") - F.col("path_km")) / F.col("len_km"))


def shape_summary(segments: DataFrame, chosen: DataFrame) -> DataFrame:
    """For each shape its length, segments, segments with a path, the paths' length and the ratio."""
    paths = chosen.groupBy("shape_id", "shape_index").agg(F.sum("path_km").alias("path_km"))
    rows = segments.join(paths, ["shape_id", "shape_index"], "left")
    return rows.groupBy("shape_id").agg(
        F.sum("len_km").alias("shape_km"),
        F.count("*").alias("n_segments"),
        F.count("path_km").alias("n_chosen"),
        F.coalesce(F.sum("path_km"), F.lit(0.0)).alias("chosen_km"),
    )


def presplit(segments: DataFrame) -> DataFrame:
    """Features longer than two kilometres as equal parts (start_km, stop_km); and whether a feature is to be made denser."""
    km = geo.length_km(F.col("coords"))
    n = F.greatest(F.ceil(km / PRESPLIT_KM), F.lit(1)).cast("int")
    rows = segments.withColumn("__km", km).withColumn("__n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    out = rows.withColumn("start_km", F.col("__km") * F.col("part") / F.col("__n")).withColumn("stop_km", F.col("__km") * (F.col("part") + 1) / F.col("__n"))
    return out.withColumn("make_dense", F.size("coords") < FEW_POINTS).drop("__km", "__n")


def coordinate_ids(lines: DataFrame) -> DataFrame:
    """Shared numbers for equal coordinates: id, k, coord_id. Numbers follow the coordinates' order."""
    prepare(lines.sparkSession)
    each = lines.select("id", F.posexplode("coords").alias("k", "c"))
    known = each.select("c").distinct().repartitionByRange("c.lon", "c.lat").sortWithinPartitions("c.lon", "c.lat")
    known = known.select("c", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")).checkpoint()
    counts = sorted((r["p"], r["n"]) for r in known.groupBy("p").agg(F.count("*").alias("n")).collect())  # a row for each partition
    before, offsets = 0, []
    for p, n in counts:
        offsets += [F.lit(p), F.lit(before)]
        before += n
    if not offsets:
        return each.select("id", "k", F.lit(0).cast("long").alias("coord_id"))
    number = F.create_map(*offsets)[F.col("p")] + F.col("i").bitwiseAND((1 << 33) - 1)
    return each.join(known.select("c", number.cast("long").alias("coord_id")), "c").select("id", "k", "coord_id")


def is_subset(a: Column, b: Column) -> Column:
    """C7."""
    return F.size(F.array_except(a, b)) == 0


def is_substring(a: Column, b: Column) -> Column:
    """A occurs as a run of b."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(b) - F.size(a), F.lit(0)))
    return (F.size(a) <= F.size(b)) & F.exists(starts, lambda i: F.slice(b, i + 1, F.greatest(F.size(a), F.lit(1))) == a) | (F.size(a) == 0)


def tile_visible(zoom: Column, level: Column) -> Column:
    """K9: whether a map segment of a network level is drawn at a zoom."""
    step = [(3, 1), (4, 2), (10, 3), (13, 4)]
    out = (level < 1) | (zoom >= 14)
    for z, most in step:
        out = out | ((zoom >= z) & (level <= most))
    return out


def summary_stats(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean, deviation and quantiles."""
    q = [0.0, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    return rows.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std_dev"), F.percentile(value, q).alias("quantiles"))


def same_distance_runs(snaps: DataFrame) -> DataFrame:
    """Neighbouring snapped stops of one distance are one node: shape_id, run, dist, stop_ids in order."""
    w = Window.partitionBy("shape_id").orderBy("k")
    new = F.when(F.col("dist") != F.lag("dist").over(w), 1).otherwise(0)
    rows = snaps.withColumn("__new", new).withColumn("run", F.sum("__new").over(w))
    out = rows.groupBy("shape_id", "run").agg(F.min("dist").alias("dist"), F.sort_array(F.collect_list(F.struct("k", "stop_id"))).alias("s"))
    return out.select("shape_id", F.col("run").cast("int").alias("run"), "dist", F.array_distinct(F.transform("s", lambda x: x["stop_id"])).alias("stop_ids"))
