"""Scheduled stops, traversals, synthetic probes, traffic and AADT."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import cluster
from ..functions.times import epoch

#: Average posted speed limit by the floor of the network level, and of any other level.
SPEED = {0: 57.5, 1: 44.9, 2: 41.6, 3: 41.7, 4: 39.5, 5: 33.5, 6: 40.8, 7: 31.9}
OTHER_SPEED = 30.0


#: Rows of shares of travel time that are broadcast at most (about 100 bytes each); beyond that they are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Trips that go to a task with the path of their stretch, and that go along it together; rows that a task makes of them (all about).
TRIPS, AT_ONCE, ROWS_A_TASK = 8192, 512, 16_000_000
#: Bytes of different paths that a task holds (Parquet writes strings once each up to 1 MB of them in a file), and of all paths that it makes (all about).
BYTES_HELD, BYTES_A_TASK = 256_000, 4_000_000_000
WEEKDAYS = range(7)
TRIPLE = ["shape_id", "departure_seg_idx", "arrival_seg_idx"]


def div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def halves_up(a: Column, b: Column, scale: int = 1) -> Column:
    """a * scale / b of whole numbers that aren't negative, rounded half up to a whole one exactly; b is positive.

    The remainder is scaled apart, so that no product is much larger than the result.
    """
    return div(a, b) * scale + div(2 * scale * (a % b) + b, 2 * b)


def thousandths(x: Column) -> Column:
    return F.floor(x * 1000 + 0.5)


def scheduled_stops(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """J1."""
    return trips.join(stop_times, "trip_id")


def with_shape(rows: DataFrame) -> DataFrame:
    """rows of trips that have a shape."""
    return rows.filter(F.col("shape_id").isNotNull() & (F.col("shape_id").cast("string") != ""))


def shapeless_trip_counts(trips: DataFrame) -> DataFrame:
    """All trips and those without a shape, in one pass."""
    return trips.agg(F.count("*").alias("n_trips"), F.count_if(F.col("shape_id").isNull()).alias("n_shapeless"))


def expected_observations(stops: DataFrame) -> DataFrame:
    """A2: every trip has one traversal less than stops."""
    return stops.agg((F.count("*") - F.count_distinct("trip_id")).alias("n_expected"))


def traversals(stops: DataFrame) -> DataFrame:
    """From each stop of a trip to the next: departure there, arrival here."""
    w = Window.partitionBy("trip_id").orderBy("stop_sequence")
    before = lambda c: F.lag(c).over(w)
    out = stops.select(
        *[c for c in ("trip_id", "shape_id") if c in stops.columns],
        "stop_sequence",
        before("stop_id").alias("from_stop_id"),
        F.col("stop_id").alias("to_stop_id"),
        before("departure_sec").alias("departure_time_sec"),
        F.col("arrival_sec").alias("arrival_time_sec"),
        F.row_number().over(w).alias("__n"),
    )
    return out.filter("__n > 1").drop("__n")


def checked_times(rows: DataFrame) -> DataFrame:
    """Raises where a trip arrives before it departs."""
    wrong = F.raise_error(F.concat(F.lit("time goes backwards in trip "), F.col("trip_id").cast("string")))
    return rows.withColumn("arrival_time_sec", F.when(F.col("arrival_time_sec") < F.col("departure_time_sec"), wrong.cast("int")).otherwise(F.col("arrival_time_sec")))


def speed_limit(networklevel: Column) -> Column:
    """P7."""
    known = F.create_map(*[F.lit(x) for k, v in SPEED.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(known, F.floor(networklevel).cast("int")), F.lit(OTHER_SPEED))


def paths_of_traversals(traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame) -> DataFrame:
    """The map segments of each traversal, a row each.

    The range condition departure <= index < arrival becomes an equi-join by exploding a traversal's indices, most often one.
    """
    steps = traffic.filter("arrival_seg_idx > departure_seg_idx").withColumn("shape_index", F.explode(F.sequence(F.col("departure_seg_idx"), F.col("arrival_seg_idx") - 1)))
    segments = shape_map.join(conflation_map.select(F.col("id").alias("conflation_map_id"), "networklevel", "length_km"), "conflation_map_id")
    return steps.join(segments, ["shape_id", "shape_index"])


def path_arrays(traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame, shown: Callable[[Column], list[Column]] = lambda path: [path.alias("path")]) -> DataFrame:
    """The map segments of each traversal in order, as an array of structs (compare ``paths_of_traversals``, a row each).

    A path depends only on the stretch of the shape, so it is made once for each distinct one, and so are the columns ``shown`` of it. Trips of a stretch meet them
    as an array, in so many tasks that one has few different paths, which Parquet can then write once each; a row for each trip comes only as it is written.
    """
    entry = F.struct("shape_index", "along_idx", "conflation_map_id")
    cluster.prepare(traffic.sparkSession)
    paths = paths_of_traversals(traffic.groupBy(*TRIPLE).agg(F.count("*").alias("n")), shape_map, conflation_map)
    paths = paths.groupBy(*TRIPLE).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("path")).withColumn("parts", F.ceil(F.col("n") / TRIPS)).checkpoint()
    one = ["trip_id", "departure_seg_idx", "arrival_seg_idx"]
    texts = paths.select("n", "parts", F.size("path").cast("long").alias("m"), F.struct(*shown(F.col("path"))).alias("s"))
    strings = [F.octet_length(f"s.{f.name}") for f in texts.schema["s"].dataType if f.dataType.typeName() == "string"]
    size = sum(strings, F.lit(0)) if strings else F.col("m") * 32
    held, made, stretches = texts.agg(F.sum(size * F.col("parts")), F.sum(size * F.col("n")), F.count("*")).first()
    tasks = max(1, -(-(held or 0) // BYTES_HELD), -(-(made or 0) // BYTES_A_TASK))
    rows = traffic.filter("arrival_seg_idx > departure_seg_idx").groupBy(*one).agg(F.collect_list("shape_id").alias("shapes"))
    alone = rows.filter("size(shapes) = 1").withColumn("shape_id", F.get("shapes", F.lit(0)))
    parts = paths.select(*TRIPLE, "parts")
    alone = alone.join(F.broadcast(parts) if stretches <= BROADCAST_ROWS else parts, TRIPLE).withColumn("part", F.pmod(F.xxhash64("trip_id"), F.col("parts")))
    alone = alone.repartition(tasks, *TRIPLE, "part").groupBy(*TRIPLE, "part").agg(F.collect_list(F.struct("trip_id")).alias("trips"))  # collect_list leaves out nulls
    each = paths.select(*TRIPLE, "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).repartition(tasks, *TRIPLE, "part")
    each = each.select(*TRIPLE, "part", *shown(F.col("path")))
    names = [c for c in each.columns if c not in (*TRIPLE, "part")]
    alone = alone.join(each, [*TRIPLE, "part"]).select(F.explode("trips").alias("t"), *one[1:], *names).select("t.trip_id", *one[1:], *names)
    # a trip that is there more than once has all of its paths in one
    again = rows.filter("size(shapes) > 1").withColumn("shape_id", F.explode("shapes")).join(paths.select(*TRIPLE, "path"), TRIPLE)
    again = again.groupBy(*one).agg(F.sort_array(F.flatten(F.collect_list("path"))).alias("path"))
    return alone.unionByName(again.select(*one, *shown(F.col("path"))))


def traversal_paths(traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame) -> DataFrame:
    """trip_id, departure_seg_idx, arrival_seg_idx, shape_index, conflation_map_id, along_idx: the rows of ``paths_of_traversals``, made by stretches.

    Trips of a stretch meet its path, which is made once, as two arrays; a row for each pair of them comes only as it is written. AT_ONCE trips go segment by
    segment, so that neighbouring rows differ in the trip alone and trips come in the same order again and again.
    """
    cluster.prepare(traffic.sparkSession)
    rows = traffic.filter("arrival_seg_idx > departure_seg_idx").select(*TRIPLE, F.struct("trip_id").alias("trip"))  # collect_list leaves out nulls
    parts = rows.groupBy(*TRIPLE).agg(F.ceil(F.count("*") / TRIPS).alias("parts"))
    rows = rows.join(parts, TRIPLE).groupBy(*TRIPLE, F.pmod(F.xxhash64("trip"), F.col("parts")).alias("part")).agg(F.collect_list("trip").alias("trips"))
    rows = rows.withColumn("trips", F.transform("trips", lambda t: t["trip_id"])).checkpoint()
    entry = F.struct("shape_index", "along_idx", "conflation_map_id")
    paths = paths_of_traversals(rows.select(*TRIPLE).distinct(), shape_map, conflation_map).groupBy(*TRIPLE).agg(F.sort_array(F.collect_list(entry)).alias("path")).checkpoint()
    pairs = rows.select(*TRIPLE, F.size("trips").cast("long").alias("n")).join(paths.select(*TRIPLE, F.size("path").alias("m")), TRIPLE).agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0
    rows = rows.join(paths, TRIPLE).repartition(max(1, -(-pairs // ROWS_A_TASK)), *TRIPLE, "part")  # so many: few bytes stand for many rows
    some = F.transform(F.sequence(F.lit(1), F.size("trips"), F.lit(AT_ONCE)), lambda k: F.slice("trips", k, AT_ONCE))
    rows = rows.select("departure_seg_idx", "arrival_seg_idx", "path", F.explode(some).alias("trips"))
    rows = rows.select("departure_seg_idx", "arrival_seg_idx", "trips", F.explode("path").alias("at"))
    return rows.select(F.explode("trips").alias("trip_id"), "departure_seg_idx", "arrival_seg_idx", "at.shape_index", "at.conflation_map_id", "at.along_idx")


def shares(traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame, compat: bool = False, counted: bool = False) -> DataFrame:
    """What each map segment takes of a traversal's time: its weight ``w`` of ``w_sum``, after ``w_before``.

    That depends only on the stretch of the shape (TRIPLE), so it is worked out once for each distinct one, not for each traversal. Weights are
    (length - overhangs) / speed; segments are ordered by shape index, position and id (compat: not by shape index, Q30). ``again``: the
    shape comes over the segment more than once. ``counted``: with ``n``, the number of traversals on the stretch.
    """
    often = F.count("*").over(Window.partitionBy("shape_id", "conflation_map_id")) > 1
    shape_map = shape_map.withColumn("again", often)
    stretches = traffic.groupBy(*TRIPLE).agg(F.count("*").alias("n")) if counted else traffic.select(*TRIPLE).distinct()
    rows = paths_of_traversals(stretches, shape_map, conflation_map)
    weight = (F.col("length_km") - F.col("conf_map_pre_len") - F.col("conf_map_post_len")) / speed_limit(F.col("networklevel"))
    one = Window.partitionBy(*TRIPLE)
    along = one.orderBy(*([] if compat else ["shape_index"]), "along_idx", "conflation_map_id")
    rows = rows.withColumn("w", weight).withColumn("w_sum", F.sum("w").over(one))
    before = F.coalesce(F.sum("w").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    cluster.prepare(traffic.sparkSession)
    more = [c for c in ("block",) if c in shape_map.columns] + ["n"] * counted
    return rows.select(*TRIPLE, "conflation_map_id", "again", "w", "w_sum", before.alias("w_before"), *more).checkpoint()


def together(traversals: DataFrame, shares: DataFrame) -> DataFrame:
    """Traversals joined with the counted shares of their stretch, in as many tasks as their pairs ask for.

    Traversals and shares of a stretch meet as arrays; a row for each pair comes only as it is used. AT_ONCE traversals in order of their times go
    segment by segment, so that neighbouring rows have the same segment and mostly the same travel time and epoch.
    """
    steps = F.sort_array(F.collect_list(F.struct("w_before", "conflation_map_id", "w", "again")))
    paths = shares.groupBy(*TRIPLE).agg(F.first("n").alias("n"), F.first("w_sum").alias("w_sum"), steps.alias("s"))
    paths = paths.select(*TRIPLE, "w_sum", F.ceil(F.col("n") / TRIPS).alias("parts"), "s.conflation_map_id", "s.w", "s.w_before", "s.again")
    pairs = shares.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-pairs // ROWS_A_TASK))
    cluster.prepare(traversals.sparkSession)
    paths = paths.checkpoint()
    parts = paths.select(*TRIPLE, "parts")
    own = [c for c in traversals.columns if c not in TRIPLE]
    total = (F.col("arrival_time_sec") - F.col("departure_time_sec")).alias("__total")
    rows = traversals.join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, TRIPLE)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*own), F.col("parts"))).repartition(tasks, *TRIPLE, "part")  # so many: few bytes stand for many rows
    rows = rows.groupBy(*TRIPLE, "part").agg(F.sort_array(F.collect_list(F.struct(total, "departure_time_sec", *[c for c in own if c != "departure_time_sec"]))).alias("t"))
    paths = paths.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts").repartition(tasks, *TRIPLE, "part")
    rows = rows.join(paths, [*TRIPLE, "part"])
    some = F.transform(F.sequence(F.lit(1), F.size("t"), F.lit(AT_ONCE)), lambda k: F.slice("t", k, AT_ONCE))
    rows = rows.select(*TRIPLE, "w_sum", "conflation_map_id", "w", "w_before", "again", F.explode(some).alias("t"))
    at = lambda c: F.get(c, F.col("__k")).alias(c)
    rows = rows.select(*TRIPLE, "t", "w_sum", F.posexplode("conflation_map_id").alias("__k", "segment"), "w", "w_before", "again")
    rows = rows.select(*TRIPLE, "w_sum", F.col("segment").alias("conflation_map_id"), *[at(c) for c in ("w", "w_before", "again")], F.explode("t").alias("t"))
    return rows.select(*TRIPLE, *[f"t.{c}" for c in own], "conflation_map_id", "again", "w", "w_sum", "w_before")


def observed(traversals: DataFrame, shares: DataFrame) -> DataFrame:
    """Traversals on their map segments, a row each: all their columns but times and indices, and epoch and ms, the travel time in thousandths of a second.

    If shares are counted, traversals of a stretch go ``together``.
    """
    if "n" in shares.columns:
        rows = together(traversals, shares)
    else:
        rows = traversals.join(F.broadcast(shares) if shares.count() <= BROADCAST_ROWS else shares, TRIPLE)
    total = F.col("arrival_time_sec") - F.col("departure_time_sec")
    start = F.col("departure_time_sec") + F.coalesce(F.try_divide(total * F.col("w_before"), F.col("w_sum")), F.lit(0.0))
    # half a millionth of a second more: a start that the noise of sums puts just before an epoch is in it
    rows = rows.withColumn("epoch", epoch(start + 5e-7)).withColumn("ms", thousandths(F.try_divide(total * F.col("w"), F.col("w_sum"))))
    return rows.drop(*TRIPLE, "departure_time_sec", "arrival_time_sec", "w", "w_sum", "w_before")


def with_overlaps(traffic: DataFrame) -> DataFrame:
    """Traversals that go somewhere; ``overlaps``: one of their trip is on the same indices, so that they can meet in a map segment."""
    rows = traffic.filter("arrival_seg_idx > departure_seg_idx").select("trip_id", *TRIPLE, "departure_time_sec", "arrival_time_sec")
    w = Window.partitionBy("trip_id").orderBy("departure_seg_idx", "arrival_seg_idx")
    overlap = F.col("departure_seg_idx") < F.max("arrival_seg_idx").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("overlaps", F.coalesce(overlap, F.lit(False))).withColumn("overlaps", F.max("overlaps").over(Window.partitionBy("trip_id")))


def met(rows: DataFrame) -> DataFrame:
    """A4: observations of one trip on one segment in one epoch, together."""
    return rows.groupBy("conflation_map_id", "trip_id", "epoch").agg(F.sum("ms").alias("ms"))


def synthetic_probe(traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame, compat: bool = False) -> DataFrame:
    """Travel time of each trip on each map segment by the epoch in which it enters it.

    Only where a shape comes over a segment again, or a trip's traversals overlap, can two observations of a trip meet; only those are grouped, and
    they are looked for only among the traversals that can have some. The others are spread by stretches, traversals of a stretch together.
    """
    part = shares(traffic, shape_map, conflation_map, compat, counted=True)
    rows = with_overlaps(traffic)
    often = part.filter("again").select(*TRIPLE).distinct().withColumn("often", F.lit(True))  # stretches
    some = rows.join(F.broadcast(often) if often.count() <= BROADCAST_ROWS else often, TRIPLE, "left").filter(F.col("overlaps") | F.col("often")).drop("often")
    alone = observed(rows.filter("NOT overlaps").drop("overlaps"), part.filter("NOT again")).select("conflation_map_id", "trip_id", "epoch", "ms")
    return alone.unionByName(met(observed(some, part.drop("n")).filter("overlaps OR again"))).withColumn("travel_time", F.col("ms") / 1000).drop("ms")


def served_days(routes: DataFrame, trips: DataFrame, dates: DataFrame) -> DataFrame:
    """trip_id, route_short_name, n0 ... n6: on how many Sundays, ..., Saturdays a trip runs. A route without a short name goes by its id (Q29)."""
    n_dates = dates.groupBy("service_id").agg(*[F.count_if(F.col("dow") == k).alias(f"n{k}") for k in WEEKDAYS])
    named = routes.select("route_id", F.coalesce(F.col("route_short_name"), F.col("route_id").cast("string")).alias("route_short_name"))
    return trips.join(named, "route_id").join(n_dates, "service_id").select("trip_id", "route_short_name", *[f"n{k}" for k in WEEKDAYS])


def days_mask() -> Column:
    """Bit k: the trip runs on weekday k."""
    return sum((F.when(F.col(f"n{k}") > 0, 1 << k).otherwise(0) for k in WEEKDAYS), F.lit(0))


def by_weekdays(rows: DataFrame, weeks: DataFrame) -> DataFrame:
    """Observations (conflation_map_id, route_short_name, epoch, ms, n0 ... n6, ids) summed by segment, route and epoch, all weekdays in one row:
    n (dates), m (those with a time) and t (their times in thousandths), each 0 ... 6, ids with their days, and the feed's number of days."""
    n, ms = lambda k: F.col(f"n{k}"), F.col("ms")
    sums = [F.sum(n(k)).alias(f"n{k}") for k in WEEKDAYS] + [F.sum(F.when(ms.isNotNull(), n(k)).otherwise(0)).alias(f"m{k}") for k in WEEKDAYS] + [F.sum(n(k) * ms).alias(f"t{k}") for k in WEEKDAYS]
    out = rows.groupBy("conflation_map_id", "route_short_name", "epoch").agg(*sums, F.flatten(F.collect_list("ids")).alias("ids"))
    # weeks are days over 7; one row
    return out.crossJoin(F.broadcast(weeks.select(F.round(F.col("feed_num_weeks") * 7).cast("long").alias("feed_days"))))


def weekday_sums(routes: DataFrame, trips: DataFrame, dates: DataFrame, traffic: DataFrame, shape_map: DataFrame, conflation_map: DataFrame, weeks: DataFrame, compat: bool = False) -> DataFrame:
    """J15, A5 from traversals: traversals alike in stretch, times and route are summed before they are spread over map segments."""
    part = shares(traffic, shape_map, conflation_map, compat)
    served = served_days(routes, trips, dates)
    rows = with_overlaps(traffic)
    days = [f"n{k}" for k in WEEKDAYS]
    ids = F.collect_list(F.struct(F.col("trip_id").cast("string").alias("id"), days_mask().alias("days"))).alias("ids")
    again = part.groupBy(*TRIPLE).agg(F.max("again").alias("again"))  # of a whole stretch
    again = F.broadcast(again) if part.count() <= BROADCAST_ROWS else again
    rows = rows.join(again, TRIPLE).withColumn("grouped", F.col("overlaps") | F.col("again")).drop("overlaps", "again")
    key = [*TRIPLE, "departure_time_sec", "arrival_time_sec", "route_short_name"]
    alike = rows.filter("NOT grouped").join(served, "trip_id").groupBy(*key).agg(*[F.sum(c).alias(c) for c in days], ids)
    # each number of dates counts for all trips of the group, and so for their common time
    alone = observed(alike, part).select("conflation_map_id", "route_short_name", "epoch", "ms", *days, "ids")
    single = met(observed(rows.filter("grouped"), part)).join(served, "trip_id").withColumn("ids", F.array(F.struct(F.col("trip_id").cast("string").alias("id"), days_mask().alias("days"))))
    single = single.select("conflation_map_id", "route_short_name", "epoch", "ms", *days, "ids")
    return by_weekdays(alone.unionByName(single), weeks)


def of_days(each: list[Column]) -> Column:
    """An array of structs, one a weekday, without those on which nothing runs (n is 0)."""
    return F.filter(F.array(*each), lambda x: x["n"] > 0)


def tenths(n: Column) -> Column:
    """n dates over the feed's weeks, in tenths, halves up; null for a feed of a day (Q5)."""
    return F.when(F.col("feed_days") > 0, halves_up(70 * n, F.col("feed_days")))


def weekly(n: Column) -> Column:
    return tenths(n) / 10


def by_route(sums: DataFrame) -> DataFrame:
    """A5: average travel time and weekly count by map segment, route, weekday and epoch, and the trips."""

    def day(k: int) -> Column:
        some = F.transform(F.filter("ids", lambda x: F.getbit(x["days"], F.lit(k)) == 1), lambda x: x["id"])
        avg = F.try_divide(F.col(f"t{k}"), F.col(f"m{k}")) / 1000
        return F.struct(F.lit(k).alias("dow"), F.col(f"n{k}").alias("n"), avg.alias("avg_travel_time"), weekly(F.col(f"n{k}")).alias("avg_weekly_count"), F.array_join(F.sort_array(F.array_distinct(some)), ",").alias("trip_ids"))

    rows = sums.select("conflation_map_id", "route_short_name", "epoch", F.inline(of_days([day(k) for k in WEEKDAYS])))
    return rows.select("conflation_map_id", "route_short_name", "dow", "epoch", "avg_travel_time", "avg_weekly_count", "trip_ids")


def sums_of_probe(served: DataFrame, probe: DataFrame, weeks: DataFrame) -> DataFrame:
    """J15, A5 from a table of probes."""
    rows = probe.join(served, "trip_id").withColumn("ids", F.array(F.struct(F.col("trip_id").cast("string").alias("id"), days_mask().alias("days"))))
    return by_weekdays(rows.withColumn("ms", thousandths(F.col("travel_time"))), weeks)


def traffic_by_route(routes: DataFrame, trips: DataFrame, dates: DataFrame, probe: DataFrame, weeks: DataFrame) -> DataFrame:
    return by_route(sums_of_probe(served_days(routes, trips, dates), probe, weeks))


def billionths(t: Column, m: Column) -> Column:
    """Average of t thousandths of m observations, in billionths of a second."""
    return F.when(m > 0, halves_up(t, m, 1_000_000))


def traffic_total(sums: DataFrame) -> DataFrame:
    """All routes together, travel times weighted by weekly counts. Averages are taken to billionths and sums are of whole numbers, so their order doesn't matter."""
    w = lambda k: tenths(F.col(f"n{k}"))
    avg = lambda k: billionths(F.col(f"t{k}"), F.col(f"m{k}"))
    # the sum of avg * w in two parts, either of which fits a long
    each = [
        f(k)
        for k in WEEKDAYS
        for f in (lambda k: F.sum(F.col(f"n{k}")).alias(f"n{k}"), lambda k: F.sum(w(k)).alias(f"w{k}"), lambda k: F.sum(div(avg(k), 1_000_000) * w(k)).alias(f"a{k}"), lambda k: F.sum(avg(k) % 1_000_000 * w(k)).alias(f"b{k}"))
    ]
    routes = F.collect_list(F.struct("route_short_name", days_mask().alias("days"))).alias("names")
    rows = sums.groupBy("conflation_map_id", "epoch").agg(*each, routes)

    def day(k: int) -> Column:
        names = F.transform(F.filter("names", lambda x: F.getbit(x["days"], F.lit(k)) == 1), lambda x: x["route_short_name"])
        whole, part = F.col(f"a{k}") + div(F.col(f"b{k}"), 1_000_000), F.col(f"b{k}") % 1_000_000  # thousandths times w, and what is left in billionths
        rest = whole % F.col(f"w{k}") * 1_000_000 + part
        tt = F.when(F.col(f"w{k}") > 0, div(whole, F.col(f"w{k}")) + div(2 * rest + 1_000_000 * F.col(f"w{k}"), 2_000_000 * F.col(f"w{k}"))) / 1000
        return F.struct(F.lit(k).alias("dow"), F.col(f"n{k}").alias("n"), tt.cast("double").alias("avg_tt"), (F.col(f"w{k}") / 10).alias("avg_weekly_count"), F.array_join(F.sort_array(F.array_distinct(names)), ",").alias("routes"))

    rows = rows.select("conflation_map_id", "epoch", F.inline(of_days([day(k) for k in WEEKDAYS])))
    return rows.select("conflation_map_id", "dow", "epoch", "avg_tt", "avg_weekly_count", "routes")


def peak(epoch: Column, dow: Column) -> Column:
    """AMP from 6 to 10, MIDD to 16, PMP to 20 on Monday to Friday; WE on other days from 6 to 20; else OVN (also after midnight, Q6)."""
    weekday = F.when(epoch < 120, "AMP").when(epoch < 192, "MIDD").otherwise("PMP")
    return F.when(epoch.between(72, 239), F.when(dow.between(1, 5), weekday).otherwise("WE")).otherwise("OVN")


def aadt_by_route_and_peak(sums: DataFrame) -> DataFrame:
    """A seventh of the weekly counts of a peak's weekdays and epochs, rounded half up.

    A row of sums has all weekdays: of Monday to Friday (week) and of the weekend it is asked once in which peak its epoch lies.
    """
    both = lambda name, f: (sum((f(k) for k in range(2, 6)), f(1)).alias(f"{name}_week"), (f(0) + f(6)).alias(f"{name}_end"))
    rows = sums.select("conflation_map_id", "route_short_name", "epoch", *[F.coalesce(tenths(F.col(f"n{k}")), F.lit(0)).alias(f"w{k}") for k in WEEKDAYS], *[f"n{k}" for k in WEEKDAYS], (F.col("feed_days") > 0).alias("known"))
    named = [peak(F.col("epoch"), F.lit(k)).alias(x) for k, x in ((1, "week"), (0, "weekend"))]
    rows = rows.select("conflation_map_id", "route_short_name", "known", *named, *both("w", lambda k: F.col(f"w{k}")), *both("n", lambda k: F.col(f"n{k}")))
    names = ["AMP", "MIDD", "PMP", "WE", "OVN"]
    of = lambda x, p: F.sum(F.when(F.col("week") == p, F.col(f"{x}_week")).otherwise(0) + F.when(F.col("weekend") == p, F.col(f"{x}_end")).otherwise(0)).alias(f"{x}_{p}")
    rows = rows.groupBy("conflation_map_id", "route_short_name").agg(*[of(x, p) for x in "wn" for p in names], F.first("known").alias("known"))
    each = [F.struct(F.lit(p).alias("peak"), F.col(f"n_{p}").alias("n"), F.when(F.col("known"), halves_up(F.col(f"w_{p}"), F.lit(70))).alias("aadt")) for p in names]  # Q5: unknown
    return rows.select("conflation_map_id", "route_short_name", F.inline(of_days(each))).select("conflation_map_id", "peak", "route_short_name", "aadt")


def aadt_breakdown(parts: DataFrame) -> DataFrame:
    """Total, map by peak and nested map by route, of the rounded parts of A7 (Q26)."""
    by_peak = F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "aadt"))))
    peaks = parts.groupBy("conflation_map_id", F.col("peak").alias("key")).agg(F.sum("aadt").alias("aadt")).groupBy("conflation_map_id").agg(F.sum("aadt").alias("aadt"), by_peak.alias("aadt_by_peak"))
    inner = parts.groupBy("conflation_map_id", "route_short_name").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("peak", "aadt")))).alias("m"))
    routes = inner.groupBy("conflation_map_id").agg(F.collect_list(F.struct("route_short_name", "m")).alias("e"))
    routes = routes.select("conflation_map_id", F.map_from_entries(F.array_sort("e", lambda a, b: F.when(a["route_short_name"] < b["route_short_name"], -1).when(a["route_short_name"] > b["route_short_name"], 1).otherwise(0))).alias("aadt_by_route"))
    return peaks.join(routes, "conflation_map_id")


def parts_of_breakdown(rows: DataFrame) -> DataFrame:
    """The parts of A7 from A8's map by route and peak."""
    rows = rows.select("conflation_map_id", F.explode("aadt_by_route").alias("route_short_name", "m"))
    return rows.select("conflation_map_id", "route_short_name", F.explode("m").alias("peak", "aadt"))
