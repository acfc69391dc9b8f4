"""Geometry as Column expressions (X1-X3, X8, X14, W5, P2, R1, C6). Coordinates are array<struct<lon,lat>>, distances kilometres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: mean earth radius in kilometres.
EARTH_KM = 6371.0088
KEY_LENGTH = 11


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def distance_km(a: Column, b: Column) -> Column:
    """Great-circle distance of two points."""
    dlat, dlon = F.radians(b["lat"] - a["lat"]), F.radians(b["lon"] - a["lon"])
    h = F.pow(F.sin(dlat / 2), 2) + F.pow(F.sin(dlon / 2), 2) * F.cos(F.radians(a["lat"])) * F.cos(F.radians(b["lat"]))
    return 2 * EARTH_KM * F.asin(F.sqrt(h))


def bearing(a: Column, b: Column) -> Column:
    """Initial bearing in degrees, -180 to 180."""
    la, lb, d = F.radians(a["lat"]), F.radians(b["lat"]), F.radians(b["lon"] - a["lon"])
    return F.degrees(F.atan2(F.sin(d) * F.cos(lb), F.cos(la) * F.sin(lb) - F.sin(la) * F.cos(lb) * F.cos(d)))


def relative_bearing(a: Column, b: Column) -> Column:
    """b - a, wrapped on the low side only (Q19)."""
    d = b - a
    return F.when(d < -180, d + 360).otherwise(d)


def steps(coords: Column) -> Column:
    """Lengths of the line's segments."""
    pairs = F.zip_with(F.slice(coords, 1, F.size(coords) - 1), F.slice(coords, 2, F.size(coords) - 1), distance_km)
    return F.when(F.size(coords) > 1, pairs).otherwise(F.array().cast("array<double>"))


def length_km(coords: Column) -> Column:
    """X1."""
    return F.aggregate(steps(coords), F.lit(0.0), lambda a, x: a + x)


def running_km(coords: Column) -> Column:
    """Distance along the line of each of its points."""
    return F.aggregate(steps(coords), F.array(F.lit(0.0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def rounded(coords: Column, digits: int = 6) -> Column:
    """P2."""
    return F.transform(coords, lambda c: F.struct(F.round(c["lon"], digits).alias("lon"), F.round(c["lat"], digits).alias("lat")))


def denser(coords: Column) -> Column:
    """A midpoint between all neighbours."""
    middle = lambda a, b: F.struct(((a["lon"] + b["lon"]) / 2).alias("lon"), ((a["lat"] + b["lat"]) / 2).alias("lat"))
    pair = lambda c, i: F.when(i + 1 < F.size(coords), F.array(c, middle(c, F.get(coords, i + 1)))).otherwise(F.array(c))
    return F.flatten(F.transform(coords, pair))


def without_repeats(coords: Column) -> Column:
    """Neighbours that are equal become one."""
    return F.filter(coords, lambda c, i: (i == 0) | (c != F.get(coords, i - 1)))


def sequentiality(s: Column, t: Column) -> Column:
    """Lengths of two lines, the bearing between their last and first segments, and the gap from s to t."""
    s1, s2 = F.element_at(s, -2), F.element_at(s, -1)
    t1, t2 = F.element_at(t, 1), F.element_at(t, 2)
    own, next_ = bearing(s1, s2), bearing(t1, t2)
    return F.struct(
        length_km(s).alias("s_len"),
        length_km(t).alias("t_len"),
        relative_bearing(own, next_).alias("segs_rel_brng"),
        distance_km(s2, t1).alias("gap_dist"),
        relative_bearing(own, bearing(s2, t1)).alias("gap_rel_brng"),
    )


def point_key(p: Column) -> Column:
    """The bits of |lon| and |lat| in 1e-5 degrees, interleaved from the most significant one, in base 36."""
    bits = lambda x: F.bin(F.round(F.abs(x * 100000)).cast("long"))
    lon, lat = F.split(bits(p["lon"]), ""), F.split(bits(p["lat"]), "")
    both = F.transform(lon, lambda c, i: F.concat(c, F.coalesce(F.get(lat, i), F.lit("0"))))
    return F.lpad(F.lower(F.conv(F.array_join(both, ""), 2, 36)), KEY_LENGTH, "0")


def proximity_key(coords: Column) -> Column:
    """The smaller key of a line's ends."""
    return F.least(point_key(F.element_at(coords, 1)), point_key(F.element_at(coords, -1)))


def padded_order_key(p: Column, bits: int = 26) -> Column:
    """A Z-order key with both coordinates padded to one width: it keeps near points together, signs included (Q17)."""
    x = F.round((p["lon"] + 180) * 100000).cast("long")
    y = F.round((p["lat"] + 90) * 100000).cast("long")
    out = F.lit(0).cast("long")
    for k in range(bits):
        out = out + F.shiftleft(F.shiftright(x, k).bitwiseAND(1), 2 * k) + F.shiftleft(F.shiftright(y, k).bitwiseAND(1), 2 * k + 1)
    return out


def cells(coords: Column, pad_km: float, size: float = 0.01) -> Column:
    """Grid cells of a line's bounding box widened by pad_km, for an equi-join before an exact test."""
    pad = pad_km / (EARTH_KM * math.pi / 180)
    lon, lat = F.transform(coords, lambda c: c["lon"]), F.transform(coords, lambda c: c["lat"])
    wide = pad / F.greatest(F.cos(F.radians(F.array_max(F.transform(lat, F.abs)))), F.lit(0.01))
    span = lambda a, p: F.sequence(F.floor((F.array_min(a) - p) / size), F.floor((F.array_max(a) + p) / size))
    spans = F.array(F.struct(span(lon, wide).alias("x"), span(lat, F.lit(pad)).alias("y")))  # a lambda's variable is worked out once, an expression for each element
    return F.flatten(F.flatten(F.transform(spans, lambda s: F.transform(s["x"], lambda i: F.transform(s["y"], lambda j: F.struct(i.alias("i"), j.alias("j")))))))


def split_at_turns(coords: Column, most_degrees: float = 67.5) -> Column:
    """Number of the smooth part that each segment of the line belongs to: in time proportional to the line's length."""
    n = F.size(coords)
    brng = F.zip_with(F.slice(coords, 1, n - 1), F.slice(coords, 2, n - 1), bearing)
    turn = lambda a, b: F.abs(F.pmod(b - a + 540, F.lit(360.0)) - 180)
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  # a lambda's variable is worked out once, an expression for each element
    sharp = once(brng, lambda b: F.filter(F.transform(F.zip_with(F.slice(b, 1, F.size(b) - 1), F.slice(b, 2, F.size(b) - 1), turn), lambda t, i: F.when(t > most_degrees, i + 1)), lambda i: i.isNotNull()))
    # parts between sharp turns: each number as often as its part has segments
    ends = lambda s: F.concat(F.array(F.lit(0)), s, F.array(n - 1))
    parts = lambda e: F.flatten(F.transform(F.slice(e, 1, F.size(e) - 1), lambda a, k: F.array_repeat(k, F.get(e, k + 1) - a)))
    return F.when(n > 1, once(once(sharp, ends), parts)).otherwise(F.array().cast("array<int>"))
