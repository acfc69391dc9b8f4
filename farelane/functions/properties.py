"""Feature properties kept as JSON at the edges (P4, P5, N1-N4): extract, set, merge, group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROPERTIES = "map<string,string>"


def extract(feature: Column, *path: str) -> Column:
    """The value at a path, as text."""
    return F.get_json_object(feature, "$." + ".".join(path))


def as_map(text: Column) -> Column:
    """A flat JSON object as a map of texts."""
    return F.coalesce(F.from_json(text, PROPERTIES), F.create_map().cast(PROPERTIES))


def merged(old: Column, new: Column) -> Column:
    """A merge patch: keys of the new map replace, its null values remove."""
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
    return F.map_filter(F.map_concat(kept, new), lambda k, v: v.isNotNull())


def without(properties: Column, names: list[str]) -> Column:
    """P4."""
    return F.map_filter(properties, lambda k, v: ~k.isin(names))


def grouped(key: Column, value: Column) -> Column:
    """N4, an aggregate: map of key to value, in order of the keys; a null key is left out (Q29)."""
    entries = F.collect_list(F.when(key.isNotNull(), F.struct(key.alias("k"), value.alias("v"))))
    return F.map_from_entries(F.sort_array(entries))
