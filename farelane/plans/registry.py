"""Registered queries and their SQL, by name; one for each operator family."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_map, queries_schedule, queries_sources
from .fixtures import with_relations

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (queries_schedule, queries_map, queries_sources)
QUERIES: dict[str, Query] = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: with_relations(sql) for m in MODULES for name, sql in m.SQL.items()}
