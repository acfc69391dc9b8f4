"""GTFS-like relations derived from the star-schema tables by the same SQL text in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DERIVED = {
    "tx_agency": """
SELECT r_regionkey AS agency_id, r_name AS agency_name
  FROM region
""",
    "tx_routes": """
SELECT n_nationkey AS route_id, n_regionkey AS agency_id, n_name AS route_short_name
  FROM nation
""",
    "tx_trips": """
SELECT o_orderkey AS trip_id, o_custkey % 25 AS route_id, o_orderpriority AS service_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey % 40 END AS shape_id
  FROM orders
""",
    "tx_stop_times": """
SELECT l_orderkey AS trip_id, l_linenumber AS stop_sequence, (l_orderkey % 40) * 100 + l_linenumber AS stop_id, 18000 + (l_orderkey % 900) * 60 + l_linenumber * 240 AS arrival_sec, 18000 + (l_orderkey % 900) * 60 + l_linenumber * 240 + MIN(l_suppkey) % 60 AS departure_sec
  FROM lineitem
  GROUP BY l_orderkey, l_linenumber
""",
    "tx_stops": """
SELECT s_suppkey AS stop_id, s_name AS stop_name, -73.9E0 - (s_suppkey % 10) * 0.01E0 AS stop_lon, 42.6E0 + CAST(floor(s_suppkey / 10.0E0) AS INT) * 0.01E0 AS stop_lat
  FROM supplier
""",
    "tx_shapes": """
SELECT p_partkey % 40 AS shape_id, CAST(floor(p_partkey / 40.0E0) AS INT) AS shape_pt_sequence, -73.9E0 - floor(p_partkey / 40.0E0) * 0.002E0 - (p_partkey % 40) * 0.0001E0 AS shape_pt_lon, 42.6E0 + (p_partkey % 40) * 0.005E0 + (p_size % 5) * 0.0003E0 AS shape_pt_lat
  FROM part
""",
    "tx_calendar": """
SELECT DISTINCT o_orderpriority AS service_id, CASE WHEN substr(o_orderpriority,1,1) IN ('1','5','3') THEN 1 ELSE 0 END AS sunday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','2','4') THEN 1 ELSE 0 END AS monday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','2') THEN 1 ELSE 0 END AS tuesday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','2','4') THEN 1 ELSE 0 END AS wednesday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','2') THEN 1 ELSE 0 END AS thursday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','2','4') THEN 1 ELSE 0 END AS friday, CASE WHEN substr(o_orderpriority,1,1) IN ('1','3') THEN 1 ELSE 0 END AS saturday, '20240101' AS start_date, '20240130' AS end_date
  FROM orders
""",
    "tx_calendar_dates": """
SELECT CASE user_id % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM' WHEN 3 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS service_id, replace(CAST(CAST(ts AS DATE) AS VARCHAR(10)),'-','') AS date, MIN(CASE WHEN event_type = 'signup' THEN '1' ELSE '2' END) AS exception_type
  FROM events
  WHERE event_type IN ('signup','error') AND event_id % 7 = 0
  GROUP BY 1, 2
""",
    "tx_conflation_map": """
SELECT p_partkey AS id, p_partkey % 500 AS shst_reference, p_size % 10 AS networklevel, (5 + p_size) / 100.0E0 AS length_km
  FROM part
""",
    "tx_shape_map_join": """
SELECT p_partkey % 40 AS shape_id, CAST(floor(p_partkey / 40.0E0) AS INT) % 7 AS shape_index, p_partkey AS conflation_map_id, (p_size % 3) / 1000.0E0 AS conf_map_pre_len, (p_size % 5) / 1000.0E0 AS conf_map_post_len, RANK() OVER (PARTITION BY p_partkey % 40, CAST(floor(p_partkey / 40.0E0) AS INT) % 7 ORDER BY p_partkey) - 1 AS along_idx
  FROM part
""",
    "tx_matches": """
SELECT p_partkey AS id, p_partkey % 40 AS shape_id, CAST(floor(p_partkey / 40.0E0) AS INT) % 7 AS shape_index, p_partkey % 500 AS shst_reference, p_size * 1.0E0 AS section_start, p_size * 1.0E0 + 10.0E0 AS section_end, p_partkey % 2 AS osrm_assisted, (5 + p_size) / 100.0E0 AS feature_len_km
  FROM part
  WHERE p_partkey % 11 <> 0
""",
    "tx_match_paths": """
SELECT shape_id, shape_index, path_index, CAST(ROW_NUMBER() OVER (PARTITION BY shape_id, shape_index, path_index ORDER BY shst_match_id) - 1 AS INT) AS path_edge_index, shst_match_id
  FROM (SELECT p_partkey % 40 AS shape_id, CAST(floor(p_partkey / 40.0E0) AS INT) % 7 AS shape_index, p_partkey % 3 AS path_index, p_partkey AS shst_match_id
  FROM part
  WHERE p_partkey % 11 <> 0 AND p_partkey % 3 <> 2) x
""",
}
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation or a base table."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = DERIVED[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE if re.search(rf"\b(FROM|JOIN)\s+{t}\b", sql)}
    return spark.sql(re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(used)})\b", r"\1\2{\3}", sql), **used)


def with_relations(sql: str) -> str:
    """SQL with a CTE for each derived relation that it names, directly or not."""
    names = [n for n in DERIVED if re.search(rf"\b{n}\b", sql)]
    ctes = ",\n".join(f"{n} AS ({DERIVED[n].strip()})" for n in names)
    if not ctes:
        return sql
    recursive = re.match(r"\s*WITH RECURSIVE\b", sql)
    if m := re.match(r"\s*WITH( RECURSIVE)?\s+", sql):
        return f"WITH{' RECURSIVE' if recursive else ''} {ctes},\n{sql[m.end():]}"
    return f"WITH {ctes}\n{sql}"
