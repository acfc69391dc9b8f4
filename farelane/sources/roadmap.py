"""Road maps and features: SQLite map, GeoJSON and NDGeoJSON."""

from __future__ import annotations

import sqlite3
import tempfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import fetched, put
from ..functions import geo

#: Target maps and the properties kept of each.
TARGET_MAPS = ["ris_2016", "ris_2017", "ris_2018", "ris_2019", "npmrds_2017", "npmrds_2019"]
TARGET_PROPERTIES = ["targetMapId", "targetMapMesoId", "targetMapMacroId", "targetMapMegaId", "targetMapNetHrchyRank", "targetMapMesoLevelIdx"]
_TARGET = "struct<" + ",".join(f"{p}:string" for p in TARGET_PROPERTIES) + ">"
FEATURE = "struct<id:long,properties:struct<shstReferenceId:string,networklevel:double,osm:struct<conflationMapMatchedTargetMapId:string>," + ",".join(f"{m}:{_TARGET}" for m in TARGET_MAPS) + ">,geometry:struct<type:string,coordinates:array<array<double>>>>"
ROWS = 10_000


def rows_of(path: str) -> Iterator[list[tuple[int, str]]]:
    """(id, feature) of a SQLite map, in blocks."""
    db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    try:
        cursor = db.execute("SELECT id, feature FROM conflation_map ORDER BY id")
        while block := cursor.fetchmany(ROWS):
            yield block
    finally:
        db.close()


def sqlite_to_parquet(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Copies the SQLite table to Parquet block by block (a SQLite file has one reader); returns it."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    n = -1
    with fetched(spark, path) as local, tempfile.TemporaryDirectory(prefix="farelane-") as aside:
        for n, block in enumerate(rows_of(local)):
            ids, features = zip(*block, strict=True)
            part = f"{aside}/part-{n:06}.parquet"
            pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "feature": pa.array(features, pa.string())}), part)
            put(spark, part, f"{folder}/part-{n:06}.parquet")
            Path(part).unlink()
    return spark.read.schema("id long, feature string").parquet(folder) if n >= 0 else spark.createDataFrame([], "id long, feature string")


def as_coords(c):
    return F.transform(c, lambda p: geo.point(F.get(p, F.lit(0)), F.get(p, F.lit(1))))


def conflation_map(features: DataFrame) -> DataFrame:
    """id, shst_reference, networklevel, length_km, coords and the target maps' properties, of segments that have a reference."""
    f = features.select("id", F.from_json("feature", FEATURE).alias("f"))
    rows = f.filter(F.col("f.properties.shstReferenceId").isNotNull()).select(
        "id", F.col("f.properties.shstReferenceId").alias("shst_reference"), F.col("f.properties.networklevel").alias("networklevel"),
        as_coords(F.col("f.geometry.coordinates")).alias("coords"), F.col("f.properties.osm.conflationMapMatchedTargetMapId").alias("osm"), *[F.col(f"f.properties.{m}").alias(m) for m in TARGET_MAPS],
    )
    return rows.withColumn("length_km", geo.length_km(F.col("coords")))


def as_geojson(df: DataFrame, geometry: str, properties: list[str], kind: str = "LineString", id_column: str | None = None) -> DataFrame:
    """One GeoJSON feature a row, as text."""
    pair = lambda p: F.array(p["lon"], p["lat"])
    c = F.col(geometry)
    coordinates = {"Point": lambda: pair(c), "LineString": lambda: F.transform(c, pair), "MultiLineString": lambda: F.transform(c, lambda x: F.transform(x, pair))}[kind]()
    head = [F.col(id_column).alias("id")] if id_column else []
    feature = F.struct(F.lit("Feature").alias("type"), *head, F.struct(*properties).alias("properties"), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feature).alias("value"))


def write_ndgeojson(conflation_map: DataFrame, path: str) -> None:
    """K8: the map with the properties id, shst, osm and nlev, a feature a line."""
    rows = conflation_map.withColumnsRenamed({"shst_reference": "shst", "networklevel": "nlev"})
    as_geojson(rows.orderBy("id"), "coords", ["id", "shst", "osm", "nlev"], id_column="id").write.mode("overwrite").text(path)


def read_feature_collection(spark: SparkSession, path: str, properties: str) -> DataFrame | None:
    """Properties and coords of a FeatureCollection's lines; None if there is no such file. properties: DDL of their struct."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    schema = f"features array<struct<properties:struct<{properties}>,geometry:struct<coordinates:array<array<double>>>>>"
    each = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return each.select("f.properties.*", as_coords(F.col("f.geometry.coordinates")).alias("coords"))


def write_feature_collection(features: DataFrame, path: str) -> None:
    """One document, written by one task, line by line: for a matcher's batch, not for a whole map."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with Path(path).open("w") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for i, row in enumerate(features.toLocalIterator()):
            out.write("," * (i > 0) + row["value"])
        out.write("]}")
