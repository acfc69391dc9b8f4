"""Output layers and a shapefile writer (K7, K7a-K7f, C4, Q22)."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Field names of the stops layer that are shortened to ten characters.
STOP_NAMES = {"location_type": "loc_type", "stop_timezone": "stop_tmzn", "wheelchair_boarding": "wchair_bdn"}
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
POINT, POLYLINE = 1, 3
TEXT_WIDTH = 254


def one_line(c: Column) -> Column:
    return F.array(c)


def layers(stops: DataFrame, lines: DataFrame, segments: DataFrame, matches: DataFrame, paths: DataFrame, join: DataFrame) -> dict[str, DataFrame]:
    """The six layers; geometry in the column ``parts`` (array of lines, a point being a line of one point)."""
    fields = [F.col(f"properties.{c}").alias(STOP_NAMES.get(c, c)) for c in stops.schema["properties"].dataType.names]
    chosen = matches.join(paths.select(F.col("shst_match_id").alias("id")), "id", "left_semi")
    renamed = [F.col("id"), F.col("shst_reference").alias("shst_ref"), "shape_id", F.col("shape_index").alias("shape_idx")]
    return {
        "geojson_gtfs_stops": stops.select(*fields, one_line(F.array("geometry")).alias("parts")),
        "geojson_gtfs_shapes": lines.select(F.col("id").alias("shape_id"), one_line(F.col("coords")).alias("parts")),
        "gtfs_network_shape_segments": segments.select(
            "shape_id", F.col("shape_index").alias("shape_idx"), F.to_json("from_stop_ids").alias("from_stops"), F.to_json("to_stop_ids").alias("to_stops"), "start_dist", "stop_dist", one_line(F.col("coords")).alias("parts")
        ),
        "shst_matches": matches.select(*renamed, one_line(F.col("coords")).alias("parts")),
        "chosen_shst_matches": chosen.select(*renamed, one_line(F.col("coords")).alias("parts")),
        "gtfs_conflation_map_join": multi_lines(join),
    }


def multi_lines(sliced: DataFrame) -> DataFrame:
    """K7f, A12: the map segments of each shape segment as one multi-line, in order."""
    entry = F.struct("along_idx", "conflation_map_id", "coords")
    out = sliced.groupBy("shape_id", F.col("shape_index").alias("shape_idx")).agg(F.sort_array(F.collect_list(entry)).alias("m"))
    return out.select("shape_id", "shape_idx", F.to_json(F.transform("m", lambda x: x["conflation_map_id"])).alias("map_ids"), F.transform("m", lambda x: x["coords"]).alias("parts"))


def write(layer: DataFrame, path: str, kind: int = POLYLINE) -> int:
    """Writes a layer as .shp, .shx, .dbf and .prj, row by row; refuses to overwrite. Returns the number of rows."""
    base = Path(path).with_suffix("")
    if base.with_suffix(".shp").exists():
        raise FileExistsError(f"{base}.shp exists")
    base.parent.mkdir(parents=True, exist_ok=True)
    names = [c for c in layer.columns if c != "parts"]
    kinds = dict(layer.dtypes)
    numeric = {c: kinds[c] in ("int", "bigint", "double", "float") for c in names}
    return _write(layer.toLocalIterator(), base, kind, names, numeric, kinds)


def _write(rows: Iterable, base: Path, kind: int, names: list[str], numeric: dict[str, bool], kinds: dict[str, str]) -> int:
    box = [np.inf, np.inf, -np.inf, -np.inf]
    n, at = 0, 50  # place in 16-bit words
    width = {c: 24 if numeric[c] else TEXT_WIDTH for c in names}
    with base.with_suffix(".shp").open("wb") as shp, base.with_suffix(".shx").open("wb") as shx, base.with_suffix(".dbf").open("wb") as dbf:
        shp.write(b"\0" * 100)
        shx.write(b"\0" * 100)
        head = 32 + 32 * len(names) + 1
        dbf.write(b"\0" * head)
        for row in rows:
            parts = [np.array([(p["lon"], p["lat"]) for p in line]) for line in row["parts"]]
            points = np.concatenate(parts)
            low, high = points.min(axis=0), points.max(axis=0)
            box = [*np.minimum(box[:2], low), *np.maximum(box[2:], high)]
            if kind == POINT:
                body = struct.pack("<i2d", POINT, *points[0])
            else:
                starts = np.cumsum([0, *map(len, parts)])[:-1].astype("<i4")
                body = struct.pack("<i4d2i", POLYLINE, *low, *high, len(parts), len(points)) + starts.tobytes() + points.astype("<f8").tobytes()
            n += 1
            shx.write(struct.pack(">2i", at, len(body) // 2))
            shp.write(struct.pack(">2i", n, len(body) // 2) + body)
            at += 4 + len(body) // 2
            dbf.write(b" " + b"".join(_field(row[c], width[c], numeric[c]) for c in names))
        dbf.write(b"\x1a")
        _head(shp, at, kind, box if n else [0.0] * 4)
        _head(shx, 50 + 4 * n, kind, box if n else [0.0] * 4)
        dbf.seek(0)
        dbf.write(struct.pack("<4BIHH20x", 3, 100, 1, 1, n, head, 1 + sum(width.values())))
        for c in names:
            decimals = 9 if kinds[c] in ("double", "float") else 0
            dbf.write(struct.pack("<11sc4xBB14x", c[:10].encode(), b"N" if numeric[c] else b"C", width[c], decimals))
        dbf.write(b"\r")
    base.with_suffix(".prj").write_text(WGS84)
    return n


def _field(value, width: int, numeric: bool) -> bytes:
    if value is None:
        return b" " * width
    if numeric:
        return (f"{value:.9f}" if isinstance(value, float) else str(value)).rjust(width).encode()[:width]
    return str(value).encode()[:width].decode("utf-8", "ignore").encode().ljust(width)


def _head(f, words: int, kind: int, box: list[float]) -> None:
    f.seek(0)
    f.write(struct.pack(">i20xi", 9994, words) + struct.pack("<2i8d", 1000, kind, *box, 0, 0, 0, 0))


def read(path: str) -> Iterator[tuple[dict[str, str | None], list[np.ndarray]]]:
    """Rows of a shapefile: fields as text (None if blank), and the parts of the geometry."""
    base = Path(path).with_suffix("")
    with base.with_suffix(".shp").open("rb") as shp, base.with_suffix(".dbf").open("rb") as dbf:
        n, head, _ = struct.unpack("<4xIHH20x", dbf.read(32))
        fields = [(f[:11].rstrip(b"\0").decode(), f[16]) for f in (dbf.read(32) for _ in range((head - 33) // 32))]
        dbf.read(1)
        shp.read(100)
        for _ in range(n):
            dbf.read(1)
            values = {name: dbf.read(width).decode().strip() or None for name, width in fields}
            body = shp.read(2 * struct.unpack(">4xi", shp.read(8))[0])
            if struct.unpack("<i", body[:4])[0] == POINT:
                yield values, [np.frombuffer(body, "<f8", 2, 4).reshape(1, 2)]
                continue
            n_parts, n_points = struct.unpack("<2i", body[36:44])
            starts = np.frombuffer(body, "<i4", n_parts, 44)
            yield values, np.split(np.frombuffer(body, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2), starts[1:])


def write_all(named: dict[str, DataFrame], output_file: str) -> dict[str, int]:
    """K7: a file for each layer in a folder that must not exist."""
    if Path(output_file).exists():
        raise FileExistsError(f"{output_file} exists")
    return {name: write(df, f"{output_file}/{name}.shp", POINT if name == "geojson_gtfs_stops" else POLYLINE) for name, df in named.items()}
