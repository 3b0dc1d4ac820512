"""Small reference files: layers of lines and polygons, vessel codes, configuration."""

from __future__ import annotations

import json
import math
import sqlite3
import tomllib
from itertools import pairwise
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions import wkb
from ..operators import spatial

_KINDS = {"LineString": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3, "Point": 0, "MultiPoint": 1}


def _features(path: str) -> list[tuple[dict, str, list]]:
    """Properties, kind and parts of each feature of a GeoJSON, GeoPackage or GeoParquet file."""
    if path.endswith(".gpkg"):
        return _gpkg(path)
    if path.endswith((".parquet", ".geoparquet")):
        import pyarrow.parquet as pq

        table = pq.read_table(path)
        column = json.loads((table.schema.metadata or {}).get(b"geo", b'{"primary_column": "geometry"}'))["primary_column"]
        return [({k: v for k, v in r.items() if k != column}, *wkb.decode(r[column])) for r in table.to_pylist()]
    out = []
    for f in json.loads(Path(path).read_text())["features"]:
        g = f["geometry"]
        c, depth = g["coordinates"], _KINDS[g["type"]]
        parts = [[c]] if depth == 0 else [c] if depth == 1 else c if depth == 2 else [ring for poly in c for ring in poly]
        out.append((f.get("properties") or {}, g["type"], [[(p[0], p[1]) for p in part] for part in parts]))
    return out


def _gpkg(path: str) -> list[tuple[dict, str, list]]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        table, column = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns LIMIT 1").fetchone()
        rows = db.execute(f'SELECT * FROM "{table}"')
        names = [d[0] for d in rows.description]
        out = []
        for row in rows:
            r = dict(zip(names, row, strict=True))
            data = r.pop(column)
            envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(data[3] >> 1) & 7]
            out.append((r, *wkb.decode(data[8 + envelope :])))
        return out


def read_lines(spark: SparkSession, path: str, id_col: str = "PassageId") -> DataFrame:
    """A layer of lines for spatial operators: LineStrings, and of MultiLineStrings the longest line in Web Mercator.
    Anything else is refused."""
    rows = []
    for props, kind, parts in _features(path):
        if kind not in ("LineString", "MultiLineString") or not parts:
            raise ValueError(f"{id_col} {props.get(id_col)} is a {kind}, not a line")
        if id_col not in props:
            raise KeyError(f"no {id_col} among {sorted(props)}")
        rows.append((str(props[id_col]), [{"x": float(x), "y": float(y)} for x, y in max(parts, key=_mercator_length)]))
    df = spark.createDataFrame(rows, f"`{id_col}` string, path array<struct<x: double, y: double>>")
    return spatial.line_layer(df).drop("path")


def _mercator_length(line: list[tuple[float, float]]) -> float:
    flat = [(math.radians(x), math.asinh(math.tan(math.radians(y)))) for x, y in line]
    return sum(math.dist(p, q) for p, q in pairwise(flat))


def read_bin_stats(spark: SparkSession, path: str, id_col: str = "PassageId") -> tuple[DataFrame, DataFrame]:
    """(statistics, layer) of a file of gate statistics: the wide bin columns, and the gates as a layer of lines."""
    features = _features(path)
    if not features:
        raise ValueError(f"{path} has no gates")
    wide = sorted({k for props, _, _ in features for k in props if k.startswith(("loc_bin_", "median_speed_loc_"))})
    kinds = ["int" if k.startswith("loc_bin_") else "double" for k in wide]
    rows = [(str(p[id_col]), *(int(p.get(k) or 0) if t == "int" else float(p.get(k) or 0) for k, t in zip(wide, kinds, strict=True))) for p, _, _ in features]
    schema = ", ".join([f"`{id_col}` string", *(f"{k} {t}" for k, t in zip(wide, kinds, strict=True))])
    return spark.createDataFrame(rows, schema), read_lines(spark, path, id_col)


def read_polygons(spark: SparkSession, path: str, id_col: str = "name") -> DataFrame:
    rows = []
    for props, kind, parts in _features(path):
        if "Polygon" not in kind:
            raise ValueError(f"{id_col} {props.get(id_col)} is a {kind}, not a polygon")
        if id_col not in props:
            raise KeyError(f"no {id_col} among {sorted(props)}")
        rows.append((str(props[id_col]), [[{"x": float(x), "y": float(y)} for x, y in part] for part in parts]))
    df = spark.createDataFrame(rows, f"`{id_col}` string, rings array<array<struct<x: double, y: double>>>")
    return spatial.polygon_layer(df).drop("rings")


def vessel_codes(path: str) -> dict:
    """Groups by whole number or lower-case label. Codes are numbers, ranges "a to b" or labels; a range with a part that
    is a number but not of that shape is an error, and so are missing keys and other types."""
    out: dict = {}
    for row in json.loads(Path(path).read_text()):
        if not isinstance(row, dict) or not {"vessel_code", "vessel_group"} <= row.keys():
            raise ValueError(f"a vessel code needs vessel_code and vessel_group: {row}")
        code, group = row["vessel_code"], row["vessel_group"]
        if isinstance(code, bool) or not isinstance(code, int | float | str):
            raise ValueError(f"not a vessel code: {code!r}")
        if isinstance(code, int | float):
            out[int(code)] = group
            continue
        parts = [p.strip() for p in code.split(" to ")]
        numbers = [_number(p) for p in parts]
        if len(parts) == 1 and numbers[0] is not None:
            out[int(numbers[0])] = group
        elif len(parts) == 2 and None not in numbers:
            out.update(dict.fromkeys(range(int(numbers[0]), int(numbers[1]) + 1), group))
        elif any(n is not None for n in numbers):
            raise ValueError(f"not a range: {code!r}")
        else:
            out[code.strip().lower()] = group
    return out


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def config(path: str) -> dict:
    """A TOML file with sections data, visualization, resources, style and outlier, with defaults filled in."""
    given = tomllib.loads(Path(path).read_text())
    base = {"data": {}, "visualization": {"zoom": 7, "tile_size": 1024, "line_width": 0}, "resources": {}, "style": {}, "outlier": {"v_max": 50.0, "d_min": 300.0}}
    return {k: base.get(k, {}) | given.get(k, {}) for k in base.keys() | given.keys()}
