"""Writing tables, small GeoJSON files and run metadata; names of outputs."""

from __future__ import annotations

import json
import re
import shutil
import sqlite3
import struct
import sys
from contextlib import closing
from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wkb
from ..functions.wkb import line_wkb
from ..operators.clean import date_parts


def write_by_day(df: DataFrame, path: str, time: str = "base_date_time", mode: str = "overwrite") -> None:
    """Folders year=/month=/day=; rows are rebalanced by day first, so that a small day is one file and a large one is
    split over tasks by its size. mode append adds a batch."""
    d = date_parts(df, time)
    d.hint("rebalance", "year", "month", "day").write.mode(mode).partitionBy("year", "month", "day").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_geoparquet(df: DataFrame, path: str, crs: int = 4326, geometry: str = "geometry") -> None:
    """A folder of GeoParquet files, one for each task, with the metadata of version 1.1. `geometry` holds WKB; where it
    is missing, it is made of `line`, of lon1 to lat2, or of longitude and latitude, in degrees. path must be a folder that
    every executor shares; a task that runs again replaces its own file."""
    d, has = df, set(df.columns)
    point = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    if geometry in has:
        pass
    elif shape := next((c for c in ("line", "points") if c in has), None):
        d = df.withColumn(geometry, line_wkb(F.col(shape))).drop(shape)
    elif {"lon1", "lat1", "lon2", "lat2"} <= has:
        d = df.withColumn(geometry, line_wkb(F.array(point("lon1", "lat1"), point("lon2", "lat2"))))
    elif {"longitude", "latitude"} <= has:
        d = df.withColumn(geometry, line_wkb(F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), F.array(point("longitude", "latitude")))))
    else:
        raise KeyError("no geometry, line, points or coordinates to write")
    about = {"version": "1.1.0", "primary_column": geometry, "columns": {geometry: {"encoding": "WKB", "geometry_types": [], "crs": {"id": {"authority": "EPSG", "code": crs}}}}}
    target = Path(path)
    if target.exists():
        shutil.rmtree(target) if target.is_dir() else target.unlink()
    target.mkdir(parents=True)

    def put(batches):
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}"
        held = Path(path, f".{name}-{TaskContext.get().taskAttemptId()}")
        out, rows = None, 0
        for batch in batches:
            if out is None:
                schema = batch.schema.with_metadata({b"geo": json.dumps(about).encode()})
                out = pq.ParquetWriter(held, schema)
            out.write_batch(batch.replace_schema_metadata(schema.metadata))
            rows += batch.num_rows
        if out is not None:
            out.close()
            held.replace(Path(path, f"{name}.parquet"))
        yield pa.RecordBatch.from_arrays([pa.array([rows])], ["rows"])

    d.mapInArrow(put, "rows long").agg(F.sum("rows")).collect()


def write_geopackage(df: DataFrame, path: str, line: str = "line", table: str = "features") -> None:
    """A small result with array<struct<x, y>> in `line` as a GeoPackage in degrees."""
    kinds = {"int": "INTEGER", "bigint": "INTEGER", "double": "REAL"}
    names = [c for c in df.columns if c != line]
    blob = lambda pts: b"GP\0\1" + struct.pack("<i", 4326) + wkb.encode("LineString" if len(pts) > 1 else "Point", [[(p["x"], p["y"]) for p in pts]])
    rows = [(*(r[c] for c in names), blob(r[line])) for r in df.toLocalIterator()]
    Path(path).unlink(missing_ok=True)
    with closing(sqlite3.connect(path)) as db, db:
        db.execute("PRAGMA application_id = 1196444487")
        db.execute("PRAGMA user_version = 10300")
        db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
        for name, code in (("WGS 84", 4326), ("Undefined Cartesian", -1), ("Undefined geographic", 0)):
            db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, NULL)", (name, code, "EPSG" if code > 0 else "NONE", code, "undefined"))
        db.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER)")
        db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, last_change, srs_id) VALUES (?, 'features', ?, ?, 4326)", (table, table, datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")))
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', 4326, 0, 0)", (table,))
        columns = ", ".join(f'"{c}" {kinds.get(df.schema[c].dataType.simpleString(), "TEXT")}' for c in names)
        db.execute(f'CREATE TABLE "{table}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, {columns}, geom BLOB)')
        db.executemany(f'INSERT INTO "{table}" ({", ".join([*(f'"{c}"' for c in names), "geom"])}) VALUES ({", ".join("?" * (len(names) + 1))})', rows)


def write_features(df: DataFrame, path: str, line: str = "line") -> None:
    """A GeoPackage where the name ends in .gpkg, else GeoJSON."""
    (write_geopackage if path.lower().endswith(".gpkg") else write_geojson)(df, path, line)


def write_geojson(df: DataFrame, path: str, line: str = "line") -> None:
    """Rows of a small result (gates, bins) with array<struct<x, y>> in `line` as features in degrees."""
    features = []
    for r in df.toLocalIterator():
        props = {k: v for k, v in r.asDict().items() if k != line}
        pts = [[p["x"], p["y"]] for p in r[line]]
        features.append({"type": "Feature", "properties": props, "geometry": {"type": "LineString" if len(pts) > 1 else "Point", "coordinates": pts if len(pts) > 1 else pts[0]}})
    Path(path).write_text(json.dumps({"type": "FeatureCollection", "features": features}, default=str))


def bin_segments_path(path: str) -> str:
    p = Path(path)
    return str(p.with_name(f"{p.stem}_bin_segments.geojson"))


def default_output(path: str, suffix: str) -> str:
    """Beside the input: its extensions and stage names dropped, the suffix added."""
    p = Path(path)
    name = p.name
    while (short := re.sub(r"\.(zip|7z|csv|ndjson|parquet|geoparquet)$", "", name)) != name:
        name = short
    return str(p.with_name(re.sub(r"-(trajectorized|lines|segments|cleaned)$", "", name) + suffix))


def write_run_metadata(folder: str, source: str, config: dict) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    about = {"timestamp": datetime.now(timezone.utc).isoformat(), "input": source, "config": config, "argv": sys.argv}
    (Path(folder) / "metadata.json").write_text(json.dumps(about, indent=2, default=str))


def drop_levels_above(folder: str, base_zoom: int) -> None:
    """Deletes the folders z=k of a pyramid with k below the base zoom."""
    for p in Path(folder).glob("z=*"):
        if int(p.name[2:]) < base_zoom:
            shutil.rmtree(p)
