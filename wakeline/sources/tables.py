"""Parquet point tables, Hive folders, WKB tables and CRS checks."""

from __future__ import annotations

import json
from pathlib import Path

import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.wkb import wkb_parts
from ..schema import require


def read_points(spark: SparkSession, path: str, first_files: int | None = None) -> DataFrame:
    """Shape becomes geometry, Shape_bbox goes. first_files takes that many files only, for trials."""
    df = spark.read.parquet(path)
    if first_files:
        df = spark.read.option("basePath", path).parquet(*sorted(df.inputFiles())[:first_files])
    return df.drop("Shape_bbox").withColumnsRenamed({"Shape": "geometry"} if "Shape" in df.columns else {})


def hive_keys(path: str) -> dict[str, str] | None:
    """Partition keys of a folder and of the folders above it, with their types: int for digits, else string. None for
    files and folders without keys."""
    p = Path(path)
    if not p.is_dir():
        return None
    found: dict[str, list[str]] = {}
    for part in p.resolve().parts:
        if "=" in part:
            k, _, v = part.partition("=")
            found.setdefault(k, []).append(v)
    level = [p]
    while level:
        below = [c for d in level for c in sorted(d.iterdir()) if c.is_dir() and "=" in c.name]
        for c in below:
            k, _, v = c.name.partition("=")
            found.setdefault(k, []).append(v)
        level = below
    return {k: "int" if all(v.isdigit() for v in vs) else "string" for k, vs in found.items()} or None


def read_hive(spark: SparkSession, path: str) -> DataFrame:
    """A Hive folder, or a leaf of one: keys of the folders above become columns too."""
    root = Path(path).resolve()
    while "=" in root.name:
        root = root.parent
    return spark.read.option("basePath", str(root)).parquet(path)


def geo_metadata(path: str) -> dict | None:
    """The GeoParquet metadata of a file, or of the first file of a folder."""
    p = Path(path)
    files = [p] if p.is_file() else sorted(p.rglob("*.parquet"))
    meta = (pq.read_schema(files[0]).metadata or {}) if files else {}
    return json.loads(meta[b"geo"]) if b"geo" in meta else None


def require_geo(path: str) -> dict:
    if not (meta := geo_metadata(path)):
        raise ValueError(f"{path} has no geometry metadata")
    return meta


def crs_code(meta: dict) -> int:
    """The EPSG code of the primary geometry; 4326 where none is given."""
    crs = meta["columns"][meta["primary_column"]].get("crs")
    return 4326 if crs is None else int(crs["id"]["code"]) if isinstance(crs, dict) else int(str(crs).rpartition(":")[2])


def read_for_rendering(spark: SparkSession, path: str) -> DataFrame:
    """A table in Web Mercator; anything else is refused."""
    if (code := crs_code(require_geo(path))) != 3857:
        raise ValueError(f"rendering needs EPSG:3857, not EPSG:{code}")
    return spark.read.parquet(path)


def read_wkb(spark: SparkSession, path: str) -> DataFrame:
    """A table with WKB in Shape: decoded into parts; other columns stay."""
    df = require(spark.read.parquet(path), "Shape")
    return df.withColumn("geometry", wkb_parts("Shape")).drop("Shape", "Shape_bbox")


def footer_bounds(path: str, columns: tuple[str, ...] = ("longitude", "latitude", "base_date_time")) -> dict[str, tuple]:
    """Smallest and largest values by the statistics of all row groups, without reading data."""
    out: dict[str, tuple] = {}
    for f in ds.dataset(path, format="parquet").files:
        meta = pq.read_metadata(f)
        place = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            for c in columns:
                stats = meta.row_group(g).column(place[c]).statistics
                if stats is None or not stats.has_min_max:
                    raise ValueError(f"{f} has no statistics of {c}")
                lo, hi = out.get(c, (stats.min, stats.max))
                out[c] = (min(lo, stats.min), max(hi, stats.max))
    return out


def with_point(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    return df.withColumn("geometry", F.struct(F.col(lon).alias("x"), F.col(lat).alias("y")))
