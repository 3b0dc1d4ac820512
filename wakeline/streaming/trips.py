"""Trips of unbounded streams of pings. An extension: the same functions run on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(pings: DataFrame, gap_hours: float = 1.0, vessel: str = "mmsi", time: str = "base_date_time", late: str | None = None) -> DataFrame:
    """Trips by gaps: vessel, begin, last, pings. A session window ends where a gap reaches its length, a trip where it
    exceeds it; the window is a microsecond longer to agree. late, as "2 hours", sets a watermark for streams."""
    t = pings.withColumn("_t", F.col(time).cast("timestamp"))
    if late:
        t = t.withWatermark("_t", late)
    gap = f"{round(gap_hours * 3_600_000_000) + 1} microseconds"
    s = t.where(F.col(vessel).isNotNull()).groupBy(vessel, F.session_window("_t", gap)).agg(F.min("_t").alias("begin"), F.max("_t").alias("last"), F.count("*").alias("pings"))
    return s.select(vessel, F.col("begin").cast("timestamp_ntz").alias("begin"), F.col("last").cast("timestamp_ntz").alias("last"), "pings")


def density(pings: DataFrame, zoom: int, window: str = "1 hour", late: str = "2 hours", lon: str = "longitude", lat: str = "latitude", time: str = "base_date_time") -> DataFrame:
    """Pings per tile and time window of a stream."""
    from ..functions import geometry, tiles

    t = pings.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    x, y = tiles.pixel_x(geometry.mercator_x(F.col(lon)), zoom, 1), tiles.pixel_y(geometry.mercator_y(F.col(lat)), zoom, 1)
    return t.groupBy(F.window("_t", window), F.floor(x).alias("tile_x"), F.floor(y).alias("tile_y")).agg(F.count("*").alias("pings"))
