"""Cleaning of pings: sentinels, speeds, moored vessels, groups, partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import vessel
from ..schema import micros, require


def null_sentinels(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Latitude 91 and longitude 181 mean "not available" and become null, each by itself; the row stays."""
    return df.withColumns({lat: F.when((F.col(lat) != 91) & ~F.isnan(lat), F.col(lat)), lon: F.when((F.col(lon) != 181) & ~F.isnan(lon), F.col(lon))})


def drop_null_coordinates(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    return df.dropna(subset=[lon, lat])


def exclude_moored(df: DataFrame, status: str = "status") -> DataFrame:
    """Drops status 5; a null status stays, textual ones too."""
    return require(df, status).where(~F.col(status).cast("string").eqNullSafe("5"))


def clean_speeds(df: DataFrame, sog: str = "sog", raw_units: bool = False) -> DataFrame:
    return require(df, sog).withColumn(sog, vessel.clean_sog(F.col(sog), raw_units))


def watch_speeds(df: DataFrame, sog: str = "sog", raw_units: bool = False) -> tuple[DataFrame, Observation]:
    """clean_speeds with an observation (rows, invalid, most) that fills when the result runs: see speed_warnings."""
    seen = Observation("speeds")
    s = F.col("_sog")
    watched = clean_speeds(df.withColumn("_raw", F.col(sog)), sog, raw_units).withColumn("_sog", F.col(sog))
    watched = watched.observe(seen, F.count("_raw").alias("rows"), F.sum((F.col("_raw").isNotNull() & s.isNull()).cast("long")).alias("invalid"), F.max(s).alias("most"))
    return watched.drop("_raw", "_sog"), seen


def speed_warnings(seen: dict, raw_units: bool = False) -> list[str]:
    """What an observation gives reason to doubt."""
    out = []
    if seen["rows"] and seen["invalid"] / seen["rows"] > 0.01:
        out.append(f"{seen['invalid']} of {seen['rows']} speeds are invalid")
    if raw_units and seen["most"] is not None and seen["most"] < 5:
        out.append(f"raw units were assumed, but no speed exceeds {seen['most']} knots")
    return out


def classify(df: DataFrame, code: str = "shiptypeAIS", mapping: dict | None = None, out: str = "VesselGroup") -> DataFrame:
    return df.withColumn(out, vessel.vessel_group(F.col(code), mapping))


def date_parts(df: DataFrame, time: str = "base_date_time") -> DataFrame:
    """year, month and day as zero-padded strings, for partitioned writes."""
    return df.withColumns({"year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM"), "day": F.date_format(time, "dd")})


def normalize_epoch(df: DataFrame, time: str = "base_date_time", trip: str = "trip_id") -> DataFrame:
    """Times of each trip as if it began in 1970."""
    from pyspark.sql import Window

    first = F.min(micros(time)).over(Window.partitionBy(trip))
    return df.withColumn(time, F.timestamp_add("MICROSECOND", micros(time) - first, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def reproject(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Adds Web Mercator x and y in metres."""
    from ..functions import geometry

    return df.withColumns({"x": geometry.mercator_x(F.col(lon)), "y": geometry.mercator_y(F.col(lat))})
