"""Trips of vessels: time gaps, stops, kinematics."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesic as g
from ..functions import hull
from ..functions.geometry import haversine
from ..schema import micros, require, time_column, vessel_column


def _order(vessel: str, time: str, ties: tuple[str, ...]) -> Window:
    return Window.partitionBy(vessel).orderBy(F.asc_nulls_last(time), *ties)


def time_deltas(df: DataFrame, vessel: str | None = None, time: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """time_diff_s: seconds since the vessel's previous ping."""
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    now = micros(time)
    return df.withColumn("time_diff_s", (now - F.lag(now).over(_order(vessel, time, ties))) / 1e6)


def _number(df: DataFrame, start: Column, vessel: str, time: str, ties: tuple[str, ...]) -> DataFrame:
    """trip_id "vessel_n": n counts starts from 1."""
    order = _order(vessel, time, ties)
    n = F.sum(start.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("trip_id", F.concat_ws("_", F.col(vessel).cast("string"), n.cast("string")))


def gap_trips(df: DataFrame, gap_hours: float = 1.0, vessel: str | None = None, time: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """time_diff_s and trip_id by gaps alone: a trip starts after more than gap_hours without a ping. Rows of a null
    vessel are dropped."""
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    d = time_deltas(df.where(F.col(vessel).isNotNull()), vessel, time, ties)
    return _number(d, F.col("time_diff_s").isNull() | (F.col("time_diff_s") > gap_hours * 3600), vessel, time, ties)


def stop_areas(df: DataFrame, stop_min: float = 20.0, vessel: str | None = None, time: str | None = None, lon: str = "longitude", lat: str = "latitude", ties: tuple[str, ...] = ()) -> DataFrame:
    """rolling_area_m2: hull area of the vessel's pings in the trailing window, on a plane about the vessel's mean
    position; 0 for fewer than three.

    The kernel gets islands, runs of pings without a pause longer than the window: no window crosses such a pause, so a
    vessel of any length is spread over many groups.
    """
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    window = round(stop_min * 60)
    order = _order(vessel, time, ties)
    centre = df.where(F.col(vessel).isNotNull()).groupBy(F.col(vessel).alias("_v")).agg(F.avg(lon).alias("_lon0"), F.avg(lat).alias("_lat0"))
    d = df.withColumn("_t", micros(time)).join(centre, F.col(vessel) == F.col("_v")).drop("_v")
    pause = F.coalesce(F.col("_t") - F.lag("_t").over(order) > window * 1_000_000, F.lit(True))
    d = d.withColumn("_island", F.sum(pause.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_row", F.row_number().over(order))

    names = df.columns

    def areas(table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")
        lon0, lat0 = table["_lon0"][0].as_py(), table["_lat0"][0].as_py()
        x, y = g.local_plane(table[lon].to_numpy().astype(float), table[lat].to_numpy().astype(float), lon0, lat0)
        a = hull.trailing_areas(table["_t"].to_numpy().astype(float) / 1e6, x, y, float(window))
        return table.select(names).append_column("rolling_area_m2", pa.array(a))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return d.groupBy(vessel, "_island").applyInArrow(areas, f"{fields}, rolling_area_m2 double")


def stop_trips(df: DataFrame, gap_hours: float = 1.0, stop_radius_m: float = 50.0, vessel: str | None = None, time: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """trip_id from time_diff_s gaps and rolling_area_m2: a trip starts also where a vessel moves on after a stop, that
    is after rows whose area is less than the circle of the radius."""
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    d = require(df, "time_diff_s", "rolling_area_m2")
    stopped = F.col("rolling_area_m2") < math.pi * stop_radius_m**2
    moved_on = F.lag(stopped, 1, False).over(_order(vessel, time, ties)) & ~stopped
    return _number(d, F.col("time_diff_s").isNull() | (F.col("time_diff_s") > gap_hours * 3600) | moved_on, vessel, time, ties)


def kinematics(df: DataFrame, time: str | None = None, trip: str = "trip_id", lon: str = "longitude", lat: str = "latitude", distance: str = "geodesic", ties: tuple[str, ...] = ()) -> DataFrame:
    """speed_mps, acceleration_mps2, turn_rate_from_cog and turn_rate_from_heading, each against the trip's previous
    ping; null for its first, where no time has passed, or where the column is missing."""
    time = time_column(df, time)
    order = Window.partitionBy(trip).orderBy(time, *ties)
    now = micros(time)
    before = lambda c: F.lag(c).over(order)
    d = df.withColumns({"_dt": (now - before(now)) / 1e6, "_x": before(lon), "_y": before(lat)})
    far = {"geodesic": g.geodesic, "haversine": haversine}[distance](F.col("_x"), F.col("_y"), F.col(lon), F.col(lat))
    d = d.withColumn("_far", far).withColumn("speed_mps", F.when(F.col("_dt") > 0, F.col("_far") / F.col("_dt")))
    d = d.withColumn("acceleration_mps2", F.when(F.col("_dt") > 0, (F.col("speed_mps") - before("speed_mps")) / F.col("_dt")))
    for name in ("cog", "heading"):
        turn = F.pmod(F.col(name) - before(name) + 180.0, F.lit(360.0)) - 180.0 if name in df.columns else F.lit(None).cast("double")
        d = d.withColumn(f"turn_rate_from_{name}", F.when(F.col("_dt") > 0, turn / F.col("_dt")))
    return d.drop("_dt", "_x", "_y", "_far")


def trajectorize(df: DataFrame, gap_hours: float = 1.0, stop_min: float = 20.0, stop_radius_m: float = 50.0, vessel: str | None = None, time: str | None = None, lon: str = "longitude", lat: str = "latitude", distance: str = "geodesic", input_crs: int = 4326, ties: tuple[str, ...] = ()) -> DataFrame:
    """Points with time_diff_s, rolling_area_m2, trip_id and kinematics. Rows without coordinates or vessel are dropped;
    coordinates must be degrees."""
    if input_crs not in (4326, 4269):
        raise ValueError("coordinates must be geographic")
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    require(df, lon, lat)
    d = df.dropna(subset=[vessel, lon, lat])
    ties = ties or (lon, lat)
    d = stop_trips(time_deltas(stop_areas(d, stop_min, vessel, time, lon, lat, ties), vessel, time, ties), gap_hours, stop_radius_m, vessel, time, ties)
    return kinematics(d, time, "trip_id", lon, lat, distance, ties)


def trip_lines(df: DataFrame, time: str | None = None, vessel: str | None = None, lon: str = "longitude", lat: str = "latitude", mapping: dict | None = None, code: str = "shiptypeAIS", ties: tuple[str, ...] = (), still: bool = False) -> DataFrame:
    """One line per trip of at least two distinct consecutive positions: trip_id, MMSI, TrackStartTime, TrackEndTime,
    VesselType, VesselGroup, Length, Width, Draft, DurationMinutes, line (array of x, y). Attributes are the first known ones.
    With still, trips of two pings or more that never move count too: their line is the place twice."""
    from ..functions.vessel import vessel_group

    time, vessel = time_column(df, time), vessel_column(df, vessel)
    order = Window.partitionBy("trip_id").orderBy(time, *ties)
    d = df.withColumn("_n", F.row_number().over(order))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_n"))) if c in df.columns else F.max(F.lit(None).cast("string"))
    t = d.groupBy("trip_id").agg(
        first(vessel).alias("MMSI"), F.min(time).alias("TrackStartTime"), F.max(time).alias("TrackEndTime"), first(code).alias("VesselType"),
        first("length").alias("Length"), first("beam").alias("Width"), first("draught").alias("Draft"),
        F.sort_array(F.collect_list(F.struct("_n", F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y")))).alias("_p"), F.count("*").alias("_pings"),
    )
    same = lambda p, i: (i > 0) & (F.get(F.col("_p"), i - 1)["x"] == p["x"]) & (F.get(F.col("_p"), i - 1)["y"] == p["y"])
    t = t.withColumn("line", F.transform(F.filter("_p", lambda p, i: ~F.coalesce(same(p, i), F.lit(False))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    minutes = F.bround((micros("TrackEndTime") - micros("TrackStartTime")) / 6e7).cast("int")
    if still:
        t = t.withColumn("line", F.when(F.size("line") == 1, F.array_repeat(F.col("line")[0], 2)).otherwise(F.col("line")))
    t = t.where("_pings >= 2 AND size(line) >= 2").withColumn("DurationMinutes", minutes).withColumn("VesselGroup", vessel_group(F.col("VesselType"), mapping))
    return t.select("trip_id", "MMSI", "TrackStartTime", "TrackEndTime", "VesselType", "VesselGroup", "Length", "Width", "Draft", "DurationMinutes", "line")


def segments(df: DataFrame, time: str | None = None, vessel: str | None = None, lon: str = "longitude", lat: str = "latitude", mapping: dict | None = None, code: str = "shiptypeAIS", raw_sog: bool = False, ties: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of consecutive pings of a trip: MMSI, trip_id, VesselType, VesselGroup, Length, Width, Draft,
    segment_start_time, segment_end_time, speed_mps, acceleration_mps2, sog, segment_duration_s, lon1, lat1, lon2, lat2
    and, in Web Mercator, x1, y1, x2, y2. Measures are those of the first ping, so speed_mps is the speed of arrival there."""
    from ..functions import geometry as geo
    from ..functions.vessel import clean_sog, vessel_group

    time, vessel = time_column(df, time), vessel_column(df, vessel)
    require(df, "trip_id", lon, lat)
    order = Window.partitionBy("trip_id").orderBy(time, *ties)
    have = lambda c, kind="double": F.col(c) if c in df.columns else F.lit(None).cast(kind)
    d = df.withColumns({"_t2": F.lead(time).over(order), "_lon2": F.lead(lon).over(order), "_lat2": F.lead(lat).over(order), "_more": F.lead(F.lit(1)).over(order)}).where("_more = 1")
    s = d.select(
        F.col(vessel).alias("MMSI"), "trip_id", have(code, "string").alias("VesselType"), vessel_group(have(code, "string"), mapping).alias("VesselGroup"), have("length").alias("Length"), have("beam").alias("Width"),
        have("draught").alias("Draft"), F.col(time).alias("segment_start_time"), F.col("_t2").alias("segment_end_time"), have("speed_mps").alias("speed_mps"),
        have("acceleration_mps2").alias("acceleration_mps2"), clean_sog(have("sog"), raw_sog).alias("sog"), ((micros("_t2") - micros(time)) / 1e6).alias("segment_duration_s"),
        F.col(lon).alias("lon1"), F.col(lat).alias("lat1"), F.col("_lon2").alias("lon2"), F.col("_lat2").alias("lat2"),
    )
    return s.withColumns({f"x{k}": geo.mercator_x(F.col(f"lon{k}")) for k in (1, 2)} | {f"y{k}": geo.mercator_y(F.col(f"lat{k}")) for k in (1, 2)})
