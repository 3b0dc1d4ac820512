"""Crossings of lines and visits to polygons, with interpolated times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..schema import micros, require
from . import spatial

VESSEL = ["MMSI", "trip_id", "VesselType", "VesselGroup", "Length", "Width", "Draft"]


def _point(x: str, y: str):
    return F.struct(geo.mercator_lon(F.col(x)).alias("x"), geo.mercator_lat(F.col(y)).alias("y"))


def _moment(share: str):
    begin, end = micros("segment_start_time"), micros("segment_end_time")
    return F.timestamp_add("MICROSECOND", begin + F.round(F.col(share) * (end - begin)).cast("long"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def line_crossings(segments: DataFrame, lines: DataFrame, id_col: str = "PassageId", **options) -> DataFrame:
    """One row for each segment and line that meet: the vessel columns, sog, speed_mps, the line's id, direction,
    event_time and points (one, in degrees). A vertex on the line belongs to two segments, and both count."""
    require(segments, *VESSEL, "segment_start_time", "segment_end_time", "x1", "y1", "x2", "y2")
    layer = lines.select(id_col, "edges", "length", "lx", "ly", "bmin_x", "bmax_x", "bmin_y", "bmax_y")
    # the vessel's Length and the line's length differ in case only
    d = spatial.crossing_points(segments.withColumnRenamed("Length", "_Length"), layer, **options).drop("length").withColumnRenamed("_Length", "Length")
    return d.select(*VESSEL, "sog", "speed_mps", id_col, "direction", _moment("share").alias("event_time"), F.array(_point("px", "py")).alias("points"))


def transitions(segments: DataFrame, polygons: DataFrame, id_col: str = "name", **options) -> DataFrame:
    """Segments with exactly one end inside a polygon, its boundary counted in: is_entry, event_time and the point of
    the boundary (the mean of several). Segments that pass straight through give none."""
    require(segments, *VESSEL, "segment_start_time", "segment_end_time", "x1", "y1", "x2", "y2")
    layer = polygons.select(id_col, "edges", "bmin_x", "bmax_x", "bmin_y", "bmax_y")
    inside = {f"_in{k}": geo.covers(F.col("edges"), F.col(f"x{k}"), F.col(f"y{k}")) for k in (1, 2)}
    d = spatial.candidates(segments, layer, **options).withColumns(inside).where("_in1 <> _in2")
    d = d.withColumn("_h", geo.hits(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.col("edges")))
    d = d.withColumns({"px": F.when(F.size("_h") > 0, geo.mean(F.col("_h"), "x")).otherwise(F.col("x1")), "py": F.when(F.size("_h") > 0, geo.mean(F.col("_h"), "y")).otherwise(F.col("y1"))})
    d = d.withColumn("share", F.expr("coalesce(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif(pow(x2 - x1, 2) + pow(y2 - y1, 2), 0), 0e0)"))
    return d.select(*VESSEL, "segment_start_time", id_col, F.col("_in2").alias("is_entry"), _moment("share").alias("event_time"), _point("px", "py").alias("point"))


def polygon_visits(segments: DataFrame, polygons: DataFrame, id_col: str = "name", merge_gap_minutes: float | None = None, **options) -> DataFrame:
    """One row for each entry: the vessel columns, the polygon's id, entry_time, exit_time (null if no exit follows
    next) and points (one or two, in degrees). Exits without an entry before them are dropped."""
    order = Window.partitionBy(id_col, "trip_id").orderBy("segment_start_time", "event_time")
    t = transitions(segments, polygons, id_col, **options)
    after = lambda c: F.when(~F.lead("is_entry").over(order), F.lead(c).over(order))
    v = t.withColumns({"exit_time": after("event_time"), "_exit": after("point")}).where("is_entry")
    points = F.when(F.col("_exit").isNull(), F.array("point")).otherwise(F.array("point", "_exit"))
    v = v.select(*VESSEL, id_col, F.col("event_time").alias("entry_time"), "exit_time", points.alias("points"))
    return v if merge_gap_minutes is None else merge_visits(v, merge_gap_minutes, id_col)


def merge_visits(visits: DataFrame, gap_minutes: float, id_col: str = "name") -> DataFrame:
    """Visits of a vessel to a polygon that follow an exit within the gap become one: attributes and entry of the first,
    exit of the last, the first point and the last one's last."""
    order = Window.partitionBy("MMSI", id_col).orderBy("entry_time", "trip_id")
    left = F.lag(micros("exit_time")).over(order)
    new = ~F.coalesce(micros("entry_time") - left <= gap_minutes * 6e7, F.lit(False))
    v = visits.withColumn("_n", F.row_number().over(order)).withColumn("_island", F.sum(new.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    every = [c for c in visits.columns if c not in ("MMSI", id_col)]
    g = v.groupBy("MMSI", id_col, "_island").agg(F.min_by(F.struct(*every), "_n").alias("f"), F.max_by(F.struct("exit_time", "points"), "_n").alias("l"))
    last = F.when(F.col("l.exit_time").isNull(), F.slice("f.points", 1, 1)).otherwise(F.concat(F.slice("f.points", 1, 1), F.slice("l.points", -1, 1)))
    cols = {"exit_time": F.col("l.exit_time"), "points": last}
    return g.select(*(cols.get(c, F.col(c) if c in ("MMSI", id_col) else F.col(f"f.{c}")).alias(c) for c in visits.columns))
