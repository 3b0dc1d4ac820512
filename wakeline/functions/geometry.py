"""Planar geometry as Column expressions: Web Mercator, orientation, crossings of segments with polylines and polygons.

A polyline or ring is array<struct<x double, y double>>; edges are array<struct<ax, ay, bx, by, at>>, where at is the
length before the edge.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Radius of the Web Mercator sphere and of great circles, metres.
MERCATOR_R = 6378137.0
EARTH_R = 6371008.8


def mercator_x(lon: Column) -> Column:
    return F.lit(MERCATOR_R) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(MERCATOR_R) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / MERCATOR_R)


def mercator_lat(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / MERCATOR_R)) - math.pi / 2)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_R * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Positive if p lies left of a -> b, 0 on the line."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def edges(path: Column) -> Column:
    """Edges of a polyline with the length before each."""
    pairs = F.zip_with(F.slice(path, F.lit(1), F.size(path) - 1), F.slice(path, F.lit(2), F.size(path) - 1), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    size = lambda e: F.sqrt(F.pow(e["bx"] - e["ax"], 2) + F.pow(e["by"] - e["ay"], 2))
    return F.transform(
        pairs,
        lambda e, i: F.struct(
            e["ax"].alias("ax"), e["ay"].alias("ay"), e["bx"].alias("bx"), e["by"].alias("by"),
            F.aggregate(F.slice(pairs, F.lit(1), i), F.lit(0.0), lambda s, x: s + size(x)).alias("at"),
        ),
    )


def path_length(path_edges: Column) -> Column:
    last = F.element_at(path_edges, -1)
    return last["at"] + F.sqrt(F.pow(last["bx"] - last["ax"], 2) + F.pow(last["by"] - last["ay"], 2))


def hit(x1: Column, y1: Column, x2: Column, y2: Column, e: Column) -> Column:
    """struct<x, y, at> where segment 1 -> 2 meets edge e, or null: touching counts, an overlap gives its middle, and a
    segment of length 0 is a point. at is the length along the path."""
    ax, ay, bx, by = e["ax"], e["ay"], e["bx"], e["by"]
    d1, d2 = cross(ax, ay, bx, by, x1, y1), cross(ax, ay, bx, by, x2, y2)
    d3, d4 = cross(x1, y1, x2, y2, ax, ay), cross(x1, y1, x2, y2, bx, by)
    near = (F.greatest(x1, x2) >= F.least(ax, bx)) & (F.greatest(ax, bx) >= F.least(x1, x2)) & (F.greatest(y1, y2) >= F.least(ay, by)) & (F.greatest(ay, by) >= F.least(y1, y2))
    meets = near & (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0)
    n2 = F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2)
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    along = lambda px, py: clip(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / F.nullif(n2, F.lit(0.0)))
    t = F.coalesce(F.when(d1 == d2, (along(ax, ay) + along(bx, by)) / 2).otherwise(d1 / F.nullif(d1 - d2, F.lit(0.0))), F.lit(0.0))
    x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
    m2 = F.pow(bx - ax, 2) + F.pow(by - ay, 2)
    s = F.coalesce(clip(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / F.nullif(m2, F.lit(0.0))), F.lit(0.0))
    return F.when(meets, F.struct(x.alias("x"), y.alias("y"), (e["at"] + s * F.sqrt(m2)).alias("at")))


def hits(x1: Column, y1: Column, x2: Column, y2: Column, path_edges: Column) -> Column:
    """The meetings of a segment with all edges of a path or of rings."""
    return F.filter(F.transform(path_edges, lambda e: hit(x1, y1, x2, y2, e)), lambda h: h.isNotNull())


def mean(points: Column, field: str) -> Column:
    return F.aggregate(points, F.lit(0.0), lambda s, h: s + h[field]) / F.size(points)


def locate(px: Column, py: Column, path_edges: Column) -> Column:
    """The share of a path's length up to its point nearest to p; 0 on a path of length 0."""

    def near(e: Column) -> Column:
        m2 = F.pow(e["bx"] - e["ax"], 2) + F.pow(e["by"] - e["ay"], 2)
        s = F.coalesce(F.least(F.greatest(((px - e["ax"]) * (e["bx"] - e["ax"]) + (py - e["ay"]) * (e["by"] - e["ay"])) / F.nullif(m2, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
        d = F.pow(e["ax"] + s * (e["bx"] - e["ax"]) - px, 2) + F.pow(e["ay"] + s * (e["by"] - e["ay"]) - py, 2)
        return F.struct(d.alias("d"), (e["at"] + s * F.sqrt(m2)).alias("at"))

    return F.coalesce(F.array_min(F.transform(path_edges, near))["at"] / F.nullif(path_length(path_edges), F.lit(0.0)), F.lit(0.0))


def interpolate(path_edges: Column, share: Column) -> Column:
    """struct<x, y> at a share of a path's length."""
    want = share * path_length(path_edges)
    e = F.element_at(F.filter(path_edges, lambda e: (e["at"] <= want) | (e["at"] == 0)), -1)
    size = F.sqrt(F.pow(e["bx"] - e["ax"], 2) + F.pow(e["by"] - e["ay"], 2))
    s = F.coalesce((want - e["at"]) / F.nullif(size, F.lit(0.0)), F.lit(0.0))
    return F.struct((e["ax"] + s * (e["bx"] - e["ax"])).alias("x"), (e["ay"] + s * (e["by"] - e["ay"])).alias("y"))


def covers(ring_edges: Column, px: Column, py: Column) -> Column:
    """Whether rings (outer ones and holes alike, even-odd) cover p; their boundary counts as covered."""
    on = F.exists(
        ring_edges,
        lambda e: (cross(e["ax"], e["ay"], e["bx"], e["by"], px, py) == 0)
        & px.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & py.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])),
    )
    passes = lambda e: F.coalesce(((e["ay"] > py) != (e["by"] > py)) & (px < (e["bx"] - e["ax"]) * (py - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]), F.lit(False))
    return on | (F.size(F.filter(ring_edges, passes)) % 2 == 1)


def points(*xy: tuple[float, float]) -> Column:
    """A path of literal points."""
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in xy))
