"""Segments against a reference layer of lines or polygons.

A layer is a DataFrame with its own columns and `edges` (see functions.geometry.edges; all rings of a polygon together).
Small layers, by their counted edges, are broadcast and meet segments by range predicates on bounding boxes; larger ones
meet them in the cells of a grid, and a pair that shares several cells is taken in one of them only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo

#: Layers of at most this many edges are broadcast: 40 bytes each, and a comparison of boxes for each pair.
MOST_BROADCAST_EDGES = 2_000


def line_layer(df: DataFrame, path: str = "path", lonlat: bool = True) -> DataFrame:
    """Adds edges in Web Mercator, length and the direction lx, ly from first to last vertex, of array<struct<x, y>>."""
    p = F.transform(path, lambda v: F.struct(geo.mercator_x(v["x"]).alias("x"), geo.mercator_y(v["y"]).alias("y"))) if lonlat else F.col(path)
    d = df.withColumn("_p", p).withColumn("edges", geo.edges(F.col("_p")))
    first, last = F.col("_p")[0], F.element_at("_p", -1)
    return _boxed(d.withColumns({"length": geo.path_length(F.col("edges")), "lx": last["x"] - first["x"], "ly": last["y"] - first["y"]}).drop("_p"))


def polygon_layer(df: DataFrame, rings: str = "rings", lonlat: bool = True) -> DataFrame:
    """Adds edges in Web Mercator of array<array<struct<x, y>>>: closed rings, outer ones and holes alike."""
    one = lambda v: F.struct(geo.mercator_x(v["x"]).alias("x"), geo.mercator_y(v["y"]).alias("y")) if lonlat else v
    return _boxed(df.withColumn("edges", F.flatten(F.transform(rings, lambda r: geo.edges(F.transform(r, one))))))


def _boxed(df: DataFrame) -> DataFrame:
    def both(k: str) -> Column:
        return F.flatten(F.transform("edges", lambda e: F.array(e[f"a{k}"], e[f"b{k}"])))

    return df.withColumns({f"b{side}_{k}": f(both(k)) for k in ("x", "y") for side, f in (("min", F.array_min), ("max", F.array_max))})


def _near() -> Column:
    return F.expr("greatest(x1, x2) >= bmin_x AND least(x1, x2) <= bmax_x AND greatest(y1, y2) >= bmin_y AND least(y1, y2) <= bmax_y")


def candidates(segments: DataFrame, layer: DataFrame, cell: float = 20_000.0, most_edges: int = MOST_BROADCAST_EDGES) -> DataFrame:
    """Pairs whose bounding boxes meet. Column names of the two must differ. Segments need x1, y1, x2, y2."""
    extent = (("bmin_x", F.min), ("bmax_x", F.max), ("bmin_y", F.min), ("bmax_y", F.max))
    n, *box = layer.agg(F.coalesce(F.sum(F.size("edges")), F.lit(0)), *(f(c) for c, f in extent)).head()
    if n <= most_edges:
        if box[0] is None:
            return segments.where("false").join(F.broadcast(layer), _near())
        # the whole layer's box first: it needs no pair, and reaches the scan where x and y are stored
        inside = (F.greatest("x1", "x2") >= box[0]) & (F.least("x1", "x2") <= box[1]) & (F.greatest("y1", "y2") >= box[2]) & (F.least("y1", "y2") <= box[3])
        return segments.where(inside).join(F.broadcast(layer), _near())
    at = lambda c: F.floor(F.expr(c) / cell)
    cells = lambda x0, x1, y0, y1: F.explode(F.flatten(F.transform(F.sequence(at(x0), at(x1)), lambda i: F.transform(F.sequence(at(y0), at(y1)), lambda j: F.struct(i.alias("cx"), j.alias("cy"))))))
    s = segments.withColumn("_c", cells("least(x1, x2)", "greatest(x1, x2)", "least(y1, y2)", "greatest(y1, y2)"))
    g = layer.withColumn("_g", cells("bmin_x", "bmax_x", "bmin_y", "bmax_y"))
    own = (F.col("_c.cx") == at("greatest(least(x1, x2), bmin_x)")) & (F.col("_c.cy") == at("greatest(least(y1, y2), bmin_y)"))
    return s.join(g, (F.col("_c") == F.col("_g")) & _near()).where(own).drop("_c", "_g")


def crossing_points(segments: DataFrame, lines: DataFrame, **options) -> DataFrame:
    """Pairs that meet, touching included, with px, py (the mean of several meetings), share (of the segment), loc_fraction
    (of the line) and direction. A vessel that moves to the left of the line's direction goes "down"."""
    xy = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    d = candidates(segments, lines, **options).withColumn("_h", geo.hits(*xy, F.col("edges"))).where("size(_h) > 0")
    d = d.withColumns({"px": geo.mean(F.col("_h"), "x"), "py": geo.mean(F.col("_h"), "y")})
    n2 = "(pow(x2 - x1, 2) + pow(y2 - y1, 2))"
    d = d.withColumn("share", F.expr(f"coalesce(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif({n2}, 0), 0e0)"))
    where = F.when(F.size("_h") == 1, F.coalesce(F.col("_h")[0]["at"] / F.nullif(F.col("length"), F.lit(0.0)), F.lit(0.0))).otherwise(geo.locate(F.col("px"), F.col("py"), F.col("edges")))
    left = F.expr("(x2 - x1) * (-ly) + (y2 - y1) * lx")
    return d.withColumns({"loc_fraction": where, "direction": F.when(left >= 0, "down").otherwise("up")}).drop("_h")
