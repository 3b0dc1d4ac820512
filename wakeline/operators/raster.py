"""Density rasters of segments as sparse rows (z, tile_x, tile_y, band, px, py, value), and their pyramid.

Lines are drawn in global pixel space, so tiles fit together without borders or clipping; empty tiles have no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tiles

COUNT = "transit_count"
SEPARATOR = "__"


def canonical(df: DataFrame) -> DataFrame:
    """Segments drawn upwards, level ones to the right, so that both directions give the same pixels."""
    swap = F.expr("y2 < y1 OR (y2 = y1 AND x2 < x1)")
    return df.withColumns({a: F.when(swap, F.col(b)).otherwise(F.col(a)) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))})


def clip_box(df: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Segments clipped to a box in their own units (Liang and Barsky); those outside are dropped."""
    d = df.withColumns({"_dx": F.expr("x2 - x1"), "_dy": F.expr("y2 - y1")})
    lows, highs, ok = [F.lit(0.0)], [F.lit(1.0)], F.lit(True)
    for delta, at, lo, hi in (("_dx", "x1", west, east), ("_dy", "y1", south, north)):
        t0, t1 = (F.lit(lo) - F.col(at)) / F.nullif(F.col(delta), F.lit(0.0)), (F.lit(hi) - F.col(at)) / F.nullif(F.col(delta), F.lit(0.0))
        lows.append(F.coalesce(F.least(t0, t1), F.lit(0.0)))
        highs.append(F.coalesce(F.greatest(t0, t1), F.lit(1.0)))
        ok = ok & ((F.col(delta) != 0) | F.col(at).between(lo, hi))
    d = d.withColumns({"_t0": F.greatest(*lows), "_t1": F.least(*highs)}).where(ok & (F.col("_t0") < F.col("_t1")))
    new = {"x2": "x1 + _t1 * _dx", "y2": "y1 + _t1 * _dy", "x1": "x1 + _t0 * _dx", "y1": "y1 + _t0 * _dy"}
    return d.withColumns({k: F.expr(v) for k, v in new.items()}).drop("_dx", "_dy", "_t0", "_t1")


def _to_pixels(df: DataFrame, zoom: int, size: int) -> DataFrame:
    d = canonical(df)
    new = {f"{k}{n}": getattr(tiles, f"pixel_{k}")(F.col(f"{k}{n}"), zoom, size) for n in (1, 2) for k in ("x", "y")}
    return d.withColumns(new)


def draw(pixels: DataFrame, width: float = 0.0) -> DataFrame:
    """Each segment (x1, y1, x2, y2 in pixels, centres at whole numbers) as rows gx, gy, coverage.

    Width 0: one pixel for each step of the longer axis, coverage 1. Else antialiased: a pixel whose centre lies d from
    the line has coverage w * max(0, 1 - d) for widths up to 1, and min(1, max(0, (w + 1) / 2 - d)) beyond; ends are
    round. Every pixel of a segment occurs once.
    """
    d = pixels.withColumns({"_dx": F.expr("x2 - x1"), "_dy": F.expr("y2 - y1")}).withColumn("_steep", F.expr("abs(_dy) > abs(_dx)"))
    if width <= 0:
        d = d.withColumn("_n", F.expr("cast(greatest(abs(floor(x2 + 0.5e0) - floor(x1 + 0.5e0)), abs(floor(y2 + 0.5e0) - floor(y1 + 0.5e0))) AS int)"))
        d = d.withColumn("_k", F.explode(F.expr("sequence(0, _n)")))
        at = lambda v: F.expr(f"cast(floor(CASE WHEN _n = 0 THEN {v}1 ELSE {v}1 + _d{v} * _k / _n END + 0.5e0) AS bigint)")
        return d.withColumns({"gx": at("x"), "gy": at("y"), "coverage": F.lit(1.0)}).drop("_dx", "_dy", "_steep", "_n", "_k")
    reach = width / 2 + 0.5 if width > 1 else 1.0
    r = f"{reach * 1.4143 + 1:.6f}e0"
    # along the longer axis, and across it as far as coverage reaches
    d = d.withColumns({"_a0": F.expr(f"CASE WHEN _steep THEN least(y1, y2) ELSE least(x1, x2) END - {reach!r}D"), "_a1": F.expr(f"CASE WHEN _steep THEN greatest(y1, y2) ELSE greatest(x1, x2) END + {reach!r}D")})
    d = d.withColumn("_k", F.explode(F.expr("sequence(cast(ceil(_a0) AS bigint), cast(floor(_a1) AS bigint))")))
    share = "CASE WHEN _steep THEN (_k - y1) / nullif(_dy, 0) ELSE (_k - x1) / nullif(_dx, 0) END"
    d = d.withColumn("_m", F.expr(f"CASE WHEN _steep THEN x1 + coalesce(least(1e0, greatest(0e0, {share})), 0e0) * _dx ELSE y1 + coalesce(least(1e0, greatest(0e0, {share})), 0e0) * _dy END"))
    d = d.withColumn("_j", F.explode(F.expr(f"sequence(cast(ceil(_m - {r}) AS bigint), cast(floor(_m + {r}) AS bigint))")))
    d = d.withColumns({"gx": F.expr("CASE WHEN _steep THEN _j ELSE _k END"), "gy": F.expr("CASE WHEN _steep THEN _k ELSE _j END")})
    t = "coalesce(least(1e0, greatest(0e0, ((gx - x1) * _dx + (gy - y1) * _dy) / nullif(_dx * _dx + _dy * _dy, 0))), 0e0)"
    d = d.withColumn("_t", F.expr(t)).withColumn("_d", F.expr("sqrt(pow(gx - x1 - _t * _dx, 2) + pow(gy - y1 - _t * _dy, 2))"))
    coverage = F.expr(f"{width!r}D * greatest(0e0, 1 - _d)" if width <= 1 else f"least(1e0, greatest(0e0, {(width + 1) / 2!r}D - _d))")
    return d.withColumn("coverage", coverage).where("coverage > 0").drop("_dx", "_dy", "_steep", "_a0", "_a1", "_k", "_m", "_j", "_t", "_d")


def render(segments: DataFrame, zoom: int, size: int = 1024, width: float = 0.0, bands: tuple[str, ...] = (COUNT,), category: str | None = None, value: tuple[str, str] | None = None, done: DataFrame | None = None) -> DataFrame:
    """(z, tile_x, tile_y, band, px, py, value) of Web Mercator segments.

    Bands: transit_count (sum of coverage), and sog or speed_mps (mean weighted by coverage, null values left out); with
    a category a band for each of its values as well, named band__value, slashes as dashes. value = (column, "mean" or
    "max") gives a band of that name instead. Tiles in `done` (z, tile_x, tile_y) are left out, to resume a run.
    """
    columns = {"sog": "sog", "speed_mps": "speed_mps"}
    if value and value[1] not in ("mean", "max"):
        raise ValueError("the aggregation of a value is mean or max")
    if unknown := [b for b in bands if b != COUNT and b not in columns]:
        raise ValueError(f"unknown bands {unknown}")
    need = [value[0]] if value else [columns[b] for b in bands if b != COUNT]
    s = segments.select("x1", "y1", "x2", "y2", *dict.fromkeys([*need, *([category] if category else [])]))
    # pixel centres lie at halves of global pixel space
    p = _to_pixels(s, zoom, size).withColumns({c: F.col(c) - 0.5 for c in ("x1", "y1", "x2", "y2")})
    d = draw(p, width).withColumns({"tile_x": F.expr(f"gx div {size}"), "tile_y": F.expr(f"gy div {size}"), "px": F.expr(f"pmod(gx, {size})"), "py": F.expr(f"pmod(gy, {size})")})
    if done is not None:
        d = d.join(done.where(F.col("z") == zoom).select("tile_x", "tile_y").distinct(), ["tile_x", "tile_y"], "left_anti")
    keys = ["tile_x", "tile_y", "px", "py"]

    def mean(c: str) -> Column:
        known = F.col(c).isNotNull() & ~F.isnan(c)
        return F.sum(F.when(known, F.col(c) * F.col("coverage"))) / F.sum(F.when(known, F.col("coverage")))

    if value:
        aggs = {value[0]: mean(value[0]) if value[1] == "mean" else F.max(value[0])}
    else:
        aggs = {b: F.sum("coverage") if b == COUNT else mean(columns[b]) for b in bands}
    if category:
        d = d.withColumn("_cat", F.regexp_replace(F.col(category), "/", "-")).where("_cat IS NOT NULL")
        keys.append("_cat")
    g = d.groupBy(*keys).agg(*(a.cast("double").alias(f"_{b}") for b, a in aggs.items()))
    long = g.select(*keys, F.expr(f"stack({len(aggs)}, " + ", ".join(f"'{b}', `_{b}`" for b in aggs) + ") AS (band, value)")).where("value IS NOT NULL")
    band = F.concat_ws(SEPARATOR, "band", "_cat") if category else F.col("band")
    return long.select(F.lit(zoom).alias("z"), "tile_x", "tile_y", band.alias("band"), "px", "py", "value")


def coarsen(level: DataFrame, size: int = 1024, compat: bool = False) -> DataFrame:
    """The next lower zoom: counts add up, means are weighted by the count band of the same category, and without one
    are plain means of the four pixels, absent ones as 0. With compat, count bands not named transit_count are such
    means too."""
    metric, cat = F.split_part("band", F.lit(SEPARATOR), F.lit(1)), F.expr(f"substr(band, length(split_part(band, '{SEPARATOR}', 1)) + 1)")
    known = F.col("metric").isin("sog", "speed_mps")
    counted = (F.col("metric") == COUNT) if compat else ~known
    gx, gy = (F.expr(f"tile_{k} * {size} + p{k}") for k in ("x", "y"))
    d = level.select("z", gx.alias("gx"), gy.alias("gy"), "band", metric.alias("metric"), cat.alias("cat"), "value")
    # the weight of a pixel's mean is the count of the same pixel and category: one group per pixel, no join
    from pyspark.sql import Window

    pixel = Window.partitionBy("z", "gx", "gy", "cat")
    d = d.withColumn("w", F.max(F.when(F.col("metric") == COUNT, F.col("value"))).over(pixel)).withColumn("any_w", F.col("w").isNotNull())
    g = d.groupBy("z", F.expr("gx div 2").alias("gx"), F.expr("gy div 2").alias("gy"), "band", "metric").agg(
        F.sum("value").alias("s"), F.sum(F.col("value") * F.col("w")).alias("vw"), F.sum("w").alias("w"), F.max("any_w").alias("any_w")
    )
    new = F.when(counted, F.col("s")).when(F.col("any_w"), F.coalesce(F.col("vw") / F.nullif(F.col("w"), F.lit(0.0)), F.lit(0.0))).otherwise(F.col("s") / 4)
    return g.select((F.col("z") - 1).alias("z"), F.expr(f"gx div {size}").alias("tile_x"), F.expr(f"gy div {size}").alias("tile_y"), "band", F.expr(f"pmod(gx, {size})").alias("px"), F.expr(f"pmod(gy, {size})").alias("py"), new.alias("value"))


def pyramid(base: DataFrame, zoom: int, lowest: int = 0, size: int = 1024, write=None, compat: bool = False) -> DataFrame:
    """All levels from `zoom` down to `lowest`. write(df, z), if given, stores a level and returns it read again, so that
    each level is computed once from the one above."""
    level, out = base, base
    for z in range(zoom - 1, lowest - 1, -1):
        level = coarsen(level, size, compat)
        if write:
            level = write(level, z)
        out = out.unionByName(level)
    return out


def robust_max(level: DataFrame, share: float = 0.98, exact: bool = True) -> DataFrame:
    """z, band, highest: a percentile of the positive pixels, 1 where there is none."""
    positive = F.when(F.col("value") > 0, F.col("value"))
    q = F.percentile(positive, share) if exact else F.percentile_approx(positive, share, 100_000)
    return level.groupBy("z", "band").agg(F.coalesce(q, F.lit(1.0)).alias("highest"))


def normalized(level: DataFrame, highest: DataFrame, scale: str = "log") -> DataFrame:
    """level with shade from 0 to 1, by log1p or linearly; 0 stays transparent."""
    d = level.join(highest, ["z", "band"])
    v = F.log1p("value") / F.log1p("highest") if scale == "log" else F.col("value") / F.col("highest")
    return d.withColumn("shade", F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))).drop("highest")


def summed(level: DataFrame) -> DataFrame:
    """Value per pixel over all bands."""
    return level.groupBy("z", "tile_x", "tile_y", "px", "py").agg(F.sum("value").alias("value"))


def tile_stats(level: DataFrame) -> DataFrame:
    return level.groupBy("z", "tile_x", "tile_y", "band").agg(F.sum("value").alias("total"), F.max("value").alias("most"), F.count("*").alias("pixels"))


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values, for a fixed order of bands."""
    return [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).collect()]
