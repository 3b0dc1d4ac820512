"""Statistics of passages through gates, from raw pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.vessel import interpolated_speed
from ..schema import micros, require, time_column
from . import spatial

BINS = 20
DIRECTIONS = ("up", "down")


def _edges(n: int) -> list[float]:
    step = 1.0 / n
    return [k * step for k in range(n)] + [1.0]


def lateral_bin(share: Column, n: int = BINS) -> Column:
    """0 to n - 1: left-closed bins between the literal edges k * (1 / n); the ends belong to the outer bins."""
    f = F.least(F.greatest(share, F.lit(0.0)), F.lit(1 - 1e-9))
    return sum(((f >= F.lit(e)).cast("int") for e in _edges(n)[1:-1]), F.lit(0))


def ping_pairs(pings: DataFrame, max_gap_s: float = 7200.0, track: str | None = None, time: str | None = None, lon: str = "longitude", lat: str = "latitude", ties: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive pings of a track at most max_gap_s apart, with s0, s1 (speeds) and Web Mercator x1, y1, x2, y2."""
    track, time = track or ("track_id" if "track_id" in pings.columns else "mmsi"), time_column(pings, time)
    require(pings, track, lon, lat, "sog")
    extra = [c for c in dict.fromkeys(ties) if c != "sog"]
    p = pings.select(F.col(track).alias("track"), micros(time).alias("t"), F.col("sog").alias("s0"), geo.mercator_x(F.col(lon)).alias("x1"), geo.mercator_y(F.col(lat)).alias("y1"), *extra)
    order = Window.partitionBy("track").orderBy("t", *extra)
    p = p.withColumns({"t2": F.lead("t").over(order), "s1": F.lead("s0").over(order), "x2": F.lead("x1").over(order), "y2": F.lead("y1").over(order)})
    return p.where(F.col("t2") - F.col("t") <= max_gap_s * 1_000_000).select("track", "t", "t2", "s0", "s1", "x1", "y1", "x2", "y2")


def gate_crossings(pings: DataFrame, gates: DataFrame, id_col: str = "PassageId", max_gap_s: float = 7200.0, **options) -> DataFrame:
    """id, speed (knots, interpolated at the gate, null if both ends are unknown), loc_fraction, direction."""
    layer = gates.select(id_col, "edges", "length", "lx", "ly", "bmin_x", "bmax_x", "bmin_y", "bmax_y")
    d = spatial.crossing_points(ping_pairs(pings, max_gap_s, **options), layer)
    return d.select(id_col, interpolated_speed(F.col("s0"), F.col("s1"), F.col("share")).alias("speed"), "loc_fraction", "direction")


def overall(crossings: DataFrame, id_col: str = "PassageId") -> DataFrame:
    """frequency_up, frequency_down (crossings with a known speed) and median_speed_up, median_speed_down of each gate."""
    g = crossings.groupBy(id_col)
    return g.agg(
        *(F.count(F.when(F.col("direction") == d, F.col("speed"))).cast("int").alias(f"frequency_{d}") for d in DIRECTIONS),
        *(F.coalesce(F.median(F.when(F.col("direction") == d, F.col("speed"))), F.lit(0.0)).alias(f"median_speed_{d}") for d in DIRECTIONS),
    )


def bin_stats(crossings: DataFrame, id_col: str = "PassageId", n: int = BINS) -> DataFrame:
    """Long form: gate, direction, bin, frequency, median_speed, for the bins with crossings."""
    b = crossings.withColumn("bin", lateral_bin(F.col("loc_fraction"), n))
    return b.groupBy(id_col, "direction", "bin").agg(F.count("speed").cast("int").alias("frequency"), F.median("speed").alias("median_speed"))


def bin_pivot(crossings: DataFrame, id_col: str = "PassageId", n: int = BINS) -> DataFrame:
    """loc_bin_{i}_{direction} and median_speed_loc_{i}_{direction}, all of them, 0 where there is none."""
    keys = [f"{i}_{d}" for d in DIRECTIONS for i in range(n)]
    b = bin_stats(crossings, id_col, n).withColumn("key", F.concat_ws("_", "bin", "direction"))
    p = b.groupBy(id_col).pivot("key", keys).agg(F.first("frequency").alias("f"), F.first("median_speed").alias("m"))
    return p.select(id_col, *(F.coalesce(f"{k}_f", F.lit(0)).alias(f"loc_bin_{k}") for k in keys), *(F.coalesce(f"{k}_m", F.lit(0.0)).alias(f"median_speed_loc_{k}") for k in keys))


def gate_statistics(pings: DataFrame, gates: DataFrame, id_col: str = "PassageId", max_gap_s: float = 7200.0, n: int = BINS, **options) -> DataFrame:
    """The columns of gates that have crossings, with overall() and bin_pivot(): one pass over the pings."""
    c = gate_crossings(pings, gates, id_col, max_gap_s, **options)
    own = [x for x in gates.columns if x not in ("edges", "length", "lx", "ly", "bmin_x", "bmax_x", "bmin_y", "bmax_y")]
    b = c.withColumn("bin", lateral_bin(F.col("loc_fraction"), n))
    # medians by gate, direction and bin, and by gate and direction, in one shuffle; then at most 2 * (n + 1) rows a gate
    sets = b.groupingSets([[id_col, "direction", "bin"], [id_col, "direction"]], id_col, "direction", "bin")
    g = sets.agg(F.count("speed").cast("int").alias("f"), F.median("speed").alias("m"), F.grouping("bin").alias("whole"))
    key = F.when(F.col("whole") == 1, F.col("direction")).otherwise(F.concat(F.col("bin").cast("string"), F.lit("_"), F.col("direction")))
    names = [(d, f"frequency_{d}", f"median_speed_{d}") for d in DIRECTIONS] + [(f"{i}_{d}", f"loc_bin_{i}_{d}", f"median_speed_loc_{i}_{d}") for d in DIRECTIONS for i in range(n)]
    pick = lambda k, c, empty, name: F.coalesce(F.max(F.when(F.col("key") == k, F.col(c))), F.lit(empty)).alias(name)
    counts = [pick(k, "f", 0, f) for k, f, _ in names[:2]] + [pick(k, "m", 0.0, m) for k, _, m in names[:2]]
    bins = [x for k, f, m in names[2:] for x in (pick(k, "f", 0, f), pick(k, "m", 0.0, m))]
    return gates.select(*own).join(g.withColumn("key", key).groupBy(id_col).agg(*counts, *bins), id_col)


def unpivot_bins(stats: DataFrame, gates: DataFrame | None = None, id_col: str = "PassageId", n: int = BINS) -> DataFrame:
    """Long form of the wide bin columns, for bins with crossings: id, BinIndex, Direction, Frequency, MedianSpeed, and
    with gates (line_layer) ProfileLength, BinWidth and line, the bin's part of the gate."""
    args = ", ".join(f"{i}, '{d}', loc_bin_{i}_{d}, median_speed_loc_{i}_{d}" for d in DIRECTIONS for i in range(n))
    long = stats.select(id_col, F.expr(f"stack({n * len(DIRECTIONS)}, {args}) AS (BinIndex, Direction, Frequency, MedianSpeed)")).where("Frequency > 0")
    if gates is None:
        return long
    at = lambda k: geo.interpolate(F.col("edges"), (F.col("BinIndex") + k) / F.lit(float(n)))
    degrees = lambda p: F.struct(geo.mercator_lon(p["x"]).alias("x"), geo.mercator_lat(p["y"]).alias("y"))
    d = long.join(gates.select(id_col, "edges", F.col("length").alias("ProfileLength")), id_col)
    return d.withColumn("BinWidth", F.col("ProfileLength") / n).withColumn("line", F.array(degrees(at(0)), degrees(at(1)))).drop("edges")


def trip_flags(lines: DataFrame, gates: DataFrame, id_col: str = "PassageId", zones: dict[str, list] | None = None) -> DataFrame:
    """trip_id and passes: for each trip line (trip_id, line in degrees) the sorted ids of the gates it meets; zones map
    a name to ids whose meetings count together, as columns of 0 and 1."""
    parts = lines.select("trip_id", F.posexplode(F.transform("line", lambda p: F.struct(geo.mercator_x(p["x"]).alias("x"), geo.mercator_y(p["y"]).alias("y")))).alias("k", "p"))
    order = Window.partitionBy("trip_id").orderBy("k")
    segs = parts.select("trip_id", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.lead("p.x").over(order).alias("x2"), F.lead("p.y").over(order).alias("y2")).where("x2 IS NOT NULL")
    layer = gates.select(id_col, "edges", "bmin_x", "bmax_x", "bmin_y", "bmax_y")
    met = spatial.candidates(segs, layer).where(F.size(geo.hits(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.col("edges"))) > 0)
    flags = met.groupBy("trip_id").agg(F.sort_array(F.collect_set(id_col)).alias("passes"))
    d = lines.select("trip_id").join(flags, "trip_id", "left").withColumn("passes", F.coalesce("passes", F.array().cast(flags.schema["passes"].dataType)))
    return d.withColumns({z: F.arrays_overlap("passes", F.array(*(F.lit(i) for i in ids))).cast("int") for z, ids in (zones or {}).items()})


def propagate_flags(points: DataFrame, flags: DataFrame, columns: list[str]) -> DataFrame:
    """Points with the flags of their trip; 0 for trips without."""
    d = points.join(flags.select("trip_id", *columns), "trip_id", "left")
    return d.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns})
