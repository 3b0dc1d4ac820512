"""Pings made from the events table: the same expressions in Spark and in the SQL of the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.geometry import points
from ..operators import spatial, trajectory

#: Text that both engines read alike; exponents make literals doubles.
COLUMNS = """
    event_id, user_id AS mmsi, ts AS base_date_time, 4e0 + ((event_id * 7919) % 1000) / 1e4 AS longitude,
    52e0 + ((event_id * 104729) % 1000) / 1e4 AS latitude, value AS sog, CAST((event_id * 37) % 360 AS DOUBLE) AS cog,
    CAST((event_id * 53) % 360 AS DOUBLE) AS heading, CAST(30 + event_id % 60 AS STRING) AS shiptypeAIS,
    CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '5' WHEN 'error' THEN '3' WHEN 'purchase' THEN NULL ELSE '5.0' END AS status,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(50 + event_id % 200 AS DOUBLE) END AS length,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(8 + event_id % 30 AS DOUBLE) END AS beam,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 15 AS DOUBLE) END AS draught"""
GAP_HOURS = 24
TIES = ("event_id",)

# gates and polygons in degrees
GATES = {"mid": [(4.05, 51.99), (4.05, 52.11)], "east": [(4.08, 52.02), (4.08, 52.07)], "slant": [(4.01, 52.01), (4.06, 52.08)]}
BOXES = {"harbour": (4.02, 52.02, 4.06, 52.07), "roads": (4.05, 52.05, 4.09, 52.09)}


def read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*[c for c in _split(COLUMNS)])


def _split(text: str) -> list[str]:
    """The expressions of a select list: commas inside brackets do not part them."""
    out, depth, held = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(held.strip())
            held = ""
        else:
            held += ch
    return [*out, held.strip()]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.gap_trips(read(spark, sf_dir), GAP_HOURS, ties=TIES)


def moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.kinematics(trips(spark, sf_dir), distance="haversine", ties=TIES)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectory.segments(moving(spark, sf_dir), ties=TIES)


def gates(spark: SparkSession, names: tuple[str, ...] = tuple(GATES)) -> DataFrame:
    return spatial.line_layer(_rows(spark, {n: points(*GATES[n]) for n in names}, "PassageId", "path")).drop("path")


def polygons(spark: SparkSession) -> DataFrame:
    from pyspark.sql import functions as F

    ring = lambda w, s, e, n: F.array(points((w, s), (e, s), (e, n), (w, n), (w, s)))
    return spatial.polygon_layer(_rows(spark, {k: ring(*b) for k, b in BOXES.items()}, "name", "rings")).drop("rings")


def _rows(spark: SparkSession, rows: dict, id_col: str, value_col: str) -> DataFrame:
    from functools import reduce

    from pyspark.sql import functions as F

    return reduce(DataFrame.unionByName, (spark.range(1).select(F.lit(k).alias(id_col), v.alias(value_col)) for k, v in rows.items()))


# --- the same in SQL -----------------------------------------------------------------------------------------------

MX, MY = "6378137e0 * radians({})", "6378137e0 * ln(tan(pi() / 4 + radians({}) / 2))"


def haversine(x1: str, y1: str, x2: str, y2: str) -> str:
    a = f"pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) * cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2)"
    return f"2 * 6371008.8e0 * asin(least(1e0, sqrt({a})))"


def geodesic_sql(name: str, source: str, keep: str, x1: str, y1: str, x2: str, y2: str, rounds: int = 6) -> str:
    """CTEs that end in `name`: the columns `keep` of source with far and azimuth on the WGS84 ellipsoid, by Vincenty's
    method with a fixed number of rounds, enough for places a few degrees apart. Null in, null out."""
    f, a, b = "(1e0 / 298.257223563e0)", "6378137e0", "(6378137e0 * (1 - 1e0 / 298.257223563e0))"
    half = lambda y: f"atan((1 - {f}) * tan(radians({y})))"
    out = f"""{name}_0 AS (SELECT {keep}, radians({x2}) - radians({x1}) AS _d, radians({x2}) - radians({x1}) AS _l, sin({half(y1)}) AS _s1, cos({half(y1)}) AS _c1, sin({half(y2)}) AS _s2, cos({half(y2)}) AS _c2 FROM {source})"""
    angles = f"""sqrt(pow(_c2 * sin(_l), 2) + pow(_c1 * _s2 - _s1 * _c2 * cos(_l), 2)) AS _ss, _s1 * _s2 + _c1 * _c2 * cos(_l) AS _cs, atan2(_ss, _cs) AS _sigma,
      CASE WHEN _ss > 0 THEN _c1 * _c2 * sin(_l) / _ss ELSE 0e0 END AS _sa, 1 - _sa * _sa AS _ca, CASE WHEN _ca > 0 THEN _cs - 2 * _s1 * _s2 / _ca ELSE 0e0 END AS _cm"""
    passing = "_ss, _cs, _sigma, _sa, _ca, _cm"
    for k in range(rounds):
        out += f""",
    {name}_{k + 1} AS (SELECT * EXCLUDE ({passing}, _c) REPLACE (_d + (1 - _c) * {f} * _sa * (_sigma + _c * _ss * (_cm + _c * _cs * (2 * _cm * _cm - 1))) AS _l)
      FROM (SELECT *, {angles}, {f} / 16 * _ca * (4 + {f} * (4 - 3 * _ca)) AS _c FROM {name}_{k}))"""
    return out + f""",
    {name} AS (SELECT * EXCLUDE (_d, _l, _s1, _c1, _s2, _c2, {passing}, _u, _ka, _kb),
      {b} * _ka * (_sigma - _kb * _ss * (_cm + _kb / 4 * (_cs * (2 * _cm * _cm - 1) - _kb / 6 * _cm * (4 * _ss * _ss - 3) * (4 * _cm * _cm - 3)))) AS far, atan2(_c2 * sin(_l), _c1 * _s2 - _s1 * _c2 * cos(_l)) AS azimuth
      FROM (SELECT *, {angles}, _ca * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS _u, 1 + _u / 16384 * (4096 + _u * (_u * (320 - 175 * _u) - 768)) AS _ka, _u / 1024 * (256 + _u * (_u * (74 - 47 * _u) - 128)) AS _kb FROM {name}_{rounds}))"""


def stops_sql(window_s: int) -> str:
    """CTEs (after p) that end in areas: p with its place n, sec and rolling_area_m2, the hull area of the pings of the
    trailing window. Hulls are wrapped point by point: from the lowest point on, the next one is the first to the left."""
    plane = geodesic_sql("q1", "q0", "*", "lon0", "lat0", "longitude", "latitude")
    return f"""q0 AS (SELECT *, epoch_us(base_date_time) AS us, avg(longitude) OVER (PARTITION BY mmsi) AS lon0, avg(latitude) OVER (PARTITION BY mmsi) AS lat0,
      row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time, event_id) AS n FROM p),
    {plane},
    q AS (SELECT *, far * sin(azimuth) AS px, far * cos(azimuth) AS py FROM q1),
    near AS (SELECT DISTINCT a.event_id, b.px, b.py FROM q a JOIN q b ON a.mmsi = b.mmsi AND b.n <= a.n AND b.us >= a.us - {window_s * 1_000_000}),
    many AS (SELECT event_id FROM near GROUP BY event_id HAVING count(*) >= 3),
    pts AS (SELECT * FROM near SEMI JOIN many USING (event_id)),
    starts AS (SELECT event_id, min(struct_pack(y := py, x := px)) AS s FROM pts GROUP BY event_id),
    wrap AS (SELECT event_id, s.x AS sx, s.y AS sy, s.x AS cx, s.y AS cy, 0e0 AS dir, 0e0 AS twice, 0 AS k FROM starts
      UNION ALL SELECT w.event_id, w.sx, w.sy, w.b.x, w.b.y, w.b.dir, w.twice + (w.cx - w.sx) * (w.b.y - w.sy) - (w.b.x - w.sx) * (w.cy - w.sy), w.k + 1
        FROM (SELECT w.event_id, w.sx, w.sy, w.cx, w.cy, w.twice, w.k, min(struct_pack(turn := CASE WHEN atan2(py - cy, px - cx) - dir < 0 THEN atan2(py - cy, px - cx) - dir + 2 * pi() ELSE atan2(py - cy, px - cx) - dir END,
            back := -(pow(px - cx, 2) + pow(py - cy, 2)), x := px, y := py, dir := CASE WHEN atan2(py - cy, px - cx) < 0 THEN atan2(py - cy, px - cx) + 2 * pi() ELSE atan2(py - cy, px - cx) END)) AS b
          FROM wrap w JOIN pts USING (event_id) WHERE (px <> cx OR py <> cy) AND (w.k = 0 OR cx <> sx OR cy <> sy) AND w.k < 100 GROUP BY ALL) w),
    hulls AS (SELECT event_id, arg_max(twice, k) / 2 AS area FROM wrap GROUP BY event_id),
    areas AS (SELECT q.*, coalesce(area, 0e0) AS rolling_area_m2 FROM q LEFT JOIN hulls USING (event_id))"""


P = f"p AS (SELECT {COLUMNS} FROM events)"
T = f"""{P},
    p1 AS (SELECT *, (epoch_us(base_date_time) - lag(epoch_us(base_date_time)) OVER v) / 1e6 AS time_diff_s FROM p WINDOW v AS (PARTITION BY mmsi ORDER BY base_date_time, event_id)),
    t AS (SELECT *, mmsi || '_' || sum(CASE WHEN time_diff_s IS NULL OR time_diff_s > {GAP_HOURS * 3600} THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi ORDER BY base_date_time, event_id ROWS UNBOUNDED PRECEDING) AS trip_id FROM p1)"""
_TURN = lambda c: f"CASE WHEN dt > 0 THEN (({c} - lag({c}) OVER w + 180e0) - 360e0 * floor(({c} - lag({c}) OVER w + 180e0) / 360e0) - 180e0) / dt END"
K = f"""{T},
    k0 AS (SELECT *, (epoch_us(base_date_time) - lag(epoch_us(base_date_time)) OVER w) / 1e6 AS dt, lag(longitude) OVER w AS lon0, lag(latitude) OVER w AS lat0 FROM t
      WINDOW w AS (PARTITION BY trip_id ORDER BY base_date_time, event_id)),
    k1 AS (SELECT *, CASE WHEN dt > 0 THEN ({haversine("lon0", "lat0", "longitude", "latitude")}) / dt END AS speed_mps FROM k0),
    k AS (SELECT *, CASE WHEN dt > 0 THEN (speed_mps - lag(speed_mps) OVER w) / dt END AS acceleration_mps2, {_TURN("cog")} AS turn_rate_from_cog, {_TURN("heading")} AS turn_rate_from_heading
      FROM k1 WINDOW w AS (PARTITION BY trip_id ORDER BY base_date_time, event_id))"""


def sog(c: str = "sog", raw: bool = False) -> str:
    s = f"({c} / 10)" if raw else c
    return f"CASE WHEN {s} >= 102.3e0 THEN NULL WHEN abs({s} - 102.2e0) <= 0.05e0 + 1e-5 * 102.2e0 THEN 102.2e0 ELSE {s} END"


def group_sql(c: str, mapping: str = "NULL") -> str:
    n = f"trunc(TRY_CAST({c} AS DOUBLE))"
    fixed = f"CASE WHEN {n} = 30 THEN 'Fishing' WHEN {n} IN (31, 32, 52) THEN 'Tug' WHEN {n} = 35 THEN 'Military' WHEN {n} IN (36, 37) THEN 'Pleasure Craft/Sailing' WHEN {n} BETWEEN 60 AND 69 THEN 'Passenger' WHEN {n} BETWEEN 70 AND 79 THEN 'Cargo' WHEN {n} BETWEEN 80 AND 89 THEN 'Tanker' ELSE 'Other' END"
    return f"coalesce({mapping}, {fixed})"


S = f"""{K},
    s0 AS (SELECT mmsi AS MMSI, trip_id, shiptypeAIS AS VesselType, {group_sql("shiptypeAIS")} AS VesselGroup, length AS Length, beam AS Width, draught AS Draft, epoch_us(base_date_time) AS t1,
      lead(epoch_us(base_date_time)) OVER w AS t2, speed_mps, acceleration_mps2, {sog()} AS sog, {MX.format("longitude")} AS x1, {MY.format("latitude")} AS y1,
      lead({MX.format("longitude")}) OVER w AS x2, lead({MY.format("latitude")}) OVER w AS y2 FROM k WINDOW w AS (PARTITION BY trip_id ORDER BY base_date_time, event_id)),
    s AS (SELECT *, (t2 - t1) / 1e6 AS segment_duration_s FROM s0 WHERE t2 IS NOT NULL)"""
G = "g AS (SELECT id AS PassageId, " + ", ".join(f"{m.format(c)} AS {n}" for m, c, n in ((MX, "alon", "ax"), (MY, "alat", '"ay"'), (MX, "blon", "bx"), (MY, "blat", '"by"'))) + " FROM (VALUES " + ", ".join(f"('{k}', {a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for k, (a, b) in GATES.items()) + ") AS q(id, alon, alat, blon, blat))"


def crossing_sql(source: str, keep: str) -> str:
    """Segments of `source` against g: the side of each end decides, then the point, shares and direction."""
    cross = lambda a, b, c, d, p, q: f"(({c} - {a}) * ({q} - {b}) - ({d} - {b}) * ({p} - {a}))"
    by = '"by"'
    return f"""
    c0 AS (SELECT {keep}, x1, y1, x2, y2, PassageId, ax, ay, bx, {by}, {cross("ax", "ay", "bx", by, "x1", "y1")} AS d1, {cross("ax", "ay", "bx", by, "x2", "y2")} AS d2,
      {cross("x1", "y1", "x2", "y2", "ax", "ay")} AS d3, {cross("x1", "y1", "x2", "y2", "bx", by)} AS d4 FROM {source} JOIN g ON
      greatest(x1, x2) >= least(ax, bx) AND greatest(ax, bx) >= least(x1, x2) AND greatest(y1, y2) >= least(ay, {by}) AND greatest(ay, {by}) >= least(y1, y2)),
    c1 AS (SELECT *, coalesce(d1 / nullif(d1 - d2, 0), 0) AS u FROM c0 WHERE sign(d1) * sign(d2) <= 0 AND sign(d3) * sign(d4) <= 0),
    c2 AS (SELECT *, x1 + u * (x2 - x1) AS px, y1 + u * (y2 - y1) AS py FROM c1),
    c AS (SELECT *, coalesce(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif(pow(x2 - x1, 2) + pow(y2 - y1, 2), 0), 0) AS share,
      least(1e0, greatest(0e0, ((px - ax) * (bx - ax) + (py - ay) * ({by} - ay)) / (pow(bx - ax, 2) + pow({by} - ay, 2)))) AS loc_fraction,
      CASE WHEN (x2 - x1) * (-({by} - ay)) + (y2 - y1) * (bx - ax) >= 0 THEN 'down' ELSE 'up' END AS direction FROM c2)"""
