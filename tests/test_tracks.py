from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.functions import geodesic, hull
from wakeline.operators import clean, events, gates, outliers, spatial, trajectory
from wakeline.plans import pings

NOON = datetime(2025, 1, 1, 12)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def track(spark, rows, extra=""):
    return frame(spark, rows, "mmsi long, base_date_time timestamp_ntz, longitude double, latitude double" + extra)


def test_kinematics(spark):
    rows = [(1, NOON + timedelta(seconds=10 * k), 0.0, 0.001 * k, c, h) for k, (c, h) in enumerate([(10.0, 0.0), (20.0, 350.0), (350.0, 10.0)])]
    t = trajectory.kinematics(trajectory.gap_trips(track(spark, rows, ", cog double, heading double"))).orderBy("base_date_time").collect()
    assert t[0].speed_mps is None and t[0].acceleration_mps2 is None and t[1].acceleration_mps2 is None
    assert 11 < t[1].speed_mps < 12 and abs(t[2].acceleration_mps2) < 1e-4
    assert t[1].turn_rate_from_cog == pytest.approx(1.0) and t[2].turn_rate_from_cog == pytest.approx(-3.0)
    assert t[2].turn_rate_from_heading == pytest.approx(2.0)


def test_no_time_no_speed(spark):
    rows = [(1, NOON, 0.0, 0.0), (1, NOON, 0.0, 0.1)]
    t = trajectory.kinematics(trajectory.gap_trips(track(spark, rows), ties=("latitude",)), ties=("latitude",)).collect()
    assert [r.speed_mps for r in t] == [None, None] and {r.turn_rate_from_cog for r in t} == {None}


def test_hull():
    assert hull.area([(0, 0), (1, 1)]) == 0
    assert hull.area([(0, 0), (1, 1), (2, 2), (3, 3)]) == 0
    assert hull.area([(0, 0), (4, 0), (0, 3), (1, 1)]) == 6


def test_trailing_window_leaves_later_ties_out():
    t = np.array([0.0, 10, 10, 20])
    x, y = np.array([0.0, 1, 0, 1]), np.array([0.0, 0, 1, 1])
    assert hull.trailing_areas(t, x, y, 10).tolist() == [0, 0, 0.5, 0.5]


@pytest.mark.parametrize(("n", "step", "window"), [(400, 1.0, 60.0), (400, 1.0, 23.5), (300, 5.0, 1000.0), (50, 1.0, 1e9), (3, 1.0, 10.0)])
def test_long_windows(n, step, window):
    """Areas of windows of any length are those of their points."""
    rng = np.random.default_rng(n)
    t = np.cumsum(rng.choice([0.0, step, step, 40 * step], n))
    x, y = np.cumsum(rng.normal(0, 5, n)), np.round(np.cumsum(rng.normal(0, 5, n)))
    first = np.searchsorted(t, t - window, "left")
    want = [hull.area(list(zip(x[first[i] : i + 1].tolist(), y[first[i] : i + 1].tolist(), strict=True))) for i in range(n)]
    assert hull.trailing_areas(t, x, y, window) == pytest.approx(want, rel=1e-9, abs=1e-6)


def brute_trips(rows, gap_s, window_s, radius):
    """trip number, area and speed of each (second, lon, lat) of one vessel, straight from the rules."""
    rows, out, n, before = sorted(rows), [], 0, False
    s, lon, lat = (np.array(c, float) for c in zip(*rows, strict=True))
    x, y = geodesic.local_plane(lon, lat, lon.mean(), lat.mean())
    for i in range(len(rows)):
        j = [k for k in range(i + 1) if s[k] >= s[i] - window_s]
        a = hull.area([(x[k], y[k]) for k in j])
        stopped = a < np.pi * radius**2
        n += i == 0 or s[i] - s[i - 1] > gap_s or (before and not stopped)
        same = i and out[-1][0] == n
        d = geodesic.inverse(*(np.array([v]) for v in (lon[i - 1], lat[i - 1], lon[i], lat[i])))[0][0] if same else None
        out.append((n, a, d / (s[i] - s[i - 1]) if same and s[i] > s[i - 1] else None))
        before = stopped
    return out


def test_trips_against_the_rules(spark):
    rng, rows, want = np.random.default_rng(3), [], {}
    for vessel in range(5):
        s = np.cumsum(rng.choice([60, 120, 600, 5000], 80, p=[0.5, 0.3, 0.15, 0.05]))
        step = np.repeat(rng.choice([0.0, 0.00001, 0.002], 8), 10)
        lon, lat = 4 + np.cumsum(rng.normal(0, 1, 80) * step), 52 + np.cumsum(rng.normal(0, 1, 80) * step)
        own = list(zip(s.tolist(), lon.tolist(), lat.tolist(), strict=True))
        rows += [(vessel, NOON + timedelta(seconds=t), a, b) for t, a, b in own]
        want |= {(vessel, NOON + timedelta(seconds=t)): r for (t, _, _), r in zip(own, brute_trips(own, 3600, 1200, 50.0), strict=True)}
    got = trajectory.trajectorize(track(spark, rows)).collect()
    assert len(got) == len(want) and len({n for n, *_ in want.values()}) > 4
    for r in got:
        n, a, v = want[r.mmsi, r.base_date_time]
        assert r.trip_id == f"{r.mmsi}_{n}" and r.rolling_area_m2 == pytest.approx(a, rel=1e-6, abs=1e-3)
        assert r.speed_mps is None if v is None else r.speed_mps == pytest.approx(v, rel=1e-9, abs=1e-6)


def test_geodesic_known_values():
    # Flinders Peak to Buninyong, and a degree of the equator and of a meridian
    d, az = geodesic.inverse(np.array([144.424867888]), np.array([-37.951033416]), np.array([143.926495527]), np.array([-37.652821138]))
    assert d[0] == pytest.approx(54972.271, abs=0.01) and np.degrees(az[0]) % 360 == pytest.approx(306.868158, abs=1e-4)
    d, _ = geodesic.inverse(np.array([0.0, 0, 5, 0]), np.array([0.0, 0, 5, 0]), np.array([1.0, 0, 5, 179.9]), np.array([0.0, 1, 5, 0.1]))
    assert d[0] == pytest.approx(111319.491, abs=1e-3) and d[1] == pytest.approx(110574.389, abs=1e-3) and d[2] == 0 and 1.9e7 < d[3] < 2.01e7


def test_stops_split_trips(spark):
    # vessel 1 stays, moves on and turns; vessel 2 runs straight, which has no area
    rows = [(1, NOON + timedelta(minutes=5 * k), float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (0, 0.0001), (0.0001, 0), (0.1, 0), (0.1, 0.1), (0.2, 0.3)])]
    rows += [(2, NOON + timedelta(minutes=5 * k), 0.01 * k, 0.0) for k in range(4)]
    t = trajectory.trajectorize(track(spark, rows), 0.25, 15, 2000.0).groupBy("mmsi").agg(F.countDistinct("trip_id").alias("n")).collect()
    n = {r.mmsi: r.n for r in t}
    assert n[1] > 1 and n[2] == 1


def test_gap_is_strict(spark):
    rows = [(1, NOON, 0.0, 0.0), (1, NOON + timedelta(hours=1), 0.0, 0.0), (1, NOON + timedelta(hours=2, microseconds=1), 0.0, 0.0), (None, NOON, 0.0, 0.0)]
    t = trajectory.gap_trips(track(spark, rows), 1.0).orderBy("base_date_time").collect()
    assert [r.trip_id for r in t] == ["1_1", "1_1", "1_2"]


def test_outliers_modes(spark):
    rows = [(1, NOON + timedelta(minutes=k), x, 0.0) for k, x in enumerate([0.0, 0.001, 5.0, 0.002, 0.003])] + [(None, NOON, 50.0, 0.0), (None, NOON, 60.0, 0.0)]
    kept = lambda **o: sorted(r.longitude for r in outliers.filter_outliers(track(spark, rows), **o).collect())
    for distance in ("geodesic", "haversine"):
        assert kept(distance=distance) == [0.0, 0.001, 0.003, 50.0, 60.0]
        assert kept(distance=distance, mode="anchor") == [0.0, 0.001, 0.002, 0.003, 50.0, 60.0]


def brute_outliers(rows, mode, v_max, d_min, passes=10):
    """(second, lon, lat) rows of one vessel that survive, one link at a time."""
    rows = sorted(rows)

    def bad(p, q):
        d = geodesic.inverse(*(np.array([v]) for v in (p[1], p[2], q[1], q[2])))[0][0]
        return d > d_min and (q[0] <= p[0] or d / (q[0] - p[0]) > v_max)

    if mode == "anchor":
        kept = rows[:1]
        for q in rows[1:]:
            if not bad(kept[-1], q):
                kept.append(q)
        return kept
    for _ in range(passes):
        rows = [q for k, q in enumerate(rows) if not k or not bad(rows[k - 1], q)]
    return rows


@pytest.mark.parametrize("mode", ["iterative", "anchor"])
def test_outliers_against_one_link_at_a_time(spark, mode):
    rng, all_rows, want = np.random.default_rng(7), [], []
    for vessel in range(4):
        s = np.cumsum(rng.integers(0, 400, 300)) + np.repeat([0, 9_000_000, 18_000_000], 100)
        x, y = np.cumsum(rng.normal(0, 0.01, 300)), np.cumsum(rng.normal(0, 0.01, 300))
        x[rng.integers(0, 300, 60)] += rng.normal(0, 2, 60)
        x[40 * vessel : 40 * vessel + 30] += 5
        rows = list(zip(s.tolist(), x.tolist(), y.tolist(), strict=True))
        all_rows += [(vessel, NOON + timedelta(seconds=t), a, b) for t, a, b in rows]
        want += [(vessel, NOON + timedelta(seconds=t), a, b) for t, a, b in brute_outliers(rows, mode, 20.0, 300.0)]
    got = [tuple(r) for r in outliers.filter_outliers(track(spark, all_rows), v_max=20.0, mode=mode).collect()]
    assert sorted(got) == sorted(want) and 500 < len(got) < 1150


def test_outliers_none_and_equal_times(spark):
    rows = [(1, NOON + timedelta(minutes=k), 0.0, 0.001 * k) for k in range(5)]
    assert outliers.filter_outliers(track(spark, rows)).count() == 5
    same = [(1, NOON, 0.0, 0.0), (1, NOON, 1.0, 0.0)]
    assert outliers.filter_outliers(track(spark, same)).count() == 1


@pytest.mark.parametrize(("given", "raw", "want"), [(150.0, True, 15.0), (1023.0, True, None), (1022.0, True, 102.2), (102.3, False, None), (102.2, False, 102.2), (150.0, False, None), (46.5, False, 46.5), (102.149, False, 102.2), (102.148, False, 102.148), (float("nan"), False, None)])
def test_speeds(spark, given, raw, want):
    got = clean.clean_speeds(frame(spark, [(given,)], "sog double"), raw_units=raw).head()[0]
    assert got == (None if want is None else pytest.approx(want))


@pytest.mark.parametrize(("code", "group"), [("31", "Tug"), ("32.9", "Tug"), ("52", "Tug"), ("30", "Fishing"), ("35", "Military"), ("36", "Pleasure Craft/Sailing"), ("37", "Pleasure Craft/Sailing"), ("60", "Passenger"), ("69", "Passenger"), ("70", "Cargo"), ("79", "Cargo"), ("80", "Tanker"), ("89", "Tanker"), ("33", "Other"), ("34", "Other"), ("51", "Other"), ("53", "Other"), ("59", "Other"), ("90", "Other"), ("0", "Other"), ("", "Other"), (None, "Other"), ("pilot", "Other")])
def test_vessel_groups(spark, code, group):
    assert clean.classify(frame(spark, [(code,)], "k string"), "k", out="g").head().g == group


def test_speed_warnings(spark):
    d, seen = clean.watch_speeds(frame(spark, [(v,) for v in [1023.0] + [10.0] * 9], "sog double"), raw_units=True)
    d.collect()
    assert len(clean.speed_warnings(seen.get, raw_units=True)) == 2


def test_moored_keeps_null(spark):
    d = frame(spark, [("5",), ("0",), (None,), ("5.0",)], "status string")
    assert sorted(str(r[0]) for r in clean.exclude_moored(d).collect()) == ["0", "5.0", "None"]
    with pytest.raises(KeyError):
        clean.exclude_moored(d.withColumnRenamed("status", "s"))


GATE = {"g": [(-0.05, 0.05), (0.05, 0.05)]}


def gate(spark):
    from wakeline.functions.geometry import points

    return spatial.line_layer(spark.range(1).select(F.lit("g").alias("PassageId"), points(*GATE["g"]).alias("path"))).drop("path")


def test_gate_statistics(spark):
    rows = [("v1", NOON, 0.0, 0.0, 10.0), ("v1", NOON + timedelta(minutes=10), 0.0, 0.1, 20.0), ("v2", NOON, 0.02, 0.1, 15.0), ("v2", NOON + timedelta(minutes=10), 0.02, 0.0, 25.0)]
    p = frame(spark, rows, "track_id string, timestamp timestamp_ntz, longitude double, latitude double, sog double")
    c = {r.direction: r for r in gates.gate_crossings(p, gate(spark)).collect()}
    assert c["down"].speed == pytest.approx(15.0, abs=0.01) and c["up"].speed == pytest.approx(20.0, abs=0.01)
    assert c["down"].loc_fraction == pytest.approx(0.5)
    s = gates.gate_statistics(p, gate(spark)).head()
    assert (s.frequency_up, s.frequency_down, s.loc_bin_10_down) == (1, 1, 1) and s.median_speed_loc_10_down == pytest.approx(15.0, abs=0.01)
    assert len(s) == 1 + 4 + 80
    assert gates.unpivot_bins(gates.gate_statistics(p, gate(spark)), gate(spark)).count() == 2


def test_bins_use_literal_edges(spark):
    shares = [0.0, 0.15, 0.3, 0.35, 0.6, 0.7, 0.85, 0.95, 1.0, -1.0]
    got = [r[0] for r in frame(spark, [(s,) for s in shares], "f double").select(gates.lateral_bin(F.col("f"))).collect()]
    edges = np.linspace(0, 1, 21)
    assert got == [int(np.searchsorted(edges, min(max(s, 0), 1 - 1e-9), "right")) - 1 for s in shares]


def segment(spark, rows):
    """(trip, minutes from noon, x1, y1, x2, y2) as ten-minute segments."""
    d = frame(spark, [(int(t[0] != "A") + 1, t, NOON + timedelta(minutes=m), NOON + timedelta(minutes=m + 10), *xy) for t, m, *xy in rows], "MMSI long, trip_id string, segment_start_time timestamp_ntz, segment_end_time timestamp_ntz, lon1 double, lat1 double, lon2 double, lat2 double")
    from wakeline.functions import geometry as geo

    d = d.withColumns({f"x{k}": geo.mercator_x(F.col(f"lon{k}")) for k in (1, 2)} | {f"y{k}": geo.mercator_y(F.col(f"lat{k}")) for k in (1, 2)})
    return d.withColumns({c: F.lit(None).cast("string") for c in ("VesselType", "VesselGroup")} | {c: F.lit(None).cast("double") for c in ("Length", "Width", "Draft", "sog", "speed_mps")})


def test_line_crossing(spark):
    c = events.line_crossings(segment(spark, [("A", 0, 0.0, 0.0, 0.0, 0.1)]), gate(spark)).head()
    assert c.direction == "down" and abs((c.event_time - NOON).total_seconds() - 300) < 1
    assert c.points[0].y == pytest.approx(0.05, abs=1e-4) and len(c.points) == 1


def square(spark):
    from wakeline.functions.geometry import points

    ring = points((0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1), (0, 0))
    return spatial.polygon_layer(spark.range(1).select(F.lit("box").alias("name"), F.array(ring).alias("rings"))).drop("rings")


def test_visits(spark):
    rows = [("A", 0, -0.05, 0.05, 0.05, 0.05), ("A", 10, 0.05, 0.05, 0.06, 0.05), ("A", 20, 0.06, 0.05, 0.16, 0.05), ("B", 0, -0.05, 0.02, 0.05, 0.02), ("C", 0, -0.05, 0.03, 0.15, 0.03), ("D", 0, 0.05, 0.05, 0.15, 0.05)]
    v = {r.trip_id: r for r in events.polygon_visits(segment(spark, rows), square(spark)).collect()}
    assert v.keys() == {"A", "B"}  # C passes straight through, D only leaves
    assert abs((v["A"].entry_time - NOON).total_seconds() - 300) < 1 and abs((v["A"].exit_time - NOON).total_seconds() - 1440) < 1
    assert len(v["A"].points) == 2 and v["B"].exit_time is None and len(v["B"].points) == 1


def test_visits_merge(spark):
    hop = lambda m: [("A", m, -0.05, 0.05, 0.05, 0.05), ("A", m + 10, 0.05, 0.05, 0.15, 0.05)]
    v = events.polygon_visits(segment(spark, hop(0) + hop(14) + hop(60)), square(spark), merge_gap_minutes=10).orderBy("entry_time").collect()
    assert [round((r.exit_time - r.entry_time).total_seconds() / 60) for r in v] == [24, 10]


def test_hole_and_boundary(spark):
    from wakeline.functions import geometry as geo

    ring = lambda a, b: geo.points((a, a), (b, a), (b, b), (a, b), (a, a))
    layer = spatial.polygon_layer(spark.range(1).select(F.lit("p").alias("name"), F.array(ring(0, 4), ring(1, 3)).alias("rings")), lonlat=False)
    pts = frame(spark, [(0.5, 0.5), (2.0, 2.0), (1.0, 2.0), (4.0, 4.0), (5.0, 1.0)], "x double, y double")
    got = [r[0] for r in pts.crossJoin(layer).select(geo.covers(F.col("edges"), F.col("x"), F.col("y"))).collect()]
    assert got == [True, False, True, True, False]


def test_polyline_gate(spark):
    from wakeline.functions import geometry as geo

    layer = spatial.line_layer(spark.range(1).select(F.lit("z").alias("PassageId"), geo.points((0, 0), (0, 2), (2, 2)).alias("path")), lonlat=False)
    s = frame(spark, [(-1.0, 1.0, 1.0, 3.0), (-1.0, 1.0, 1.0, 1.0), (0.0, 0.5, 0.0, 1.5), (5.0, 5.0, 6.0, 6.0), (0.0, 1.0, 0.0, 1.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {(r.x1, r.y1, r.x2): r for r in spatial.crossing_points(s, layer.drop("path")).collect()}
    assert got.keys() == {(-1.0, 1.0, 1.0), (0.0, 0.5, 0.0), (0.0, 1.0, 0.0)} or len(got) == 3
    mid = [r for r in got.values() if (r.x1, r.y1) == (0.0, 0.5)][0]
    assert (mid.px, mid.py) == (0.0, 1.0) and mid.loc_fraction == 0.25  # an overlap gives its middle


def test_grid_join_equals_broadcast(spark, sf):
    s, layer = pings.segments(spark, sf), pings.gates(spark).drop("length")
    few = spatial.candidates(s, layer).select("trip_id", "segment_start_time", "PassageId")
    grid = spatial.candidates(s, layer, cell=500.0, most_edges=0).select("trip_id", "segment_start_time", "PassageId")
    assert few.exceptAll(grid).count() == 0 and grid.exceptAll(few).count() == 0


def test_empty_layer(spark, sf):
    assert spatial.candidates(pings.segments(spark, sf), pings.gates(spark).drop("length").where("false")).count() == 0


def test_segments(spark):
    rows = [(1, NOON + timedelta(minutes=k), 0.01 * k, 0.0, "70") for k in range(3)]
    t = trajectory.kinematics(trajectory.gap_trips(track(spark, rows, ", shiptypeAIS string")))
    s = trajectory.segments(t).orderBy("segment_start_time").collect()
    assert len(s) == 2 and s[0].VesselGroup == "Cargo" and s[0].speed_mps is None and s[1].speed_mps is not None and s[0].segment_duration_s == 60
    with pytest.raises(KeyError):
        trajectory.segments(t.drop("trip_id"))


def test_trip_lines(spark):
    rows = [(1, NOON + timedelta(seconds=75 * k), x, 0.0, ship) for k, (x, ship) in enumerate([(0.0, None), (0.0, "80"), (1.0, "70")])] + [(2, NOON, 0.0, 0.0, "30")]
    t = trajectory.trip_lines(trajectory.gap_trips(track(spark, rows, ", shiptypeAIS string"))).collect()
    assert len(t) == 1 and t[0].VesselGroup == "Tanker" and len(t[0].line) == 2 and t[0].DurationMinutes == 2  # 2.5 to even


def test_epoch(spark):
    rows = [(1, NOON + timedelta(minutes=k), 0.0, 0.0) for k in range(2)]
    t = clean.normalize_epoch(trajectory.gap_trips(track(spark, rows))).orderBy("base_date_time").collect()
    assert [r.base_date_time for r in t] == [datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 1)]


def test_hilbert_is_a_curve(spark):
    from wakeline.functions.layout import hilbert

    n = 16
    d = frame(spark, [(x, y) for x in range(n) for y in range(n)], "x long, y long").select("x", "y", hilbert(F.col("x"), F.col("y"), 4).alias("d")).orderBy("d").collect()
    assert [r.d for r in d] == list(range(n * n))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(d, d[1:], strict=False))
    assert (d[0].x, d[0].y, d[-1].x, d[-1].y) == (0, 0, n - 1, 0)


def test_sessions_stream(spark, sf, tmp_path):
    from wakeline.streaming import trips

    source = tmp_path / "in"
    pings.read(spark, sf).repartition(1).write.parquet(str(source))
    stream = spark.readStream.schema(spark.read.parquet(str(source)).schema).parquet(str(source))
    q = trips.gap_sessions(stream, 24, late="1 second").writeStream.format("memory").queryName("sessions").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT * FROM sessions")
        want = trips.gap_sessions(pings.read(spark, sf), 24)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    finally:
        q.stop()
