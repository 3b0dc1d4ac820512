import json
import sqlite3
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wakeline.functions import wkb
from wakeline.plans import pings
from wakeline.sinks import files
from wakeline.sources import archive, csv, ndjson, reference, tables

HEADER = "# Timestamp,Type of mobile,MMSI,Latitude,Longitude,Navigational status,SOG,COG,Heading,Ship type,Width,Length,Draught"
LINES = ["17/03/2024 00:00:00,Class A,244660123,51.95217,4.05081,Under way using engine,7.5,88.5,87,Cargo,14,86,4.6", "junk,Class A,244660124,91,181,,,,,,,,"]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *LINES]))
    with zipfile.ZipFile(tmp_path / "a.csv.zip", "w") as z:
        z.write(tmp_path / "a.csv", "a.csv")
    for name in ("a.csv", "a.csv.zip"):
        r = csv.read(spark, str(tmp_path / name)).orderBy("mmsi").collect()
        assert len(r) == 2 and (r[0].mmsi, r[0].longitude, r[0].latitude, r[0].cog, r[0].sog, r[0].heading) == (244660123, 4.05081, 51.95217, 88.5, 7.5, 87.0)
        assert str(r[0].base_date_time) == "2024-03-17 00:00:00" and r[1].base_date_time is None and r[1].latitude is None and r[1].longitude is None


FLAT = [
    {"id": "1", "track_id": "boat-a", "timestamp": "2025-01-01T00:00:00Z", "longitude": {"value": 4.0}, "latitude": {"value": 52.0}, "heading": {"code": "264"}, "status": {"code": "3"}, "shiptypeAIS": {"code": "70"}},
    {"track_id": "boat-b", "timestamp": "2024-06-30T23:30:00-02:00", "cog": {"code": "333.5"}, "sog": {"value": None, "code": "5"}, "heading": None},
]
NESTED = {"mmsi": "m", "track_id": "t", "timestamp": "2025-01-01T00:00:00Z", "data": {"longitude": 4, "casco": {"to_bow": 61, "to_stern": 17, "to_port": 5, "to_starboard": 7, "draught": 6}, "identification": {"name": " ZEEHOND ", "shiptypeAIS": 84}}}


def test_ndjson(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text("\n\n".join(map(json.dumps, [*FLAT, NESTED])) + "\n")
    r = {x.mmsi: x for x in ndjson.read(spark, str(tmp_path / "a.ndjson")).collect()}
    assert (r["boat-a"].heading, r["boat-a"].status, r["boat-a"].shiptypeAIS) == (264.0, "3", "70")
    assert r["boat-b"].cog == 333.5 and r["boat-b"].sog is None and r["boat-b"].heading is None and str(r["boat-b"].base_date_time) == "2024-07-01 01:30:00"
    assert (r["m"].length, r["m"].beam, r["m"].draught, r["m"].name, r["m"].shiptypeAIS) == (78.0, 12.0, 6.0, "ZEEHOND", "84")
    (tmp_path / "e.ndjson").write_text("\n")
    with pytest.raises(ValueError):
        ndjson.read(spark, str(tmp_path / "e.ndjson"))


def test_times_are_utc_in_any_zone(spark):
    texts = ["2024-03-31T02:30:00", "2024-03-31 02:30:00.25", "2024-10-27T01:30:00Z", "2024-10-27T03:30:00+03:00", "2024-10-27", None, "2024-10-27T00:30:00.5-01:00"]
    want = ["2024-03-31 02:30:00", "2024-03-31 02:30:00.250000", "2024-10-27 01:30:00", "2024-10-27 00:30:00", "2024-10-27 00:00:00", "None", "2024-10-27 01:30:00.500000"]
    d = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    try:
        for zone in ("Europe/Amsterdam", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [str(r.t) for r in d.select("k", ndjson.naive_utc(F.col("s")).alias("t")).orderBy("k").collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_archive(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "a.7z", "w") as z:
        z.writestr("a.ndjson", "\n".join(map(json.dumps, FLAT)))
    assert not archive.is_encrypted(str(tmp_path / "a.7z")) and ndjson.read(spark, str(tmp_path / "a.7z")).count() == 2
    for name in list(monkeypatch._setitem) + ["ZIP_PASSWORD"]:
        monkeypatch.delenv(name, raising=False)
    (tmp_path / ".env").write_text("TESTDATA_PASSWORD='secret'\n")
    assert archive.password(str(tmp_path / "a.7z")) == "secret"
    monkeypatch.setenv("OTHER_PASSWORD", "x")
    with pytest.raises(ValueError):
        archive.password(str(tmp_path / "a.7z"))
    monkeypatch.setenv("ZIP_PASSWORD", "z")
    assert archive.password(str(tmp_path / "a.7z")) == "z"


def test_missing_7z(monkeypatch):
    monkeypatch.setattr(archive.shutil, "which", lambda _: None)
    with pytest.raises(RuntimeError):
        archive.require_7z()


@pytest.mark.parametrize(("kind", "parts"), [("Point", [[(1.0, 2.0)]]), ("LineString", [[(0.0, 0.0), (1.0, 1.0)]]), ("Polygon", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]), ("MultiPoint", [[(1.0, 2.0)], [(3.0, 4.0)]]), ("MultiLineString", [[(0.0, 0.0), (1.0, 1.0)], [(5.0, 5.0), (6.0, 6.0)]])])
def test_wkb(kind, parts):
    assert wkb.decode(wkb.encode(kind, parts)) == (kind, parts)


def test_wkb_table(spark, tmp_path):
    pq.write_table(pa.table({"Shape": [wkb.encode("LineString", [[(0.0, 0.0), (1.0, 2.0)]])], "Shape_bbox": [1], "k": [7]}), tmp_path / "a.parquet")
    r = tables.read_wkb(spark, str(tmp_path / "a.parquet")).head()
    assert r.k == 7 and r.geometry[0][1].y == 2.0 and "Shape_bbox" not in r
    assert "geometry" in tables.read_points(spark, str(tmp_path / "a.parquet")).columns
    with pytest.raises(KeyError):
        tables.read_wkb(spark, "/root/testdata/sf0.001/region.parquet")


def test_hive(spark, tmp_path):
    p = pings.read(spark, "/root/testdata/sf0.001").drop("props")
    files.write_by_day(p, str(tmp_path / "t"))
    assert tables.hive_keys(str(tmp_path / "t")) == {"year": "int", "month": "int", "day": "int"}
    leaf = next((tmp_path / "t").glob("year=*/month=*"))
    assert tables.hive_keys(str(leaf)) == {"year": "int", "month": "int", "day": "int"}
    assert tables.hive_keys(str(tmp_path / "none")) is None and tables.hive_keys("/root/testdata/sf0.001") is None
    assert tables.read_hive(spark, str(leaf)).where("year = 2024").count() == tables.read_hive(spark, str(tmp_path / "t")).count() == p.count()
    assert tables.read_points(spark, str(tmp_path / "t"), first_files=1).count() < p.count()


def test_footer_bounds(spark, sf, tmp_path):
    p = pings.read(spark, sf).select("longitude", "latitude", "event_id")
    p.repartition(3).write.parquet(str(tmp_path / "b"))
    got = tables.footer_bounds(str(tmp_path / "b"), ("longitude", "event_id"))
    assert got["longitude"] == tuple(p.agg(F.min("longitude"), F.max("longitude")).head())
    with pytest.raises(KeyError):
        tables.footer_bounds(str(tmp_path / "b"), ("nothing",))


def test_geo_metadata(spark, tmp_path):
    geo = lambda crs: {b"geo": json.dumps({"primary_column": "geometry", "columns": {"geometry": {"crs": crs}}}).encode()}
    for name, crs in (("m", {"id": {"authority": "EPSG", "code": 3857}}), ("d", None)):
        pq.write_table(pa.table({"geometry": [b""]}).replace_schema_metadata(geo(crs)), tmp_path / f"{name}.parquet")
    assert tables.read_for_rendering(spark, str(tmp_path / "m.parquet")).count() == 1
    with pytest.raises(ValueError):
        tables.read_for_rendering(spark, str(tmp_path / "d.parquet"))
    with pytest.raises(ValueError):
        tables.require_geo("/root/testdata/sf0.001/region.parquet")


LINE = {"type": "Feature", "properties": {"PassageId": "p", "name": "p"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [0.1, 0]]}}
RING = {"type": "Feature", "properties": {"name": "q"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}


def test_geoparquet(spark, tmp_path):
    """Every shape of table gets its geometry and metadata, and can be read for rendering."""
    p = pings.read(spark, "/root/testdata/sf0.001").select("mmsi", "longitude", "latitude").limit(50).repartition(3)
    p = p.unionByName(spark.createDataFrame([(9, None, 52.0)], "mmsi long, longitude double, latitude double"))
    files.write_geoparquet(p, str(tmp_path / "p.geoparquet"))
    meta = tables.require_geo(str(tmp_path / "p.geoparquet"))
    assert tables.crs_code(meta) == 4326 and meta["columns"]["geometry"]["encoding"] == "WKB"
    back = spark.read.parquet(str(tmp_path / "p.geoparquet"))
    assert back.count() == 51 and back.where("geometry IS NULL").count() == 1
    r = back.where("geometry IS NOT NULL").head()
    assert wkb.decode(bytes(r.geometry)) == ("Point", [[(r.longitude, r.latitude)]])
    line = spark.range(1).select(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y")), F.struct(F.lit(3.0).alias("x"), F.lit(4.0).alias("y"))).alias("line"))
    files.write_geoparquet(line, str(tmp_path / "l"), 3857)
    assert wkb.decode(bytes(tables.read_for_rendering(spark, str(tmp_path / "l")).head().geometry)) == ("LineString", [[(1.0, 2.0), (3.0, 4.0)]])
    s = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "lon1 double, lat1 double, lon2 double, lat2 double")
    files.write_geoparquet(s, str(tmp_path / "l"))
    assert tables.crs_code(tables.require_geo(str(tmp_path / "l"))) == 4326 and spark.read.parquet(str(tmp_path / "l")).count() == 1
    with pytest.raises(KeyError):
        files.write_geoparquet(spark.range(1), str(tmp_path / "n"))


def test_gates_of_several_lines_and_geopackages(spark, tmp_path):
    lines = {"type": "MultiLineString", "coordinates": [[[0, 0], [0.1, 0]], [[5, 50], [5.3, 50]], [[1, 1], [1, 1.1]]]}
    f = {"type": "Feature", "properties": {"PassageId": "m"} | {f"{k}_3_up": v for k, v in (("loc_bin", 4), ("median_speed_loc", 7.5))}, "geometry": lines}
    (tmp_path / "m.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [f]}))
    layer = reference.read_lines(spark, str(tmp_path / "m.geojson"))
    assert layer.head().length == pytest.approx(0.3 * 111319.49, rel=1e-6) and len(layer.head().edges) == 1
    df = spark.createDataFrame([("g", 3, 1.5, [(4.0, 52.0), (4.1, 52.1)])], "PassageId string, n int, v double, line array<struct<x: double, y: double>>")
    for name in ("a.gpkg", "a.geojson"):
        files.write_features(df, str(tmp_path / name))
        ((props, kind, parts),) = reference._features(str(tmp_path / name))
        assert {k: v for k, v in props.items() if k != "fid"} == {"PassageId": "g", "n": 3, "v": 1.5} and (kind, parts) == ("LineString", [[(4.0, 52.0), (4.1, 52.1)]])


def test_layers(spark, tmp_path):
    for name, f in (("line", LINE), ("ring", RING)):
        (tmp_path / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [f]}))
    assert reference.read_lines(spark, str(tmp_path / "line.geojson")).head().length == pytest.approx(11131.95, abs=0.1)
    assert len(reference.read_polygons(spark, str(tmp_path / "ring.geojson")).head().edges) == 3
    for f, name in ((reference.read_lines, "ring"), (reference.read_polygons, "line")):
        with pytest.raises(ValueError):
            f(spark, str(tmp_path / f"{name}.geojson"))
    with pytest.raises(KeyError):
        reference.read_lines(spark, str(tmp_path / "line.geojson"), "other")


def test_geopackage(spark, tmp_path):
    with sqlite3.connect(tmp_path / "a.gpkg") as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES ('t', 'geom')")
        db.execute("CREATE TABLE t (PassageId TEXT, geom BLOB)")
        db.execute("INSERT INTO t VALUES ('p', ?)", (b"GP\0\x01\xe6\x10\0\0" + wkb.encode("LineString", [[(0.0, 0.0), (0.1, 0.0)]]),))
    assert reference.read_lines(spark, str(tmp_path / "a.gpkg")).head().PassageId == "p"


def codes(tmp_path, rows):
    (tmp_path / "c.json").write_text(json.dumps(rows))
    return reference.vessel_codes(str(tmp_path / "c.json"))


def test_vessel_codes(tmp_path):
    row = lambda c, g="x": {"vessel_code": c, "vessel_group": g}
    assert codes(tmp_path, [row(80), row("70 to 72"), row("HSC"), row("Not party to conflict")]).keys() == {80, 70, 71, 72, "hsc", "not party to conflict"}
    for bad in ([{"vessel_code": 1}], [row("70 to 79 to 89")], [row([1])]):
        with pytest.raises(ValueError):
            codes(tmp_path, bad)
    with pytest.raises(FileNotFoundError):
        reference.vessel_codes(str(tmp_path / "none.json"))


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text("[outlier]\nv_max = 20\n[style.sog]\nscale = 'log'\n")
    c = reference.config(str(tmp_path / "c.toml"))
    assert c["outlier"] == {"v_max": 20, "d_min": 300.0} and c["visualization"]["tile_size"] == 1024 and c["style"]["sog"]["scale"] == "log"


def test_outputs(spark, tmp_path):
    assert files.default_output("/x/foo.csv.zip", ".geoparquet") == "/x/foo.geoparquet"
    assert files.default_output("foo-trajectorized.geoparquet", "-lines.geoparquet") == "foo-lines.geoparquet"
    df = spark.range(1).select(F.lit("p").alias("id"), F.array(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y")), F.struct(F.lit(3.0).alias("x"), F.lit(4.0).alias("y"))).alias("line"))
    files.write_geojson(df, str(tmp_path / "a.geojson"))
    assert json.loads((tmp_path / "a.geojson").read_text())["features"][0]["geometry"]["coordinates"] == [[1, 2], [3, 4]]
    assert files.bin_segments_path("/x/a.geojson") == "/x/a_bin_segments.geojson"
    files.write_run_metadata(str(tmp_path / "run"), "in", {"zoom": 7})
    assert json.loads((tmp_path / "run" / "metadata.json").read_text())["config"] == {"zoom": 7}
    for z in (1, 2, 3):
        (tmp_path / "run" / f"z={z}").mkdir()
    files.drop_levels_above(str(tmp_path / "run"), 3)
    assert sorted(p.name for p in (tmp_path / "run").glob("z=*")) == ["z=3"]
