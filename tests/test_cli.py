import json

import pytest

from wakeline import cli
from wakeline.plans import pings


def test_help(capsys):
    with pytest.raises(SystemExit) as e:
        cli.main(["--help"])
    assert e.value.code == 0 and "trajectorize" in capsys.readouterr().out


def test_from_pings_to_tiles(spark, sf, tmp_path):
    at = lambda n: str(tmp_path / n)
    pings.read(spark, sf).drop("props").write.parquet(at("in.parquet"))
    gate = {"type": "Feature", "properties": {"PassageId": "mid"}, "geometry": {"type": "LineString", "coordinates": pings.GATES["mid"]}}
    (tmp_path / "gates.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [gate]}))
    ring = [[4.02, 52.02], [4.06, 52.02], [4.06, 52.07], [4.02, 52.07], [4.02, 52.02]]
    (tmp_path / "boxes.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "b"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    (tmp_path / "c.toml").write_text("[visualization]\nzoom = 3\ntile_size = 64\nline_width = 1\n[outlier]\nv_max = 50\nd_min = 300\n")
    assert cli.main(["filter-outliers", at("in.parquet"), "--config-file", at("c.toml")]) == 0
    assert cli.main(["trajectorize", at("in-cleaned.parquet"), "--gap-threshold-hours", "24", "--exclude-moored"]) == 0
    trips = spark.read.parquet(at("in-trajectorized.parquet"))
    assert {"trip_id", "speed_mps", "rolling_area_m2"} <= set(trips.columns) and trips.where("status = '5'").count() == 0
    assert cli.main(["to-lines", at("in-trajectorized.parquet")]) == 0 and spark.read.parquet(at("in-lines.parquet")).count() > 0
    assert cli.main(["to-segments", at("in-trajectorized.parquet")]) == 0
    assert cli.main(["line-crossings", at("in-segments.parquet"), "--passage-file", at("gates.geojson"), "-o", at("x.parquet")]) == 0
    assert spark.read.parquet(at("x.parquet")).count() > 0
    assert cli.main(["polygon-visits", at("in-segments.parquet"), "--polygons-file", at("boxes.geojson"), "--merge-gap-minutes", "30", "-o", at("v.parquet")]) == 0
    assert spark.read.parquet(at("v.parquet")).count() > 0
    assert cli.main(["analyze-passage", at("in.parquet"), "--passage-file", at("gates.geojson"), "--max-time-gap", "86400", "-o", at("g.geojson")]) == 0
    stats = json.loads((tmp_path / "g.geojson").read_text())["features"][0]["properties"]
    assert stats["frequency_up"] + stats["frequency_down"] == sum(stats[f"loc_bin_{i}_{d}"] for i in range(20) for d in ("up", "down")) > 0
    assert json.loads((tmp_path / "g_bin_segments.geojson").read_text())["features"]
    assert cli.main(["render", at("in-segments.parquet"), "-o", at("run"), "--config-file", at("c.toml"), "--bands", "transit_count,sog"]) == 0
    assert cli.main(["render", at("in-segments.parquet"), "-o", at("run"), "--config-file", at("c.toml"), "--resume"]) == 0
    assert cli.main(["postprocess", at("run"), "--base-zoom", "3", "--config-file", at("c.toml"), "--cogs", "--clean-intermediate"]) == 0
    assert (tmp_path / "run" / "png" / "transit_count" / "0" / "0" / "0.png").exists() and list((tmp_path / "run" / "cogs").rglob("*.tif"))
    assert [p.name for p in (tmp_path / "run" / "tiles").glob("z=*")] == ["z=3"]
    assert cli.main(["preprocess", at("in.parquet"), "-o", at("p.parquet"), "--partitions", "3"]) == 0 and "space_time" in spark.read.parquet(at("p.parquet")).columns
