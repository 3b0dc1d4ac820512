"""Command line: python -m wakeline.cli COMMAND INPUT [options]. Each command is one call of the library."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import clean, events, gates, layout, outliers, raster, trajectory
from .session import session
from .sinks import files, images
from .sources import csv, ndjson, reference, tables


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="wakeline")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *flags: tuple[str, dict]) -> None:
        c = sub.add_parser(name, help=about)
        c.add_argument("input")
        c.add_argument("-o", "--output")
        for flag, options in flags:
            c.add_argument(flag, **options)

    number = lambda default: {"type": float, "default": default}
    yes = {"action": "store_true"}
    command("convert-csv", "AIS CSV to daily folders")
    command("convert-ndjson", "AIS NDJSON to daily folders")
    command("convert-wkb", "a table with WKB shapes to parts")
    command("preprocess", "Web Mercator coordinates, ordered in space and time", ("--partitions", {"type": int, "default": 128}), ("--no-spatial-index", yes))
    command("filter-outliers", "drop position outliers", ("--config-file", {}), ("--v-max", number(None)), ("--d-min", number(None)), ("--mode", {"choices": ["iterative", "anchor"], "default": "iterative"}))
    command("trajectorize", "trips and kinematics", ("--gap-threshold-hours", number(1.0)), ("--stop-duration-min", number(20.0)), ("--stop-radius-m", number(50.0)), ("--epoch-time", yes), ("--exclude-moored", yes), ("--status-col", {"default": "status"}), ("--vessel-col", {}), ("--time-col", {}), ("--x-col", {"default": "longitude"}), ("--y-col", {"default": "latitude"}), ("--input-crs", {"type": int, "default": 4326}), ("--hilbert-p", {"type": int, "default": 16}), ("--partition-method", {"choices": ["vessel", "spatiotemporal"], "default": "vessel"}), ("--n-partitions", {"type": int, "default": 128}))
    command("to-lines", "one line per trip", ("--vessel-codes-json", {}))
    command("to-segments", "pairs of consecutive pings", ("--vessel-codes-json", {}), ("--epoch-time", yes), ("--sog-raw-units", yes))
    command("line-crossings", "crossings of lines", ("--passage-file", {"required": True}))
    command("polygon-visits", "visits to polygons", ("--polygons-file", {"required": True}), ("--polygon-id-col", {"default": "name"}), ("--merge-gap-minutes", number(None)))
    command("analyze-passage", "statistics of gates", ("--passage-file", {"required": True}), ("--max-time-gap", number(7200.0)))
    command("bin-segments", "the parts of gates with crossings, from a file of gate statistics")
    command("render", "density tiles", ("--config-file", {}), ("--zoom", {"type": int, "default": None}), ("--bands", {"default": raster.COUNT}), ("--category", {}), ("--bbox", {"nargs": 4, "type": float}), ("--resume", yes))
    command("postprocess", "pyramid, PNG and GeoTIFF of rendered tiles", ("--base-zoom", {"type": int, "default": 7}), ("--config-file", {}), ("--clean-intermediate", yes), ("--cogs", yes), ("--zarr", yes))
    return p


def _codes(path: str | None) -> dict | None:
    return reference.vessel_codes(path) if path else None


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = session()
    suffix = {"filter-outliers": "-cleaned", "trajectorize": "-trajectorized", "to-lines": "-lines", "to-segments": "-segments"}.get(a.command, "-" + a.command)
    out = a.output or files.default_output(a.input, suffix + (".geojson" if a.command == "analyze-passage" else ".parquet"))
    read = lambda: tables.read_points(spark, a.input)
    if a.command in ("convert-csv", "convert-ndjson"):
        files.write_by_day((csv if a.command == "convert-csv" else ndjson).read(spark, a.input), out)
        return 0
    if a.command in ("render", "postprocess"):
        return _raster(spark, a, out)
    if a.command == "analyze-passage":
        return _gates(spark, a, out)
    if a.command == "bin-segments":
        files.write_features(gates.unpivot_bins(*reference.read_bin_stats(spark, a.input)), a.output or files.bin_segments_path(a.input))
        return 0
    table = _table(spark, a, read)
    if a.command == "convert-wkb" or not out.endswith(".geoparquet"):
        files.write_table(table, out)
    else:
        files.write_geoparquet(table, out)
    return 0


def _table(spark, a: argparse.Namespace, read) -> DataFrame:
    if a.command == "convert-wkb":
        return tables.read_wkb(spark, a.input)
    if a.command == "preprocess":
        d = clean.reproject(read())
        return d if a.no_spatial_index else layout.cluster(layout.space_time_index(d), a.partitions)
    if a.command == "filter-outliers":
        limits = reference.config(a.config_file)["outlier"] if a.config_file else {"v_max": 50.0, "d_min": 300.0}
        return outliers.filter_outliers(read(), v_max=a.v_max or limits["v_max"], d_min=a.d_min or limits["d_min"], mode=a.mode)
    if a.command == "trajectorize":
        d = clean.drop_null_coordinates(read(), a.x_col, a.y_col)
        d = clean.exclude_moored(d, a.status_col) if a.exclude_moored else d
        t = trajectory.trajectorize(d, a.gap_threshold_hours, a.stop_duration_min, a.stop_radius_m, a.vessel_col, a.time_col, a.x_col, a.y_col, input_crs=a.input_crs)
        time = trajectory.time_column(t, a.time_col)
        if a.partition_method == "spatiotemporal":
            box = layout.bounds(t, a.x_col, a.y_col, time)
            t = layout.cluster(layout.space_time_index(t, box, a.hilbert_p, a.x_col, a.y_col, time), a.n_partitions)
        return clean.normalize_epoch(t, time) if a.epoch_time else t
    if a.command == "to-lines":
        return trajectory.trip_lines(read(), mapping=_codes(a.vessel_codes_json))
    if a.command == "to-segments":
        d = read()
        d = clean.normalize_epoch(d, trajectory.time_column(d)) if a.epoch_time else d
        return trajectory.segments(d, mapping=_codes(a.vessel_codes_json), raw_sog=a.sog_raw_units)
    if a.command == "line-crossings":
        return events.line_crossings(read(), reference.read_lines(spark, a.passage_file))
    return events.polygon_visits(read(), reference.read_polygons(spark, a.polygons_file, a.polygon_id_col), a.polygon_id_col, a.merge_gap_minutes)


def _gates(spark, a: argparse.Namespace, out: str) -> int:
    layer = reference.read_lines(spark, a.passage_file)
    stats = gates.gate_statistics(tables.read_points(spark, a.input), layer, max_gap_s=a.max_time_gap).cache()
    if not stats.head(1):
        print("no gate has crossings", file=sys.stderr)
        return 0
    from .functions import geometry as geo

    degrees = F.transform("edges", lambda e: F.struct(geo.mercator_lon(e["ax"]).alias("x"), geo.mercator_lat(e["ay"]).alias("y")))
    last = F.element_at("edges", -1)
    line = F.concat(degrees, F.array(F.struct(geo.mercator_lon(last["bx"]).alias("x"), geo.mercator_lat(last["by"]).alias("y"))))
    files.write_features(stats.join(layer.select("PassageId", line.alias("line")), "PassageId"), out)
    files.write_geojson(gates.unpivot_bins(stats, layer), files.bin_segments_path(out))
    return 0


def _styles(config: dict) -> dict:
    """Styles of bands, and for the run the colormap and log_scale of the sections style or visualization."""
    return {k: config["visualization"][k] for k in ("colormap", "log_scale") if k in config["visualization"]} | config["style"]


def _raster(spark, a: argparse.Namespace, out: str) -> int:
    config = reference.config(a.config_file) if a.config_file else {"visualization": {}, "style": {}}
    v = {"zoom": 7, "tile_size": 1024, "line_width": 0} | config["visualization"]
    if a.command == "render":
        zoom = v["zoom"] if a.zoom is None else a.zoom
        s = spark.read.parquet(a.input)
        if box := a.bbox or v.get("bbox"):
            x0, y0, x1, y1 = clean.reproject(spark.createDataFrame([(box[0], box[1]), (box[2], box[3])], "longitude double, latitude double")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).head()
            s = raster.clip_box(s, x0, y0, x1, y1)
        done = spark.read.parquet(f"{out}/tiles").select("z", "tile_x", "tile_y").distinct() if a.resume else None
        r = raster.render(s, zoom, v["tile_size"], v["line_width"], tuple(a.bands.split(",")), a.category or v.get("category_column"), done=done)
        files.write_run_metadata(out, a.input, config)
        r.repartition("tile_x", "tile_y").write.mode("append" if a.resume else "overwrite").partitionBy("z").parquet(f"{out}/tiles")
        return 0
    folder, size = f"{a.input}/tiles", v["tile_size"]
    base = spark.read.parquet(folder).where(F.col("z") == a.base_zoom)

    def write(level: DataFrame, z: int) -> DataFrame:
        level.drop("z").write.mode("overwrite").parquet(f"{folder}/z={z}")
        return spark.read.parquet(f"{folder}/z={z}").withColumn("z", F.lit(z))

    every = raster.pyramid(base, a.base_zoom, size=size, write=write)
    images.save(images.png_tiles(every, raster.robust_max(every, exact=False), size, _styles(config)), f"{a.input}/png", "png")
    if a.zarr:
        images.save_zarr(images.zarr_tiles(every, raster.categories(base, "band"), size), f"{a.input}/zarr")
    if a.cogs:
        images.save(images.geotiff_tiles(base, raster.categories(base, "band"), size), f"{a.input}/cogs", "tif")
    if a.clean_intermediate:
        files.drop_levels_above(folder, a.base_zoom)
    return 0


if __name__ == "__main__":
    sys.exit(main())
