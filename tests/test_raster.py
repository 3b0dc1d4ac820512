import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.functions import tiles
from wakeline.operators import raster
from wakeline.sinks import images


def drawn(spark, x1, y1, x2, y2, width, size=10):
    d = raster.draw(raster.canonical(spark.createDataFrame([(float(x1), float(y1), float(x2), float(y2))], "x1 double, y1 double, x2 double, y2 double")), width)
    out = np.zeros((size, size))
    for r in d.collect():
        if 0 <= r.gx < size and 0 <= r.gy < size:
            assert out[r.gy, r.gx] == 0
            out[r.gy, r.gx] = r.coverage
    return out


def test_aliased(spark):
    a = drawn(spark, 1, 1, 8, 8, 0)
    assert set(a.ravel()) == {0, 1} and a.sum() == 8 and np.trace(a) == 8


@pytest.mark.parametrize(("width", "on", "side"), [(1.0, 1.0, 0.29), (math.sqrt(0.5), 0.7071, 0.2071)])
def test_diagonal_coverage(spark, width, on, side):
    a = drawn(spark, 1, 1, 8, 8, width)
    assert a[4, 4] == pytest.approx(on, abs=5e-3) and a[4, 5] == pytest.approx(side, abs=5e-3) and a.max() <= 1


def test_level_coverage(spark):
    a = drawn(spark, 1, 4.5, 8, 4.5, 1.0)
    assert a[4, 4] == pytest.approx(0.5) and a[5, 4] == pytest.approx(0.5)
    assert drawn(spark, 1, 4, 8, 4, 4.0).astype(bool).sum() > 2 * drawn(spark, 1, 4, 8, 4, 1.0).astype(bool).sum()


@pytest.mark.parametrize("width", [0.0, 1.0])
def test_directions_agree(spark, width):
    assert np.array_equal(drawn(spark, 1, 2, 8, 5, width), drawn(spark, 8, 5, 1, 2, width))


def segments(spark, rows):
    return spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, sog double, speed_mps double, VesselGroup string")


def test_seamless_over_tiles(spark):
    # one line over four tiles has the pixels of the same line in one tile of four times the size
    s = segments(spark, [(-3e6, -2e6, 2.5e6, 3e6, 5.0, 1.0, "Cargo")])
    for width in (0.0, 1.0):
        small, large = (raster.render(s, z, n, width).select(F.expr(f"tile_x * {n} + px").alias("x"), F.expr(f"tile_y * {n} + py").alias("y"), F.round("value", 9).alias("v")) for z, n in ((3, 64), (1, 256)))
        assert small.count() == large.count() > 50 and small.exceptAll(large).count() == 0


def test_bands_share_a_footprint(spark):
    s = segments(spark, [(0.0, 0.0, 2e6, 1e6, 10.0, 2.0, "A/B"), (0.0, 0.0, 2e6, 1e6, 20.0, 4.0, "C"), (0.0, 1e6, 2e6, 0.0, None, None, "C")])
    r = raster.render(s, 1, 256, 1.0, bands=("transit_count", "sog", "speed_mps"), category="VesselGroup")
    n = {x.band: x.n for x in r.groupBy("band").agg(F.count("*").alias("n")).collect()}
    assert n["transit_count__A-B"] == n["sog__A-B"] == n["speed_mps__A-B"] and "sog__C" in n
    assert raster.render(s, 1, 256, value=("sog", "max")).agg(F.max("value")).head()[0] == 20
    with pytest.raises(ValueError):
        raster.render(s, 1, 256, bands=("nonsense",))
    with pytest.raises(ValueError):
        raster.render(s, 1, 256, value=("sog", "median"))


def level(spark, rows):
    return spark.createDataFrame([(1, 0, 0, b, x, y, v) for b, x, y, v in rows], "z int, tile_x long, tile_y long, band string, px long, py long, value double")


def test_pyramid(spark):
    rows = [("transit_count", x, y, 100.0 if (x, y) == (0, 0) else 1.0) for x in (0, 1) for y in (0, 1)] + [("sog", x, y, 20.0 if (x, y) == (0, 0) else 2.0) for x in (0, 1) for y in (0, 1)]
    got = {r.band: r.value for r in raster.coarsen(level(spark, rows), 4).collect()}
    assert got["transit_count"] == 103 and got["sog"] == pytest.approx((100 * 20 + 3 * 1 * 2) / 103)


def test_pyramid_categories_and_fallback(spark):
    rows = [("transit_count__A", 0, 0, 3.0), ("transit_count__A", 1, 0, 1.0), ("sog__A", 0, 0, 10.0), ("sog__A", 1, 0, 2.0), ("sog__B", 0, 0, 8.0), ("counts", 0, 0, 4.0)]
    got = {r.band: r.value for r in raster.coarsen(level(spark, rows), 4).collect()}
    assert got == {"transit_count__A": 4, "sog__A": 8, "sog__B": 2, "counts": 4}
    compat = {r.band: r.value for r in raster.coarsen(level(spark, rows), 4, compat=True).collect()}
    assert compat["counts"] == 1


def test_resume(spark):
    s = segments(spark, [(-3e6, -2e6, 2.5e6, 3e6, 5.0, 1.0, "Cargo")])
    whole = raster.render(s, 3, 64)
    done = whole.select("z", "tile_x", "tile_y").distinct().limit(1)
    left = raster.render(s, 3, 64, done=done)
    assert left.select("tile_x", "tile_y").distinct().count() == whole.select("tile_x", "tile_y").distinct().count() - 1


def test_tiles():
    assert tiles.tiles_of((-1, -1, 1, 1), 1) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    w, s, e, n = tiles.tile_bounds(0, 0, 0)
    assert (w, e) == (-tiles.HALF, tiles.HALF) and n == -s == pytest.approx(tiles.HALF)


def test_png(spark):
    v = level(spark, [("transit_count", 1, 2, 5.0)])
    t = images.png_tiles(v, raster.robust_max(v), 4).head()
    assert t.content[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", t.content[16:24]) == (4, 4)
    at = t.content.index(b"IDAT")
    raw = np.frombuffer(zlib.decompress(t.content[at + 4 : at + 4 + struct.unpack(">I", t.content[at - 4 : at])[0]]), np.uint8).reshape(4, 17)[:, 1:].reshape(4, 4, 4)
    assert raw[2, 1, 3] == 255 and (raw[..., 3] > 0).sum() == 1


def test_geotiff(spark):
    v = level(spark, [("transit_count", 1, 2, 5.0), ("sog", 0, 0, 1.5)])
    t = images.geotiff_tiles(v, ["transit_count", "sog"], 4).head().content
    n = struct.unpack_from("<H", t, 8)[0]
    tags = {struct.unpack_from("<H", t, 10 + 12 * k)[0]: struct.unpack_from("<HII", t, 12 + 12 * k) for k in range(n)}
    assert t[:4] == b"II*\0" and tags[256][2] == 4 and tags[277][2] == 2 and 42112 in tags
    first, size = (struct.unpack_from("<I", t, tags[k][2])[0] for k in (324, 325))
    pixels = np.frombuffer(zlib.decompress(t[first : first + size]), "<f4").reshape(256, 256)
    assert pixels[2, 1] == 5 and pixels.sum() == 5


def test_styles():
    assert images.style("transit_count") == {"colormap": "oslo", "scale": "log"} and images.style("sog") == {"colormap": "plasma", "scale": "linear"}
    assert images.style("sog", {"sog": {"log_scale": True, "colormap": "viridis"}}) == {"colormap": "viridis", "scale": "log"}
    assert images.style("sog", {"log_scale": True, "sog": {"log_scale": False}}) == {"colormap": "plasma", "scale": "linear"}
    assert images.style("transit_count", {"colormap": "gray", "log_scale": False}) == {"colormap": "gray", "scale": "linear"}
    for name in images.MAPS:
        assert images.palette(name).shape == (256, 4) and images.palette(name)[-1, 3] == 255
    with pytest.raises(ValueError):
        images.palette("nonsense")
    images.add_map("two", [(0, 0, 0), (0, 0, 255)])
    assert images.palette("two")[-1].tolist() == [0, 0, 255, 255]


def test_zarr_tiles(spark, tmp_path):
    v = level(spark, [("transit_count", 1, 2, 5.0), ("sog", 0, 0, 1.5)])
    images.save_zarr(images.zarr_tiles(v, ["transit_count", "sog"], 4), str(tmp_path))
    data = (tmp_path / "tile_1_0_0.zarr" / "data" / "0.0.0").read_bytes()
    assert np.frombuffer(zlib.decompress(data), "<f4").reshape(4, 4)[2, 1] == 5 and (tmp_path / "tile_1_0_0.zarr" / "data" / ".zarray").exists()


def test_zarr():
    f = images.zarr_files([np.eye(4)], ["transit_count"], (0, 0, 4, 4))
    assert np.array_equal(np.frombuffer(zlib.decompress(f["data/0.0.0"]), "<f4").reshape(4, 4), np.eye(4)) and b"EPSG:3857" in f["data/.zattrs"]
