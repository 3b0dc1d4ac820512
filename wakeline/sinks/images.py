"""Tiles of sparse pixels as PNG, GeoTIFF and Zarr, made on the executors: one group of rows per tile and band."""

from __future__ import annotations

import json
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tiles import tile_bounds

#: Colours from low to high: a few anchors, between which shades run evenly.
MAPS = {
    "oslo": [(1, 1, 1), (13, 40, 72), (41, 92, 152), (120, 160, 216), (255, 255, 255)],
    "plasma": [(13, 8, 135), (126, 3, 168), (204, 71, 120), (248, 149, 64), (240, 249, 33)],
    "viridis": [(68, 1, 84), (59, 82, 139), (33, 145, 140), (94, 201, 98), (253, 231, 37)],
    "inferno": [(0, 0, 4), (87, 16, 110), (188, 55, 84), (249, 142, 9), (252, 255, 164)],
    "magma": [(0, 0, 4), (81, 18, 124), (183, 55, 121), (252, 137, 97), (252, 253, 191)],
    "cividis": [(0, 34, 78), (65, 77, 107), (124, 123, 120), (188, 174, 108), (254, 232, 56)],
    "gray": [(0, 0, 0), (255, 255, 255)],
    "hot": [(11, 0, 0), (255, 0, 0), (255, 255, 0), (255, 255, 255)],
}
#: The least alpha of a visible pixel, and the share of the colours that it starts from.
FLOORS = {"oslo": 0.2}


def add_map(name: str, anchors: list[tuple[int, int, int]]) -> None:
    """Makes a palette known by its colours from low to high, evenly spaced."""
    MAPS[name] = anchors


def palette(name: str, steps: int = 256) -> np.ndarray:
    """steps x RGBA; alpha rises with the shade."""
    if name not in MAPS:
        raise ValueError(f"unknown colormap {name!r}; known are {', '.join(sorted(MAPS))}, and others by add_map()")
    at, low = np.array(MAPS[name], float), FLOORS.get(name, 0.0)
    t = np.linspace(0, 1, steps)
    rgb = [np.interp(low + (1 - low) * t, np.linspace(0, 1, len(at)), at[:, k]) for k in range(3)]
    return np.stack([*rgb, 255 * (low + (1 - low) * t)], 1).round().astype(np.uint8)


def style(band: str, overrides: dict | None = None) -> dict:
    """colormap and scale (log or linear) of a band. Settings of the band itself come first, then those of the run, which
    are the values that are no tables; a count has oslo and log, a mean plasma and linear unless set. log_scale, true or
    false, is another word for scale."""
    base = {"colormap": "oslo", "scale": "log"} if "count" in band else {"colormap": "plasma", "scale": "linear"}
    top = {k: v for k, v in (overrides or {}).items() if not isinstance(v, dict)}
    out = base
    for given in (top, (overrides or {}).get(band, {})):
        out = out | given
        if "log_scale" in given and "scale" not in given:
            out["scale"] = "log" if given["log_scale"] else "linear"
    return {k: v for k, v in out.items() if k != "log_scale"}


def png(rgba: np.ndarray) -> bytes:
    h, w, _ = rgba.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), rgba.reshape(h, 4 * w)], 1).tobytes()
    part = lambda tag, data: struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows, 6)) + part(b"IEND", b"")


def shade(values: np.ndarray, highest: float, scale: str, colormap: str) -> np.ndarray:
    v = np.log1p(values) / math.log1p(highest) if scale == "log" else values / highest
    out = palette(colormap)[(np.clip(v, 0, 1) * 255).round().astype(int)]
    out[values == 0] = 0
    return out


def geotiff(bands: list[np.ndarray], names: list[str], bounds: tuple[float, float, float, float], tile: int = 256) -> bytes:
    """A tiled, deflated float32 GeoTIFF in EPSG:3857; descriptions are written for more than one band."""
    h, w = bands[0].shape
    nx, ny = -(-w // tile), -(-h // tile)
    blocks = []
    for b in bands:
        full = np.zeros((ny * tile, nx * tile), "<f4")
        full[:h, :w] = b
        blocks += [zlib.compress(full[j * tile : (j + 1) * tile, i * tile : (i + 1) * tile].tobytes(), 6) for j in range(ny) for i in range(nx)]
    n = len(bands)
    west, south, east, north = bounds
    about = "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{v}</Item>' for k, v in enumerate(names)) if n > 1 else ""
    tags: list[tuple[int, int, list | bytes]] = [
        (256, 4, [w]), (257, 4, [h]), (258, 3, [32] * n), (259, 3, [8]), (262, 3, [1]), (277, 3, [n]), (284, 3, [2]), (322, 4, [tile]), (323, 4, [tile]),
        (324, 4, [0] * len(blocks)), (325, 4, [len(b) for b in blocks]), (339, 3, [3] * n), (33550, 12, [(east - west) / w, (north - south) / h, 0.0]),
        (33922, 12, [0.0, 0.0, 0.0, west, north, 0.0]), (34735, 3, [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, 3857]),
        *([(42112, 2, f"<GDALMetadata>{about}</GDALMetadata>\0".encode())] if about else []),
    ]
    if n > 1:
        tags.append((338, 3, [0] * (n - 1)))
    tags.sort(key=lambda t: t[0])
    code, size = {2: "s", 3: "H", 4: "I", 12: "d"}, {2: 1, 3: 2, 4: 4, 12: 8}
    pack = lambda kind, v: v if isinstance(v, bytes) else struct.pack(f"<{len(v)}{code[kind]}", *v)
    at = 8 + 2 + 12 * len(tags) + 4
    place = at + sum(len(pack(k, v)) + len(pack(k, v)) % 2 for _, k, v in tags if len(pack(k, v)) > 4)
    offsets = [place + sum(map(len, blocks[:k])) for k in range(len(blocks))]
    head, extra = b"II*\0" + struct.pack("<IH", 8, len(tags)), b""
    for tag, kind, value in tags:
        data = pack(kind, offsets if tag == 324 else value)
        head += struct.pack("<HHI", tag, kind, len(data) // size[kind])
        if len(data) <= 4:
            head += data.ljust(4, b"\0")
        else:
            head += struct.pack("<I", at + len(extra))
            extra += data + b"\0" * (len(data) % 2)
    return head + struct.pack("<I", 0) + extra + b"".join(blocks)


def _dense(px: np.ndarray, py: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[py, px] = value
    return out


def png_tiles(level: DataFrame, highest: DataFrame, size: int = 1024, styles: dict | None = None) -> DataFrame:
    """(z, tile_x, tile_y, band, content): one PNG for each tile and band that has pixels."""

    def draw(table: pa.Table) -> pa.Table:
        band = table["band"][0].as_py()
        s = style(band, styles)
        v = _dense(*(table[c].to_numpy() for c in ("px", "py", "value")), size)
        content = png(shade(v, table["highest"][0].as_py(), s["scale"], s["colormap"]))
        return pa.table({**{k: [table[k][0].as_py()] for k in ("z", "tile_x", "tile_y", "band")}, "content": [content]}, schema=schema)

    schema = pa.schema([("z", pa.int32()), ("tile_x", pa.int64()), ("tile_y", pa.int64()), ("band", pa.string()), ("content", pa.binary())])
    return level.join(highest, ["z", "band"]).groupBy("z", "tile_x", "tile_y", "band").applyInArrow(draw, "z int, tile_x long, tile_y long, band string, content binary")


def geotiff_tiles(level: DataFrame, bands: list[str], size: int = 1024) -> DataFrame:
    """(z, tile_x, tile_y, content): one GeoTIFF for each tile, with the given bands in order."""

    def make(table: pa.Table) -> pa.Table:
        z, x, y = (table[c][0].as_py() for c in ("z", "tile_x", "tile_y"))
        names = np.array(table["band"].to_pylist())
        px, py, value = (table[c].to_numpy() for c in ("px", "py", "value"))
        full = [_dense(px[names == b], py[names == b], value[names == b], size) for b in bands]
        return pa.table({"z": [z], "tile_x": [x], "tile_y": [y], "content": [geotiff(full, bands, tile_bounds(x, y, z))]}, schema=schema)

    schema = pa.schema([("z", pa.int32()), ("tile_x", pa.int64()), ("tile_y", pa.int64()), ("content", pa.binary())])
    return level.where(F.col("band").isin(bands)).groupBy("z", "tile_x", "tile_y").applyInArrow(make, "z int, tile_x long, tile_y long, content binary")


def zarr_files(bands: list[np.ndarray], names: list[str], bounds: tuple[float, float, float, float]) -> dict[str, bytes]:
    """A Zarr v2 group as files by path: array data of bands, y, x, with CRS and affine transform as attributes."""
    h, w = bands[0].shape
    west, south, east, north = bounds
    meta = {"zarr_format": 2, "shape": [len(bands), h, w], "chunks": [1, h, w], "dtype": "<f4", "compressor": {"id": "zlib", "level": 5}, "fill_value": 0.0, "order": "C", "filters": None}
    attrs = {"_ARRAY_DIMENSIONS": ["band", "y", "x"], "bands": names, "crs": "EPSG:3857", "transform": [(east - west) / w, 0, west, 0, -(north - south) / h, north]}
    out = {".zgroup": b'{"zarr_format": 2}', "data/.zarray": json.dumps(meta).encode(), "data/.zattrs": json.dumps(attrs).encode()}
    return out | {f"data/{k}.0.0": zlib.compress(b.astype("<f4").tobytes(), 5) for k, b in enumerate(bands)}


def zarr_tiles(level: DataFrame, bands: list[str], size: int = 1024) -> DataFrame:
    """(z, tile_x, tile_y, path, content): the files of a Zarr group for each tile, with the given bands in order. Tiles
    without pixels have none."""

    def make(table: pa.Table) -> pa.Table:
        z, x, y = (table[c][0].as_py() for c in ("z", "tile_x", "tile_y"))
        names = np.array(table["band"].to_pylist())
        px, py, value = (table[c].to_numpy() for c in ("px", "py", "value"))
        found = zarr_files([_dense(px[names == b], py[names == b], value[names == b], size) for b in bands], bands, tile_bounds(x, y, z))
        n = len(found)
        return pa.table({"z": [z] * n, "tile_x": [x] * n, "tile_y": [y] * n, "path": list(found), "content": list(found.values())}, schema=schema)

    schema = pa.schema([("z", pa.int32()), ("tile_x", pa.int64()), ("tile_y", pa.int64()), ("path", pa.string()), ("content", pa.binary())])
    return level.where(F.col("band").isin(bands)).groupBy("z", "tile_x", "tile_y").applyInArrow(make, "z int, tile_x long, tile_y long, path string, content binary")


def save_zarr(files: DataFrame, folder: str) -> None:
    """Groups folder/tile_z_x_y.zarr of zarr_tiles(). folder must be one that every executor shares."""
    from pathlib import Path

    def put(rows) -> None:
        for r in rows:
            p = Path(folder, f"tile_{r['z']}_{r['tile_x']}_{r['tile_y']}.zarr", r["path"])
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(r["content"])

    files.foreachPartition(put)


def save(tiles: DataFrame, folder: str, extension: str) -> None:
    """Files folder[/band]/z/x/y.extension of a DataFrame with content. folder must be one that every executor shares."""
    from pathlib import Path

    def put(rows) -> None:
        for r in rows:
            p = Path(folder, *([r["band"]] if "band" in r else []), str(r["z"]), str(r["tile_x"]), f"{r['tile_y']}.{extension}")
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(r["content"])

    tiles.foreachPartition(put)
