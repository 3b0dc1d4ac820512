"""Web Mercator tiles and pixels. Pixel rows and tile rows count from the north."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import MERCATOR_R

#: Half the width of the Web Mercator square, metres.
HALF = math.pi * MERCATOR_R


def pixel_x(x: Column, zoom: int, size: int = 1024) -> Column:
    """Global pixel coordinate, a real number, of Web Mercator x."""
    return (x + HALF) / F.lit(2 * HALF) * F.lit(float(size << zoom))


def pixel_y(y: Column, zoom: int, size: int = 1024) -> Column:
    return (F.lit(HALF) - y) / F.lit(2 * HALF) * F.lit(float(size << zoom))


def tile_of(lon: float, lat: float, zoom: int) -> tuple[int, int]:
    n = 1 << zoom
    x = int((lon + 180) / 360 * n)
    y = int((1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n)
    return min(max(x, 0), n - 1), min(max(y, 0), n - 1)


def tiles_of(bbox: tuple[float, float, float, float], zoom: int) -> list[tuple[int, int]]:
    """Tiles that a box of degrees (west, south, east, north) touches."""
    x0, y0 = tile_of(bbox[0], bbox[3], zoom)
    x1, y1 = tile_of(bbox[2], bbox[1], zoom)
    return [(x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)]


def tile_bounds(x: int, y: int, zoom: int) -> tuple[float, float, float, float]:
    """West, south, east, north in metres."""
    step = 2 * HALF / (1 << zoom)
    return -HALF + x * step, HALF - (y + 1) * step, -HALF + (x + 1) * step, HALF - y * step
