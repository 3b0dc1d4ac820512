"""Keys that order points in space and time: a Hilbert curve with the time below it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantize(v: Column, low: float, high: float, p: int) -> Column:
    """v as a whole number of p bits; an empty range counts as 1 wide."""
    span = (high - low) or 1.0
    most = (1 << p) - 1
    return F.least(F.greatest((v - F.lit(low)) / F.lit(span) * most, F.lit(0.0)), F.lit(float(most))).cast("long")


def hilbert(x: Column, y: Column, p: int) -> Column:
    """Position of cell (x, y) along the Hilbert curve of order p, from (0, 0) to (2 ** p - 1, 0).

    One fold over the bits from the highest: each step adds its quadrant and turns the lower bits.
    """

    def step(a: Column, s: Column) -> Column:
        rx, ry = (a["x"].bitwiseAND(s) > 0).cast("long"), (a["y"].bitwiseAND(s) > 0).cast("long")
        d = a["d"] + s * s * (3 * rx).bitwiseXOR(ry)
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, s - 1 - a["x"].bitwiseAND(s - 1)).otherwise(a["x"].bitwiseAND(s - 1)), F.when(flip, s - 1 - a["y"].bitwiseAND(s - 1)).otherwise(a["y"].bitwiseAND(s - 1))
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    bits = F.array(*(F.lit(1 << k).cast("long") for k in reversed(range(p))))
    begin = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(bits, begin, step, lambda a: a["d"])


def space_time_key(x: Column, y: Column, t: Column, bounds: dict[str, tuple[float, float]], p: int = 16) -> Column:
    """Hilbert position of (x, y), then p bits of time: 3 * p bits in all. bounds: x, y, t to (low, high); t in seconds."""
    h = hilbert(quantize(x, *bounds["x"], p), quantize(y, *bounds["y"], p), p)
    return F.shiftleft(h, p).bitwiseOR(quantize(t, *bounds["t"], p))
