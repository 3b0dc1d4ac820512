"""Convex hulls of planar points by the monotone chain, and trailing windows of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Vertices in counter-clockwise order; collinear points leave two ends."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def half(ordered: list) -> list:
        out: list = []
        for p in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(pts[::-1])


def area(points: list[tuple[float, float]]) -> float:
    """Of the hull; 0 for fewer than three points and for collinear ones."""
    h = hull(points)
    if len(h) < 3:
        return 0.0
    x, y = np.array(h).T
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


#: Windows of more points are put together from hulls of two parts.
_FEW = 24


def trailing_areas(t: np.ndarray, x: np.ndarray, y: np.ndarray, window: float) -> np.ndarray:
    """For each row, in time order, the hull area of the rows up to it whose time is at least its own less window.

    A long window is cut at a fixed row: hulls of the rows from each of its first rows to the cut are made once, and the
    hull of what follows the cut grows with each row, so that a row costs its hulls' few vertices, not its window's points.
    """
    out = np.zeros(len(t))
    begin = np.searchsorted(t, t - window, "left")
    pts = list(zip(x.tolist(), y.tolist(), strict=True))
    cut, before, after = -1, [], []
    for i in np.flatnonzero(np.arange(len(t)) - begin >= 2).tolist():
        first = int(begin[i])
        if i - first < _FEW:
            out[i], cut = area(pts[first : i + 1]), -1
            continue
        if first > cut or cut < 0:
            # rows first..i-1 lie before the cut; before[k] is the hull of rows first + k to the cut
            cut, start, before = i - 1, first, []
            for p in reversed(pts[first:i]):
                before.append(hull([*(before[-1] if before else ()), p]))
            before.reverse()
            after = []
            done = i
        while done <= i:
            after = hull([*after, pts[done]])
            done += 1
        out[i] = area([*before[first - start], *after])
    return out


@F.arrow_udf(T.DoubleType())
def hull_area(points: pa.Array) -> pa.Array:
    """Of array<struct<x, y>>; null for null."""
    return pa.array([None if p is None else area([(q["x"], q["y"]) for q in p]) for p in points.to_pylist()], pa.float64())
