"""Well-known binary: points, lines, polygons and their collections to arrays of parts, and back."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(POINT))
NAMES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def decode(data: bytes) -> tuple[str, list[list[tuple[float, float]]]]:
    """Kind and parts: points and lines are a part each, polygons one for each ring. Z and M are dropped, EWKB allowed."""

    def read(at: int) -> tuple[str, list, int]:
        order = "<" if data[at] else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if code & 0x20000000:
            at += 4
        extra = bool(code & 0x80000000) + bool(code & 0x40000000)
        base = code & 0xFFFF
        extra = extra or {0: 0, 1: 1, 2: 1, 3: 2}.get(base // 1000, 0)
        kind, size = base % 1000, 2 + extra

        def run(at: int, n: int) -> tuple[list, int]:
            flat = struct.unpack_from(f"{order}{n * size}d", data, at)
            return [(flat[i], flat[i + 1]) for i in range(0, n * size, size)], at + 8 * n * size

        if kind == 1:
            pts, at = run(at, 1)
            return "Point", [[p for p in pts if p[0] == p[0]]], at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        parts: list = []
        if kind == 2:
            pts, at = run(at, n)
            return "LineString", [pts], at
        for _ in range(n):
            if kind == 3:
                (m,) = struct.unpack_from(order + "I", data, at)
                pts, at = run(at + 4, m)
                parts.append(pts)
            else:
                _, inner, at = read(at)
                parts += inner
        return NAMES[kind], parts, at

    return read(0)[:2]


def encode(kind: str, parts: list[list[tuple[float, float]]]) -> bytes:
    """Little-endian WKB. A MultiPolygon's parts are rings of one polygon each."""
    code = {v: k for k, v in NAMES.items()}[kind]
    run = lambda pts: struct.pack(f"<{2 * len(pts)}d", *(v for p in pts for v in p))
    head = struct.pack("<BI", 1, code)
    if code == 1:
        return head + (run(parts[0][:1]) if parts and parts[0] else struct.pack("<2d", float("nan"), float("nan")))
    if code == 2:
        return head + struct.pack("<I", len(parts[0])) + run(parts[0])
    if code == 3:
        return head + struct.pack("<I", len(parts)) + b"".join(struct.pack("<I", len(p)) + run(p) for p in parts)
    inner = {4: "Point", 5: "LineString", 6: "Polygon"}[code]
    return head + struct.pack("<I", len(parts)) + b"".join(encode(inner, [p]) for p in parts)


@F.arrow_udf(PARTS)
def wkb_parts(data: pa.Array) -> pa.Array:
    rows = [None if b is None else [[{"x": x, "y": y} for x, y in part] for part in decode(b)[1]] for b in data.to_pylist()]
    return pa.array(rows, pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


@F.arrow_udf(T.BinaryType())
def line_wkb(path: pa.Array) -> pa.Array:
    """array<struct<x, y>> as a LineString, or a Point if it has one vertex."""
    pts = [None if p is None else [(q["x"], q["y"]) for q in p] for p in path.to_pylist()]
    return pa.array([None if p is None else encode("LineString" if len(p) > 1 else "Point", [p]) for p in pts], pa.binary())
