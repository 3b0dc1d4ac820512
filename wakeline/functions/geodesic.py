"""Inverse geodesics on the WGS84 ellipsoid in numpy, and as an Arrow UDF."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: WGS84
A, FLATTENING = 6378137.0, 1 / 298.257223563
B = A * (1 - FLATTENING)


def inverse(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metres and forward azimuth in radians, by Vincenty's method. Pairs near antipodes, where it does not converge,
    get the great-circle distance scaled to the mean radius; NaN in, NaN out."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    d = lon2 - lon1
    d = (d + np.pi) % (2 * np.pi) - np.pi
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(lat1)), np.arctan((1 - FLATTENING) * np.tan(lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam, done = d.copy(), np.zeros(d.shape, bool)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss > 0, c1 * c2 * sl / np.where(ss > 0, ss, 1), 0)
            ca2 = 1 - sa**2
            cm = np.where(ca2 > 0, cs - 2 * s1 * s2 / np.where(ca2 > 0, ca2, 1), 0)
            c = FLATTENING / 16 * ca2 * (4 + FLATTENING * (4 - 3 * ca2))
            new = d + (1 - c) * FLATTENING * sa * (sigma + c * ss * (cm + c * cs * (2 * cm**2 - 1)))
            done = np.abs(new - lam) < 1e-12
            lam = new
            if np.all(done | ~np.isfinite(new)):
                break
        us = ca2 * (A**2 - B**2) / B**2
        ka = 1 + us / 16384 * (4096 + us * (us * (320 - 175 * us) - 768))
        kb = us / 1024 * (256 + us * (us * (74 - 47 * us) - 128))
        ds = kb * ss * (cm + kb / 4 * (cs * (2 * cm**2 - 1) - kb / 6 * cm * (4 * ss**2 - 3) * (4 * cm**2 - 3)))
        far = B * ka * (sigma - ds)
        azimuth = np.arctan2(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
        a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin(d / 2) ** 2
        circle = 2 * (2 * A + B) / 3 * np.arcsin(np.minimum(1, np.sqrt(a)))
    return np.where(done, far, circle), azimuth


def local_plane(lon: np.ndarray, lat: np.ndarray, lon0: float, lat0: float) -> tuple[np.ndarray, np.ndarray]:
    """Metres east and north of a centre in the azimuthal equidistant projection."""
    s, az = inverse(np.full(len(lon), lon0), np.full(len(lat), lat0), lon, lat)
    return s * np.sin(az), s * np.cos(az)


@F.arrow_udf(T.DoubleType())
def _distance(lon1: pa.Array, lat1: pa.Array, lon2: pa.Array, lat2: pa.Array) -> pa.Array:
    given = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (lon1, lat1, lon2, lat2)]
    metres = inverse(*given)[0]
    return pa.array(metres, mask=np.isnan(metres))


def geodesic(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Ellipsoidal metres; null if any coordinate is."""
    return _distance(lon1, lat1, lon2, lat2)


def register(spark) -> None:
    """Makes geodesic_m(lon1, lat1, lon2, lat2) and hull_area(points) known to SQL."""
    from .hull import hull_area

    spark.udf.register("geodesic_m", _distance)
    spark.udf.register("hull_area", hull_area)
