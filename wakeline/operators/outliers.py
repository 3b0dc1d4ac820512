"""Removal of position outliers: jumps that are both too fast and too far.

Two modes. "iterative": up to `passes` times all points are dropped whose jump from the previous surviving point is
bad, so the return from a spike goes with it. "anchor": a walk along the track that keeps a point only if the jump from
the last kept one is fine. Two distances: "haversine" runs as window functions alone (one shuffle, one sort for all
passes); "geodesic" runs as an Arrow kernel on the ellipsoid for each run of a vessel's pings without a very long pause.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesic as g
from ..functions.geometry import haversine
from ..schema import micros, time_column, vessel_column

#: Metres: no two places are farther apart.
HALFWAY = 20_037_509.0


def _seconds(time: str):
    """Whole seconds, as the rule counts them."""
    return F.floor(micros(time) / 1_000_000)


def filter_outliers(df: DataFrame, vessel: str | None = None, time: str | None = None, lon: str = "longitude", lat: str = "latitude", v_max: float = 50.0, d_min: float = 300.0, mode: str = "iterative", distance: str = "geodesic", passes: int = 10, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows that survive, per vessel in time order; speeds in m/s, distances in metres, equal times count as infinitely
    fast. Rows of a null vessel stay. ties: further columns that order equal times."""
    vessel, time = vessel_column(df, vessel), time_column(df, time)
    if mode == "iterative" and distance == "haversine":
        return _windows(df, vessel, time, lon, lat, v_max, d_min, passes, ties)
    return _kernel(df, vessel, time, lon, lat, v_max, d_min, mode, distance, passes, ties)


def _windows(df: DataFrame, vessel: str, time: str, lon: str, lat: str, v_max: float, d_min: float, passes: int, ties: tuple[str, ...]) -> DataFrame:
    d = df.withColumn("_s", _seconds(time))
    order = Window.partitionBy(vessel).orderBy(time, lon, lat, *ties)
    for _ in range(passes):
        before = {c: F.lag(c).over(order) for c in ("_s", lon, lat)}
        d = d.withColumns({"_dt": F.col("_s") - before["_s"], "_d": haversine(before[lon], before[lat], F.col(lon), F.col(lat))})
        bad = F.col(vessel).isNotNull() & (F.col("_d") > d_min) & ((F.col("_dt") <= 0) | (F.col("_d") > v_max * F.col("_dt")))
        d = d.where(~F.coalesce(bad, F.lit(False)))
    return d.drop("_s", "_dt", "_d")


def _kernel(df: DataFrame, vessel: str, time: str, lon: str, lat: str, v_max: float, d_min: float, mode: str, distance: str, passes: int, ties: tuple[str, ...]) -> DataFrame:
    def metres(x0, y0, x1, y1):
        if distance == "geodesic":
            return g.inverse(x0, y0, x1, y1)[0]
        a = np.sin(np.radians(y1 - y0) / 2) ** 2 + np.cos(np.radians(y0)) * np.cos(np.radians(y1)) * np.sin(np.radians(x1 - x0) / 2) ** 2
        return 2 * 6371008.8 * np.arcsin(np.minimum(1, np.sqrt(a)))

    def bad(s, x, y, i, j):
        d, dt = metres(x[i], y[i], x[j], y[j]), s[j] - s[i]
        return (d > d_min) & ((dt <= 0) | (d > v_max * dt))

    def walk(s, x, y) -> np.ndarray:
        """Rows that a walk keeps: runs whose links are all fine at once, and after a bad link the next row that fits."""
        links = np.concatenate(([False], bad(s, x, y, np.arange(len(s) - 1), np.arange(1, len(s)))))
        stops, kept, at = np.flatnonzero(links), np.zeros(len(s), bool), 0
        while at < len(s):
            k = np.searchsorted(stops, at, "right")
            end = int(stops[k]) if k < len(stops) else len(s)
            kept[at:end] = True
            last, at = end - 1, end
            while at < len(s):
                some = np.arange(at, min(at + 256, len(s)))
                fits = np.flatnonzero(~bad(s, x, y, np.full(len(some), last), some))
                if len(fits):
                    at = int(some[fits[0]])
                    break
                at = int(some[-1]) + 1
        return np.flatnonzero(kept)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in (time, lon, lat, *ties)])
        s, x, y = (table[c].to_numpy() for c in ("_s", lon, lat))
        keep = np.arange(table.num_rows)
        if table[vessel].null_count == 0:
            x, y = x.astype(float), y.astype(float)
            if mode == "anchor":
                keep = walk(s, x, y)
            else:
                for _ in range(passes):
                    wrong = np.concatenate(([False], bad(s, x, y, keep[:-1], keep[1:])))
                    if not wrong.any():
                        break
                    keep = keep[~wrong]
        return table.take(pa.array(keep)).drop_columns(["_s", "_island"])

    # no jump over a pause in which v_max reaches the antipode is too fast: what lies beyond stands on its own
    order = Window.partitionBy(vessel).orderBy(time, lon, lat, *ties)
    d = df.withColumn("_s", _seconds(time).cast("double"))
    pause = F.coalesce(F.col("_s") - F.lag("_s").over(order) > HALFWAY / max(v_max, 1e-9), F.lit(False))
    # rows of a null vessel are not compared, so they need not lie together
    d = d.withColumn("_island", F.when(F.col(vessel).isNull(), F.pmod(F.xxhash64(time, lon, lat), F.lit(1 << 16))).otherwise(F.sum(pause.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    return d.groupBy(vessel, "_island").applyInArrow(run, df.schema)
