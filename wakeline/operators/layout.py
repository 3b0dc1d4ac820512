"""Ordering tables in space and time, and their bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout
from ..schema import micros


def bounds(df: DataFrame, x: str = "longitude", y: str = "latitude", time: str = "base_date_time") -> dict[str, tuple[float, float]]:
    """Smallest and largest x, y and whole second, in one aggregation."""
    r = df.agg(*(f(c).alias(f"{n}{k}") for n, c in (("x", F.col(x)), ("y", F.col(y)), ("t", F.floor(micros(time) / 1_000_000))) for k, f in (("0", F.min), ("1", F.max)))).head()
    if r["x0"] is None:
        raise ValueError("no rows to take bounds of")
    return {n: (r[f"{n}0"], r[f"{n}1"]) for n in ("x", "y", "t")}


def space_time_index(df: DataFrame, box: dict[str, tuple[float, float]] | None = None, p: int = 16, x: str = "longitude", y: str = "latitude", time: str = "base_date_time", out: str = "space_time") -> DataFrame:
    box = box or bounds(df, x, y, time)
    return df.withColumn(out, layout.space_time_key(F.col(x), F.col(y), F.floor(micros(time) / 1_000_000), box, p))


def cluster(df: DataFrame, partitions: int, key: str = "space_time") -> DataFrame:
    """Rows in ranges of the key, sorted: files written from it have narrow bounds, which scans skip by."""
    return df.repartitionByRange(partitions, key).sortWithinPartitions(key)


def partition_bounds(df: DataFrame, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """The box of each partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.min(x).alias("min_x"), F.max(x).alias("max_x"), F.min(y).alias("min_y"), F.max(y).alias("max_y"), F.count("*").alias("rows"))
