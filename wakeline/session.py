"""A Spark session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions import geodesic


def session(app: str = "wakeline", master: str | None = None, **conf: object) -> SparkSession:
    """AQE with skew joins and coalescing, UTC, Kryo; further settings by keyword, with dots as double underscores. SQL
    knows geodesic_m and hull_area.

    Shuffle partitions start high where AQE coalesces them, so that tasks stay small at 100 TB.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    } | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    geodesic.register(spark)
    return spark
