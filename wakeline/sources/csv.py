"""Danish AIS CSV files, also in plain zip archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import null_sentinels

# fixed values: columns of the files (source, name, type)
COLUMNS = [
    ("# Timestamp", "base_date_time", "string"),
    ("MMSI", "mmsi", "bigint"),
    ("Latitude", "latitude", "double"),
    ("Longitude", "longitude", "double"),
    ("Navigational status", "status", "string"),
    ("SOG", "sog", "double"),
    ("COG", "cog", "double"),
    ("Heading", "heading", "double"),
    ("Width", "beam", "double"),
    ("Length", "length", "double"),
    ("Draught", "draught", "double"),
    ("Ship type", "shiptypeAIS", "string"),
]


def _typed(raw: DataFrame, keep: list[str]) -> DataFrame:
    cols = []
    for source, name, kind in COLUMNS:
        text = F.nullif(F.trim(F.col(f"`{source}`")), F.lit(""))
        value = F.try_to_timestamp(text, F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz") if name == "base_date_time" else text if kind == "string" else text.try_cast(kind)
        cols.append(value.alias(name))
    return null_sentinels(raw.select(*keep, *cols))


def parse(lines: DataFrame, header: list[str], keep: list[str] | None = None, value: str = "value") -> DataFrame:
    """Lines of text as pings; the columns in `keep` stay. Times that do not parse are null."""
    fields = ", ".join(f"`{h}` STRING" for h in header)
    return _typed(lines.select(*(keep or []), F.from_csv(value, fields).alias("_r")).select(*(keep or []), "_r.*"), keep or [])


def read(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder; .zip archives are read by the zip source, one task for each."""
    if path.endswith(".zip"):
        from . import archive

        lines = archive.read_lines(spark, path)
        header = archive.first_line(path).split(",")
        return parse(lines.where(~F.startswith("value", F.lit("# Timestamp"))), [h.strip() for h in header])
    return _typed(spark.read.option("header", True).csv(path).select(*(f"`{c}`" for c, _, _ in COLUMNS)), [])
