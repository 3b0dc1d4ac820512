"""AIS messages as one JSON object per line, in a flat and a nested profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import null_sentinels

# fixed values: where a field is looked for, in order
PATHS = {
    "mmsi": ["mmsi", "track_id"],
    "track_id": ["track_id"],
    "base_date_time": ["timestamp"],
    "longitude": ["longitude", "data.longitude"],
    "latitude": ["latitude", "data.latitude"],
    "cog": ["cog", "data.cog"],
    "sog": ["sog", "data.sog"],
    "heading": ["heading", "data.heading"],
    "beam": ["beam", "data.beam"],
    "length": ["length", "data.length"],
    "draught": ["draught", "data.draught", "data.casco.draught"],
    "status": ["status", "data.status"],
    "shiptypeAIS": ["shiptypeAIS", "data.shiptypeAIS", "data.identification.shiptypeAIS"],
    "imo": ["imo", "data.identification.imo"],
    "name": ["name", "data.identification.name"],
    "callsign": ["callsign", "data.identification.callsign"],
}
NUMBERS = ("longitude", "latitude", "cog", "sog", "heading", "beam", "length", "draught")


_PARTS = ["to_bow", "to_stern", "to_port", "to_starboard"]


def _schema() -> T.StructType:
    """All paths as text, which for a member that is an object is its JSON: one parse of a line finds everything."""

    def struct(paths: list[list[str]]) -> T.StructType:
        heads = dict.fromkeys(p[0] for p in paths)
        below = {h: [p[1:] for p in paths if p[0] == h and len(p) > 1] for h in heads}
        return T.StructType([T.StructField(h, struct(below[h]) if below[h] else T.StringType()) for h in heads])

    every = [p for paths in PATHS.values() for p in paths] + [f"data.casco.{p}" for p in _PARTS]
    return struct([p.split(".") for p in every])


def leaf(raw: Column) -> Column:
    """A member's text: of an object its member value where it has one, even null, else its member code."""
    members = F.array(F.from_json(raw, T.MapType(T.StringType(), T.StringType())))
    unwrapped = F.transform(members, lambda m: F.when(F.map_contains_key(m, "value"), m["value"]).otherwise(m["code"]))[0]
    return F.when(F.startswith(raw, F.lit("{")), unwrapped).otherwise(raw)


def _number(text: Column) -> Column:
    n = text.try_cast("double")
    return F.when(~F.isnan(n), n)


def naive_utc(text: Column) -> Column:
    """ISO-8601 text as a time in UTC without zone, whatever the session's zone; text without a zone is in UTC."""
    bare = text.rlike(r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{1,2}:\d{2}(:\d{2}([.]\d*)?)?)?\s*$")
    day = F.length(F.trim(text)) == 10
    zoned = F.when(bare & day, F.concat(F.trim(text), F.lit("T00:00:00Z"))).when(bare, F.concat(F.trim(text), F.lit("Z"))).otherwise(text)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(F.to_timestamp(zoned))


def flatten(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Pings of lines of JSON. Missing beams and lengths are put together from distances to the antenna; blank lines are
    dropped, numbers that do not parse are null."""
    keep = keep or []
    first = {k: F.coalesce(*(leaf(F.col(f"_j.{p}")) for p in paths)) for k, paths in PATHS.items()}
    part = lambda name: _number(leaf(F.col(f"_j.data.casco.{name}")))
    cols = {k: _number(v) if k in NUMBERS else v for k, v in first.items()}
    cols["beam"] = F.coalesce(cols["beam"], part("to_port") + part("to_starboard"))
    cols["length"] = F.coalesce(cols["length"], part("to_bow") + part("to_stern"))
    cols["base_date_time"] = naive_utc(first["base_date_time"])
    for k in ("imo", "name", "callsign"):
        cols[k] = F.trim(cols[k])
    parsed = lines.where(F.trim(value) != "").select(*keep, F.from_json(value, _schema()).alias("_j"))
    rows = parsed.select(*keep, *(c.alias(k) for k, c in cols.items()))
    return null_sentinels(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of lines, compressed ones too; archives (.zip, and zips named .7z) are read by the zip source. An
    input without lines is an error."""
    if path.endswith((".zip", ".7z")):
        from . import archive

        lines = archive.read_lines(spark, path)
    else:
        lines = spark.read.text(path)
    if not lines.where(F.trim("value") != "").head(1):
        raise ValueError(f"{path} has no lines")
    return flatten(lines)
