"""Column names: aliases, requirements, and time in microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The first of these that a table has holds the time, or the vessel.
TIME_NAMES = ("base_date_time", "timestamp")
VESSEL_NAMES = ("mmsi", "track_id")


def require(df: DataFrame, *names: str) -> DataFrame:
    """df, or a KeyError that lists what is missing and what there is."""
    if missing := [n for n in names if n not in df.columns]:
        raise KeyError(f"missing columns {missing}; available: {df.columns}")
    return df


def resolve(df: DataFrame, given: str | None, names: tuple[str, ...]) -> str:
    """The given column, or the first of names that df has."""
    if given:
        require(df, given)
        return given
    for n in names:
        if n in df.columns:
            return n
    raise KeyError(f"none of {list(names)} among {df.columns}")


def time_column(df: DataFrame, given: str | None = None) -> str:
    return resolve(df, given, TIME_NAMES)


def vessel_column(df: DataFrame, given: str | None = None) -> str:
    return resolve(df, given, VESSEL_NAMES)


def micros(c: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp, without regard to a zone. timestamp_diff would read both in the session's
    zone, where times that its clocks skip are moved by an hour."""
    c = F.col(c) if isinstance(c, str) else c
    since = c.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long")


def from_micros(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", c, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def nan_to_null(c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c))
