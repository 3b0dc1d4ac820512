"""Speeds and vessel groups as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: AIS ship-type codes (first, last, group)
TYPE_GROUPS = [
    (30, 30, "Fishing"),
    (31, 32, "Tug"),
    (52, 52, "Tug"),
    (35, 35, "Military"),
    (36, 37, "Pleasure Craft/Sailing"),
    (60, 69, "Passenger"),
    (70, 79, "Cargo"),
    (80, 89, "Tanker"),
]
#: Speeds of at least this many knots mean "not available"; the largest real one, and how near to it counts as it.
SOG_INVALID, SOG_MOST, SOG_NEAR = 102.3, 102.2, 0.05 + 1e-5 * 102.2


def clean_sog(sog: Column, raw_units: bool = False) -> Column:
    """Knots: raw tenths divided by 10, invalid ones null, those about the largest set to it."""
    s = sog.cast("double") / 10 if raw_units else sog.cast("double")
    return F.when(F.isnan(s) | (s >= SOG_INVALID), None).when(F.abs(s - SOG_MOST) <= SOG_NEAR, SOG_MOST).otherwise(s)


def vessel_group(code: Column, mapping: dict | None = None) -> Column:
    """The group of a ship-type code or label. Codes count by their whole part; a mapping (whole numbers and lower-case
    labels to groups) goes before the fixed groups; null, empty and unknown ones are Other."""
    text = F.trim(code.cast("string"))
    number = text.try_cast("double")
    whole = F.when((number > -1e9) & (number < 1e9), number.cast("long"))
    given = F.lit(None).cast("string")
    label = F.lit(None).cast("string")
    if mapping:
        numbers = {k: v for k, v in mapping.items() if not isinstance(k, str)}
        labels = {k: v for k, v in mapping.items() if isinstance(k, str)}
        if numbers:
            given = F.element_at(F.create_map(*(F.lit(x) for k, v in numbers.items() for x in (int(k), v))), whole.cast("int"))
        if labels:
            label = F.element_at(F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)), F.lower(text))
    fixed = F.lit(None).cast("string")
    for first, last, group in TYPE_GROUPS:
        fixed = F.when(whole.between(first, last), group).otherwise(fixed)
    return F.when(text.isNull() | (text == "") | (whole == 0), "Other").when(number.isNotNull(), F.coalesce(given, fixed, F.lit("Other"))).otherwise(F.coalesce(label, F.lit("Other")))


def interpolated_speed(s0: Column, s1: Column, share: Column) -> Column:
    """Speed at a share of the way; an end that is null or 102.2 or more takes the other's, both such give null."""
    ok = lambda s: F.when(~F.isnan(s) & (s < SOG_MOST), s)
    a, b = F.coalesce(ok(s0), ok(s1)), F.coalesce(ok(s1), ok(s0))
    return a + share * (b - a)
