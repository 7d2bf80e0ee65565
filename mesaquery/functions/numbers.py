"""Numeric, geographic, date and hash functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounding to even at ties, as doubles."""
    return F.bround(x.cast("double"), digits)


def ramp(x: Column, low: float | Column, high: float | Column) -> Column:
    """0 at ``low`` to 100 at ``high``, clamped, in either direction; 100 for equal bounds; null for null."""
    low, high = (b if isinstance(b, Column) else F.lit(float(b)) for b in (low, high))
    part = F.least(F.greatest(F.try_divide(x - low, high - low) * 100, F.lit(0.0)), F.lit(100.0))
    return F.when(x.isNull(), None).when(low == high, F.lit(100.0)).otherwise(part)


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def walk_minutes(metres: Column, detour: float = 1.3, per_minute: float = 80.0) -> Column:
    return half_even(metres * detour / per_minute).cast("int")


def shrink(mean: Column, votes: Column, prior: Column, weight: float = 150.0) -> Column:
    """A mean pulled towards a prior that counts as ``weight`` votes."""
    return (votes * mean + weight * prior) / (votes + weight)


def valid_date(text: Column) -> Column:
    """A date, or null where the text isn't one."""
    return F.try_to_date(text, "yyyy-MM-dd")


def days_left(end: Column, today: Column) -> Column:
    """Days from today to a date, 0 if it has passed."""
    return F.greatest(F.lit(0), F.date_diff(end, today))


def weekday(day: Column) -> Column:
    """0 on Sunday to 6 on Saturday, of a date or of the date of a time."""
    return F.dayofweek(day) - 1


def days_after(day: Column, n: Column | int) -> Column:
    """The date ``n`` days on; an unreal text is null."""
    return F.date_add(day.try_cast("date"), n if isinstance(n, Column) else F.lit(n))


def date_range(start: Column, end: Column) -> Column:
    """All dates from start to end; empty if end comes first, where ``sequence`` would run backwards."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def shard(key: Column, shards: int) -> Column:
    """md5 of a key, as a 128-bit number, modulo ``shards``: folded by byte, as no type holds it."""
    digits = F.md5(key.cast("string").cast("binary"))
    steps = F.transform(F.sequence(F.lit(1), F.lit(31), F.lit(2)), lambda i: F.conv(F.substr(digits, i, F.lit(2)), 16, 10).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: (a * 256 + x) % shards)


def numeric_sorted(values: Column) -> Column:
    """Distinct strings in the order of the first number in them."""
    keyed = F.transform(F.array_distinct(values), lambda v: F.struct(F.try_to_number(F.regexp_extract(v, r"(\d+)", 1), F.lit("999999999")).alias("n"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])
