"""Small numeric expressions shared by operators and jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def duration_days(
    years: Column, months: Column, days: Column, weeks: Column | None = None
) -> Column:
    """Length in days, counting 365 days a year, 30 a month and 7 a week."""
    total = years * 365 + months * 30
    if weeks is not None:
        total = total + weeks * 7
    return total + days


def ratio(part: Column, whole: Column, scale: float = 1.0, digits: int | None = 2) -> Column:
    """``scale * part / whole`` as a double, null where ``whole`` is 0, rounded to ``digits``."""
    value = F.try_divide(F.lit(float(scale)) * part, whole)
    return value if digits is None else F.round(value, digits)


def uniform(seed: int, *key: Column, draw: int = 0) -> Column:
    """Number in [0, 1) that depends only on ``seed``, ``draw`` and ``key``.

    The same row gets the same number after a retry, a repartition or a lost executor. Several
    draws of a row differ by ``draw``, so neighbouring seeds share none. Nulls, which the hash
    itself skips, count by their place in the key.
    """
    absent = F.lit(0).cast("long")
    for place, column in enumerate(key):
        absent = absent + F.when(column.isNull(), F.lit(1 << place)).otherwise(0).cast("long")
    start = [F.lit(seed).cast("long"), F.lit(draw).cast("long"), absent]
    bits = F.shiftrightunsigned(F.xxhash64(*start, *key), 11)
    return bits * F.lit(2.0**-53)


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Straight-line distance in the units of the coordinates (degrees stay degrees)."""
    return F.sqrt(F.pow(x2 - x1, F.lit(2.0)) + F.pow(y2 - y1, F.lit(2.0)))


def within_radius(x: Column, y: Column, centre: tuple[float, float], radius: float) -> Column:
    """Whether a point lies in the circle; null for a null coordinate, false for NaN."""
    return planar_distance(F.lit(centre[0]), F.lit(centre[1]), x, y) <= F.lit(radius)
