"""Joins of two streams whose state expires."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakeops.streaming.windows import with_watermark


def join_streams(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    times: tuple[str, str],
    between: tuple[str, str],
    delays: tuple[str, str],
    how: str = "inner",
    salts: int = 1,
) -> DataFrame:
    """Pairs of left and right rows of one key whose right time lies around the left time.

    ``on`` maps left to right key columns, ``times`` names the time of each side and ``between`` the
    intervals from the left to the right time, both ends included, such as ``("0 seconds", "6
    hours")`` or ``("-1 hour", "1 hour")``. ``delays`` says how late rows of each side may be. ``how``
    is ``inner``, ``left_outer``, ``right_outer``, ``full_outer`` or ``left_semi``; an unmatched row
    comes out once the watermark rules out a partner. Columns of the two sides must differ in name.

    Both sides stay in state until the watermark, the earlier of the two sides', has passed all
    times they could meet at; rows that come later than that are left out. Times without a zone get the
    session's. Works on whole tables too, where nothing is late.

    A key held by a large part of a stream fills one task and one state store. ``salts`` spreads
    its left rows over as many copies of the right rows (not with ``right_outer`` or
    ``full_outer``, whose unmatched right rows would repeat). Like the number of shuffle partitions
    it is fixed for the life of a checkpoint.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if salts > 1 and how not in ("inner", "left_outer", "left_semi"):
        raise ValueError(f"salting would repeat unmatched rows of a {how} join")
    columns = left.columns if how == "left_semi" else [*left.columns, *right.columns]
    left = with_watermark(left, times[0], delays[0])
    right = with_watermark(right, times[1], delays[1])
    at, to = F.col(f"`{times[0]}`"), F.col(f"`{times[1]}`")
    low, high = (F.expr(f"interval {gap}") for gap in between)
    same = [F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in on.items()]
    if salts > 1:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
        left = left.withColumn("__salt", F.pmod(row, F.lit(salts)).cast("int"))
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same.append(F.col("__salt") == F.col("__copy"))
    condition = reduce(lambda a, b: a & b, [*same, to >= at + low, to <= at + high])
    return left.join(right, condition, how).select(*[F.col(f"`{c}`") for c in columns])


def drop_repeats(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key; a repetition no more than ``delay`` behind it is dropped.

    On a stream a key is forgotten once the watermark passes its first row's time by ``delay``, so state
    stays bounded however long the stream runs; which of several rows is first depends on
    arrival. Rows without a time, or later than the watermark allows, do not come out. A table
    keeps one row of each key.
    """
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    return with_watermark(df, time, delay).dropDuplicatesWithinWatermark(keys)
