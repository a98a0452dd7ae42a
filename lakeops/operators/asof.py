"""As-of joins: for each row the latest earlier row of the other side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.slices import SLICE, SLICE_ROWS, SLICES, WHOLE, with_slices


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    times: tuple[str, str],
    columns: Sequence[str],
    strict: bool = False,
    within: str | None = None,
    slice_rows: int = SLICE_ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """All left rows with ``columns`` of the latest right row of the same key not after them.

    ``on`` maps left to right key columns and ``times`` names the time of each side (any ordered
    type). Of right rows at one instant the greatest by ``columns`` counts. With ``strict`` the right
    row must be earlier than the left one. ``within``, an interval such as ``"2 hours"``, leaves out
    matches that are older. Left rows without a match, a key or a time get nulls.

    The answer depends on key and time alone. So both sides are first reduced to their different
    instants, which are united and swept once per key by a window. A key with more than
    ``slice_rows`` instants is cut at quantiles of its times into up to ``slices`` ranges that are
    swept side by side; each begins with the last right row before it. Rows that share an instant
    only meet in the last join, an equi join whose hot keys adaptive execution splits.
    """
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if left.isStreaming or right.isStreaming:
        raise ValueError("an as-of join needs whole tables")
    keys = [f"__key_{i}" for i in range(len(on))]
    swept = _sweep(*_instants(left, right, on, times, columns, keys, strict), keys, slice_rows, slices)
    named = dict(zip(keys, on))
    same = [F.col(f"`{name}`") == F.col(key) for key, name in named.items()]
    condition = reduce(lambda a, b: a & b, same, F.col(f"`{times[0]}`") == F.col("__at"))
    found = F.col("__found")
    if within is not None:
        found = F.when(F.col("__at") - F.expr(f"interval {within}") <= F.col("__found.since"), found)
    joined = left.join(swept.select(*keys, "__at", found.alias("__found")), condition, "left")
    return joined.select(*[left[c] for c in left.columns], *[F.col(f"__found.row.`{c}`").alias(c) for c in columns])


def _instants(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    times: tuple[str, str],
    columns: Sequence[str],
    keys: Sequence[str],
    strict: bool,
) -> tuple[DataFrame, DataFrame]:
    """Different keys and times of both sides; ``__turn`` orders the sides at one time."""

    def placed(df: DataFrame, names: Sequence[str], time: str, *more: Column) -> DataFrame:
        named = [F.col(f"`{name}`").alias(key) for key, name in zip(keys, names)]
        rows = df.select(*named, F.col(f"`{time}`").alias("__at"), *more)
        return rows.na.drop(subset=[*keys, "__at"])

    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row")
    known = placed(right, list(on.values()), times[1], row).groupBy(*keys, "__at").agg(F.max("__row").alias("row"))
    known = known.select(
        *keys, "__at", F.lit(0 if not strict else 1).alias("__turn"),
        F.struct(F.col("__at").alias("since"), "row").alias("__known"),
    )
    asked = placed(left, list(on), times[0]).distinct()
    asked = asked.select(
        *keys, "__at", F.lit(1 if not strict else 0).alias("__turn"),
        F.lit(None).cast(known.schema["__known"].dataType).alias("__known"),
    )
    return asked, known


def _sweep(asked: DataFrame, known: DataFrame, keys: Sequence[str], slice_rows: int, slices: int) -> DataFrame:
    """Asked instants with the last known row (``__found``) up to them."""
    both, cut = with_slices(asked.unionAll(known), keys, "__at", slice_rows, slices)
    if not cut:
        return _last_known(both, Window.partitionBy(*keys).orderBy("__at", "__turn"))
    # Of a key that is cut, at most one row per range is carried on.
    tails = both.where((F.col(SLICE) != WHOLE) & F.col("__known").isNotNull()).groupBy(*keys, SLICE)
    tails = tails.agg(F.max_by("__known", "__at").alias("__known"))
    following = F.lead(SLICE, 1, slices - 1).over(Window.partitionBy(*keys).orderBy(SLICE))
    carried = tails.withColumn("__to", following).where(F.col("__to") > F.col(SLICE))
    carried = carried.withColumn(SLICE, F.explode(F.sequence(F.col(SLICE) + 1, F.col("__to"))))
    carried = carried.select(*keys, F.col("__known.since").alias("__at"), F.lit(-1).alias("__turn"), "__known", SLICE)
    rows = both.select(*keys, "__at", "__turn", "__known", SLICE).unionAll(carried)
    return _last_known(rows, Window.partitionBy(*keys, SLICE).orderBy("__at", "__turn"))


def _last_known(rows: DataFrame, order) -> DataFrame:
    last = F.last("__known", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__found", last).where(F.col("__known").isNull())
