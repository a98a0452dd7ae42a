"""Sums over explicit window frames, on groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.joins import fits_broadcast, join_groups
from lakeops.operators.slices import SLICE, SLICE_ROWS, SLICES, WHOLE, with_slices
from lakeops.session import shared_dir
from lakeops.sources.tables import read_table, write_table

AT, SUM, ROWS = "__at", "__sum", "__rows"


def _steps(df: DataFrame, keys: Sequence[str], order: str, value: str) -> tuple[DataFrame, list[str]]:
    """One row per group and ``order`` with the sum and number of its rows, written once, and its key columns."""
    folder = shared_dir(df.sparkSession, "steps")
    names = [f"__key_{i}" for i in range(len(keys))]
    given = [F.col(f"`{key}`").alias(name) for key, name in zip(keys, names)]
    steps = df.groupBy(*given, F.col(f"`{order}`").alias(AT)).agg(F.sum(f"`{value}`").alias(SUM), F.count("*").alias(ROWS))
    write_table(steps, folder)
    return read_table(df.sparkSession, folder), names


def _with_steps(
    df: DataFrame, steps: DataFrame, found: DataFrame, keys: Sequence[str], order: str, results: dict[str, str]
) -> DataFrame:
    """Each row with what was ``found`` for its step, under the names of ``results``.

    Steps measured to be small are broadcast, so rows are not moved; else both sides are merged, where
    adaptive execution splits a step of many rows.
    """
    found = found.select(*[f"__key_{i}" for i in range(len(keys))], AT, *[F.col(c).alias(f"__out_{c}") for c in results.values()])
    condition = F.col(f"`{order}`").eqNullSafe(F.col(AT))
    for i, key in enumerate(keys):
        condition &= F.col(f"`{key}`").eqNullSafe(F.col(f"__key_{i}"))
    joined = df.join(F.broadcast(found) if fits_broadcast(steps) else found.hint("merge"), condition, "left")
    out = {c: F.col(f"`{c}`") for c in df.columns} | {name: F.col(f"__out_{c}") for name, c in results.items()}
    return joined.select(*[column.alias(name) for name, column in out.items()])


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    name: str = "total",
    slice_rows: int = SLICE_ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """Each row with the sum of ``value`` over its group's rows up to its place in ``order``.

    Rows of equal order count together (a RANGE frame from the start of the group), so the result
    does not depend on how ties are sorted. Nulls in ``order`` come first; a null value adds
    nothing, and the sum is null until a value has come. Rows of equal order are summed first, and frames
    run over these sums. A group of many is cut into ranges of ``order``: each range is summed by itself
    and begins with the sum of the ranges before it.
    """
    steps, names = _steps(df, keys, order, value)
    kind = steps.schema[SUM].dataType
    rows, cut = with_slices(steps, names, AT, slice_rows, slices)
    here = Window.partitionBy(*names, SLICE).orderBy(AT).rangeBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn(SUM, F.sum(SUM).over(here).cast(kind))
    if cut:
        parts = rows.groupBy(*names, SLICE).agg(F.sum(SUM).alias("__part"))
        before = Window.partitionBy(*names).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("__before", F.sum("__part").over(before)).drop("__part")
        joined = join_groups(summed, parts, [*names, SLICE], "left")
        total = F.when(F.col(SUM).isNull(), F.col("__before")).otherwise(F.col(SUM) + F.coalesce("__before", F.lit(0)))
        summed = joined.withColumn(SUM, total.cast(kind))
    return _with_steps(df, steps, summed, keys, order, {name: SUM})


def moving_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    back: int,
    name: str = "total",
    count: str | None = None,
    slice_rows: int = SLICE_ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """Each row with the sum of ``value`` over its group's rows whose ``order`` is at most ``back`` lower.

    ``order`` is a whole number (seconds, days, a sequence); ties count together and rows without an
    order make a frame of their own. ``count`` names a column for the number of rows in the frame.
    Rows of equal order are summed first, and frames run over these sums. A group of many is cut into ranges;
    each also gets copies of the earlier sums that its first frames reach back to, which are not returned.
    """
    steps, names = _steps(df, keys, order, value)
    kind = steps.schema[SUM].dataType
    rows, cut = with_slices(steps, names, AT, slice_rows, slices)
    frame = Window.partitionBy(*names, SLICE).orderBy(AT).rangeBetween(-back, 0)
    sums: dict[str, Column] = {SUM: F.sum(SUM).over(frame).cast(kind), ROWS: F.sum(ROWS).over(frame)}
    if cut:
        firsts = rows.where((F.col(SLICE) != WHOLE) & F.col(AT).isNotNull()).groupBy(*names, SLICE).agg(F.min(AT).alias("first"))
        listed = firsts.groupBy(*names).agg(F.collect_list(F.struct(SLICE, "first")).alias("__firsts"))  # at most one per range
        reached = F.filter("__firsts", lambda s: (s[SLICE] > F.col(SLICE)) & (s["first"] - back <= F.col(AT)))
        copied = join_groups(rows, listed, names).withColumn("__to", F.explode(F.transform(reached, lambda s: s[SLICE])))
        copied = copied.withColumn(SLICE, F.col("__to")).select(*steps.columns, SLICE, F.lit(True).alias("__copy"))
        rows = rows.select(*steps.columns, SLICE, F.lit(False).alias("__copy")).unionAll(copied)
    found = rows.withColumns(sums)
    found = found.where(~F.col("__copy")) if cut else found
    return _with_steps(df, steps, found, keys, order, {name: SUM} | ({count: ROWS} if count else {}))
