"""Cutting large groups into ranges of their order, so that windows over them run side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.operators.joins import join_dimension
from lakeops.session import shared_dir
from lakeops.sources.tables import read_table, write_table

# Rows of a group that one task sorts, and ranges a group with more of them is cut into.
SLICE_ROWS = 1_000_000
SLICES = 256
SLICE = "__slice"
WHOLE = -1


def with_slices(
    rows: DataFrame, keys: Sequence[str], order: str, slice_rows: int = SLICE_ROWS, slices: int = SLICES
) -> tuple[DataFrame, bool]:
    """Rows with the number ``__slice`` of their range within their group, and whether any group is cut.

    Groups of more than ``slice_rows`` rows are cut at quantiles of ``order`` into up to ``slices``
    ranges, from 0; the others, and a group with a null key, are one range, -1. Rows of equal order
    share a range, a later range holds greater values only, and rows without an order are in
    the first. The cuts are written once, so every branch of a plan reads the same ones.
    """
    folder = shared_dir(rows.sparkSession, "slices")
    shares = F.lit([i / slices for i in range(1, slices)])
    some = rows.where(F.col(f"`{order}`").isNotNull())
    write_table(
        some.groupBy(*keys)
        .agg(F.count("*").alias("__n"), F.percentile_approx(order, shares, 10 * slices).alias("__cuts"))
        .where(F.col("__n") > slice_rows)
        .drop("__n"),
        folder,
    )
    cuts = read_table(rows.sparkSession, folder)
    if cuts.isEmpty():
        return rows.withColumn(SLICE, F.lit(WHOLE)), False
    named = {key: f"__cut_{i}" for i, key in enumerate(keys)}
    plain = cuts.na.drop(subset=list(keys)).withColumnsRenamed(named)
    cut = join_dimension(rows, plain, named).drop(*named.values())
    below = F.size(F.filter("__cuts", lambda c: c < F.col(f"`{order}`")))
    place = F.when(F.col("__cuts").isNull(), WHOLE).otherwise(F.coalesce(below, F.lit(0)))
    return cut.withColumn(SLICE, place).drop("__cuts"), True
