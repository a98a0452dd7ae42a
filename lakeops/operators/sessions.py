"""Sessions of whole tables: rows of a group that follow one another closely enough."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.operators.joins import join_groups


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap: str | Column,
    count_name: str = "cnt",
    sums: Mapping[str, str] | None = None,
    slice: str = "1 day",
) -> DataFrame:
    """``window_start``, ``window_end`` and number of rows of every session of a group.

    A row reaches from its time to ``gap`` later; the gap is an interval, or a column that gives each row
    its own. Rows of a group whose reaches touch or overlap form a session. ``sums`` maps
    result names to number columns added up. Rows without a time, or with a gap that is null or not
    positive, belong to no session. A null key is a key.

    A group with many rows is cut into time slices, which are combined before they are shuffled and
    whose sessions are found side by side. Only sessions that touch another one across the end of
    a slice are merged afterwards, along one window per group.
    """
    sums = dict(sums or {})
    totals = {count_name: F.count("*"), **{name: F.sum(f"`{column}`") for name, column in sums.items()}}
    cut = df.withColumn("__slice", F.window(time, slice)["start"])
    pieces = (
        cut.groupBy(*keys, "__slice", F.session_window(time, gap).alias("__session"))
        .agg(*[total.alias(name) for name, total in totals.items()])
        .select(
            *keys, "__slice", F.col("__session")["start"].alias("window_start"),
            F.col("__session")["end"].alias("window_end"), *totals,
        )
    )
    order = Window.partitionBy(*keys).orderBy("__slice")
    edges = pieces.groupBy(*keys, "__slice").agg(F.min("window_start").alias("__first"), F.max("window_end").alias("__last"))
    edges = edges.select(
        *keys,
        "__slice",
        F.max("__last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__reached"),
        F.lead("__first").over(order).alias("__next"),
    )
    marked = join_groups(pieces, edges, [*keys, "__slice"])
    touched = F.coalesce(F.col("window_start") <= F.col("__reached"), F.lit(False)) | F.coalesce(
        F.col("window_end") >= F.col("__next"), F.lit(False)
    )
    columns = [*keys, "window_start", "window_end", *totals]
    along = Window.partitionBy(*keys).orderBy("window_start", "window_end")
    before = F.max("window_end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("window_start") > before, F.lit(True)).cast("long")
    linked = (
        marked.where(touched)
        .withColumn("__begins", begins)
        .withColumn("__island", F.sum("__begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__island")
        .agg(
            F.min("window_start").alias("window_start"),
            F.max("window_end").alias("window_end"),
            *[F.sum(name).alias(name) for name in totals],
        )
    )
    return marked.where(~touched).select(*columns).unionAll(linked.select(*columns))
