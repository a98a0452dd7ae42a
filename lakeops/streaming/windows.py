"""Event-time window aggregates, the same for batch frames and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def with_watermark(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    """Declare how late rows may be; needed to bound state, and to use ``append`` output.

    Rows later than that are left out in ``append`` and ``update`` mode. Without a delay every
    row counts and all windows stay in state. Times without a zone get the session's.
    """
    if delay is None:
        return df
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def _as_given(result: DataFrame, df: DataFrame, time: str) -> DataFrame:
    """Windows with the type of the time they were made from, whether or not a watermark was set."""
    kind = df.schema[time].dataType.simpleString()
    if kind not in ("timestamp", "timestamp_ntz"):
        return result
    return result.withColumn("window", F.col("window").cast(f"struct<start:{kind},end:{kind}>"))


def tumbling_counts(
    df: DataFrame,
    time: str,
    width: str,
    keys: Sequence[str] = (),
    count_name: str = "cnt",
    watermark: str | None = None,
) -> DataFrame:
    """Rows per time window and keys. Rows without a time belong to no window."""
    timed = with_watermark(df, time, watermark)
    counts = timed.groupBy(F.window(time, width).alias("window"), *keys).agg(
        F.count("*").alias(count_name)
    )
    return _as_given(counts, df, time)


def session_counts(
    df: DataFrame,
    time: str,
    gap: str | Column,
    keys: Sequence[str] = (),
    count_name: str = "cnt",
    watermark: str | None = None,
) -> DataFrame:
    """Rows per session and keys: rows whose times, each with the ``gap`` behind it, touch or overlap.

    The gap is an interval, or a column that gives each row its own. Rows without a time, or with a gap
    that is null or not positive, belong to no session. For streams, in ``append`` mode (which
    needs a watermark) or ``complete`` mode; for whole tables with hot keys see
    :func:`lakeops.operators.sessions.sessions`.
    """
    timed = with_watermark(df, time, watermark)
    counts = timed.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(F.count("*").alias(count_name))
    return _as_given(counts, df, time)


def window_status(
    df: DataFrame,
    time: str,
    width: str,
    predicate: Column,
    threshold: int,
    labels: tuple[str, str] = ("unsafe", "safe"),
    name: str = "status",
    hits_name: str = "hits",
    watermark: str | None = None,
) -> DataFrame:
    """First label for windows with at least ``threshold`` rows meeting ``predicate``, else second."""
    timed = with_watermark(df, time, watermark)
    hits = timed.groupBy(F.window(time, width).alias("window")).agg(
        F.count_if(predicate).alias(hits_name)
    )
    status = F.when(F.col(hits_name) >= threshold, labels[0]).otherwise(labels[1])
    return _as_given(hits.withColumn(name, status), df, time)


def flatten_window(df: DataFrame, window: str = "window") -> DataFrame:
    """Columns ``window_start`` and ``window_end`` in place of the window struct."""
    others = [F.col(f"`{c}`") for c in df.columns if c != window]
    return df.select(
        F.col(window)["start"].alias("window_start"), F.col(window)["end"].alias("window_end"), *others
    )
