"""Ranking within groups and changes between periods.

Ranks with ties depend only on the distinct values of a group, so they are computed on those and
joined back. Row counts have few distinct values: n rows can show at most about sqrt(2n) different
counts, which keeps the window of even the largest group small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.numbers import ratio
from lakeops.functions.temporal import minute_of_day
from lakeops.operators.joins import join_groups
from lakeops.operators.shares import count_by


def top_k_per_group(
    df: DataFrame, group: Sequence[str], by: str, k: int, rank_name: str = "ranking"
) -> DataFrame:
    """Rows whose ``by`` is among the ``k`` highest distinct values of their group.

    Ties share a rank without gaps, so more than ``k`` rows may return.
    """
    window = Window.partitionBy(*group).orderBy(F.desc(by))
    ranks = (
        df.select(*group, by)
        .distinct()
        .withColumn(rank_name, F.dense_rank().over(window))
        .where(F.col(rank_name) <= k)
    )
    return join_groups(df, ranks, [*group, by])


def rank_counts(
    counts: DataFrame,
    group: str,
    k: int,
    share: Column,
    share_name: str = "percentage",
    rank_name: str = "ranking",
    rank_by_share: bool = False,
) -> DataFrame:
    """Top ``k`` counts of each group with the share of the group they stand for.

    ``counts`` has ``group``, other key columns and ``cnt``. ``share`` is built from ``cnt`` and
    ``total`` (the rows of the group). Ranking is by ``cnt``, or by the computed share where
    ``rank_by_share`` is set. Adds ``total``, ``share_name`` and ``rank_name``.
    """
    order = share_name if rank_by_share else "cnt"
    same_count = counts.groupBy(group, "cnt").agg(F.sum("cnt").alias("__rows"))
    ranks = (
        same_count.withColumn("total", F.sum("__rows").over(Window.partitionBy(group)))
        .withColumn(share_name, share)
        .withColumn(
            rank_name, F.dense_rank().over(Window.partitionBy(group).orderBy(F.desc(order)))
        )
        .where(F.col(rank_name) <= k)
        .drop("__rows")
    )
    return join_groups(counts, ranks, [group, "cnt"])


def top_k_shares(
    df: DataFrame,
    group: str,
    category: str,
    k: int,
    share_name: str = "percentage",
    rank_name: str = "ranking",
) -> DataFrame:
    """The ``k`` most frequent categories of each group and their percentage of the group."""
    share = ratio(F.col("cnt"), F.col("total"), 100.0)
    return rank_counts(count_by(df, [group, category]), group, k, share, share_name, rank_name)


def change_over_time(
    df: DataFrame,
    entity: str,
    period: str,
    between: tuple[int, int],
    names: Sequence[str] = ("cnt", "share", "change"),
) -> DataFrame:
    """Rows, share and change of share of each entity and period, within a range of periods.

    The change is against the entity's previous present period and null for its first; shares
    count rows without an entity, which do not appear themselves. One entity holds at most one
    row per whole number in ``between``, which bounds its window. Nothing runs before the result is
    used; both branches read one exchange, because rows without an entity stay until the end.
    """
    count_name, share_name, change_name = names
    counts = count_by(df.where(F.col(period).between(*between)), [entity, period], count_name)
    totals = counts.groupBy(period).agg(F.sum(count_name).alias("__total"))
    shares = join_groups(counts, totals, [period]).withColumn(
        share_name, ratio(F.col(count_name), F.col("__total"), 100.0)
    )
    previous = F.lag(share_name).over(Window.partitionBy(entity).orderBy(period))
    change = F.round(F.col(share_name) - previous, 2).alias(change_name)
    changes = shares.select(F.struct(period, entity, count_name, share_name, change).alias("__row"))
    # The generator keeps the filter from being pushed into one branch only.
    changes = changes.select(F.explode_outer(F.array("__row")).alias("__row"))
    return changes.where(F.col("__row")[entity].isNotNull()).select("__row.*")


def change_text(change: Column) -> Column:
    """Display text of a change, ``N/A`` where there is none."""
    return F.coalesce(change.cast("string"), F.lit("N/A"))


def mine_common_patterns(df: DataFrame, outer: str, keys: Sequence[str], k: int) -> DataFrame:
    """The key combinations with the ``k`` highest shares within each ``outer`` value.

    Shares are fractions rounded to 2 digits before ranking, so many combinations can tie. Rows
    without an ``outer`` value are left out.
    """
    counts = count_by(df.where(F.col(outer).isNotNull()), [outer, *keys])
    share = ratio(F.col("cnt"), F.col("total"))
    return rank_counts(counts, outer, k, share, rank_by_share=True).select(
        outer, *keys, "percentage", "ranking"
    )


def arrival_schedule(df: DataFrame, time: Column) -> DataFrame:
    """Minutes of the day that hold rows and the gap to the next such minute (null for the last).

    The minute is taken from ``time``, so there are at most 1,440, which is all the window ever
    sees. Rows without a time give one row with a null minute and no gap.
    """
    buckets = df.select(minute_of_day(time).alias("bucket")).distinct()
    following = F.lead("bucket").over(Window.orderBy(F.asc_nulls_last("bucket")))
    return buckets.select("bucket", (following - F.col("bucket")).alias("gap"))
