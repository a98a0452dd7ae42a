"""Group counts, shares, indexes and scores.

Every operator counts the raw rows once with map-side combining and works on the counts from
there, so a key held by a large part of all rows never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.numbers import ratio
from lakeops.operators.joins import join_groups


def count_by(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """Rows per combination of ``keys``."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def share_of_total(
    df: DataFrame, key: str, share_name: str = "percentage", scale: float = 100.0
) -> DataFrame:
    """Share of all rows held by each value of ``key``, null included."""
    counts = count_by(df, [key])
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select(key, ratio(F.col("cnt"), total, scale).alias(share_name))


def conditional_share(
    df: DataFrame, key: str, predicate: Column, share_name: str = "percentage"
) -> DataFrame:
    """Percentage of each group's rows that meet ``predicate``.

    Groups without a hit and the null group do not appear.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_if(predicate).alias("hits"), F.count("*").alias("cnt"))
        .where("hits > 0")
        .select(key, ratio(F.col("hits"), F.col("cnt"), 100.0).alias(share_name))
    )


def value_stats(df: DataFrame, key: str, value: Column, names: Sequence[str]) -> DataFrame:
    """Average, minimum and maximum of the positive values of each group."""
    average, low, high = names
    return (
        df.select(key, value.alias("__value"))
        .where("__value > 0")
        .groupBy(key)
        .agg(
            F.avg("__value").alias(average),
            F.min("__value").alias(low),
            F.max("__value").alias(high),
        )
    )


def weighted_code_score(
    df: DataFrame, columns: Sequence[str], name: str = "question", score_name: str = "score"
) -> DataFrame:
    """Per column: sum over its answers of (1 / answer) * (share of the non-null answers).

    Low codes weigh more. The columns are stacked in one scan; an answer of 0 adds nothing to the
    sum but counts as an answer.
    """
    answers = df.select(*columns).unpivot([], list(columns), name, "__answer")
    counts = count_by(answers.where("__answer IS NOT NULL"), [name, "__answer"])
    totals = counts.groupBy(name).agg(F.sum("cnt").alias("__total"))
    part = F.try_divide(F.lit(1.0), F.col("__answer")) * ratio(F.col("cnt"), F.col("__total"), digits=None)
    return (
        join_groups(counts, totals, [name], nulls_match=False)
        .groupBy(name)
        .agg(F.round(F.sum(part), 2).alias(score_name))
    )


def share_index(
    df: DataFrame, group: str, category: str, index_name: str = "share_index", total_name: str = "cnt"
) -> DataFrame:
    """How over-represented a group is in a category: share there / share overall.

    The overall share is rounded to 2 digits before dividing, and an overall share of 0.00 gives
    null. A null category appears once, without group and index. ``total_name`` holds the size
    of the category, for ordering.
    """
    counts = count_by(df, [category, group], "__cnt")
    everyone = counts.agg(F.sum("__cnt")).scalar()
    overall = counts.groupBy(group).agg(ratio(F.sum("__cnt"), everyone).alias("__overall"))
    sizes = counts.groupBy(category).agg(F.sum("__cnt").alias(total_name))
    # Null-safe joins keep all three branches on one scan; what a null may not match is blanked.
    joined = join_groups(join_groups(counts, sizes, [category]), overall, [group])
    inside = ratio(F.col("__cnt"), F.col(total_name), digits=None)
    index = F.when(F.col(group).isNotNull(), F.round(F.try_divide(inside, F.col("__overall")), 2))
    known = F.col(category).isNotNull()
    return joined.select(
        category,
        F.when(known, F.col(group)).alias(group),
        F.when(known, index).alias(index_name),
        total_name,
    ).distinct()


def most_frequent(
    counts: DataFrame, keys: Sequence[str], value: str, count_name: str = "cnt"
) -> DataFrame:
    """The most frequent value(s) of each key combination; ties give several rows.

    Takes counts per ``keys + [value]``. Key combinations holding a null have no entry.
    """
    known = counts.na.drop(subset=list(keys))
    top = known.groupBy(*keys).agg(F.max(count_name).alias(count_name))
    return known.join(top, on=[*keys, count_name]).select(*keys, value)
