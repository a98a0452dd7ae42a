"""Assignment of labels by weight, repeatable for a given seed and row key."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.numbers import uniform


def cumulative_weights(
    df: DataFrame, columns: Sequence[str], scale: float = 100.0, compat: bool = False
) -> DataFrame:
    """Replace weights by their running sums in [0, 1], in the order of ``columns``.

    A null weight counts as 0. With ``compat`` each step divides the carried sum by ``scale`` once
    more and the sums are added up again, and a null weight blanks all later ones.
    """
    weights = [F.col(f"`{c}`") for c in columns]
    if compat:
        carried = accumulate(weights[1:], lambda acc, w: (acc + w) / scale, initial=weights[0] / scale)
        weights = [F.coalesce(w, F.lit(0.0)) for w in carried]
    else:
        weights = [F.coalesce(w, F.lit(0)) / scale for w in weights]
    sums = accumulate(weights, lambda a, b: a + b)
    return df.withColumns(dict(zip(columns, sums)))


def weighted_label(
    labels: Sequence[str],
    limits: Sequence[Column],
    draws: Sequence[Column],
    explore: float = 0.1,
) -> Column:
    """Label picked by three uniform draws: whether to explore, which label then, and the wheel.

    With probability ``explore`` any label is equally likely. Otherwise the first label whose
    cumulative limit reaches the third draw wins, and the last label takes the remainder.
    """
    choose, which, wheel = draws
    position = F.floor(which * len(labels)).cast("int")
    any_label = F.element_at(F.array(*[F.lit(label) for label in labels]), position + 1)
    picked = F.lit(labels[-1])
    for label, limit in reversed(list(zip(labels[:-1], limits))):
        picked = F.when(wheel <= limit, F.lit(label)).otherwise(picked)
    return F.when(choose <= explore, any_label).otherwise(picked)


def draw_columns(seed: int, key: Sequence[str]) -> list[Column]:
    """Three independent uniform draws per row.

    They depend on the seed and on ``key`` alone, the columns that identify a row, so a retry, a
    join or a repartition changes none of them.
    """
    if not key:
        raise ValueError("draws need the columns that identify a row")
    return [uniform(seed, *[F.col(f"`{c}`") for c in key], draw=i) for i in range(3)]


def weighted_assign(
    df: DataFrame,
    weights: dict[str, str],
    name: str,
    seed: int,
    key: Sequence[str],
    explore: float = 0.1,
) -> DataFrame:
    """Add column ``name`` with a label drawn by ``{label: column of cumulative weight}``."""
    limits = [F.col(f"`{c}`") for c in weights.values()]
    label = weighted_label(list(weights), limits, draw_columns(seed, key), explore)
    return df.withColumn(name, label)
