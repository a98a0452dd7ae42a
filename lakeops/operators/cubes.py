"""Totals over many groupings at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def grouping_totals(
    df: DataFrame,
    keys: Sequence[str],
    sets: Sequence[Sequence[str]] | str = "cube",
    count_name: str = "cnt",
    sums: Mapping[str, str] | None = None,
    id_name: str = "grouping_id",
) -> DataFrame:
    """Row counts and sums for every grouping in ``sets``: ``"cube"``, ``"rollup"`` or lists of keys.

    Keys a grouping leaves out are null; ``grouping_id`` has a bit for each of them, the first key's
    the highest, and so tells them from keys that are null in the data. ``sums`` maps result names to
    number columns. A grouping listed twice gives its rows once.

    Rows are counted once by all keys, combined before they are shuffled. Only those counts are
    multiplied for the groupings, so the cost of a cube grows with the different key
    combinations, not with the rows, and a hot key stays one row.
    """
    sums = dict(sums or {})
    counts = df.groupBy(*keys).agg(
        F.count("*").alias(count_name), *[F.sum(f"`{column}`").alias(name) for name, column in sums.items()]
    )
    columns = [F.col(f"`{k}`") for k in keys]
    if sets == "cube":
        grouped = counts.cube(*columns)
    elif sets == "rollup":
        grouped = counts.rollup(*columns)
    else:
        once = dict.fromkeys(tuple(k for k in keys if k in some) for some in sets)
        unknown = {k for some in sets for k in some} - set(keys)
        if unknown:
            raise ValueError(f"groupings over unknown keys: {sorted(unknown)}")
        grouped = counts.groupingSets([[F.col(f"`{k}`") for k in some] for some in once], *columns)
    return grouped.agg(
        F.grouping_id().cast("long").alias(id_name),
        *[F.sum(name).alias(name) for name in (count_name, *sums)],
    )
