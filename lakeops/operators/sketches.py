"""Approximate distinct counts and quantiles that can be stored and merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Registers of a distinct count are 2 to this power; its relative standard error is 1.04 / 2^(power / 2).
LOG_REGISTERS = 12
# Size parameter of a quantile sketch; its rank error is about 1.65 %.
QUANTILE_SIZE = 200


def sketch(
    df: DataFrame,
    keys: Sequence[str | Column],
    distinct: str,
    number: str,
    log_registers: int = LOG_REGISTERS,
    quantile_size: int = QUANTILE_SIZE,
) -> DataFrame:
    """Per key the number of rows ``n``, a sketch of the different ``distinct`` values and one of the ``number`` s.

    Sketches are a few kilobytes, however many rows they stand for, and are combined before they
    are shuffled. Nulls (and NaN among the numbers) are left out of them; ``n`` counts all rows.
    Store the result, for example one row per day, and merge rows with :func:`merged`.
    """
    value = F.col(f"`{number}`").cast("double")
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.hll_sketch_agg(f"`{distinct}`", log_registers).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.when(~F.isnan(value), value), quantile_size).alias("number_sketch"),
    )


def merged(sketches: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """Sketches of coarser keys, or of all rows, from stored ones. No raw row is read again."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch").alias("number_sketch"),
    )


def estimates(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """The distinct count ``n_distinct`` and the named quantiles (null without numbers) of each row's sketches."""
    some = F.kll_sketch_get_n_double("number_sketch") > 0
    values = {
        name: F.when(some, F.kll_sketch_get_quantile_double("number_sketch", F.lit(float(share))))
        for name, share in quantiles.items()
    }
    named = {"n_distinct": F.hll_sketch_estimate("distinct_sketch"), **values}
    return sketches.withColumns(named).drop("distinct_sketch", "number_sketch")
