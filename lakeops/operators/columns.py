"""Column selection, casting, renaming and cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from lakeops.functions.coding import int_sql, to_int

# Survey codes that stand for "refused", "unknown" and "suppressed".
SENTINELS = (9, 99, 999, 9999)


def select_cast(df: DataFrame, columns: Sequence[str], type_name: str = "int") -> DataFrame:
    """Only ``columns``, cast to one type; values that do not cast become null."""
    if type_name == "int":
        return df.select(*[to_int(df, c).alias(c) for c in columns])
    return df.select(*[F.col(f"`{c}`").try_cast(type_name).alias(c) for c in columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns in one projection; names absent from the frame are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def drop_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Drop every column whose name starts with one of ``prefixes``."""
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def blank_negative(df: DataFrame) -> DataFrame:
    """Null in place of every negative number, in one projection; other columns untouched."""

    def cleaned(field):
        value = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, NumericType):
            return value
        return F.when(value >= 0, value).alias(field.name)

    return df.select(*[cleaned(field) for field in df.schema])


def _unusable_counts(df: DataFrame, sentinels: Sequence[int]) -> list[Column]:
    # As SQL text, which takes one call into the JVM per column of a wide table. A value that is
    # no number, NaN included, counts through the first sentinel.
    codes = ", ".join(str(code) for code in sentinels)
    return [
        F.expr(f"count_if(coalesce({int_sql(field)}, {sentinels[0]}) IN ({codes}))").alias(field.name)
        for field in df.schema
    ]


def missing_profile(df: DataFrame, sentinels: Sequence[int] = SENTINELS) -> DataFrame:
    """One row: for each column the number of rows without a usable value.

    Unusable are sentinels, NaN, null and anything that is not a number. All columns are counted
    in one scan and one aggregate.
    """
    return df.agg(*_unusable_counts(df, sentinels))


def sparse_columns(
    df: DataFrame, limit: float = 0.9, sentinels: Sequence[int] = SENTINELS
) -> list[str]:
    """Names of the columns unusable in at least ``int(limit * rows)`` rows, from one job."""
    counted = df.agg(F.count("*").alias("__rows"), *_unusable_counts(df, sentinels)).first()
    threshold = int(limit * counted[0])
    return [column for column, unusable in zip(df.columns, counted[1:]) if unusable >= threshold]


def drop_sparse_columns(
    df: DataFrame, limit: float = 0.9, sentinels: Sequence[int] = SENTINELS
) -> DataFrame:
    """The frame without its sparse columns."""
    return df.drop(*sparse_columns(df, limit, sentinels))
