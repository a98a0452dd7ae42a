"""Joins whose strategy depends on a measured size, and null-safe joins of aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _width(field: StructField) -> Column:
    """Bytes of a value: as they are of text, as text of nested values, a fixed number of others."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(column.cast("string")), F.lit(0))
    return F.lit(8)


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether a batch frame is measured to be small enough to send to every executor.

    One aggregate counts rows and their bytes in all tasks side by side; only its sums are moved.
    """
    width = reduce(lambda a, b: a + b, map(_width, df.schema.fields), F.lit(0))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size + 16 * rows * len(df.columns) <= max_bytes


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    ignore_case: Sequence[str] = (),
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = 8,
) -> DataFrame:
    """Left, inner or left-anti join of facts to a dimension on ``{fact column: dimension column}``.

    A dimension measured to be small is broadcast. A larger one is joined by a sorted merge. There a key
    (or null) held by a large part of the facts would fill one task: in a batch, adaptive execution
    splits such a partition; a stream has no adaptive execution, so its rows are spread over
    ``salts`` copies of the dimension. All ways give the same rows.

    Columns in ``ignore_case`` compare without regard to letter case. Facts may come from a
    stream; the dimension is a batch frame, best a stored one as it is measured first.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    right = dimension
    if how == "left_anti":
        # Only the existence of a key matters.
        keys = [
            (F.lower(F.col(f"`{c}`")) if left in ignore_case else F.col(f"`{c}`")).alias(c)
            for left, c in on.items()
        ]
        right = dimension.select(*keys).na.drop()
    position = {c: f"__dim_{i}" for i, c in enumerate(right.columns)}
    right = right.withColumnsRenamed(position)

    def same(left: str, other: str) -> Column:
        a, b = F.col(f"`{left}`"), F.col(position[other])
        return F.lower(a) == F.lower(b) if left in ignore_case else a == b

    condition = reduce(lambda a, b: a & b, [same(left, other) for left, other in on.items()])
    once = right.distinct() if how == "left_anti" else right
    if fits_broadcast(once, max_rows, max_bytes):
        joined = facts.join(F.broadcast(once), condition, how)
    elif facts.isStreaming:
        joined = _salted_join(facts, once, condition, how, salts)
    else:
        # Repeated keys stay in, as an aggregate below the join would keep hot keys from splitting.
        joined = facts.join(right.hint("merge"), condition, how)
    if how == "left_anti":
        return joined
    return joined.withColumnsRenamed({v: k for k, v in position.items()})


def _salted_join(
    facts: DataFrame, right: DataFrame, condition: Column, how: str, salts: int
) -> DataFrame:
    # The partition id spreads exact copies of a row too; both parts survive a task retry.
    row = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns], F.spark_partition_id())
    spread = facts.withColumn("__salt", F.pmod(row, F.lit(salts)).cast("int"))
    copies = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = condition & (F.col("__salt") == F.col("__copy"))
    return spread.join(copies.hint("merge"), salted, how).drop("__salt", "__copy")


def join_groups(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", nulls_match: bool = True
) -> DataFrame:
    """Equi join of two aggregates on shared key columns, keeping one copy of each key.

    With ``nulls_match`` a null key finds the null key of the other side.
    """
    if not nulls_match:
        return left.join(right, on=list(keys), how=how)
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b,
        [F.col(f"`{key}`").eqNullSafe(F.col(f"`__right_{key}`")) for key in keys],
    )
    return left.join(renamed, condition, how).drop(*[f"__right_{key}" for key in keys])
