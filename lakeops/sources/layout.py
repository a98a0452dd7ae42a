"""Tables laid out for the reads they are meant for: partitioned folders and bucketed files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import shared_dir
from lakeops.sources.tables import read_table


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = 5_000_000, mode: str = "error"
) -> None:
    """Parquet in one folder per value of ``by``, so that a filter on them reads their folders alone.

    Rows are brought together by folder first, which keeps the number of files small; the rebalance
    splits a folder that holds a large part of the rows, and ``rows_per_file`` bounds a file.
    """
    together = df.hint("rebalance", *[F.col(f"`{c}`") for c in by])
    together.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, by: Sequence[str], buckets: int, name: str | None = None, path: str | None = None) -> str:
    """Save a table in ``buckets`` sorted files by the hash of ``by``, and return its name.

    Tables with the same keys and number of buckets join and group by these keys without an exchange or
    a sort. Each bucket is written by one task as one file; size them for the largest bucket, as a hot key
    stays in one (join a side with a hot key by :func:`lakeops.operators.joins.join_dimension`).
    """
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    path = path or shared_dir(df.sparkSession, name)
    columns = [F.col(f"`{c}`") for c in by]
    dealt = df.repartition(buckets, *columns)
    dealt.write.option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return name


def read_partition(spark: SparkSession, path: str, **values) -> DataFrame:
    """Rows of the folders that hold these values; files of other folders are not read."""
    rows = read_table(spark, path)
    for column, value in values.items():
        rows = rows.where(F.col(f"`{column}`") == F.lit(value))
    return rows
