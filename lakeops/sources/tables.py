"""Batch tables: reading, naming, writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
) -> DataFrame:
    """A table of a lake zone: Parquet, or CSV/TSV text with a header.

    Text without a schema is read as strings, which costs no pass over the files; ``infer`` asks
    for the extra pass.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=header, sep=sep, inferSchema=infer and schema is None)
    return reader.load(path)


def read_event_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """An event file with a leading unnamed index column, which is dropped."""
    df = read_table(spark, path, "csv", schema)
    return df.drop("Unnamed: 0", "_c0")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL text."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; frames given by name are referred to as ``{name}`` and need no view."""
    return spark.sql(text, **frames)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return (df.orderBy(*order) if order else df).limit(n)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    header: bool = True,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write a frame once; text files carry a header so they read back with their names."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    mode: str = "overwrite",
    connections: int = 8,
) -> None:
    """Replace (or extend) a database table with a report.

    Credentials and driver come with ``properties``. Overwriting empties the table instead of
    dropping it, and at most ``connections`` tasks write at a time.
    """
    (
        df.write.mode(mode)
        .option("truncate", True)
        .option("numPartitions", connections)
        .option("batchsize", 10_000)
        .jdbc(url=url, table=table, properties=properties)
    )


def publish_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON message in column ``value``; nulls are kept as JSON nulls."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
