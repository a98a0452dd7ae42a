"""Event streams and their JSON payload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "complaints",
    starting: str = "earliest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of the messages of a topic (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
        .load()
    )


def write_kafka(
    messages: DataFrame, servers: str, topic: str = "complaints", options: Mapping[str, str] | None = None
) -> None:
    """Send column ``value`` of a batch frame to a topic, one message per row."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_trigger: int = 1000,
    glob: str | None = None,
) -> DataFrame:
    """Stream of the rows of the files that arrive below ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def _plain_text(value: Column, data_type: DataType) -> Column:
    """Text fields without the missing-value token a JSON writer left bare.

    A bare NaN reaches a text field as the five characters ``"NaN"`` or as three.
    """
    if not isinstance(data_type, StringType):
        return value
    return F.when(value.isin('"NaN"', "NaN"), F.lit(None)).otherwise(value)


def parse_json_events(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    corrupt: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Flat columns of the JSON text (or bytes) in column ``value``.

    Text that is not JSON gives a row of nulls, which is kept; ``corrupt`` names a column that
    then holds the text. Fields outside ``schema`` are ignored and missing-value tokens are null.
    ``columns`` limits parsing to the fields a query needs.

    The text is parsed by a generator, because filters on parsed fields would otherwise be moved
    below the projection with a copy of the parser for every field they mention.
    """
    wanted = [f for f in schema.fields if columns is None or f.name in columns]
    target, options = StructType(wanted), {}
    if corrupt is not None:
        target = StructType([*wanted, StructField(corrupt, StringType())])
        options = {"columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json(F.col(value).cast("string"), target, options)
    rows = df.select(F.inline_outer(F.array(parsed)))
    fields = [_plain_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in wanted]
    return rows.select(*fields, *([corrupt] if corrupt is not None else []))
