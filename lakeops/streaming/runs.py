"""Starting streams and writing their results so that a replay changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeops.sources.tables import write_jdbc

BatchSink = Callable[[DataFrame, int], None]


def run_stream(
    df: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    mode: str = "update",
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into a micro-batch sink.

    Runs until stopped, or over everything present when ``available_now`` is set. The number of
    shuffle partitions is fixed for the life of the checkpoint.
    """
    writer = df.writeStream.outputMode(mode).foreachBatch(sink)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def archive_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append every event to files, each exactly once across restarts."""
    writer = df.writeStream.outputMode("append").format(fmt)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def folder_sink(path: str, order_by: Sequence = ()) -> BatchSink:
    """Write micro-batch N to ``path/batch_id=N``, replacing what a failed attempt left there.

    For ``append`` output; see :func:`latest_sink` and :func:`upsert_sink` for the others.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.orderBy(*order_by) if order_by else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of an ``append`` stream written by :func:`folder_sink`."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _stored(rows: DataFrame, path: str, kind: str, slot: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/kind={kind}/slot={slot}")


def _publish(rows: DataFrame, path: str, slot: int, upto: int, order_by: Sequence = ()) -> None:
    """Write a whole result, then the single-file mark that makes readers use it."""
    ordered = rows.orderBy(*order_by) if order_by else rows
    _stored(ordered.withColumn("upto", F.lit(upto).cast("long")), path, "whole", slot)
    mark = rows.sparkSession.range(1).select(F.lit(upto).cast("long").alias("upto"))
    _stored(mark.coalesce(1), path, "mark", slot)


def _slots(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    added = StructType().add("batch_id", "long").add("upto", "long").add("kind", "string").add("slot", "integer")
    return spark.read.schema(StructType([*schema.fields, *added.fields])).parquet(path)


def _marked(rows: DataFrame) -> Column:
    """The last micro-batch whose whole result is complete, -1 before the first."""
    return F.coalesce(rows.where("kind = 'mark'").agg(F.max("upto")).scalar(), F.lit(-1))


def latest_sink(path: str, order_by: Sequence = (), keep: int = 2) -> BatchSink:
    """Sink for ``complete`` output that stores the ``keep`` newest results and nothing older.

    Results take turns in ``keep`` (at least 2) folders, so a replayed micro-batch replaces itself
    and never the result readers use. A reader may take as long as ``keep - 1`` micro-batches.
    Result columns must not be called ``batch_id``, ``upto``, ``kind`` or ``slot``.
    """
    if keep < 2:
        raise ValueError("the result in use and the one being written need two folders")

    def write(batch: DataFrame, batch_id: int) -> None:
        _publish(batch, path, batch_id % keep, batch_id, order_by)

    return write


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Newest complete result written by :func:`latest_sink`."""
    rows = _slots(spark, path, schema)
    return rows.where((F.col("kind") == "whole") & (F.col("upto") == _marked(rows))).select(*schema.names)


def _newest(rows: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Newest row of each key among the whole result in use and the changes since."""
    upto = _marked(rows)
    live = rows.where(
        ((F.col("kind") == "whole") & (F.col("upto") == upto))
        | ((F.col("kind") == "changes") & (F.col("batch_id") > upto))
    )
    latest = live.groupBy(*keys).agg(F.max_by(F.struct(*names, "batch_id"), "batch_id").alias("__row"))
    return latest.select("__row.*")


def upsert_sink(path: str, keys: Sequence[str], fold_every: int = 16) -> BatchSink:
    """Sink for ``update`` output whose folders and reading cost stay bounded.

    The changes of a micro-batch go to a folder of their own. Every ``fold_every`` micro-batches
    they are folded into one whole result. Folders of changes are used again after twice as many
    micro-batches, when their rows are long folded in; a replay replaces what it wrote before and
    reads only what was complete before it. Result columns: see :func:`latest_sink`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        _stored(changes, path, "changes", batch_id % (2 * fold_every))
        group, place = divmod(batch_id, fold_every)
        if place == fold_every - 1:
            # What an earlier attempt at this fold left is not read, so its folder may be replaced.
            rows = _slots(batch.sparkSession, path, batch.schema)
            rows = rows.where((F.col("kind") == "changes") | (F.col("upto") < batch_id))
            _publish(_newest(rows, batch.columns, keys), path, group % 2, batch_id)

    return write


def read_upserted(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]
) -> DataFrame:
    """Newest row of each key written by :func:`upsert_sink`."""
    return _newest(_slots(spark, path, schema), schema.names, keys).select(*schema.names)


def append_once(
    read_batch: Callable[[SparkSession, int], DataFrame],
    write: Callable[[DataFrame], None],
    keys: Sequence[str],
) -> BatchSink:
    """Append sink for a store without atomic replacement, such as a database table.

    Rows get a ``batch_id``. ``read_batch`` returns what the store already holds of a micro-batch,
    normally nothing; after a crash in mid-write only the missing rows are added. ``keys`` must
    identify a row within its micro-batch.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        present = read_batch(batch.sparkSession, batch_id).select(
            *[F.col(f"`{k}`").alias(f"__{k}") for k in keys]
        )
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in keys]
        write(rows.join(present, same, "left_anti"))

    return sink


def jdbc_append_sink(
    url: str, table: str, properties: dict[str, str], keys: Sequence[str]
) -> BatchSink:
    """:func:`append_once` for a database table that has a ``batch_id`` column."""

    def read_batch(spark: SparkSession, batch_id: int) -> DataFrame:
        query = f"(SELECT * FROM {table} WHERE batch_id = {int(batch_id)}) present"
        return spark.read.jdbc(url=url, table=query, properties=properties)

    return append_once(
        read_batch, lambda rows: write_jdbc(rows, url, table, properties, mode="append"), keys
    )


def jdbc_replace_sink(url: str, table: str, properties: dict[str, str]) -> BatchSink:
    """Sink for ``complete`` output: the table holds the newest result and nothing older."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(
            batch.withColumn("batch_id", F.lit(batch_id).cast("long")), url, table, properties
        )

    return sink
