"""Running the complaint queries: from messages to a result folder, and reading the result.

Also making messages from complaint rows, for a feed that is replayed.

Any number of them can run in one session. Results default to ``update`` output, where a reader
takes the newest row of each key; ``complete`` keeps whole sorted results instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeops.functions.temporal import event_time, minute_of_day
from lakeops.operators.ranking import arrival_schedule
from lakeops.plans import complaints
from lakeops.plans.values import COMPLAINT_SCHEMA
from lakeops.sources.tables import publish_json, read_table
from lakeops.streaming import runs

def _minute() -> Column:
    return minute_of_day(event_time(F.col("CMPLNT_FR_TM")))


def outgoing_messages(rows: DataFrame) -> DataFrame:
    """Complaint rows as JSON messages, with the minute of the day as ``time_seconds``."""
    return publish_json(rows.withColumn("time_seconds", _minute()))


def sending_schedule(rows: DataFrame) -> DataFrame:
    """Minutes of the day with complaints to send and the wait until the next one."""
    return arrival_schedule(rows, event_time(F.col("CMPLNT_FR_TM")))


# Window queries: the function, what identifies a result row and the count it is sorted by.
WINDOW_QUERIES = {
    "complaints_per_hour_and_borough": (
        complaints.complaints_per_hour_and_borough, ("window_str", "boro_nm"), "complaints_count",
    ),
    "most_common_complaints": (
        complaints.most_common_complaints, ("window_str", "crime"), "complaints_count",
    ),
    "unsafest_boroughs": (
        complaints.unsafest_boroughs, ("window_start", "Borough"), "Felonies",
    ),
    "location_safety": (complaints.location_safety, ("window_str",), None),
}


def query_result(
    messages: DataFrame,
    name: str,
    patterns: DataFrame | None = None,
    mode: str = "update",
    watermark: str | None = None,
) -> DataFrame:
    """Result of a query over JSON messages, from a stream or a table."""
    events = complaints.parse_complaints(messages, name)
    if name == "save_to_lake":
        return complaints.archive_rows(events)
    if name == "uncommon_crimes":
        return complaints.uncommon_crimes(events, patterns)
    function, _, count = WINDOW_QUERIES[name]
    result = function(events, watermark=watermark)
    return complaints.in_order(result, count) if mode == "complete" else result


def result_schema(
    messages: DataFrame, name: str, mode: str = "update", watermark: str | None = None
) -> StructType:
    """Schema of :func:`query_result`; no patterns are read or measured for it."""
    if name == "uncommon_crimes":
        return complaints.UNCOMMON_SCHEMA
    return query_result(messages, name, mode=mode, watermark=watermark).schema


def start_query(
    messages: DataFrame,
    name: str,
    out: str,
    checkpoint: str,
    patterns: DataFrame | Callable[[], DataFrame] | None = None,
    mode: str = "update",
    watermark: str | None = None,
    available_now: bool = False,
    sink: runs.BatchSink | None = None,
    every: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start one query on a stream of messages; its result goes below ``out``.

    ``sink`` writes elsewhere instead, such as a database (:func:`runs.jdbc_append_sink`,
    :func:`runs.jdbc_replace_sink`). ``patterns`` as a function is called anew in every micro-batch;
    as a frame they are measured once, and the stream keeps the way of joining chosen at its start.
    ``every`` is the trigger interval; ``fmt`` and ``partition_by`` belong to the archive.
    """
    if name == "save_to_lake":
        if sink is not None:
            raise ValueError("the archive is written by the file sink alone")
        result = query_result(messages, name)
        return runs.archive_stream(result, out, checkpoint, fmt, partition_by, available_now, every)
    if name == "uncommon_crimes":
        mode = "append"
    sink = sink or _default_sink(name, out, mode)
    if callable(patterns):
        result = complaints.parse_complaints(messages, name)
        sink = complaints.uncommon_crimes_sink(patterns, sink)
    else:
        result = query_result(messages, name, patterns, mode, watermark)
    return runs.run_stream(result, sink, checkpoint, mode, available_now, every, name)


def _default_sink(name: str, out: str, mode: str) -> runs.BatchSink:
    if mode == "append":
        return runs.folder_sink(out)
    _, keys, count = WINDOW_QUERIES[name]
    if mode == "complete":
        order = "window_start" if "window_start" in keys else "window_str"
        return runs.latest_sink(out, [order, *([F.desc(count)] if count else [])])
    return runs.upsert_sink(out, keys)


def read_result(
    spark: SparkSession, name: str, out: str, schema: StructType, mode: str = "update", fmt: str = "parquet"
) -> DataFrame:
    """What a query has written so far; ``schema`` is :func:`result_schema`."""
    if name == "save_to_lake":
        return read_table(spark, out, fmt, schema=COMPLAINT_SCHEMA)
    if name == "uncommon_crimes" or mode == "append":
        return runs.read_appended(spark, out, schema)
    if mode == "complete":
        return runs.read_latest(spark, out, schema)
    return runs.read_upserted(spark, out, schema, WINDOW_QUERIES[name][1])
